"""Monthly rollups that follow the increments.

Every micro-batch of new daily rows becomes one folder of facts and one folder of partial
rollup states; the rollup is the sum of the states.  A batch's folders are named by its
epoch and overwritten when it is retried, and its duplicate check leaves its own epoch out,
so a retry at any point gives the same tables.  ``compact`` adds the states of finished
batches up into one folder; readers take the newest whole one and the batches after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens.operators import aggregates as agg
from fundlens.sources.files import as_text, conform
from fundlens.streaming.ingest import Ingested


def _folders(spark: SparkSession, path: str) -> dict[int, str]:
    """Finished folders ``<name>=<number>`` under ``path`` by number."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return {}
    found = {}
    for s in fs.listStatus(p):
        sub = s.getPath()
        if s.isDirectory() and "=" in sub.getName() and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(sub, "_SUCCESS")):
            found[int(sub.getName().split("=")[1])] = sub.toString()
    return found


def _read(spark: SparkSession, folders: Sequence[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def ingest_with_rollup(spark: SparkSession, landing: str, root: str, schema: T.StructType, checkpoint: str,
                       key: str = "fund_id", date_col: str = "nav_date", fmt: str = "csv") -> Ingested:
    """Take in what has landed (available now) and bring the rollup states up to date.

    Rows that do not conform go to ``root/quarantine``; rows that repeat a (key, date) of an
    earlier batch are dropped, of one batch the least by the other columns stays.  The
    duplicate check reads the keys of the days the batch spans.
    """
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    reader = spark.readStream.schema(text if fmt == "csv" else schema).format(fmt)
    stream = (reader.option("header", True) if fmt == "csv" else reader).load(landing)
    names, keys = [f.name for f in schema.fields], [key, date_col]
    others = [n for n in names if n not in keys]
    total = {"appended": 0, "quarantined": 0}

    def take_in(batch: DataFrame, epoch: int) -> None:
        good, bad = conform(as_text(batch), schema)
        bad.write.mode("overwrite").parquet(f"{root}/quarantine/batch={epoch}")
        fresh = good.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row")).select(*keys, "_row.*").select(*names)
        lo, hi = fresh.agg(F.min(date_col), F.max(date_col)).first()
        earlier = [path for n, path in _folders(spark, f"{root}/facts").items() if n != epoch]
        if earlier and lo is not None:
            seen = _read(spark, earlier, schema).where(F.col(date_col).between(lo, hi)).select(*keys)
            fresh = fresh.join(seen, keys, "left_anti")
        facts = f"{root}/facts/batch={epoch}"
        fresh.write.mode("overwrite").parquet(facts)
        new = spark.read.schema(schema).parquet(facts)
        agg.rollup_states(new, key, date_col).write.mode("overwrite").parquet(f"{root}/states/batch={epoch}")
        total["appended"] += new.count()
        total["quarantined"] += spark.read.schema(bad.schema).parquet(f"{root}/quarantine/batch={epoch}").count()

    q = (stream.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return Ingested(**total)


def states(spark: SparkSession, root: str, schema: T.StructType, key: str = "fund_id", date_col: str = "nav_date") -> DataFrame:
    """Merged states of every batch so far."""
    shape = agg.rollup_states(spark.createDataFrame([], schema), key, date_col).schema
    whole = _folders(spark, f"{root}/compacted")
    upto = max(whole, default=-1)
    parts = [path for n, path in _folders(spark, f"{root}/states").items() if n > upto] + ([whole[upto]] if whole else [])
    return agg.merge_states(_read(spark, sorted(parts), shape), key)


def current_rollup(spark: SparkSession, root: str, schema: T.StructType, dim: DataFrame | None = None, key: str = "fund_id",
                   date_col: str = "nav_date", class_col: str = "asset_class") -> DataFrame:
    """``monthly_rollup`` of all rows taken in, from the states alone."""
    return agg.finish_states(states(spark, root, schema, key, date_col), dim, key, class_col)


def compact(spark: SparkSession, root: str, schema: T.StructType, key: str = "fund_id", date_col: str = "nav_date") -> int | None:
    """Add the states of all finished batches up into one folder; returns the last batch in it."""
    done = _folders(spark, f"{root}/states")
    if not done:
        return None
    states(spark, root, schema, key, date_col).write.mode("overwrite").parquet(f"{root}/compacted/upto={max(done)}")
    return max(done)
