"""Incremental daily ingestion with Structured Streaming.

New files landing in a folder are picked up exactly once (the file source
records them in the checkpoint), conformed, de-duplicated on the table's
unique key inside the batch and against the target (left anti join), then
appended.  A retried micro-batch re-applies the anti join, so the append is
idempotent.  ``trigger(availableNow=True)`` processes what has landed and
stops: the daily batch cadence, restartable at any point.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens.sources.files import as_text as fs_text
from fundlens.sources.files import conform


class Ingested(NamedTuple):
    appended: int
    quarantined: int


def _ensure_target(spark: SparkSession, target: str, schema: T.StructType,
                   partition_col: str | None) -> None:
    """Create the empty table on a first run; any other fault of the target is left to surface."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        w = spark.createDataFrame([], schema).write.mode("append")
        (w.partitionBy(partition_col) if partition_col else w).parquet(target)


def ingest_incremental(spark: SparkSession, landing: str, target: str, schema: T.StructType,
                       checkpoint: str, key: Sequence[str], quarantine: str,
                       fmt: str = "csv", glob: str | None = None,
                       partition_col: str | None = None) -> Ingested:
    """Run one available-now pass; returns the rows appended and the rows quarantined.

    Rows that do not conform go to ``quarantine/batch=<id>``, overwritten when a batch is
    retried.  Rows of one batch that share a key are one row, the least by its other
    columns.  With ``partition_col`` (a column the key determines, e.g. the event day)
    the target is partitioned by it and each batch reads only the partitions it touches
    for the duplicate check, instead of every key ever loaded.
    """
    text_schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    _ensure_target(spark, target, schema, partition_col)
    reader = spark.readStream.schema(text_schema if fmt == "csv" else schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = reader.load(landing)
    total = {"appended": 0, "quarantined": 0}
    keys = list(key)
    others = [f.name for f in schema.fields if f.name not in keys]

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        good, bad = conform(fs_text(batch), schema)
        held = f"{quarantine}/batch={epoch_id}"
        bad.write.mode("overwrite").parquet(held)
        total["quarantined"] += spark.read.schema(bad.schema).parquet(held).count()
        fresh = (good.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row"))
                 .select(*keys, "_row.*").select(*[f.name for f in schema.fields]).cache())
        existing = spark.read.schema(schema).parquet(target)
        if partition_col:
            existing = existing.join(fresh.select(partition_col).distinct(), partition_col, "left_semi")
        new_rows = fresh.join(existing.select(*keys), keys, "left_anti").cache()
        n = new_rows.count()
        if n:
            w = new_rows.write.mode("append")
            (w.partitionBy(partition_col) if partition_col else w).parquet(target)
        new_rows.unpersist()
        fresh.unpersist()
        total["appended"] += n

    q = (stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return Ingested(**total)
