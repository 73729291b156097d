"""File sources and sinks, typed conformance, row counts, run log, full ingest.

Readers always take an explicit schema (never inferred).  Sinks overwrite or
append whole tables; a JDBC target is written with truncate + batch size.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens import schemas
from fundlens.operators.joins import orphan_keys

# Batch sizes of the daily load per table (fixed values of the ingest plan).
BATCH_SIZES = {"fund_master": 1000, "nav_daily": 5000, "cash_flows": 2000, "trades": 2000}
LOAD_ORDER = ["fund_master", "nav_daily", "cash_flows", "trades"]
FILE_NAMES = {"fund_master": "fund_master.csv", "nav_daily": "nav_daily.csv",
              "cash_flows": "cash_flows.csv", "trades": "trades.csv"}
SCHEMAS = {"fund_master": schemas.FUND_MASTER, "nav_daily": schemas.NAV_DAILY,
           "cash_flows": schemas.CASH_FLOWS, "trades": schemas.TRADES}
DEFAULTS = {"nav_daily": {"is_anomaly": 0}, "monthly_performance": {"anomaly_count": 0}}


def project_schema(schema: T.StructType, columns: Sequence[str]) -> T.StructType:
    """The declared fields named in ``columns``, in that order."""
    return T.StructType([schema[c] for c in columns])


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "csv", glob: str | None = None, date_format: str = "yyyy-MM-dd",
               header: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    """Read a table with an explicit schema; ``glob`` selects files by name, non-recursively.

    For delimited files ``columns`` names the file's columns in file order; the
    header is checked against them instead of being trusted by position.
    """
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(project_schema(schema, columns) if columns else schema)
    if fmt == "csv":
        r = (r.option("header", header).option("dateFormat", date_format)
             .option("mode", "PERMISSIVE").option("enforceSchema", not header))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.option("recursiveFileLookup", False).load(path)


def write_table(df: DataFrame, target: str, fmt: str = "parquet", mode: str = "overwrite",
                columns: Sequence[str] | None = None, partition_by: Sequence[str] | None = None,
                date_format: str = "yyyy-MM-dd") -> str:
    """Write a table (optionally only ``columns``), overwrite or append."""
    out = df.select(*columns) if columns else df
    w = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("dateFormat", date_format)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(target)
    return target


def as_text(df: DataFrame) -> DataFrame:
    """All columns as strings: what a delimited file carries."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def conform(df: DataFrame, schema: T.StructType,
            defaults: Mapping[str, object] | None = None) -> tuple[DataFrame, DataFrame]:
    """Cast text columns to ``schema``; rows that do not fit go to quarantine.

    Returns (good, bad).  Defaults fill nulls first.  A row is bad if a value does
    not convert or a NOT NULL column has none; ``bad`` keeps the raw text plus
    ``_errors``, the names of those columns.  A column missing from ``df`` raises.
    """
    tagged = tag(df, schema, defaults)
    good = tagged.filter(F.col("_errors").isNull()).select(*schema.fieldNames())
    return good, tagged.filter(F.col("_errors").isNotNull()).select("_raw.*", "_errors")


def tag(df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """The typed columns of every row; a row that does not fit also has ``_errors`` and its raw text as ``_raw``."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the source: {missing}")
    defaults = dict(defaults or {})

    def typed(f: T.StructField):
        c = F.col(f"_raw.{f.name}").try_cast(f.dataType)
        null = F.col(f"_raw.{f.name}").isNull()
        return F.coalesce(c, F.when(null, F.lit(defaults[f.name]).cast(f.dataType))) if f.name in defaults else c

    cast = df.select(F.struct(*df.columns).alias("_raw")).select("_raw", *[typed(f).alias(f.name) for f in schema.fields])
    faulty = [F.col(f.name).isNull() & (F.col(f"_raw.{f.name}").isNotNull() | F.lit(not f.nullable)) for f in schema.fields]
    names = F.array_compact(F.array(*[F.when(c, F.lit(f.name)) for c, f in zip(faulty, schema.fields)]))
    errors = F.when(reduce(Column.__or__, faulty), names)
    return cast.withColumn("_errors", errors).withColumn("_raw", F.when(F.col("_errors").isNotNull(), F.col("_raw")))


def load_table(df: DataFrame, target: str, batch_size: int | None = None,
               jdbc_url: str | None = None, properties: Mapping[str, str] | None = None,
               fmt: str = "parquet") -> str:
    """Truncate-and-load.  JDBC: TRUNCATE keeps the table definition; else overwrite files."""
    if jdbc_url:
        w = df.write.mode("overwrite").option("truncate", True)
        if batch_size:
            w = w.option("batchsize", batch_size)
        w.jdbc(jdbc_url, target, properties=dict(properties or {}))
        return target
    return write_table(df, target, fmt=fmt, mode="overwrite")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row with the row count of every table (each a scalar subquery)."""
    names = list(tables)
    first = tables[names[0]].agg(F.count(F.lit(1)).alias(f"{names[0]}_count"))
    return first.select(f"{names[0]}_count", *[
        tables[n].select(F.count(F.lit(1))).scalar().alias(f"{n}_count") for n in names[1:]])


def log_run(spark: SparkSession, target: str, pipeline: str, status: str,
            run_date: str | None = None, details: Mapping[str, int] | None = None) -> DataFrame:
    """Append one run record (pipeline, status, run time in UTC) to ``target``."""
    rec = spark.range(1).select(
        F.lit(pipeline).alias("pipeline_name"), F.lit(status).alias("status"),
        F.current_timestamp().alias("run_time"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd").alias("run_day"),
        F.lit(run_date).cast("date").alias("run_date"),
        F.lit(",".join(f"{k}={v}" for k, v in (details or {}).items())).alias("details"))
    rec.write.mode("append").parquet(target)
    return rec


def ingest_all(spark: SparkSession, sources: Mapping[str, DataFrame], target_root: str,
               run_date: str | None = None, pipeline: str = "daily_fund_ingestion",
               jdbc_url: str | None = None, properties: Mapping[str, str] | None = None
               ) -> DataFrame:
    """Daily full reload: dimension first, orphan check, facts, counts, run log.

    ``sources`` maps table name to its (conformed) DataFrame.  Facts whose
    fund_id has no dimension row fail the run before anything is loaded.
    Returns one row: the loaded counts next to the source counts.
    """
    run_date = run_date or dt.date.today().isoformat()
    dim = sources["fund_master"]
    rows = {name: orphan_keys(sources[name], dim, "fund_id").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
            for name in LOAD_ORDER[1:] if name in sources}
    failing = {name: n for name, n in rows.items() if n}
    if failing:
        log_run(spark, f"{target_root}/_run_log", pipeline, "Failed", run_date, failing)
        raise ValueError(f"rows whose fund_id is missing from fund_master: {failing}")
    loaded = {}
    for name in LOAD_ORDER:
        if name not in sources:
            continue
        tgt = f"{target_root}/{name}"
        load_table(sources[name], tgt, BATCH_SIZES.get(name), jdbc_url, properties)
        loaded[name] = tgt if jdbc_url else spark.read.parquet(tgt)
    counts = row_counts({n: (loaded[n] if isinstance(loaded[n], DataFrame)
                             else spark.read.jdbc(jdbc_url, loaded[n], properties=dict(properties or {})))
                         for n in loaded})
    src = row_counts({f"source_{n}": sources[n] for n in loaded})
    result = counts.select(
        "*", *[src.select(f"source_{n}_count").scalar().alias(f"source_{n}_count") for n in loaded])
    first = result.first()
    result = spark.createDataFrame([first], result.schema)      # the counted row: nothing is counted again
    status = "Succeeded" if all(first[f"{n}_count"] == first[f"source_{n}_count"] for n in loaded) \
        else "CountMismatch"
    log_run(spark, f"{target_root}/_run_log", pipeline, status, run_date,
            {n: first[f"{n}_count"] for n in loaded})
    return result.withColumn("status", F.lit(status))


def ingest_files(spark: SparkSession, landing_root: str, target_root: str,
                 run_date: str | None = None, names=LOAD_ORDER, **kw) -> DataFrame:
    """Daily load from delimited files: read each table's file by name as text,
    conform it to the declared schema (bad rows to ``_quarantine/<table>``,
    defaults applied), then ``ingest_all`` in dimension-first order.

    A landed file is read and conformed once, into ``_landed/<table>``; the quarantine, the orphan
    check, the load and the counts read the columns they need of that typed copy.
    """
    sources = {}
    for name in names:
        path, landed = f"{landing_root}/{FILE_NAMES[name]}", f"{target_root}/_landed/{name}"
        text = spark.read.option("header", True).csv(path)         # every column as text
        tagged = tag(text, SCHEMAS[name], DEFAULTS.get(name))
        tagged.write.mode("overwrite").parquet(landed)
        rows = spark.read.schema(tagged.schema).parquet(landed)
        rows.where("_errors IS NOT NULL").select("_raw.*", "_errors").write.mode("overwrite").parquet(f"{target_root}/_quarantine/{name}")
        sources[name] = rows.where("_errors IS NULL").select(*SCHEMAS[name].fieldNames())
    return ingest_all(spark, sources, target_root, run_date, **kw)
