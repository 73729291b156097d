"""Shared helpers: scratch tables in the shared checkpoint folder and table access."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.session import scratch_path

T = TypeVar("T")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark removes the shuffle files of a finished query at once instead of with the next collection.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (cuts lineage).

    With ``tidy`` the write's shuffle files go when it ends; ``df`` itself may be run again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, str(tidy).lower() if before == "false" else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the scratch table that ``materialise`` wrote; nothing may read it any more."""
    files = df.inputFiles()
    if files:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def tasks(df: DataFrame) -> int:
    """Partition count for exchanges dealt by ``repartition`` with a number."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept for evaluation: crc32 of the id as text is a multiple of five."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _worker_slot() -> dict[str, tuple]:
    return sys.modules.setdefault("fundlens_worker_cache", types.ModuleType("fundlens_worker_cache")).__dict__


def worker_cache(slot: str, key: str, make: Callable[[], T]) -> T:
    """The worker's object for (slot, key), made anew when either has changed; it lives as long as the Python worker.

    Functions that travel by value get fresh module globals with every task; a module
    entry of its own outlives them.  A worker holds one object in all, so what one operator
    kept is gone when the next one starts.
    """
    kept = _worker_slot()
    if kept.get("held", (None,))[0] != (slot, key):
        worker_free()
        kept["held"] = ((slot, key), make())
    return kept["held"][1]


def worker_free() -> None:
    """Let go of what an operator before kept in this worker."""
    _worker_slot().pop("held", None)
