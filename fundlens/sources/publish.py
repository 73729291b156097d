"""Loading all tables of a run or none.

A run writes its tables into a folder of its own and counts what was written; one small
manifest file then makes them current.  Manifests are numbered and never changed: a new one
is written aside and renamed to the next number, which fails if another run took it.
Readers follow the newest manifest, so they see the tables of one run, whole, whatever
happens to the runs after it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.operators.joins import orphan_keys
from fundlens.sources.files import LOAD_ORDER, log_run


class NotPublished(RuntimeError):
    """A run that ended before its tables became current; the earlier ones still are."""


def _path(spark: SparkSession, *parts: str):
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def manifests(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all manifests, oldest first."""
    path, fs = _path(spark, root, "_manifests")
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())


def manifest(spark: SparkSession, root: str, number: int | None = None) -> dict | None:
    """The newest (or the given) manifest: run, run_date and, by table, folder and rows."""
    known = manifests(spark, root)
    if not known:
        return None
    path, _ = _path(spark, root, "_manifests", f"{number if number is not None else known[-1]:012d}.json")
    return json.loads("\n".join(r["value"] for r in spark.read.text(path.toString(), wholetext=True).collect()))


def read_current(spark: SparkSession, root: str, table: str, number: int | None = None) -> DataFrame:
    """A table of the current run (or of the manifest with the given number)."""
    m = manifest(spark, root, number)
    if m is None or table not in m["tables"]:
        raise LookupError(f"no run has published {table}")
    return spark.read.parquet(f"{root}/{m['tables'][table]['folder']}")


def stage(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, run: str) -> dict[str, dict]:
    """Write every table into the run's folder; rows are counted from the written files' footers.

    (An ``Observation`` would count during the write, but a session that has used one can no
    longer ship the closures of Spark's tree models.)
    """
    out = {}
    for name, df in tables.items():
        folder = f"_runs/{run}/{name}"
        df.write.mode("overwrite").parquet(f"{root}/{folder}")
        out[name] = {"folder": folder, "rows": spark.read.schema(df.schema).parquet(f"{root}/{folder}").count()}
    return out


def publish(spark: SparkSession, root: str, run: str, tables: Mapping[str, dict], run_date: str | None = None) -> int:
    """Make a run's tables current by one rename; tables it does not hold stay those of the run before."""
    known = manifests(spark, root)
    before = manifest(spark, root)["tables"] if known else {}
    number = known[-1] + 1 if known else 1
    aside, fs = _path(spark, root, "_manifests", f"{run}.tmp")
    target, _ = _path(spark, root, "_manifests", f"{number:012d}.json")
    body = json.dumps({"run": run, "run_date": run_date, "tables": {**before, **tables}})
    stream = fs.create(aside, True)
    stream.write(bytearray(body.encode()))
    stream.close()
    if fs.exists(target) or not fs.rename(aside, target):
        raise NotPublished(f"another run became number {number}")
    return number


def load_all(spark: SparkSession, sources: Mapping[str, DataFrame], root: str, run_date: str | None = None,
             pipeline: str = "daily_fund_ingestion") -> DataFrame:
    """All-or-nothing daily load; returns one row with the number of rows of each table.

    Every table is staged, the dimension first; the staged facts' keys are checked against the
    staged dimension; only then do the tables become current together.  Any failure on the way
    leaves the current tables as they were, is logged, and raises ``NotPublished``.
    """
    run = uuid.uuid4().hex[:12]
    order = [n for n in LOAD_ORDER if n in sources] + [n for n in sources if n not in LOAD_ORDER]
    try:
        staged = stage(spark, {n: sources[n] for n in order}, root, run)
        held = {n: spark.read.parquet(f"{root}/{t['folder']}") for n, t in staged.items()}
        if "fund_master" in held:
            orphans = {n: orphan_keys(df, held["fund_master"], "fund_id").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
                       for n, df in held.items() if n != "fund_master" and "fund_id" in df.columns}
            if any(orphans.values()):
                raise NotPublished(f"rows whose fund_id is missing from fund_master: {({n: r for n, r in orphans.items() if r})}")
        publish(spark, root, run, staged, run_date)
    except Exception as fault:
        log_run(spark, f"{root}/_run_log", pipeline, "Failed", run_date, {"run": run})
        if isinstance(fault, NotPublished):
            raise
        raise NotPublished(f"run {run} was not published: {str(fault).splitlines()[0][:200]}") from fault
    counts = {n: t["rows"] for n, t in staged.items()}
    log_run(spark, f"{root}/_run_log", pipeline, "Succeeded", run_date, counts)
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{n}_count long" for n in counts))


def retire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the folders of runs that none of the last ``keep`` manifests names; returns their runs.

    Staged folders of failed runs go too, so no load may be under way.
    """
    known = manifests(spark, root)[-keep:]
    used = {t["folder"].split("/")[1] for n in known for t in manifest(spark, root, n)["tables"].values()}
    path, fs = _path(spark, root, "_runs")
    gone = []
    for s in fs.listStatus(path) if fs.exists(path) else []:
        if s.getPath().getName() not in used:
            fs.delete(s.getPath(), True)
            gone.append(s.getPath().getName())
    return gone
