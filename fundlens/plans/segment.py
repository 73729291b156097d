"""Fund segmentation: standardisation, k-means with restarts, cluster labelling."""

from __future__ import annotations

import math
import sys
import warnings
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlens.functions.scalars import fround
from fundlens.session import cut_lineage

# worker functions travel by value, so executors need no package install
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The feature columns of the segmentation
CLUSTER_FEATURES = ["avg_return", "return_vol", "avg_active_ret", "avg_sharpe", "avg_aum",
                    "total_anomalies", "consistency", "management_fee", "target_volatility"]

# Labelling rules, applied in this order; a later rule overwrites an earlier
# one for the same cluster.  Fixed values of the labelling scheme:
LABEL_RULES = [
    ("avg_return", "max", "High Growth"),
    ("avg_sharpe", "max", "Risk-Adjusted Leaders"),
    ("avg_aum_m", "max", "Large Cap Stable"),
    ("avg_anomalies", "max", "High Operational Risk"),
    ("avg_return", "min", "Underperformers"),
]


def standardise(df: DataFrame, cols: Sequence[str], places: int | None = 8) -> DataFrame:
    """(x - mean) / population std per column (std 0 -> 1), as plain columns.

    The statistics are one aggregate row, attached as a single scalar subquery.
    """
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                   *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])
    row = stats.select(F.struct(*[f"m_{c}" for c in cols],
                                *[F.when(F.col(f"s_{c}") == 0, 1.0).otherwise(F.col(f"s_{c}")).alias(f"s_{c}") for c in cols]))
    d = df.select("*", row.scalar().alias("_stats"))
    out = []
    for c in cols:
        z = (F.col(c).cast("double") - F.col(f"_stats.m_{c}")) / F.col(f"_stats.s_{c}")
        out.append((fround(z, places) if places is not None else z).alias(c))
    return d.select(*[c for c in df.columns if c not in cols], *out)


ROWS_PER_PARTITION = 200_000
SEED_ROWS = 20_000                  # rows that start centres are drawn from
MAX_ITER, TOL = 300, 1e-4


def _scaled(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, int]:
    """Rows with their standardised feature vector ``features``, partitioned by size for the passes; their number."""
    df = cut_lineage(df)                    # statistics, count and passes read the rows again
    z = standardise(df.select("*", *[F.col(c).alias(f"_z_{c}") for c in cols]), [f"_z_{c}" for c in cols], None)
    out = z.withColumn("features", F.array(*[F.col(f"_z_{c}") for c in cols])).drop(*[f"_z_{c}" for c in cols])
    n = df.count()
    return out.repartition(max(1, math.ceil(n / ROWS_PER_PARTITION))), n


@dataclass
class Fit:
    """Centres of one run, its sum of squares, the passes it took and whether it settled."""

    centres: np.ndarray
    cost: float
    passes: int
    settled: bool


def lloyd(data: DataFrame, starts: Mapping[str, np.ndarray], features: str = "features", max_iter: int = MAX_ITER,
          tol: float = TOL, rows: int | None = None) -> dict[str, Fit]:
    """K-means of several runs at once: every pass over the data serves all runs.

    ``starts`` gives each run's first centres (k x d).  A pass assigns every row to its nearest
    centre of every run (ties to the first) and adds rows up per run and centre inside the tasks,
    so one job is one iteration of all runs and brings k rows a run to the driver.  A centre
    without rows stays where it is.  A run has settled when its centres move by a squared
    distance of at most ``tol`` in all (0: not at all), and takes no part from then on; one that
    has not settled after ``max_iter`` passes says so.  Where ``rows``, the number of rows, is
    known to be at most ROWS_PER_PARTITION, one task holds them and makes all passes in one job.
    """
    if rows is not None and rows <= ROWS_PER_PARTITION and starts:
        return _passes_in_one_task(data, starts, features, max_iter, tol)
    at = {name: np.array(c, float) for name, c in starts.items()}
    done: dict[str, Fit] = {}
    for turn in range(max_iter + 1):
        if not at:
            break
        cost, moved = _pass(data, at, features)
        for name, c in list(at.items()):
            shift = float(((moved[name] - c) ** 2).sum())
            if shift <= tol or turn == max_iter:
                done[name] = Fit(c, cost[name], turn, shift <= tol)
                del at[name]
            else:
                at[name] = moved[name]
    return done


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of a batch; those with a null or non-finite component are left out."""
    rows = [r for r in vectors.to_pylist() if r is not None and None not in r]
    x = np.array(rows, float).reshape(len(rows), -1)
    return x[np.isfinite(x).all(1)] if len(x) else x


def _passes_in_one_task(data: DataFrame, starts: Mapping[str, np.ndarray], features: str, max_iter: int, tol: float) -> dict[str, Fit]:
    def settle(x: np.ndarray, c: np.ndarray) -> Fit:
        for turn in range(max_iter + 1):
            gap = ((x[:, None, :] - c[None]) ** 2).sum(2)
            near = gap.argmin(1)
            n, total = np.bincount(near, minlength=len(c)), np.zeros(c.shape)
            np.add.at(total, near, x)
            moved = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
            shift = float(((moved - c) ** 2).sum())
            if shift <= tol or turn == max_iter:
                return Fit(c, float(gap[np.arange(len(x)), near].sum()), turn, shift <= tol)
            c = moved

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [m for m in (_matrix(b[features]) for b in batches) if len(m)]
        fits = {name: settle(np.concatenate(parts) if parts else np.zeros((0, np.shape(c)[1])), np.array(c, float))
                for name, c in starts.items()}
        kinds = [pa.string(), pa.list_(pa.list_(pa.float64())), pa.float64(), pa.int32(), pa.bool_()]
        rows = [(name, f.centres.tolist(), f.cost, f.passes, f.settled) for name, f in fits.items()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)],
                                         names=["run", "centres", "cost", "passes", "settled"])

    found = data.select(features).coalesce(1).mapInArrow(run, "run string, centres array<array<double>>, cost double, passes int, settled boolean")
    return {r["run"]: Fit(np.array(r["centres"]), r["cost"], r["passes"], r["settled"]) for r in found.collect()}


def _pass(data: DataFrame, at: Mapping[str, np.ndarray], features: str) -> tuple[dict[str, float], dict[str, np.ndarray]]:
    """(sum of squares, means of the rows nearest to each centre) of every run, in one job."""
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {name: (np.zeros(len(c)), np.zeros(c.shape), np.zeros(len(c))) for name, c in at.items()}
        for b in batches:
            x = _matrix(b[features])
            for name, c in at.items() if len(x) else ():
                gap = ((x[:, None, :] - c[None]) ** 2).sum(2)
                near = gap.argmin(1)
                n, total, cost = sums[name]
                n += np.bincount(near, minlength=len(c))
                np.add.at(total, near, x)
                cost += np.bincount(near, gap[np.arange(len(x)), near], len(c))
        rows = [(name, i, int(n[i]), total[i].tolist(), float(cost[i]))
                for name, (n, total, cost) in sums.items() for i in range(len(n))]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)],
                                         names=["run", "centre", "n", "total", "cost"])

    dims = next(iter(at.values())).shape[1]
    sums = (data.select(features).mapInArrow(add_up, "run string, centre int, n long, total array<double>, cost double")
            .groupBy("run", "centre").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"),
                                          F.array(*[F.sum(F.col("total")[i]) for i in range(dims)]).alias("total")))
    cost, moved = dict.fromkeys(at, 0.0), {name: c.copy() for name, c in at.items()}
    for r in sums.collect():                                   # k rows a run
        cost[r["run"]] += r["cost"]
        if r["n"]:
            moved[r["run"]][r["centre"]] = np.array(r["total"]) / r["n"]
    return cost, moved


def _starts(data: DataFrame, runs: Sequence[tuple[int, int]], seed_rows: int = SEED_ROWS) -> dict[str, np.ndarray]:
    """First centres of each run (k, seed): spread by squared distance over a sample of at most ``seed_rows`` rows."""
    whole = F.col("features").isNotNull() & F.forall("features", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sample = data.where(whole).select("features").orderBy(F.xxhash64("features"), "features").limit(seed_rows).collect()
    x = np.array([r["features"] for r in sample], float)
    out = {}
    for k, seed in runs if len(x) else ():
        rng = np.random.default_rng([k, seed])
        centres = [x[rng.integers(len(x))]]
        gap = ((x - centres[0]) ** 2).sum(1)
        for _ in range(k - 1):
            p = gap / gap.sum() if gap.sum() > 0 else None
            centres.append(x[rng.choice(len(x), p=p)])
            gap = np.minimum(gap, ((x - centres[-1]) ** 2).sum(1))
        out[f"{k}:{seed}"] = np.array(centres)
    return out


def _nearest(centres: np.ndarray, features: str = "features") -> Column:
    """Number of the nearest centre (ties to the first); null for rows with a null or non-finite component."""
    def gap(c: np.ndarray) -> Column:
        return F.aggregate(F.zip_with(features, F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b)),
                           F.lit(0.0), lambda s, v: s + v)
    gaps = F.array(*[F.struct(gap(c).alias("gap"), F.lit(i).alias("centre")) for i, c in enumerate(centres)])
    whole = F.forall(features, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(whole, F.array_min(gaps)["centre"])


def elbow(df: DataFrame, cols: Sequence[str], ks: Sequence[int] = range(2, 8), seed: int = 42, restarts: int = 10,
          max_iter: int = MAX_ITER, tol: float = TOL) -> DataFrame:
    """Within-cluster sum of squares for each k, the least of ``restarts`` seeds (a few rows).

    All runs go through each pass over the data together.  Without rows the sums are 0.
    """
    data, n = _scaled(df, cols)
    data = data.cache()
    fits = lloyd(data, _starts(data, [(k, seed + i) for k in ks for i in range(restarts)]), max_iter=max_iter, tol=tol, rows=n)
    data.unpersist()
    rows = [(int(k), min((f.cost for name, f in fits.items() if name.startswith(f"{k}:")), default=0.0)) for k in ks]
    return df.sparkSession.createDataFrame(rows, "k int, inertia double")


def segment(df: DataFrame, cols: Sequence[str] = CLUSTER_FEATURES, k: int = 5, restarts: int = 10,
            seed: int = 42, order_by: str = "avg_aum", out: str = "cluster_id", max_iter: int = MAX_ITER,
            tol: float = TOL) -> DataFrame:
    """K-means on standardised columns, best of ``restarts`` seeds, run together.

    Cluster ids are renumbered by descending mean of ``order_by`` so they do not depend on the
    seed that won.  A best run that has not settled after ``max_iter`` passes is reported by a
    warning.  Rows with a null or non-finite column have a null cluster.
    """
    data, n = _scaled(df, cols)
    data = data.cache()
    fits = lloyd(data, _starts(data, [(k, seed + i) for i in range(restarts)]), max_iter=max_iter, tol=tol, rows=n)
    if not fits:
        return df.withColumn(out, F.lit(None).cast("int"))
    best = min(fits.items(), key=lambda f: (f[1].cost, f[0]))[1]
    if not best.settled:
        warnings.warn(f"k-means has not settled after {best.passes} passes", RuntimeWarning, stacklevel=2)
    pred = data.withColumn("_raw_cluster", _nearest(best.centres))
    means = pred.where("_raw_cluster IS NOT NULL").groupBy("_raw_cluster").agg(F.avg(order_by).alias("_m"))
    # k rows: the renumbering window is bounded by k
    ids = means.withColumn(out, (F.row_number().over(
        Window.orderBy(F.desc("_m"), "_raw_cluster")) - 1).cast("int")).select("_raw_cluster", out)
    # materialise before the cached matrix is released: profile, labels and
    # output all read the assignments
    res = cut_lineage(pred.join(F.broadcast(ids), "_raw_cluster", "left").drop("_raw_cluster", "features"))
    data.unpersist()
    return res


def label_clusters(profile: DataFrame, rules=LABEL_RULES, cluster_col: str = "cluster_id",
                   k: int | None = None, out: str = "cluster_label") -> DataFrame:
    """Name clusters by ordered argmax/argmin rules; the last matching rule wins,
    ties go to the lowest cluster id, unnamed clusters become 'Cluster <id>'.
    ``profile`` holds one row per cluster (bounded by k)."""
    profile = cut_lineage(profile)          # read once per rule: materialise the k rows
    wins = None
    for i, (metric, how, label) in enumerate(rules):
        o = F.desc(metric) if how == "max" else F.asc(metric)
        w = profile.withColumn("_rk", F.row_number().over(Window.orderBy(o, F.asc(cluster_col))))
        hit = w.filter("_rk = 1").select(cluster_col, F.lit(i).alias("_rule"), F.lit(label).alias("_label"))
        wins = hit if wins is None else wins.unionByName(hit)
    named = wins.groupBy(cluster_col).agg(F.max_by("_label", "_rule").alias("_label"))
    return profile.join(named, cluster_col, "left").withColumn(
        out, F.coalesce(F.col("_label"), F.concat(F.lit("Cluster "), F.col(cluster_col).cast("string")))
    ).drop("_label")


def map_values(df: DataFrame, col: str, mapping: DataFrame, key: str, value: str,
               out: str, default=None) -> DataFrame:
    """Replace ``col`` by its value in a small mapping frame (broadcast join)."""
    m = mapping.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    j = df.join(m, df[col] == m["_k"], "left")
    return j.withColumn(out, F.coalesce(F.col("_v"), F.lit(default))).drop("_k", "_v")
