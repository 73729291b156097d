"""Ordering: global ranks, exact quantiles, top-k, tails, first/last, argmax.

Global order statistics are computed without an unpartitioned window over the
data.  ``global_rank`` ranks inside range partitions and adds the counts of the
partitions before.  ``value_prefix`` first aggregates per distinct value (map-side
combined, so a value held by a third of the rows is one row afterwards),
splits the distinct values into ranges at approximate quantiles, sums each
range (one row per range, a bounded frame that is broadcast), and finishes
with a window inside each range.  Every figure is exact; the approximate
quantiles only decide where the ranges are cut.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlens.operators.sketches import quantile_sketches, quantiles_of
from fundlens.session import cut_lineage

ROWS_PER_RANGE = 1_000_000
MIN_RANGES, MAX_RANGES = 8, 4096


PROBE_CUTS = 1024          # cut candidates taken in the same pass as the distinct count


def _with_range(d: DataFrame, value: str, out: str = "_rng") -> DataFrame:
    """Assign each distinct value to one of a bounded number of value ranges.

    One pass yields the approximate distinct count and 1024 candidate cuts;
    only when a range would hold more than ROWS_PER_RANGE values is a second
    pass with finer cuts needed.
    """
    v = F.col(value).cast("double")
    probs = [i / PROBE_CUTS for i in range(1, PROBE_CUTS)]
    row = d.agg(F.approx_count_distinct(value).alias("ndv"),
                F.percentile_approx(v, probs, 10_000).alias("cuts")).first()
    k = int(min(MAX_RANGES, max(MIN_RANGES, math.ceil((row["ndv"] or 0) / ROWS_PER_RANGE))))
    if k <= PROBE_CUTS:
        step = PROBE_CUTS / k
        cuts = [row["cuts"][int(round(i * step)) - 1] for i in range(1, k)] if row["cuts"] else []
    else:
        cuts = d.select(F.percentile_approx(v, [i / k for i in range(1, k)], 100_000)).first()[0]
    return _in_ranges(d, v, cuts, out)


def _in_ranges(d: DataFrame, v: Column, cuts, out: str) -> DataFrame:
    """Number of the range between finite cuts that a value lies in (NaN beyond the last)."""
    inner = sorted({float(c) for c in (cuts or []) if c is not None and math.isfinite(c)})
    if not inner:
        return d.withColumn(out, F.lit(0.0))
    dd = d.withColumn("_vd", v)
    return Bucketizer(splits=[-math.inf, *inner, math.inf], inputCol="_vd", outputCol=out,
                      handleInvalid="keep").transform(dd).drop("_vd")


def value_prefix(df: DataFrame, value: str, weights: Mapping[str, Column],
                 partition: str | None = None) -> DataFrame:
    """Per distinct non-null ``value``: the weights, and their totals over smaller values.

    Returns columns: [partition,] value, each weight name, and ``<name>_below``
    for each (totals over smaller values within the same partition value).
    ``partition`` must have few distinct values (e.g. a class label).
    """
    names = list(weights)
    part = [partition] if partition else []
    d = df.filter(F.col(value).isNotNull()).groupBy(*part, value).agg(
        *[F.sum(w).alias(n) for n, w in weights.items()])
    # the distinct-value frame is read by the cut pass and by the result:
    # write it once to the shared checkpoint folder instead of recomputing
    d = _with_range(cut_lineage(d), value)
    per = d.groupBy(*part, "_rng").agg(*[F.sum(n).alias(f"_t_{n}") for n in names])
    # one row per (partition, range): bounded by MAX_RANGES x partitions
    wr = Window.partitionBy(*part).orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*part, "_rng", *[F.coalesce(F.sum(f"_t_{n}").over(wr), F.lit(0))
                                      .alias(f"_o_{n}") for n in names])
    wv = Window.partitionBy(*part, "_rng").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    out = d.join(F.broadcast(per), [*part, "_rng"]).select(
        *part, value, *names,
        *[(F.col(f"_o_{n}") + F.coalesce(F.sum(n).over(wv), F.lit(0))).alias(f"{n}_below")
          for n in names])
    return out


def global_rank(df: DataFrame, value: str, descending: bool = True,
                out: str = "rank") -> DataFrame:
    """SQL ``RANK()`` over the whole frame (ties share a rank, null values have none).

    Rows are range-partitioned by value and, within a value, by a hash of the row, so a value
    held by a third of the rows is spread over partitions.  Each partition ranks its own rows;
    the counts of the partitions before it, and the rank of a value that began in one of them,
    are added from one summary row a partition.  Nothing is joined on the value.
    """
    spark = df.sparkSession
    order = F.desc_nulls_last(value) if descending else F.asc_nulls_last(value)
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (df.repartitionByRange(parts, order, F.xxhash64(*plain)).withColumn("_part", F.spark_partition_id()))
    within = F.rank().over(Window.partitionBy("_part").orderBy(order))
    ranked = cut_lineage(placed.withColumn("_within", F.when(F.col(value).isNotNull(), within)))
    first = F.when(F.col("_within") == 1, F.struct(F.col(value).alias("v")))
    per = ranked.where(F.col("_within").isNotNull()).groupBy("_part").agg(
        F.count(F.lit(1)).alias("n"), F.max(first)["v"].alias("first"), F.max_by(value, "_within").alias("last"),
        F.max("_within").alias("last_rank"))
    rows, before, value_rank, last = [], 0, None, None
    for r in sorted(per.collect(), key=lambda r: r["_part"]):            # one row a partition
        goes_on = value_rank is not None and (r["first"] == last or (r["first"] != r["first"] and last != last))
        head = value_rank if goes_on else before + 1
        rows.append((r["_part"], before, head))
        value_rank = head if r["last_rank"] == 1 else before + r["last_rank"]
        last, before = r["last"], before + r["n"]
    edges = F.broadcast(spark.createDataFrame(rows, "_part int, _before long, _head long"))
    rank = F.when(F.col("_within") == 1, F.col("_head")).otherwise(F.col("_before") + F.col("_within"))
    return ranked.join(edges, "_part", "left").select(*df.columns, rank.cast("long").alias(out))


def order_statistics(df: DataFrame, value: str, ranks) -> tuple[int, dict]:
    """For 0-based ``ranks`` (or a function of the row count giving them) in the
    ascending order of non-null ``value``:
    {rank: (value at that rank, rows with a smaller value)}, plus the row count.

    One pass takes approximate cuts from the raw rows, one counts the rows between them
    (map-side combined, one row per range), and only the ranges that hold a rank are read
    again and ordered; a range still larger than ``ROWS_PER_RANGE`` is cut again the same way.
    No row outside those ranges is shuffled.
    """
    d = df.filter(F.col(value).isNotNull()).select(value)
    v = F.col(value).cast("double")
    probs = [i / PROBE_CUTS for i in range(1, PROBE_CUTS)]
    cuts, counts = [], {}
    spread: list[float] = d.agg(F.percentile_approx(v, probs, 10_000)).first()[0] or []
    while True:
        cuts = sorted({c for c in [*cuts, *spread] if c is not None and math.isfinite(c)})
        counts = {float(r["_rng"]): int(r["t"]) for r in _in_ranges(d, v, cuts, "_rng").groupBy("_rng")
                  .agg(F.count(F.lit(1)).alias("t")).collect()}
        n = sum(counts.values())
        wanted = ranks(n) if callable(ranks) else ranks      # ranks may depend on the row count
        wanted = sorted({r for r in wanted if 0 <= r < n})
        if not wanted:
            return n, {}
        offsets, run = {}, 0
        for rng in sorted(counts):
            offsets[rng] = run
            run += counts[rng]
        needed = sorted({max(rng for rng, off in offsets.items() if off <= r) for r in wanted})
        large = [rng for rng in needed if counts[rng] > ROWS_PER_RANGE]
        if not large:
            break
        inside = _in_ranges(d, v, cuts, "_rng").filter(F.col("_rng").isin(large)).groupBy("_rng").agg(
            F.percentile_approx(v, [i / 64 for i in range(1, 64)], 10_000).alias("c"))
        spread = [c for r in inside.collect() for c in r["c"]]
        if not set(spread) - set(cuts):
            break                                            # few distinct values: they combine map-side below
    ranks = wanted
    d = _in_ranges(d, v, cuts, "_rng").filter(F.col("_rng").isin(needed)).groupBy("_rng", value).agg(
        F.count(F.lit(1)).alias("_n"))
    off = F.create_map(*[x for rng in needed for x in (F.lit(float(rng)), F.lit(offsets[rng]))])
    w = Window.partitionBy("_rng").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    sub = d.withColumn("_n_below", off[F.col("_rng")] + F.coalesce(F.sum("_n").over(w), F.lit(0)))
    hit = None
    for r in ranks:
        c = (F.col("_n_below") <= r) & (F.lit(r) < F.col("_n_below") + F.col("_n"))
        hit = c if hit is None else hit | c
    rows = [(int(r["_n_below"]), int(r["_n"]), r[value])
            for r in sub.filter(hit).select("_n_below", "_n", value).collect()]
    return n, {r: next((v, below) for below, cnt, v in rows if below <= r < below + cnt)
               for r in ranks}


def exact_quantiles(df: DataFrame, value: str, ps: list[float]) -> list[float | None]:
    """Linear-interpolated quantiles (as pandas ``quantile`` / SQL ``quantile_cont``).

    Only the two values around each target position reach the driver.
    """
    def targets(n: int) -> list[int]:
        return [r for p in ps for r in (math.floor((n - 1) * p), math.ceil((n - 1) * p))]

    n, at = order_statistics(df, value, targets)
    if not n:
        return [None for _ in ps]
    want = [((n - 1) * p, math.floor((n - 1) * p), math.ceil((n - 1) * p)) for p in ps]
    out = []
    for pos, lo, hi in want:
        v_lo, v_hi = float(at[lo][0]), float(at[hi][0])
        out.append(v_lo if lo == hi else v_lo + (pos - lo) * (v_hi - v_lo))
    return out


def exact_quantile(df: DataFrame, value: str, p: float) -> float | None:
    return exact_quantiles(df, value, [p])[0]


def quantile(df: DataFrame, value: str, p: float, approx: bool = False) -> float | None:
    """Quantile ``p`` of the non-null values: exact and interpolated, or from one pass over a mergeable sketch."""
    if not approx:
        return exact_quantile(df, value, p)
    return quantiles_of(quantile_sketches(df, value, []), [p]).first()[1]


def top_k(df: DataFrame, value: str, k: int, descending: bool = True,
          tie_break: str | None = None) -> DataFrame:
    """The k rows with the largest (or smallest) value (TakeOrderedAndProject)."""
    o = [F.desc(value) if descending else F.asc(value)]
    if tie_break:
        o.append(F.asc(tie_break))
    return df.orderBy(*o).limit(k)


def tail_by(df: DataFrame, order: str, n: int) -> DataFrame:
    """The last n rows in ``order`` (returned in ascending order)."""
    return df.orderBy(F.desc(order)).limit(n).orderBy(order)


def first_last(df: DataFrame, order: str, value: str, group: str | None = None) -> DataFrame:
    """First and last ``value`` in ``order`` (per group, or over the frame)."""
    aggs = [F.min_by(value, order).alias("first_value"), F.max_by(value, order).alias("last_value"),
            F.min(order).alias("first_at"), F.max(order).alias("last_at")]
    return df.groupBy(group).agg(*aggs) if group else df.agg(*aggs)


def arg_extreme(df: DataFrame, value: str, id_col: str, largest: bool = True) -> DataFrame:
    """Row with the largest (smallest) value; ties go to the lowest id (idxmax semantics)."""
    o = F.desc(value) if largest else F.asc(value)
    return df.orderBy(o, F.asc(id_col)).limit(1)
