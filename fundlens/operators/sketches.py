"""Quantiles and distinct counts from sketches that merge.

A sketch is kept per partition of a table (a month, a day).  New days only add sketches;
figures over any set of partitions come from the sketches, and no row is read again.  The
exact forms stay in ``ordering`` and in plain aggregates.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUANTILE_K = 800                    # rank error about 0.4 % at 99 % confidence
DISTINCT_LGK = 14                   # relative error 0.8 %, one deviation


def rank_error(k: int = QUANTILE_K) -> float:
    """Rank error of a quantile sketch that 99 % of the sketches keep (published fit of the algorithm)."""
    return 2.296 / k ** 0.9021


def distinct_error(lgk: int = DISTINCT_LGK, deviations: float = 3.0) -> float:
    """Relative error of a distinct count at the given number of standard deviations."""
    return deviations * 1.04 / math.sqrt(2 ** lgk)


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str | Column], k: int = QUANTILE_K) -> DataFrame:
    """One sketch of ``value`` per group, with its row count; nulls are not counted, NaN not held."""
    v = F.col(value).cast("double")
    return df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"))


def quantiles_of(sketches: DataFrame, ps: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Approximate quantiles over all (or, with ``by``, over each group of) sketches: rows and q<100 p>.

    Without rows the quantiles are null.
    """
    merged = sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch").alias("_s"))
    some = F.col("rows") > 0
    return merged.select(*by, F.coalesce("rows", F.lit(0)).alias("rows"), *[
        F.when(some, F.kll_sketch_get_quantile_double("_s", F.lit(float(p)))).alias(f"q{100 * p:g}") for p in ps])


def distinct_sketches(df: DataFrame, value: str, by: Sequence[str | Column], lgk: int = DISTINCT_LGK) -> DataFrame:
    """One distinct-count sketch of ``value`` (a whole number, string or binary column) per group."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(value, lgk).alias("sketch"))


def distinct_of(sketches: DataFrame, by: Sequence[str] = (), out: str = "distinct") -> DataFrame:
    """Approximate distinct count over all (or each group of) sketches."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("_s")).select(
        *by, F.coalesce(F.hll_sketch_estimate("_s"), F.lit(0).cast("long")).alias(out))
