"""Grouped aggregates: exact moments, monthly rollup, fund features, profiles.

Sums are taken over DECIMAL columns (exact and order independent), and every
mean or deviation is formed from those exact sums with a fixed sequence of
IEEE operations.  The result does not depend on partitioning or task order,
and an independent SQL engine following the same steps gets the same bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.functions.scalars import (
    TRADING_DAYS, _c, fround, mean_of, month_bucket, to_decimal)
from fundlens.operators.joins import with_dimension

SHARPE_EPS = 1e-8


def _over(c: Column, w) -> Column:
    return c.over(w) if w is not None else c


def exact_var_samp(col, w=None) -> Column:
    """Sample variance of a small DECIMAL(.,6) column from exact sums.

    var = (n*S2 - S1^2) / (n*(n-1)); the numerator is exact, so there is no
    cancellation.  Null for fewer than two rows (as pandas and SQL).
    """
    x = _c(col).cast("decimal(12,6)")
    n = _over(F.count(x), w)
    s1 = _over(F.sum(x), w).cast("decimal(18,6)")
    s2 = _over(F.sum(x * x), w).cast("decimal(26,12)")
    num = n.cast("decimal(10,0)") * s2 - s1 * s1
    return F.when(n > 1, num.cast("double") / (n * (n - 1)).cast("double"))


def exact_std_samp(col, w=None) -> Column:
    return F.sqrt(exact_var_samp(col, w))


def exact_mean(col, w=None) -> Column:
    x = _c(col)
    return _over(F.sum(x), w).cast("double") / _over(F.count(x), w)


# Bounded frames (rolling windows): the same exact sums over unscaled integers.
# Squares are summed as DECIMAL(38,0), so no value of a declared money or rate
# column overflows; a sum past 38 digits raises instead of wrapping.

def unscaled(col, scale: int) -> Column:
    return (_c(col).cast(f"decimal(18,{scale})") * F.lit(10 ** scale)).cast("long")


def mean_of_sums(n, s1, scale: int) -> Column:
    """Mean from the count and the sum of unscaled integers."""
    return s1.cast("double") / float(10 ** scale) / n


def var_of_sums(n, s1, s2, scale: int) -> Column:
    """Sample variance from the count, the sum and the sum of squares of unscaled integers."""
    s1 = s1.cast("decimal(19,0)")
    num = n.cast("decimal(9,0)") * s2 - s1 * s1
    return F.when(n > 1, num.cast("double") / float(10 ** (2 * scale)) / (n * (n - 1)).cast("double"))


# Squares of integers of at most 10 digits as two 64-bit parts, high * 2^32 + low with 0 <= low < 2^33:
# sums of 2^27 of them stay exact.

PART_DIGITS = 10


def square_parts(u: Column) -> tuple[Column, Column]:
    """High and low part of u * u."""
    hi, lo = F.shiftright(u, 16), u.bitwiseAND(F.lit(65535))
    cross = hi * lo                                         # u^2 = hi^2 2^32 + cross 2^17 + lo^2
    return hi * hi + F.shiftright(cross, 15), F.shiftleft(cross.bitwiseAND(F.lit(32767)), 17) + lo * lo


def var_of_parts(n, s1, high, low, scale: int) -> Column:
    """``var_of_sums`` from the sums of the squares' parts: in 64 bits where n * sum of squares fits."""
    short = n * (F.shiftleft(high, 32) + low) - s1 * s1
    s2 = high.cast("decimal(19,0)") * F.lit(2 ** 32).cast("decimal(10,0)") + low.cast("decimal(19,0)")
    d1 = s1.cast("decimal(19,0)")
    num = F.when((n <= 256) & (high < 2 ** 20) & (low < 2 ** 41), short.cast("double")).otherwise(
        (n.cast("decimal(9,0)") * s2.cast("decimal(28,0)") - d1 * d1).cast("double"))
    return F.when(n > 1, num / float(10 ** (2 * scale)) / (n * (n - 1)).cast("double"))


def integer_sums(col, w, scale: int) -> tuple[Column, Column, Column]:
    """Count, sum and sum of squares of a column's unscaled integers over a window frame."""
    u = unscaled(col, scale)
    d = u.cast("decimal(19,0)")
    return F.count(u).over(w), F.sum(u).over(w), F.sum((d * d).cast("decimal(38,0)")).over(w)


def bounded_mean(col, w, scale: int) -> Column:
    n, s1, _ = integer_sums(col, w, scale)
    return mean_of_sums(n, s1, scale)


def bounded_var_samp(col, w, scale: int = 6) -> Column:
    return var_of_sums(*integer_sums(col, w, scale), scale)


def bounded_std_samp(col, w, scale: int = 6) -> Column:
    return F.sqrt(bounded_var_samp(col, w, scale))


def last_value(value_col, order_col) -> Column:
    """Value at the greatest ``order_col`` in the group (iloc[-1] after a sort)."""
    return F.max_by(_c(value_col), _c(order_col))


# --- the monthly rollup as states that merge -----------------------------------

def rollup_states(nav: DataFrame, key: str = "fund_id", date_col: str = "nav_date") -> DataFrame:
    """Partial states of ``monthly_rollup`` per key and month: exact sums, counts and the last day.

    States of disjoint sets of days add up (``merge_states``) to the state of all days.
    """
    x = F.col("daily_return").cast("decimal(12,6)")
    nav_col = F.col("nav") if "nav" in nav.columns else F.lit(None).cast("double")
    return nav.groupBy(key, month_bucket(date_col).alias("month")).agg(
        F.count(x).alias("n"), F.sum(x).cast("decimal(24,6)").alias("s1"), F.sum(x * x).cast("decimal(38,12)").alias("s2"),
        F.sum("daily_return").cast("decimal(24,6)").alias("r"), F.sum("benchmark_return").cast("decimal(24,6)").alias("b"),
        F.count("aum").alias("aum_n"), F.sum("aum").cast("decimal(38,2)").alias("aum"),
        F.max(F.when(F.col(date_col).isNotNull(), F.struct(F.col(date_col).alias("day"), nav_col.alias("nav"), F.col("aum").alias("aum")))).alias("last"),
        F.sum("is_anomaly").cast("long").alias("anomalies"))


def merge_states(states: DataFrame, key: str = "fund_id") -> DataFrame:
    """One state per key and month from any number of partial ones (map-side combined)."""
    sums = [F.sum(c).cast(states.schema[c].dataType).alias(c) for c in ("n", "s1", "s2", "r", "b", "aum_n", "aum", "anomalies")]
    return states.groupBy(key, "month").agg(*sums, F.max("last").alias("last"))


def finish_states(states: DataFrame, dim: DataFrame | None = None, key: str = "fund_id",
                  class_col: str = "asset_class", keep: Sequence[str] = ()) -> DataFrame:
    """``monthly_rollup``'s rows, to the last digit, from merged states; ``keep`` names state columns to pass on."""
    n, s1, s2 = F.col("n"), F.col("s1").cast("decimal(18,6)"), F.col("s2").cast("decimal(26,12)")
    spread = (n.cast("decimal(10,0)") * s2 - s1 * s1).cast("double")
    std = F.sqrt(F.when(n > 1, spread / (n * (n - 1)).cast("double")))
    sharpe = F.col("r").cast("double") / (std * F.sqrt(F.lit(float(TRADING_DAYS))) + SHARPE_EPS)
    out = states.select(
        key, "month", F.col("r").cast("decimal(10,6)").alias("monthly_return"), F.col("b").cast("decimal(10,6)").alias("benchmark_return"),
        (F.col("r") - F.col("b")).cast("decimal(10,6)").alias("active_return"),
        to_decimal(F.col("aum").cast("double") / F.col("aum_n"), 20, 2).alias("avg_aum"),
        to_decimal(F.col("last.nav"), 12, 4).alias("month_end_nav"), F.col("anomalies").cast("int").alias("anomaly_count"),
        to_decimal(sharpe, 20, 4).alias("sharpe_ratio"), *keep)
    return out if dim is None else with_dimension(out, dim, key, [class_col])


def monthly_rollup(nav: DataFrame, dim: DataFrame | None = None, key: str = "fund_id",
                   date_col: str = "nav_date", class_col: str = "asset_class") -> DataFrame:
    """Fund x month rollup of a daily NAV table.

    monthly_return / benchmark_return are sums of daily values (returns add,
    they are not compounded), active_return is their difference, sharpe is
    the house formula  sum / (daily sample std * sqrt(252) + 1e-8).
    """
    # grouped by the month's first day: text is formed once a month, not once a row
    agg = nav.groupBy(key, F.trunc(date_col, "month").alias("_month")).agg(
        F.sum("daily_return").alias("_r"),
        F.sum("benchmark_return").alias("_b"),
        mean_of("aum").alias("_aum"),
        last_value("nav", date_col).alias("_nav") if "nav" in nav.columns else F.lit(None).alias("_nav"),
        F.sum("is_anomaly").cast("int").alias("anomaly_count"),
        exact_std_samp("daily_return").alias("_std"),
    )
    sharpe = F.col("_r").cast("double") / (
        F.col("_std") * F.sqrt(F.lit(float(TRADING_DAYS))) + SHARPE_EPS)
    out = agg.select(
        key, month_bucket("_month").alias("month"),
        F.col("_r").cast("decimal(10,6)").alias("monthly_return"),
        F.col("_b").cast("decimal(10,6)").alias("benchmark_return"),
        (F.col("_r") - F.col("_b")).cast("decimal(10,6)").alias("active_return"),
        to_decimal("_aum", 20, 2).alias("avg_aum"),
        to_decimal("_nav", 12, 4).alias("month_end_nav"),
        "anomaly_count",
        to_decimal(sharpe, 20, 4).alias("sharpe_ratio"),
    )
    if dim is not None:
        out = with_dimension(out, dim, key, [class_col])
    return out


def fund_features(monthly: DataFrame, dim: DataFrame | None = None, key: str = "fund_id",
                  dim_columns: Sequence[str] = ("asset_class", "management_fee",
                                                "target_volatility")) -> DataFrame:
    """Fund-level feature vector from the monthly table; missing values -> 0."""
    f = monthly.groupBy(key).agg(
        exact_mean("monthly_return").alias("avg_return"),
        exact_std_samp("monthly_return").alias("return_vol"),
        exact_mean("active_return").alias("avg_active_ret"),
        exact_mean("sharpe_ratio").alias("avg_sharpe"),
        exact_mean("avg_aum").alias("avg_aum"),
        F.sum("anomaly_count").cast("long").alias("total_anomalies"),
        (F.count_if(F.col("monthly_return") > 0).cast("double") / F.count(F.lit(1)))
        .alias("consistency"),
    ).fillna(0, subset=["avg_return", "return_vol", "avg_active_ret", "avg_sharpe", "avg_aum",
                        "total_anomalies", "consistency"])
    if dim is None:
        return f
    f = with_dimension(f, dim, key, list(dim_columns))
    for c in ("management_fee", "target_volatility"):
        if c in dim_columns:
            f = f.withColumn(c, F.col(c).cast("double"))
    return f


PROFILE_METRICS = ("avg_return", "avg_vol", "avg_sharpe", "avg_aum_m", "avg_anomalies",
                   "consistency")


def cluster_profile(features: DataFrame, cluster_col: str = "cluster_id",
                    key: str = "fund_id", places: int = 4) -> DataFrame:
    """Per-cluster size and six means (AUM in millions), rounded to ``places``."""
    return features.groupBy(cluster_col).agg(
        F.count(key).alias("fund_count"),
        fround(F.avg("avg_return"), places).alias("avg_return"),
        fround(F.avg("return_vol"), places).alias("avg_vol"),
        fround(F.avg("avg_sharpe"), places).alias("avg_sharpe"),
        fround(F.avg("avg_aum") / 1e6, places).alias("avg_aum_m"),
        fround(F.sum("total_anomalies").cast("double") / F.count(F.lit(1)), places)
        .alias("avg_anomalies"),
        fround(F.avg("consistency"), places).alias("consistency"),
    )


def group_argmax(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """Group with the highest mean of ``value_col``; ties go to the smallest group."""
    means = df.groupBy(group_col).agg(F.avg(value_col).alias("mean_value"))
    # argmin of (-mean, group): an ordinary partial aggregate, whatever the group count
    best = means.agg(F.min_by(F.struct(F.col(group_col).alias("g"), F.col("mean_value").alias("m")),
                              F.struct(F.negative("mean_value"), F.col(group_col))).alias("_b"))
    return best.select(F.col("_b.g").alias(group_col), F.col("_b.m").alias("mean_value"))
