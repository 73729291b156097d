"""Dashboard reports: KPIs, AUM share, trends, rankings, leaderboards, cash breakdowns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.functions.scalars import fround, mean_of, month_bucket
from fundlens.operators.aggregates import exact_mean, finish_states, rollup_states
from fundlens.operators.joins import with_dimension
from fundlens.plans.views import at_latest


def slice_by(df: DataFrame, col: str, value) -> DataFrame:
    """Dashboard slicer: restrict any metric to one value before aggregating."""
    return df.filter(F.col(col) == F.lit(value))


def kpis(dim: DataFrame, nav: DataFrame, key: str = "fund_id", date_col: str = "nav_date") -> DataFrame:
    """One row: AUM on the latest date, fund count, mean monthly Sharpe, anomalies.

    The daily table, unique on (key, date), is read once: its monthly states are summed up by
    their last day, and the latest of those days gives the AUM.
    """
    months = finish_states(rollup_states(nav, key, date_col), key=key, keep=["last"])
    days = months.groupBy(F.col("last.day").alias("day")).agg(
        F.sum("last.aum").alias("aum"), F.sum("sharpe_ratio").alias("s"), F.count("sharpe_ratio").alias("n"),
        F.sum("anomaly_count").alias("anomalies"))
    return days.agg(
        F.max_by("aum", "day").cast("double").alias("total_aum"),
        dim.select(F.count(F.lit(1))).scalar().alias("funds"),
        F.try_divide(F.sum("s").cast("double"), F.sum("n").cast("double")).alias("mean_sharpe"),
        F.sum("anomalies").cast("long").alias("anomalies"))


def aum_share(dim: DataFrame, nav: DataFrame, class_col: str = "asset_class",
              date_col: str = "nav_date") -> DataFrame:
    day = with_dimension(at_latest(nav, date_col), dim, "fund_id", [class_col])
    per = day.groupBy(class_col).agg(F.sum("aum").alias("_aum"))
    total = per.select(F.sum("_aum").cast("double")).scalar()      # scalar subquery
    return per.select(class_col, F.col("_aum").cast("double").alias("aum"),
                      fround(F.col("_aum").cast("double") / total * 100, 4).alias("share_pct"))


def return_trend(monthly: DataFrame, class_col: str = "asset_class") -> DataFrame:
    return monthly.groupBy(class_col, "month").agg(
        exact_mean("monthly_return").alias("avg_monthly_return"),
        F.count(F.lit(1)).alias("funds"))


def risk_return(features: DataFrame, segment_col: str) -> DataFrame:
    return features.groupBy(segment_col).agg(
        F.count(F.lit(1)).alias("funds"),
        fround(F.avg("avg_return"), 8).alias("avg_return"),
        fround(F.avg("return_vol"), 8).alias("avg_risk"),
        fround(F.avg("avg_sharpe"), 6).alias("avg_sharpe"))


def leaderboard(performance: DataFrame, segments: DataFrame, key: str = "fund_id",
                segment_col: str = "segment", columns: Sequence[str] = ()) -> DataFrame:
    j = performance.join(segments.select(key, segment_col), key, "left")
    cols = [key, "fund_name", segment_col, "avg_sharpe_ratio", "total_return_pct",
            "total_active_return_pct", *columns]
    return j.select(*cols).orderBy(F.desc("avg_sharpe_ratio"), key)


def anomalies_over_time(nav: DataFrame, date_col: str = "nav_date") -> DataFrame:
    return nav.groupBy(month_bucket(date_col).alias("month")).agg(
        F.sum("is_anomaly").cast("long").alias("anomalies"),
        F.count(F.lit(1)).alias("records"))


STATUSES = ("Settled", "Pending", "Failed")


def cashflow_by_status(cash: DataFrame, type_col: str = "transaction_type",
                       statuses: Sequence[str] = STATUSES) -> DataFrame:
    """Type x status pivot of amounts; unlisted and null statuses are summed as ``other``."""
    listed = F.coalesce(F.col("status").isin(list(statuses)), F.lit(False))
    total = lambda keep: F.coalesce(F.sum(F.when(keep, F.col("amount"))), F.lit(0)).cast("double")
    return cash.groupBy(type_col).agg(*[total(F.col("status") == s).alias(s.lower()) for s in statuses],
                                      total(~listed).alias("other"))


def status_breakdown(cash: DataFrame) -> DataFrame:
    per = cash.groupBy("status").agg(F.count(F.lit(1)).alias("transactions"))
    total = per.select(F.sum("transactions")).scalar()               # scalar subquery
    return per.select("status", "transactions",
                      fround(F.col("transactions").cast("double") / total * 100, 4).alias("share_pct"))
