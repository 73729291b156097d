"""The four reporting views of the relational model, plus the daily total.

Each view aggregates the fact at fund grain first and only then joins the
fund dimension (the key determines the dimension attributes), so the join
is between two fund-sized inputs, never fact-sized.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.functions.scalars import TRADING_DAYS, fround, mean_of
from fundlens.operators.joins import with_dimension


def at_latest(df: DataFrame, date_col: str) -> DataFrame:
    """Rows on the table's latest date (uncorrelated scalar subquery)."""
    return df.filter(F.col(date_col) == df.select(F.max(date_col)).scalar())


def aum_by_asset_class(dim: DataFrame, nav: DataFrame, key: str = "fund_id",
                       date_col: str = "nav_date", class_col: str = "asset_class") -> DataFrame:
    day = at_latest(nav, date_col)
    j = with_dimension(day, dim, key, [class_col])
    return j.groupBy(class_col).agg(
        F.count_distinct(key).alias("fund_count"),
        fround(F.sum("aum").cast("double") / 1e9, 2).alias("total_aum_billions"),
        fround(mean_of("aum") / 1e6, 2).alias("avg_fund_aum_millions"),
        fround(mean_of("daily_return") * TRADING_DAYS * 100, 2).alias("annualized_return_pct"),
        fround(mean_of("active_return") * TRADING_DAYS * 100, 2).alias("avg_active_return_pct"),
        F.sum("is_anomaly").cast("long").alias("total_anomalies"),
    )


FUND_ATTRS = ("fund_name", "asset_class", "benchmark", "fund_manager")


def fund_performance(dim: DataFrame, monthly: DataFrame, key: str = "fund_id",
                     attrs=FUND_ATTRS) -> DataFrame:
    per_fund = monthly.groupBy(key).agg(
        fround(F.sum("monthly_return").cast("double") * 100, 2).alias("total_return_pct"),
        fround(F.sum("benchmark_return").cast("double") * 100, 2).alias("benchmark_return_pct"),
        fround(F.sum("active_return").cast("double") * 100, 2).alias("total_active_return_pct"),
        fround(mean_of("sharpe_ratio"), 4).alias("avg_sharpe_ratio"),
        fround(mean_of("avg_aum") / 1e6, 2).alias("avg_aum_millions"),
        F.sum("anomaly_count").cast("long").alias("total_anomalies"),
    )
    return with_dimension(per_fund, dim, key, list(attrs))


def cashflow_summary(dim: DataFrame, cash: DataFrame, key: str = "fund_id",
                     type_col: str = "transaction_type", failed: str = "Failed") -> DataFrame:
    per_fund = cash.groupBy(key, type_col).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        fround(F.sum("amount").cast("double") / 1e6, 2).alias("total_amount_millions"),
        fround(mean_of("amount") / 1e3, 2).alias("avg_amount_thousands"),
        F.sum(F.when(F.col("status") == failed, 1).otherwise(0)).cast("long").alias("failed_count"),
    )
    return with_dimension(per_fund, dim, key, ["fund_name", "asset_class"])


def nav_anomalies(dim: DataFrame, nav: DataFrame, key: str = "fund_id") -> DataFrame:
    per_fund = nav.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_nav_records"),
        F.sum("is_anomaly").cast("long").alias("anomaly_count"),
        fround(F.sum("is_anomaly").cast("double") / F.count(F.lit(1)) * 100, 2)
        .alias("anomaly_rate_pct"),
        fround(mean_of("aum") / 1e6, 2).alias("avg_aum_millions"),
    )
    out = with_dimension(per_fund, dim, key, ["fund_name", "asset_class", "fund_manager"])
    return out.orderBy(F.desc("anomaly_count"), key)


def daily_total(nav: DataFrame, date_col: str = "nav_date", value_col: str = "aum") -> DataFrame:
    """Total across all funds per date, as (ds, y)."""
    return nav.groupBy(F.col(date_col).alias("ds")).agg(
        F.sum(value_col).cast("double").alias("y"))
