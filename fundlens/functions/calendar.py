"""Calendars: business days (Mon-Fri, no holidays) and month ends, as DataFrames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def is_business_day(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return ~F.dayofweek(c).isin(1, 7)          # 1 = Sunday, 7 = Saturday


def _lit_date(d) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(d.isoformat() if isinstance(d, (dt.date, dt.datetime)) else str(d)).cast("date")


def business_days(spark: SparkSession, start, end, col: str = "ds") -> DataFrame:
    """Business days in [start, end]; start/end may be literals or scalar Columns."""
    days = spark.range(1).select(
        F.explode(F.sequence(_lit_date(start), _lit_date(end))).alias(col))
    return days.filter(is_business_day(col))


def date_range_of(df: DataFrame, col: str) -> tuple[Column, Column]:
    """The table's first and last date as scalar subqueries (no collect)."""
    return (df.select(F.min(col)).scalar(), df.select(F.max(col)).scalar())


def next_business_days(spark: SparkSession, after, n: int, col: str = "ds") -> DataFrame:
    """The n business days strictly after ``after`` (a literal or scalar Column)."""
    start = F.date_add(_lit_date(after), 1)
    # n business days always fit into n + 2 * (n // 5 + 1) + 2 calendar days
    span = n + 2 * (n // 5 + 1) + 2
    days = spark.range(1).select(
        F.explode(F.sequence(start, F.date_add(start, span))).alias(col))
    days = days.filter(is_business_day(col))
    return days.orderBy(col).limit(n)


def month_ends(spark: SparkSession, start, end, col: str = "month_end") -> DataFrame:
    """Last calendar day of every month touching [start, end]."""
    first = F.trunc(_lit_date(start), "month")
    months = spark.range(1).select(
        F.explode(F.sequence(first, F.trunc(_lit_date(end), "month"),
                             F.expr("INTERVAL 1 MONTH"))).alias("_m"))
    return months.select(F.last_day("_m").alias(col))
