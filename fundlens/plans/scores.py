"""Assembly of the per-fund model score table (ml_scores layout)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble_scores(anomaly: DataFrame, segments: DataFrame, forecasts: DataFrame,
                    version: str, key: str = "fund_id", date_col: str = "nav_date",
                    steps: Sequence[int] = (30, 60, 90), model_type: str = "ensemble") -> DataFrame:
    """Latest anomaly score per fund + segment + forecasts at the listed steps.

    ``forecasts`` has (key, step, yhat); steps are pivoted with listed values.
    """
    latest = anomaly.groupBy(key).agg(
        F.max(date_col).alias("score_date"),
        # (key, date) is unique; plain columns are aggregated by hash, a struct would be sorted
        *[F.max_by(c, date_col).alias(c) for c in ("ensemble_score", "rf_is_anomaly")])
    latest = latest.select(key, "score_date",
                           F.col("ensemble_score").cast("decimal(10,6)").alias("anomaly_score"),
                           F.col("rf_is_anomaly").cast("int").alias("is_anomaly"))
    piv = forecasts.groupBy(key).pivot("step", list(steps)).agg(F.first("yhat"))
    piv = piv.select(key, *[F.col(str(s)).cast("decimal(20,2)").alias(f"forecast_{s}d") for s in steps])
    out = latest.join(segments.select(key, "cluster_id", "cluster_label"), key, "left") \
        .join(piv, key, "left")
    return out.select(key, "score_date", F.lit(model_type).alias("model_type"),
                      F.lit(version).alias("model_version"), "anomaly_score", "is_anomaly",
                      "cluster_id", "cluster_label", *[f"forecast_{s}d" for s in steps])
