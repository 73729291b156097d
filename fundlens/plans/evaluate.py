"""Model evaluation: AUC, precision/recall/F1, forecast error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.operators.ordering import value_prefix


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """ROC AUC with ties counted one half (the Mann-Whitney statistic), one row.

    Built on per-distinct-score counts, so no global sort of the rows.
    """
    pos = F.when(F.col(label) == 1, 1).otherwise(0)
    neg = F.when(F.col(label) == 1, 0).otherwise(1)
    pref = value_prefix(df, score, {"p": pos, "q": neg})
    return pref.agg(
        ((F.sum(F.col("p").cast("double") * (F.col("q_below").cast("double") + F.col("q") * 0.5)))
         / (F.sum("p").cast("double") * F.sum("q").cast("double"))).alias("auc"),
        F.sum("p").cast("long").alias("positives"), F.sum("q").cast("long").alias("negatives"))


def classification_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall and F1 of the positive class; 0 where undefined."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    c = df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
               F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double")), F.lit(0.0))
    c = c.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")), F.lit(0.0))
    return c.withColumn("f1", f1)


def forecast_error(actual: DataFrame, forecast: DataFrame, on: str = "ds", y: str = "y",
                   yhat: str = "yhat") -> DataFrame:
    """MAPE (%) and MAE over the dates present in both frames (inner join)."""
    j = actual.select(on, y).join(forecast.select(on, yhat), on, "inner")
    err = F.col(y).cast("double") - F.col(yhat).cast("double")
    return j.agg(F.count(F.lit(1)).alias("n"),
                 (F.avg(F.abs(err / F.col(y).cast("double"))) * 100).alias("mape"),
                 F.avg(F.abs(err)).alias("mae"))


def interval_coverage(actual: DataFrame, forecast: DataFrame, on: str | list[str] = "ds", y: str = "y") -> DataFrame:
    """Rows present in both frames and the share of them whose value lies inside the forecast interval."""
    on = [on] if isinstance(on, str) else on
    j = actual.select(*on, y).join(forecast.select(*on, "yhat_lower", "yhat_upper"), on)
    inside = F.col(y).cast("double").between(F.col("yhat_lower"), F.col("yhat_upper"))
    return j.agg(F.count(F.lit(1)).alias("n"), F.count_if(inside).alias("inside"),
                 F.try_divide(F.count_if(inside).cast("double"), F.count(F.lit(1)).cast("double")).alias("coverage"))
