"""Forecasting of a daily series (optionally one per group).

Two tiers:

* ``seasonal_baseline`` - least-squares trend a + b*t from exact decimal sums,
  times weekday and month-of-year factors; interval from the residual spread,
  widening with the horizon.  Every step is an aggregate or a join, so it
  runs per group at any scale and an SQL engine reproduces it.
* ``fit_forecast`` - Spark ML linear regression on log(y) over trend,
  changepoint hinges, yearly/weekly Fourier terms and period regressors
  (multiplicative seasonality through the log); an elastic-net penalty stands
  in for the priors of a Bayesian curve fitter.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.functions.scalars import fround, period_flag

Z80 = 1.2815515655446004          # two-sided 80% normal interval


def time_split(df: DataFrame, col: str, cutoff) -> tuple[DataFrame, DataFrame]:
    """(rows before cutoff, rows at or after cutoff)."""
    c = F.lit(cutoff).cast("date") if isinstance(cutoff, str) else cutoff
    return df.filter(F.col(col) < c), df.filter(F.col(col) >= c)


def split_point(df: DataFrame, col: str, fraction: float = 0.8) -> Column:
    """The date ``fraction`` of the way through the table's span (scalar subquery)."""
    lo = df.select(F.min(col)).scalar()
    span = df.select(F.datediff(F.max(col), F.min(col))).scalar()
    return F.date_add(lo, F.floor(span * fraction).cast("int"))


def _g(group):
    return [] if group is None else ([group] if isinstance(group, str) else list(group))


def seasonal_baseline(train: DataFrame, horizon: DataFrame, ds: str = "ds", y: str = "y",
                      group: str | Sequence[str] | None = None, z: float = Z80) -> DataFrame:
    """Forecast ``horizon`` (columns ds [+ group]) from ``train`` (ds, y [+ group]).

    yhat = (a + b t) * weekday factor * month factor, t in days from the first
    training date; bounds yhat -/+ z * sigma * sqrt(1 + h / n), h = step.
    A group's factors are columns of its one model row, so rows meet it on the group alone.
    """
    g = _g(group)
    t0 = train.select(F.min(ds)).scalar()
    tr = train.select(*g, ds, F.datediff(F.col(ds), t0).cast("long").alias("t"),
                      F.col(y).cast("decimal(20,2)").alias("_y"))
    s = tr.groupBy(*g).agg(
        F.count(F.lit(1)).alias("n"), F.sum("t").alias("st"), F.sum(F.col("t") * F.col("t")).alias("stt"),
        F.sum("_y").cast("decimal(20,2)").alias("sy"),
        F.sum(F.col("t").cast("decimal(10,0)") * F.col("_y")).cast("decimal(28,2)").alias("sty"),
        F.max(ds).alias("last_ds"))
    num = (F.col("n").cast("decimal(9,0)") * F.col("sty")
           - F.col("st").cast("decimal(18,0)") * F.col("sy")).cast("double")
    den = (F.col("n") * F.col("stt") - F.col("st") * F.col("st")).cast("double")
    s = s.withColumn("b", F.try_divide(num, den))
    s = s.withColumn("a", (F.col("sy").cast("double") - F.col("b") * F.col("st").cast("double"))
                     / F.col("n").cast("double"))
    coef = s.select(*g, "a", "b", "n", "last_ds")
    days, months = [f"_wd{i}" for i in range(1, 8)], [f"_mo{i}" for i in range(1, 13)]

    def fitted(model: DataFrame) -> DataFrame:
        return _attach(tr, model, g).withColumn("trend", F.col("a") + F.col("b") * F.col("t").cast("double"))

    def factors(fit: DataFrame, model: DataFrame, part: Column, ratio: Column, names: list[str]) -> DataFrame:
        # the model so far is the same in all rows of a group; it goes on beside its new factors
        rows = fit.withColumn("_p", part).withColumn("_r", ratio)
        return rows.groupBy(*g).agg(
            *[F.max(c).alias(c) for c in model.columns if c not in g],
            *[fround(F.avg(F.when(F.col("_p") == i, F.col("_r"))), 12).alias(c) for i, c in enumerate(names, 1)])

    s_wd, s_mo = F.element_at(F.array(*days), F.dayofweek(ds)), F.element_at(F.array(*months), F.month(ds))
    actual = F.col("_y").cast("double")
    model = factors(fitted(coef), coef, F.dayofweek(ds), actual / F.col("trend"), days)
    model = factors(fitted(model).withColumn("s_wd", s_wd), model, F.month(ds), actual / (F.col("trend") * F.col("s_wd")), months)
    resid = actual - F.col("trend") * s_wd * s_mo
    sig = fitted(model).withColumn("_e", resid).groupBy(*g).agg(
        fround(F.sqrt(F.avg(F.col("_e") * F.col("_e"))), 4).alias("sigma"))
    h = _attach(_attach(horizon.select(*g, ds), model, g), sig, g)
    h = h.withColumn("t", F.datediff(F.col(ds), t0).cast("long"))
    h = h.withColumn("step", F.datediff(F.col(ds), F.col("last_ds")).cast("double"))
    # a weekday or month never seen in training gets the neutral factor 1
    yhat = ((F.col("a") + F.col("b") * F.col("t").cast("double"))
            * F.coalesce(s_wd, F.lit(1.0)) * F.coalesce(s_mo, F.lit(1.0)))
    width = z * F.col("sigma") * F.sqrt(1 + F.col("step") / F.col("n").cast("double"))
    return h.select(*g, ds, fround(yhat, 2).alias("yhat"), fround(yhat - width, 2).alias("yhat_lower"),
                    fround(yhat + width, 2).alias("yhat_upper"))


def _attach(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join a small per-group (or single-row) coefficient frame onto ``left``."""
    if keys:
        return left.join(right, keys, "left")
    # a single coefficient row: one scalar subquery
    row = right.select(F.struct(*right.columns)).scalar()
    return left.select("*", row.alias("_row")).select(*left.columns, "_row.*")


# --- tier ii ----------------------------------------------------------------

def trend_variance(spread, changepoints: int, ahead) -> Column:
    """Variance of the trend ``ahead`` (in spans) of the last day, from the steps it took so far.

    Steps of mean size ``spread``, two-sided exponential (variance 2 spread^2), come
    ``changepoints`` times a span; one that comes u before the forecast day moves it by u times
    the step, so the variance is changepoints * 2 spread^2 * integral of u^2 from 0 to ahead.
    """
    spread, ahead = (c if isinstance(c, Column) else F.lit(float(c)) for c in (spread, ahead))
    return 2.0 * changepoints / 3.0 * spread * spread * ahead * ahead * ahead


def forecast_features(df: DataFrame, ds: str, t0, span_days: float, changepoints: int = 25,
                      changepoint_range: float = 0.8, yearly: int = 10, weekly: int = 3,
                      regressors: Mapping[str, tuple[str, str]] | None = None) -> tuple[DataFrame, list[str]]:
    """Trend, changepoint hinges, Fourier terms and period flags; returns (df, names)."""
    t = F.datediff(F.col(ds), t0).cast("double")
    cols, names = [(t / span_days).alias("trend")], ["trend"]
    for i in range(1, changepoints + 1):
        c = changepoint_range * i / (changepoints + 1)
        cols.append(F.greatest(t / span_days - c, F.lit(0.0)).alias(f"cp{i}"))
        names.append(f"cp{i}")
    for k in range(1, yearly + 1):
        ang = 2 * math.pi * k * t / 365.25
        cols += [F.sin(ang).alias(f"ys{k}"), F.cos(ang).alias(f"yc{k}")]
        names += [f"ys{k}", f"yc{k}"]
    for k in range(1, weekly + 1):
        ang = 2 * math.pi * k * t / 7.0
        cols += [F.sin(ang).alias(f"ws{k}"), F.cos(ang).alias(f"wc{k}")]
        names += [f"ws{k}", f"wc{k}"]
    for name, (lo, hi) in (regressors or {}).items():
        cols.append(period_flag(ds, lo, hi).cast("double").alias(name))
        names.append(name)
    return df.select("*", *cols), names


class LogLinearForecaster:
    """log(y) ~ features, elastic net; exp back with an interval from residuals and trend steps."""

    def __init__(self, reg_param: float = 0.001, elastic_net: float = 0.5,
                 regressors: Mapping[str, tuple[str, str]] | None = None, z: float = Z80):
        self.reg_param, self.elastic_net, self.regressors, self.z = reg_param, elastic_net, regressors, z

    def fit(self, train: DataFrame, ds: str = "ds", y: str = "y") -> "LogLinearForecaster":
        self.ds = ds
        stats = train.agg(F.min(ds).alias("lo"), F.datediff(F.max(ds), F.min(ds)).alias("span"),
                          F.max(ds).alias("hi"), F.count(F.lit(1)).alias("n"),
                          F.count_if(F.coalesce(F.col(y) <= 0, F.lit(True))).alias("unusable")).first()
        if stats["unusable"]:
            raise ValueError(f"{stats['unusable']} training rows have no positive {y}: their logarithm is undefined")
        self.t0, self.span, self.last, self.n = stats["lo"], float(max(stats["span"], 1)), stats["hi"], stats["n"]
        feats, self.names = forecast_features(train, ds, F.lit(self.t0),
                                              self.span, regressors=self.regressors)
        data = VectorAssembler(inputCols=self.names, outputCol="features").transform(
            feats.withColumn("label", F.log(F.col(y).cast("double"))))
        self.model = LinearRegression(regParam=self.reg_param, elasticNetParam=self.elastic_net,
                                      maxIter=200).fit(data)
        self.sigma = self.model.summary.rootMeanSquaredError
        steps = [abs(float(c)) for name, c in zip(self.names, self.model.coefficients) if name.startswith("cp")]
        self.changepoints, self.spread = len(steps), sum(steps) / max(len(steps), 1)
        return self

    def predict(self, horizon: DataFrame, overrides: Mapping[str, float] | None = None) -> DataFrame:
        """Forecast of the horizon's days; the interval widens with the trend's uncertainty."""
        feats, _ = forecast_features(horizon, self.ds, F.lit(self.t0), self.span,
                                     regressors=self.regressors)
        for c, v in (overrides or {}).items():
            feats = feats.withColumn(c, F.lit(float(v)))
        out = self.model.transform(VectorAssembler(inputCols=self.names, outputCol="features")
                                   .transform(feats))
        step = F.greatest(F.datediff(F.col(self.ds), F.lit(self.last)).cast("double"), F.lit(0.0))
        width = self.z * F.sqrt(self.sigma ** 2 + trend_variance(self.spread, self.changepoints, step / self.span))
        return out.select(self.ds, F.exp("prediction").alias("yhat"),
                          F.exp(F.col("prediction") - width).alias("yhat_lower"),
                          F.exp(F.col("prediction") + width).alias("yhat_upper"))
