"""One forecast model per group, fitted for all groups together.

Each group gets a regularised least-squares fit of log(y) on trend, changepoint hinges,
Fourier terms and period flags.  The fit needs only the Gram matrix X'X and X'y of a group.
Rows meet in slices of (group, year), so no task holds a whole group; a slice becomes one
partial Gram matrix, the few of a group are added up, and all groups of an Arrow batch are
solved together.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.plans.forecast import Z80, forecast_features, trend_variance

# worker functions travel by value, so executors need no package install
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: ridge weight by kind of term; a hinge is held back so that the trend bends only where days ask for it
PENALTY = {"trend": 0.0, "cp": 1.0, "season": 0.01, "regressor": 0.01}


def _kinds(changepoints: int, yearly: int, weekly: int, regressors: Mapping | None) -> list[str]:
    return (["trend"] + ["cp"] * changepoints + ["season"] * (2 * (yearly + weekly))
            + ["regressor"] * len(regressors or {}))


def _terms(df: DataFrame, ds: str, t0, span, shape: dict) -> tuple[DataFrame, list[str]]:
    feats, names = forecast_features(df, ds, t0, span, **shape)
    return feats.withColumn("_x", F.array(F.lit(1.0), *names)).drop(*names), ["intercept", *names]


def partial_grams(rows: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """One row per run of equal keys in a batch: n, X'X, X'y, y'y, last day (columns _x, _v, _ok, _ds)."""
    fields = [f for f in rows.schema.fields if f.name in keys]
    names = [f.name for f in fields] + ["_n", "_skipped", "_first", "_last", "_gram"]
    size = (width + 1) ** 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            values = list(zip(*(b[k].to_pylist() for k in keys))) if keys else [()] * len(b)
            edge = [0, *[i for i in range(1, len(b)) if values[i] != values[i - 1]], len(b)]
            x = b["_x"].values.to_numpy(zero_copy_only=False)[-len(b) * width:].reshape(len(b), width)
            ok = b["_ok"].to_numpy(zero_copy_only=False)
            both = np.column_stack([x, b["_v"].to_numpy(zero_copy_only=False)]) * ok[:, None]
            grams = [(both[i:j].T @ both[i:j]).ravel() for i, j in zip(edge[:-1], edge[1:])]
            at, to = pa.array(edge[:-1]), pa.array([j - 1 for j in edge[1:]])
            n = [int(ok[i:j].sum()) for i, j in zip(edge[:-1], edge[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(b[k].take(at) for k in [f.name for f in fields]), pa.array(n, pa.int64()),
                 pa.array([j - i - m for i, j, m in zip(edge[:-1], edge[1:], n)], pa.int64()), b["_ds"].take(at), b["_ds"].take(to),
                 pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(grams)), size).cast(pa.list_(pa.float64()))],
                names=names)

    head = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    return rows.mapInArrow(run, head + "_n long, _skipped long, _first date, _last date, _gram array<double>")


def solve(gram: np.ndarray, penalty: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients, residual sums of squares) of stacked Gram matrices [X y]'[X y]; least norm where singular."""
    xx, xy, yy = gram[:, :-1, :-1], gram[:, :-1, -1], gram[:, -1, -1]
    a = xx + np.diag(penalty)
    try:
        beta = np.linalg.solve(a, xy[..., None])[..., 0]
        if not np.isfinite(beta).all() or (np.linalg.cond(a) > 1e12).any():
            raise np.linalg.LinAlgError
    except np.linalg.LinAlgError:
        beta = np.stack([np.linalg.lstsq(m, v, rcond=1e-12)[0] for m, v in zip(a, xy)])
    rss = yy - 2 * (beta * xy).sum(1) + np.einsum("gi,gij,gj->g", beta, xx, beta)
    return beta, np.maximum(rss, 0.0)


def fit_forecast(train: DataFrame, ds: str = "ds", y: str = "y", group: str | Sequence[str] | None = None,
                 start: Column | str | None = None, span: Column | float | None = None, changepoints: int = 25,
                 yearly: int = 10, weekly: int = 3, regressors: Mapping[str, tuple[str, str]] | None = None,
                 penalty: Mapping[str, float] = PENALTY) -> DataFrame:
    """Coefficients per group: [group,] n, skipped, start, span, last_ds, beta, sigma, spread.

    ``beta`` holds the intercept and the terms of ``forecast_features`` in their order, ``sigma``
    the residual deviation of log(y), ``spread`` the mean absolute changepoint step.  Time runs
    from ``start`` (default: the first day of all groups) in units of ``span`` days (default: to
    the last day).  Rows without a positive y are not fitted but counted as skipped; a group
    without any other row has null coefficients; where a group's days do not determine the
    coefficients the least-norm ones are taken; null keys form a group.
    """
    keys = [] if group is None else [group] if isinstance(group, str) else list(group)
    shape = dict(changepoints=changepoints, yearly=yearly, weekly=weekly, regressors=regressors)
    ends = train.select(F.min(ds).alias("lo"), F.max(ds).alias("hi"))
    if start is None or span is None:
        lo, hi = ends.first()
        start = F.lit(lo) if start is None else start
        span = float(max((hi - lo).days, 1)) if span is None and lo else (1.0 if span is None else span)
    start = F.lit(start).cast("date") if isinstance(start, str) else start
    ok = F.coalesce(F.col(y).cast("double") > 0, F.lit(False))
    rows = (train.where(F.col(ds).isNotNull())
            .select(*keys, F.col(ds).cast("date").alias("_ds"), F.year(ds).alias("_year"), ok.alias("_ok"),
                    F.when(ok, F.log(F.col(y).cast("double"))).otherwise(0.0).alias("_v"))
            .repartition(*keys, "_year").sortWithinPartitions(*keys, "_year", "_ds"))
    feats, names = _terms(rows, "_ds", start, span, shape)
    width = len(names)
    weights = np.array([0.0] + [float(penalty.get(k, 0.0)) for k in _kinds(**shape)])
    hinges = np.array([False] + [k == "cp" for k in _kinds(**shape)])
    grams = partial_grams(feats, [*keys, "_year"], width)
    fields = [f for f in grams.schema.fields if f.name in keys]

    def finish(held: list[tuple[tuple, list]]) -> pa.RecordBatch:
        n = np.array([sum(r[0] for r in rows) for _, rows in held])
        gram = np.stack([np.sum([r[3] for r in rows], axis=0) for _, rows in held]).reshape(-1, width + 1, width + 1)
        beta, rss = solve(gram, weights)
        sigma = np.sqrt(rss / np.maximum(n, 1))
        spread = np.abs(beta[:, hinges]).mean(1) if hinges.any() else np.zeros(len(n))
        some = n > 0
        cols = [pa.array([k[keys.index(f.name)] for k, _ in held], types[f.name]) for f in fields]
        return pa.RecordBatch.from_arrays(
            [*cols, pa.array(n, pa.int64()), pa.array([sum(r[1] for r in rows) for _, rows in held], pa.int64()),
             pa.array([max(r[2] for r in rows) for _, rows in held], pa.date32()),
             pa.array([b.tolist() if s else None for b, s in zip(beta, some)], pa.list_(pa.float64())),
             pa.array(sigma, mask=~some), pa.array(spread, mask=~some)],
            names=[*(f.name for f in fields), "n", "skipped", "last_ds", "beta", "sigma", "spread"])

    types: dict[str, pa.DataType] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[tuple, list]] = []            # groups in order; the last one may go on in the next batch
        for b in batches:
            types.update({k: b.schema.field(k).type for k in keys})
            cols = [b[c].to_pylist() for c in ("_n", "_skipped", "_last")]
            values = list(zip(*(b[k].to_pylist() for k in keys))) if keys else [()] * len(b)
            for key, *row, gram in zip(values, *cols, b["_gram"]):
                if not held or held[-1][0] != key:
                    if len(held) >= 512:
                        yield finish(held)
                        held = []
                    held.append((key, []))
                held[-1][1].append((*row, gram.values.to_numpy()))
        if held:
            yield finish(held)

    head = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    placed = (grams.repartition(*keys) if keys else grams.coalesce(1)).sortWithinPartitions(*keys, "_year", "_first")
    fit = placed.mapInArrow(run, head + "n long, skipped long, last_ds date, beta array<double>, sigma double, spread double")
    return fit.select(*keys, "n", "skipped", start.alias("start"), (F.lit(span) if isinstance(span, float) else span).alias("span"),
                      "last_ds", "beta", "sigma", "spread")


def predict_forecast(fit: DataFrame, horizon: DataFrame, ds: str = "ds", group: str | Sequence[str] | None = None,
                     changepoints: int = 25, yearly: int = 10, weekly: int = 3,
                     regressors: Mapping[str, tuple[str, str]] | None = None, overrides: Mapping[str, float] | None = None,
                     z: float = Z80) -> DataFrame:
    """Forecast of ``horizon`` (ds [+ group] and further columns): yhat, yhat_lower and yhat_upper.

    The interval on the logarithm is z * sqrt(sigma^2 + variance of the trend): the steps a
    trend took in the past are expected, as often and as large, in the days ahead.
    ``overrides`` fixes regressors.  The shape arguments are those of the fit.
    """
    keys = [] if group is None else [group] if isinstance(group, str) else list(group)
    cols = ["start", "span", "last_ds", "beta", "sigma", "spread"]
    coef = fit.select(*keys, F.struct(*cols).alias("_fit"))
    j = horizon.join(coef, keys) if keys else horizon.select("*", coef.select("_fit").scalar().alias("_fit"))
    feats, names = forecast_features(j, ds, F.col("_fit.start"), F.col("_fit.span"), changepoints=changepoints, yearly=yearly,
                                     weekly=weekly, regressors=regressors)
    fixed = overrides or {}
    x = [F.lit(1.0)] + [F.lit(float(fixed[n])) if n in fixed else F.col(n) for n in names]
    level = F.aggregate(F.zip_with("_fit.beta", F.array(*x), lambda b, v: b * v), F.lit(0.0), lambda s, v: s + v)
    ahead = F.greatest(F.datediff(F.col(ds), F.col("_fit.last_ds")).cast("double"), F.lit(0.0)) / F.col("_fit.span")
    width = z * F.sqrt(F.col("_fit.sigma") * F.col("_fit.sigma") + trend_variance(F.col("_fit.spread"), changepoints, ahead))
    out = feats.select(*horizon.columns, level.alias("_level"), width.alias("_width"))
    return out.select(*horizon.columns, F.exp("_level").alias("yhat"), F.exp(F.col("_level") - F.col("_width")).alias("yhat_lower"),
                      F.exp(F.col("_level") + F.col("_width")).alias("yhat_upper"))
