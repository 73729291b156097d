"""Grouped forecast models against plain least squares."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundlens.plans import evaluate as ev
from fundlens.plans import forecast as fc
from fundlens.plans import panel

DAY0 = dt.date(2019, 3, 1)


def series(n, seed, level=8.0, bend=0.0):
    rng = random.Random(seed)
    return [(DAY0 + dt.timedelta(days=i), math.exp(level + 0.3 * i / 700 + bend * max(i / 700 - 0.5, 0) + 0.1 * math.sin(2 * math.pi * i / 7)
                                                   + rng.gauss(0, 0.02))) for i in range(n)]


def design(days, span, changepoints, yearly, weekly):
    t = np.array([(d - DAY0).days for d in days], float)
    cols = [np.ones(len(t)), t / span]
    cols += [np.maximum(t / span - 0.8 * i / (changepoints + 1), 0) for i in range(1, changepoints + 1)]
    for top, period in ((yearly, 365.25), (weekly, 7.0)):
        for k in range(1, top + 1):
            cols += [np.sin(2 * np.pi * k * t / period), np.cos(2 * np.pi * k * t / period)]
    return np.column_stack(cols)


SHAPE = dict(changepoints=3, yearly=1, weekly=1)
WEIGHT = np.array([0, 0, 1, 1, 1, .01, .01, .01, .01])


@pytest.fixture(scope="module")
def frame(spark):
    rows = [("a", 1, d, y) for d, y in series(700, 1)] + [("b", 1, d, y) for d, y in series(400, 2, bend=1.5)]
    rows += [("b", None, d, y) for d, y in series(50, 3)] + [("c", 2, d, -1.0) for d, _ in series(9, 4)]
    rows += [("a", 1, DAY0, 0.0), ("a", 1, DAY0, None), ("a", 1, None, 5.0), ("d", 1, DAY0, 7.0)]
    return spark.createDataFrame([(*r, 1.0, "z") for r in rows], "k string, k2 int, ds date, y double, trend double, _x string")


def test_coefficients_match_ridge_least_squares(frame):
    fit = {(r["k"], r["k2"]): r for r in panel.fit_forecast(frame, group=["k", "k2"], **SHAPE).collect()}
    assert set(fit) == {("a", 1), ("b", 1), ("b", None), ("c", 2), ("d", 1)}
    for key, n, seed, bend in ((("a", 1), 700, 1, 0), (("b", 1), 400, 2, 1.5), (("b", None), 50, 3, 0)):
        s = series(n, seed, bend=bend)
        x, v = design([d for d, _ in s], 699.0, 3, 1, 1), np.log([y for _, y in s])
        want = np.linalg.solve(x.T @ x + np.diag(WEIGHT), x.T @ v)
        r = fit[key]
        assert np.allclose(r["beta"], want, rtol=1e-6, atol=1e-7)
        assert r["n"] == n and r["last_ds"] == s[-1][0] and r["span"] == 699.0
        assert math.isclose(r["sigma"], math.sqrt(((v - x @ want) ** 2).mean()), rel_tol=1e-5)
        assert math.isclose(r["spread"], np.abs(want[2:5]).mean(), rel_tol=1e-6, abs_tol=1e-9)
    assert fit["a", 1]["skipped"] == 2 and fit["c", 2]["beta"] is None and fit["c", 2]["skipped"] == 9
    x = design([DAY0], 699.0, 3, 1, 1)[0]                       # one day: the level alone is known
    assert math.isclose(float(x @ fit["d", 1]["beta"]), math.log(7.0), rel_tol=1e-6)


def test_forecasts_follow_the_series_and_widen(frame, spark):
    fit = panel.fit_forecast(frame, group=["k", "k2"], **SHAPE)
    horizon = spark.createDataFrame([("b", 1, DAY0 + dt.timedelta(days=399 + h), h, 5.0) for h in (1, 30, 90, 365)],
                                    "k string, k2 int, ds date, h int, yhat0 double")
    got = sorted(panel.predict_forecast(fit, horizon, group=["k", "k2"], **SHAPE).collect(), key=lambda r: r["h"])
    assert all(r["yhat_lower"] < r["yhat"] < r["yhat_upper"] and r["yhat0"] == 5.0 for r in got)
    widths = [math.log(r["yhat_upper"] / r["yhat_lower"]) for r in got]
    assert widths == sorted(widths) and widths[-1] > 1.001 * widths[0]
    truth = math.exp(8.0 + 0.3 * 429 / 700 + 1.5 * (429 / 700 - 0.5) + 0.1 * math.sin(2 * math.pi * 429 / 7))
    assert abs(got[1]["yhat"] / truth - 1) < 0.25


def test_trend_variance_matches_simulated_steps():
    rng = np.random.default_rng(0)
    ahead, steps, spread, total = 0.7, 25, 0.04, []
    for _ in range(20000):
        at = rng.uniform(0, ahead, rng.poisson(steps * ahead))
        total.append((rng.laplace(0, spread, len(at)) * (ahead - at)).sum())
    assert math.isclose(np.var(total), 2 * steps / 3 * spread ** 2 * ahead ** 3, rel_tol=0.05)


def test_one_series_and_no_rows(frame, spark):
    one = frame.where("k = 'a'")
    r = panel.fit_forecast(one, **SHAPE).collect()
    assert len(r) == 1 and r[0]["n"] == 700
    pred = panel.predict_forecast(panel.fit_forecast(one, **SHAPE), one.select("ds").where("ds IS NOT NULL"), **SHAPE)
    cover = ev.interval_coverage(one.where("y > 0"), pred).first()
    assert cover["n"] >= 700 and 0.6 < cover["coverage"] <= 1
    assert panel.fit_forecast(frame.where("k = 'none'"), group="k", **SHAPE).count() == 0


def test_one_series_forecaster_widens(frame, spark):
    model = fc.LogLinearForecaster().fit(frame.where("k = 'a' AND y > 0 AND ds IS NOT NULL").select("ds", "y"))
    days = spark.createDataFrame([(DAY0 + dt.timedelta(days=699 + h),) for h in (1, 100, 400)], "ds date")
    w = [math.log(r["yhat_upper"] / r["yhat_lower"]) for r in model.predict(days).orderBy("ds").collect()]
    assert w == sorted(w)
    base = 2 * model.z * math.sqrt(model.sigma ** 2 + 2 * 25 / 3 * model.spread ** 2 * (400 / 699.0) ** 3)
    assert math.isclose(w[2], base, rel_tol=1e-9)
