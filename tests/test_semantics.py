"""Hand-computed micro-frames for the semantics that are easy to get wrong."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fundlens.operators import aggregates as agg
from fundlens.operators import ordering as ordr
from fundlens.operators import windows as win
from fundlens.plans import evaluate as ev
from fundlens.plans import segment as sg


def nav_frame(spark, returns, fund=1, aum=None, start=dt.date(2024, 1, 1)):
    rows = []
    for i, r in enumerate(returns):
        a = aum[i] if aum else 100.0 + i
        rows.append((fund, start + dt.timedelta(days=i), float(r), 0.0, float(r), float(a), 0))
    df = spark.createDataFrame(rows, "fund_id long, nav_date date, daily_return double, "
                                     "benchmark_return double, active_return double, aum double, is_anomaly int")
    return df.select("fund_id", "nav_date",
                     *[F.col(c).cast("decimal(10,6)").alias(c) for c in ("daily_return", "benchmark_return", "active_return")],
                     F.col("aum").cast("decimal(20,2)").alias("aum"), "is_anomaly")


def test_rolling_std_single_row_is_zero_and_z_needs_five(spark):
    r = [0.01, 0.02, -0.01, 0.03, 0.00, 0.02]
    nav = nav_frame(spark, r)

    def build(w):
        return [win.rolling_std("daily_return", w, 5).alias("s5"),
                win.rolling_z("daily_return", w, 20, 5).alias("z"),
                win.rolling_mean("daily_return", w, 5).alias("m5")]
    out = win.with_window(nav, "fund_id", "nav_date", 19, build, plan="direct").orderBy("nav_date").collect()
    assert out[0]["s5"] == 0.0                       # std of one row is NaN -> filled with 0
    assert [o["z"] for o in out[:4]] == [None] * 4    # min_periods = 5
    s = pd.Series(r)
    z5 = (s.iloc[4] - s.iloc[:5].mean()) / (s.iloc[:5].std() + 1e-8)
    assert math.isclose(out[4]["z"], z5, rel_tol=1e-12)
    assert math.isclose(out[5]["m5"], s.iloc[1:6].mean(), rel_tol=1e-12)
    assert math.isclose(out[5]["s5"], s.iloc[1:6].std(), rel_tol=1e-12)


def test_pct_change_first_row_zero_and_zero_base_null(spark):
    nav = nav_frame(spark, [0.0, 0.0, 0.0], aum=[100.0, 0.0, 50.0])
    out = win.with_window(nav, "fund_id", "nav_date", 1,
                          lambda w: [win.pct_change("aum", w).alias("p")], plan="direct")
    got = [r["p"] for r in out.orderBy("nav_date").collect()]
    assert got[0] == 0.0 and got[1] == -1.0 and got[2] is None


@pytest.mark.parametrize("block", [20, 33, 64])
def test_blocked_plan_equals_direct_plan(spark, block):
    rng = np.random.default_rng(1)
    frames = [nav_frame(spark, list(np.round(rng.normal(0, 0.01, n), 6)), fund=f,
                        aum=list(np.round(rng.uniform(1e3, 2e3, n), 2)))
              for f, n in ((1, 150), (2, 9), (3, 41))]   # fund 1 is the hot key
    nav = frames[0].unionByName(frames[1]).unionByName(frames[2])
    a = win.anomaly_features(nav, plan="direct").orderBy("fund_id", "nav_date").collect()
    b = win.anomaly_features(nav, plan="blocked", block_rows=block).orderBy("fund_id", "nav_date").collect()
    c = win.anomaly_features(nav, plan="auto", block_rows=block).orderBy("fund_id", "nav_date").collect()
    assert len(a) == len(b) == len(c) == 146 + 5 + 37          # four rows per fund lack a z-score
    assert [tuple(r) for r in a] == [tuple(r) for r in b] == [tuple(r) for r in c]


def test_running_total_matches_cumsum(spark):
    nav = nav_frame(spark, [0.01] * 70)
    out = win.running_total(nav, "fund_id", "nav_date", F.col("daily_return").cast("double"), "cum")
    got = [r["cum"] for r in out.orderBy("nav_date").collect()]
    assert np.allclose(got, np.cumsum([0.01] * 70))


def test_global_rank_with_a_hot_value(spark):
    vals = [5.0] * 400 + [float(x) for x in range(800)] + [None] * 3   # one value holds a third
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    got = {r["id"]: r["rank"] for r in ordr.global_rank(df, "v", descending=True).collect()}
    s = pd.Series(vals)
    want = s.rank(method="min", ascending=False)
    for i in range(len(vals)):
        if vals[i] is None or (isinstance(vals[i], float) and math.isnan(vals[i])):
            assert got[i] is None
        else:
            assert got[i] == int(want[i])


@pytest.mark.parametrize("p", [0.0, 0.01, 0.5, 0.99, 1.0])
def test_exact_quantile_matches_numpy(spark, p):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=500), np.full(300, 0.25)])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    assert math.isclose(ordr.exact_quantile(df, "v", p), float(np.quantile(vals, p)), rel_tol=1e-12, abs_tol=1e-15)


def test_auc_matches_pairwise_count(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.normal(size=300) + y, 1)                # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    got = ev.auc(df, "y", "s").first()["auc"]
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert math.isclose(got, want, rel_tol=1e-12)


def test_label_overwrite_and_ties(spark):
    # cluster 4 wins both highest return and most anomalies -> keeps the later label;
    # clusters 0 and 1 tie on aum -> the lower id wins
    prof = spark.createDataFrame([
        (0, 0.0066, 0.03, 0.0746, 900.0, 10.0, 0.5),
        (1, 0.0126, 0.06, 0.0627, 900.0, 15.0, 0.5),
        (2, -0.0003, 0.06, -0.0021, 700.0, 13.0, 0.5),
        (3, 0.0104, 0.01, 0.5393, 500.0, 14.0, 0.9),
        (4, 0.0137, 0.04, 0.1020, 800.0, 15.9, 0.6)],
        "cluster_id int, avg_return double, avg_vol double, avg_sharpe double, avg_aum_m double, "
        "avg_anomalies double, consistency double")
    got = {r["cluster_id"]: r["cluster_label"] for r in sg.label_clusters(prof).collect()}
    assert got == {0: "Large Cap Stable", 1: "Cluster 1", 2: "Underperformers",
                   3: "Risk-Adjusted Leaders", 4: "High Operational Risk"}


def test_monthly_sharpe_house_formula(spark):
    r = [0.01, 0.02, 0.03]
    nav = nav_frame(spark, r).withColumn("nav", F.lit(1.0))
    m = agg.monthly_rollup(nav).first()
    s = pd.Series(r)
    assert float(m["monthly_return"]) == pytest.approx(0.06)
    assert float(m["sharpe_ratio"]) == round(0.06 / (s.std() * math.sqrt(252) + 1e-8), 4)
    one = agg.monthly_rollup(nav_frame(spark, [0.01]).withColumn("nav", F.lit(1.0))).first()
    assert one["sharpe_ratio"] is None                 # one row: std undefined


def test_group_argmax_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5)], "g string, v double")
    assert agg.group_argmax(df, "g", "v").first()["g"] == "a"


def test_rounding_is_half_away_from_zero_on_the_decimal_form(spark):
    from fundlens.functions.scalars import fround
    df = spark.createDataFrame([(0.285,), (-2.5,), (1.005,), (2.675,), (3e30,), (float("inf"),)], "x double")
    got = [r[0] for r in df.select(fround("x", 2)).collect()]
    assert got == [0.29, -2.5, 1.01, 2.68, 3e30, float("inf")]
    assert df.select(fround("x", 0)).collect()[1][0] == -3.0


def test_latest_date_view_drops_funds_without_a_row_that_day(spark):
    from fundlens.plans import views
    dim = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "fund_id long, asset_class string")
    nav = spark.createDataFrame(
        [(1, "2024-01-02", 100.0, 0.01, 0.0, 0), (2, "2024-01-01", 50.0, 0.02, 0.0, 1),
         (3, "2024-01-02", 10.0, -0.01, 0.0, 0)],
        "fund_id long, nav_date string, aum double, daily_return double, active_return double, is_anomaly int")
    nav = nav.select("fund_id", F.col("nav_date").cast("date").alias("nav_date"),
                     F.col("aum").cast("decimal(20,2)").alias("aum"),
                     F.col("daily_return").cast("decimal(10,6)").alias("daily_return"),
                     F.col("active_return").cast("decimal(10,6)").alias("active_return"), "is_anomaly")
    got = {r["asset_class"]: (r["fund_count"], r["total_anomalies"])
           for r in views.aum_by_asset_class(dim, nav).collect()}
    assert got == {"A": (1, 0), "B": (1, 0)}        # fund 2 has no row on 2024-01-02


def test_blocked_plan_on_real_nav_data(spark, sf_small):
    from fundlens.sources import bindings as bd
    nav = bd.nav_daily(spark, sf_small)
    a = win.anomaly_features(nav, plan="direct").orderBy("fund_id", "nav_date").collect()
    b = win.anomaly_features(nav, plan="auto", block_rows=50).orderBy("fund_id", "nav_date").collect()
    assert len(a) == len(b) > 0 and [tuple(r) for r in a] == [tuple(r) for r in b]


@pytest.mark.parametrize("descending", [True, False])
def test_rank_with_hot_values_spread_over_partitions(spark, descending):
    rng = random.Random(5)
    values = [rng.choice([1.5, 1.5, 1.5, float(rng.randrange(30)), None, float("nan")]) for _ in range(3000)]
    rows = [(i, v, 1, 2) for i, v in enumerate(values)] + [(0, values[0], 1, 2)]
    df = spark.createDataFrame(rows, "id long, v double, rank2 int, _n int").repartition(7)
    got = ordr.global_rank(df, "v", descending, out="r").collect()
    assert len(got) == len(rows)
    key = lambda v: float("inf") if v != v else v              # NaN is the largest value
    have = [key(r[1]) for r in rows if r[1] is not None]
    for r in got:
        if r["v"] is None:
            assert r["r"] is None
        else:
            better = sum(h > key(r["v"]) if descending else h < key(r["v"]) for h in set(have) for _ in range(have.count(h))) if r["id"] % 97 == 0 else None
            assert better is None or r["r"] == better + 1
    assert len({(key(r["v"]), r["r"]) for r in got if r["v"] is not None}) == len(set(have))
    assert ordr.global_rank(df.where("id < 0"), "v").count() == 0


def test_return_index_plans_agree(spark):
    rows = [(f, dt.date(2024, 1, 1) + dt.timedelta(days=3 * i), 0.01 * ((f * 7 + i) % 5 - 2)) for f in range(4) for i in range(60)]
    df = spark.createDataFrame(rows, "fund_id long, nav_date date, daily_return double")
    a, b = (sorted(map(tuple, win.return_index(df, "fund_id", "nav_date", "daily_return", plan=p).collect())) for p in ("direct", "months"))
    assert [r[:3] for r in a] == [r[:3] for r in b] and max(abs(x[3] - y[3]) for x, y in zip(a, b)) < 1e-7
