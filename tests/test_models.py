"""Properties of the model operators and the ingestion paths."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens.functions import calendar as cal
from fundlens.operators import ordering as ordr
from fundlens.operators import quality as qa
from fundlens.plans import anomaly as an
from fundlens.plans import forecast as fc
from fundlens.plans import segment as sg
from fundlens.session import scratch_path
from fundlens.sources import files as fs
from fundlens.streaming import ingest as ing


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    normal = rng.normal(0, 1, (1500, 3))
    planted = np.array([[8, 8, 8], [-9, 7, -8], [10, -10, 9], [-8, -9, -10]], dtype=float)
    x = np.vstack([normal, planted])
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double")


def test_isolation_forest_ranks_planted_outliers_lowest(spark, blobs):
    keys = [F.col("id")]
    iso = an.IsolationForest(trees=50, contamination=0.01, seed=7).fit(blobs, ["a", "b", "c"], keys)
    scored = iso.score(blobs)
    iso.set_offset(scored)
    out = iso.predict(scored).toPandas().sort_values("iso_score")
    assert set(out["id"].head(4)) == {1500, 1501, 1502, 1503}
    assert out["iso_score"].between(-1, 0).all()
    assert 0.005 <= out["iso_outlier"].mean() <= 0.02
    again = an.IsolationForest(trees=50, contamination=0.01, seed=7).fit(blobs, ["a", "b", "c"], keys)
    a = scored.orderBy("id").select("iso_score").toPandas()["iso_score"].to_numpy()
    b = again.score(blobs).orderBy("id").select("iso_score").toPandas()["iso_score"].to_numpy()
    assert np.array_equal(a, b)                                    # fixed seed -> same model


def test_random_forest_probabilities_and_importance(spark, blobs):
    df = blobs.withColumn("y", (F.col("a") > 1.0).cast("int"))
    rf = an.fit_random_forest(df, ["a", "b", "c"], "y", {0: 1, 1: 5}, trees=20, max_depth=4)
    p = an.class_probability(rf, df, ["a", "b", "c"]).select("rf_anomaly_prob").toPandas()["rf_anomaly_prob"]
    assert p.between(0, 1).all()
    imp = an.importance(rf, ["a", "b", "c"])
    assert imp[0][0] == "a" and math.isclose(sum(v for _, v in imp), 1.0, rel_tol=1e-9)


def test_stratified_split_is_exact_per_class(spark, blobs):
    df = blobs.withColumn("y", (F.col("id") % 7 == 0).cast("int"))
    s = an.stratified_split(df, "y", [F.col("id")], 0.8, seed=3)
    got = {(r["y"], r["is_train"]): r["count"] for r in s.groupBy("y", "is_train").count().collect()}
    for cls in (0, 1):
        n = got.get((cls, 0), 0) + got.get((cls, 1), 0)
        assert got[(cls, 1)] == math.floor(0.8 * n)


def test_kmeans_segments_and_elbow(spark):
    rng = np.random.default_rng(1)
    centers = np.array([[0, 0], [10, 0], [0, 10], [10, 10], [5, 20]], dtype=float)
    x = np.vstack([c + rng.normal(0, 0.3, (30, 2)) for c in centers])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, u double, v double")
    seg = sg.segment(df, ["u", "v"], k=5, restarts=3, seed=1, order_by="u").toPandas()
    assert seg["cluster_id"].nunique() == 5
    assert (seg.groupby("cluster_id").size() == 30).all()
    costs = [r["inertia"] for r in sg.elbow(df, ["u", "v"], range(2, 6)).orderBy("k").collect()]
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))


def test_seasonal_baseline_recovers_a_linear_series(spark):
    days = cal.business_days(spark, "2024-01-01", "2024-06-30")
    t0 = dt.date(2024, 1, 1)
    train = days.select("ds", (F.lit(1000.0) + F.datediff("ds", F.lit(t0)) * 10.0).alias("y"))
    hz = cal.next_business_days(spark, "2024-06-30", 10)
    pred = fc.seasonal_baseline(train, hz).orderBy("ds").collect()
    for r in pred:
        want = 1000.0 + (r["ds"] - t0).days * 10.0
        assert abs(r["yhat"] - want) < 1e-6 and r["yhat_lower"] <= r["yhat"] <= r["yhat_upper"]


def test_log_linear_forecaster_interval(spark, sf_small):
    from fundlens.catalog import QUERIES
    df = QUERIES["forecast_model"](spark, sf_small).toPandas()
    assert len(df) == 90 and (df["yhat"] > 0).all()
    assert ((df["yhat_lower"] <= df["yhat"]) & (df["yhat"] <= df["yhat_upper"])).all()


def test_conform_quarantines_bad_text(spark):
    raw = spark.createDataFrame([("1", "7", "2024-01-02", "Subscription", "10.50", "USD", "CP001", "Settled"),
                                 ("2", "7", "not-a-date", "Redemption", "-3.00", "USD", "CP001", "Settled"),
                                 ("3", "7", "2024-01-03", "Dividend", "12x", "USD", "CP002", None)],
                                ", ".join(f"{c} string" for c in ["transaction_id", "fund_id", "transaction_date",
                                                                  "transaction_type", "amount", "currency",
                                                                  "counterparty", "status"]))
    from fundlens import schemas
    good, bad = fs.conform(raw, schemas.CASH_FLOWS, defaults={"status": "Pending"})
    assert [r["transaction_id"] for r in good.collect()] == ["1"]
    errs = {r["transaction_id"]: r["_errors"] for r in bad.collect()}
    assert errs == {"2": ["transaction_date"], "3": ["amount"]}


def test_incremental_ingest_is_idempotent(spark):
    root = scratch_path(spark, "test-stream")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    fs.write_table(spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string"),
                   f"{root}/landing/a", fmt="csv")
    args = dict(landing=f"{root}/landing/*", target=f"{root}/t", schema=schema,
                checkpoint=f"{root}/ck", key=["k"], quarantine=f"{root}/bad")
    assert ing.ingest_incremental(spark, **args) == (2, 0)
    assert ing.ingest_incremental(spark, **args) == (0, 0)               # nothing new
    fs.write_table(spark.createDataFrame([("2", "b"), ("3", "c"), ("3", "c")], "k string, v string"),
                   f"{root}/landing/b", fmt="csv")
    assert ing.ingest_incremental(spark, **args) == (1, 0)               # 2 is known, 3 once
    assert sorted(r["k"] for r in spark.read.parquet(f"{root}/t").collect()) == [1, 2, 3]


def test_expect_reports_every_check(spark):
    df = spark.createDataFrame([(1, 0.5, "Equity"), (2, 3.5, "Gold"), (2, None, "Equity")],
                               "id int, fee double, cls string")
    res = {r["check"]: r for r in qa.expect(df, [
        qa.row_count(equals=3), qa.unique(["id"]), qa.in_range("fee", 0, 3, lo_strict=True),
        qa.in_set("cls", ["Equity"]), qa.not_null(["fee"]),
        qa.columns_exist(df.columns, ["id", "missing"])]).collect()}
    assert res["row_count(eq=3,min=None)"]["passed"]
    assert res["unique(id)"]["failing_rows"] == 1
    assert res["in_range(fee,0,3)"]["failing_rows"] == 2
    assert res["in_set(cls)"]["failing_rows"] == 1
    assert res["not_null(fee)"]["failing_rows"] == 1
    assert not res["columns_exist(id,missing)"]["passed"]


def test_incremental_ingest_partitioned_target(spark):
    root = scratch_path(spark, "test-stream-part")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("day", T.DateType()),
                           T.StructField("v", T.StringType())])
    rows1 = [("1", "2024-01-01", "a"), ("2", "2024-01-02", "b")]
    fs.write_table(spark.createDataFrame(rows1, "k string, day string, v string"), f"{root}/landing/a", fmt="csv")
    args = dict(landing=f"{root}/landing/*", target=f"{root}/t", schema=schema, checkpoint=f"{root}/ck",
                key=["k"], partition_col="day", quarantine=f"{root}/bad")
    assert ing.ingest_incremental(spark, **args) == (2, 0)
    rows2 = [("2", "2024-01-02", "b"), ("3", "2024-01-03", "c")]
    fs.write_table(spark.createDataFrame(rows2, "k string, day string, v string"), f"{root}/landing/b", fmt="csv")
    assert ing.ingest_incremental(spark, **args) == (1, 0)
    got = spark.read.schema(schema).parquet(f"{root}/t").orderBy("k").collect()
    assert [(r["k"], str(r["day"])) for r in got] == [(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")]


def test_anomaly_scores_like_the_published_checks(spark, sf_small):
    """Output checks of the anomaly stage: probabilities in [0, 1], 0.5%-5% flagged."""
    from fundlens.catalog import QUERIES
    df = QUERIES["nav_anomaly_scores"](spark, sf_small).toPandas()
    assert len(df) > 0
    assert df["rf_anomaly_prob"].between(0, 1).all()
    assert 0.005 <= df["rf_is_anomaly"].mean() <= 0.05
    assert df["iso_score"].between(-1, 0).all()


def test_segments_like_the_published_checks(spark, sf_small):
    """Output checks of the segmentation stage: one row per fund, 5 labelled clusters."""
    from fundlens.catalog import QUERIES
    from fundlens.sources import bindings as bd
    seg = QUERIES["fund_segments"](spark, sf_small).toPandas()
    funds = {r[0] for r in bd.fund_dimension(spark, sf_small).select("fund_id").collect()}
    assert set(seg["fund_id"]) == funds
    assert seg["cluster_id"].nunique() == 5 and seg["cluster_label"].notna().all()
    assert seg["avg_return"].between(-1, 1).all() and seg["consistency"].between(0, 1).all()


def test_output_exists_and_defaults(spark):
    root = scratch_path(spark, "test-exists")
    assert not qa.output_exists(spark, f"{root}/missing")
    df = spark.createDataFrame([(1, None), (2, 1)], "id int, is_anomaly int")
    fs.write_table(df, f"{root}/t")
    assert qa.output_exists(spark, f"{root}/t")
    filled = qa.with_defaults(spark.read.parquet(f"{root}/t"), {"is_anomaly": 0})
    assert sorted(tuple(r) for r in filled.collect()) == [(1, 0), (2, 1)]


def test_forest_scores_do_not_move_with_the_number_of_trees(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 3))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "k long, a double, b double, c double").cache()
    medians = []
    for trees in (10, 50, 200):
        f = an.IsolationForest(trees=trees).fit(df, ["a", "b", "c"], [F.col("k")])
        assert f.n_trees == trees and f.m == 256
        medians.append(np.median([r[0] for r in f.score(df).select("iso_score").collect()]))
    assert max(medians) - min(medians) < 0.02 and -0.5 < medians[0] < -0.35
    small = an.IsolationForest(trees=200).fit(df.where("k < 150"), ["a", "b", "c"], [F.col("k")])
    assert small.n_trees == 200 and small.m == 150
    with pytest.raises(ValueError):
        an.IsolationForest(trees=3).fit(df.where("k < 0"), ["a", "b", "c"], [F.col("k")])


def test_seeds_give_unrelated_orders(spark):
    df = spark.range(2000)
    h = np.array([[r[0], r[1]] for r in df.select(an.portable_hash([F.col("id")], 42), an.portable_hash([F.col("id")], 43)).collect()])
    assert len({int(d) for d in (h[:, 1] - h[:, 0]) % an.HASH_P}) > 1990
    assert abs(np.corrcoef(h.T)[0, 1]) < 0.1 and len(set(h[:, 0])) == 2000


def test_split_classes_without_an_edge(spark):
    df = spark.createDataFrame([(i, None if i % 7 == 0 else i % 3) for i in range(500)], "k long, y int")
    got = an.stratified_split(df, "y", [F.col("k")], 1.0).collect()
    assert len(got) == 500 and all(r["is_train"] == 1 for r in got)
    half = an.stratified_split(df, "y", [F.col("k")], 0.5)
    sizes = {r["y"]: (r["n"], r["t"]) for r in half.groupBy("y").agg(F.count("*").alias("n"), F.sum("is_train").alias("t")).collect()}
    assert all(t == n // 2 for n, t in sizes.values()) and len(sizes) == 4


@pytest.mark.parametrize("values", [[], [None, None], [1.0, float("inf"), float("-inf"), 2.0], [5.0] * 40, [3.0]])
def test_order_statistics_of_odd_columns(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    known = sorted(v for v in values if v is not None)
    n, at = ordr.order_statistics(df, "v", range(len(known)))
    assert n == len(known) and [at[i][0] for i in range(n)] == known
    assert ordr.exact_quantile(df, "v", 0.0) == (known[0] if known else None)
    assert ordr.global_rank(df, "v").count() == len(values)


def test_order_statistics_cut_large_ranges_again(spark, monkeypatch):
    monkeypatch.setattr(ordr, "ROWS_PER_RANGE", 3)
    monkeypatch.setattr(ordr, "PROBE_CUTS", 2)
    vals = [float((i * 7919) % 1009) for i in range(700)] + [4.0] * 50
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    _, at = ordr.order_statistics(df, "v", [0, 17, 400, 749])
    assert {r: v for r, (v, _) in at.items()} == {r: sorted(vals)[r] for r in (0, 17, 400, 749)}


def test_conform_needs_every_column_and_required_values(spark):
    from fundlens import schemas
    cols = [f.name for f in schemas.CASH_FLOWS.fields]
    raw = spark.createDataFrame([("1", None, "2024-01-02", "x", "1", "USD", "c", "Settled")], ", ".join(f"{c} string" for c in cols))
    good, bad = fs.conform(raw, schemas.CASH_FLOWS)
    assert good.count() == 0 and bad.first()["_errors"] == ["fund_id"]
    with pytest.raises(ValueError):
        fs.conform(raw.drop("amount"), schemas.CASH_FLOWS)


def test_quarantine_is_counted_and_survives_a_retry(spark):
    root = scratch_path(spark, "test-bad")
    schema = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("v", T.IntegerType())])
    fs.write_table(spark.createDataFrame([("1", "5"), ("x", "6"), (None, "7"), ("2", "y")], "k string, v string"),
                   f"{root}/landing/a", fmt="csv")
    args = dict(landing=f"{root}/landing/*", target=f"{root}/t", schema=schema, key=["k"], quarantine=f"{root}/bad")
    assert ing.ingest_incremental(spark, checkpoint=f"{root}/ck", **args) == (1, 3)
    # the same files again under a new checkpoint: nothing is appended and no bad row is kept twice
    assert ing.ingest_incremental(spark, checkpoint=f"{root}/ck2", **args) == (0, 3)
    assert spark.read.parquet(f"{root}/bad").count() == 3


def test_unlisted_statuses_are_summed(spark):
    from fundlens.plans import reports as rp
    cash = spark.createDataFrame([("a", "Settled", 1.0), ("a", "Cancelled", 5.0), ("a", None, 2.0)],
                                 "transaction_type string, status string, amount double")
    r = rp.cashflow_by_status(cash).first()
    assert (r["settled"], r["pending"], r["other"]) == (1.0, 0.0, 7.0)


def plain_lloyd(x, centres, passes, tol):
    c = np.array(centres, float)
    for turn in range(passes + 1):
        gap = ((x[:, None] - c[None]) ** 2).sum(2)
        near = gap.argmin(1)
        moved = np.array([x[near == i].mean(0) if (near == i).any() else c[i] for i in range(len(c))])
        if ((moved - c) ** 2).sum() <= tol or turn == passes:
            return c, gap.min(1).sum(), turn
        c = moved


def test_passes_of_several_runs_match_plain_lloyd(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, (300, 3)) + rng.integers(0, 3, (300, 1)) * 2
    df = spark.createDataFrame([(v.tolist(),) for v in x] + [(None,), ([1.0, None, 2.0],), ([float("nan")] * 3,)],
                               "features array<double>").repartition(5)
    starts = {"a": x[:3], "b": x[10:14], "far": np.vstack([x[:2], [[99.0, 99.0, 99.0]]])}
    for passes, tol in ((2, 0.0), (300, 1e-4)):
        fits, one = sg.lloyd(df, starts, max_iter=passes, tol=tol), sg.lloyd(df, starts, max_iter=passes, tol=tol, rows=303)
        for name, c in starts.items():
            assert np.allclose(one[name].centres, fits[name].centres) and one[name].passes == fits[name].passes
            want, cost, turns = plain_lloyd(x, c, passes, tol)
            assert np.allclose(fits[name].centres, want) and math.isclose(fits[name].cost, cost, rel_tol=1e-9)
            assert fits[name].passes == turns and fits[name].settled == (passes == 300)


def test_segments_of_rows_without_values(spark):
    df = spark.createDataFrame([(i, float(i % 2), float(i)) for i in range(20)] + [(90, None, 1.0)], "id long, u double, v double")
    seg = sg.segment(df, ["u", "v"], k=2, restarts=2, order_by="v").toPandas().set_index("id")
    assert np.isnan(seg.loc[90, "cluster_id"]) and seg["cluster_id"].nunique() == 2
    none = sg.segment(df.where("id < 0"), ["u", "v"], k=2, order_by="v")
    assert none.count() == 0 and "cluster_id" in none.columns
    assert [r["inertia"] for r in sg.elbow(df.where("id < 0"), ["u", "v"], [2, 3]).collect()] == [0.0, 0.0]


@pytest.mark.parametrize("buckets,edge_rows", [(4096, 1_000_000), (4, 3), (2, 1), (64, 10)])
def test_split_is_the_same_at_any_depth(spark, monkeypatch, buckets, edge_rows):
    monkeypatch.setattr(an, "SPLIT_BUCKETS", buckets)
    monkeypatch.setattr(an, "EDGE_ROWS", edge_rows)
    rows = [(i, [None, "a", "b", "b"][i % 4], i % 3) for i in range(500)] + [(900, "one", 1), (901, "two", 1), (902, "two", 2)]
    df = spark.createDataFrame(rows, "id long, y string, _lo int")
    got = an.stratified_split(df.select("id", "y"), "y", [F.col("id")], 0.8, seed=5)
    hashes = {r["id"]: r["h"] for r in df.select("id", an.portable_hash([F.col("id")], 5).alias("h")).collect()}
    want = set()
    for y in (None, "a", "b", "one", "two"):
        ids = sorted((i for i, c, _ in rows if c == y), key=lambda i: (hashes[i], i))
        want |= set(ids[:math.floor(0.8 * len(ids))])
    assert {r["id"] for r in got.where("is_train = 1").collect()} == want and got.count() == len(rows)


def test_a_forest_written_and_read_back_scores_alike(spark, blobs):
    cols = [c for c in blobs.columns if c != "id"][:2]
    forest = an.IsolationForest(trees=20, max_samples=32, seed=3).fit(blobs, cols, [F.col("id")])
    path = scratch_path(spark, "test-forest")
    forest.nodes(spark).write.parquet(path)
    again = an.IsolationForest.from_nodes(spark.read.parquet(path), cols)
    a = {r["id"]: r["iso_score"] for r in forest.score(blobs).select("id", "iso_score").collect()}
    b = {r["id"]: r["iso_score"] for r in again.score(blobs).select("id", "iso_score").collect()}
    assert a == b and again.n_trees == 20


def test_class_probability_is_that_of_the_fitted_model(spark, blobs):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    cols = ["a", "b", "c"]
    df = blobs.withColumn("a", F.round("a", 1)).withColumn("y", (F.col("a") + F.col("b") > 1.0).cast("int"))
    rf = an.fit_random_forest(df, cols, "y", {0: 1, 1: 5}, trees=20, max_depth=5, key_cols=[F.col("id")])
    want = rf.transform(VectorAssembler(inputCols=cols, outputCol="features").transform(df)).select(
        "id", vector_to_array("probability")[1].alias("p"))
    got = an.class_probability(rf, df, cols).select("id", "rf_anomaly_prob")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # values that equal a threshold go left
    nodes = an.Walk([0, -1, -1], [1.5, 0, 0], [1, -1, -1], [2, -1, -1], [0], [[0.0, 1.0, 2.0]], 1, closed=True)
    assert nodes.sums([pd.Series([1.4, 1.5, 1.6, math.nan])])[0].tolist() == [1.0, 1.0, 2.0, 2.0]


def test_classifier_is_fitted_on_few_partitions(spark):
    """The same rows in 3 or 300 partitions give the same forest, fitted on as many partitions as there are to be."""
    df = spark.range(3000).select("id", (F.col("id") * 37 % 101).cast("double").alias("a"), (F.col("id") * 11 % 53).cast("double").alias("b"))
    df = df.withColumn("y", (F.col("a") + F.col("b") > 110).cast("int"))
    few, many = (an.fit_random_forest(df.repartition(n), ["a", "b"], "y", trees=5, max_depth=4, key_cols=[F.col("id")]) for n in (3, 300))
    assert few.toDebugString.split("\n")[1:] == many.toDebugString.split("\n")[1:]


def test_split_numbers_rows_that_share_hash_and_key(spark):
    """Equal keys at the cut are dealt exactly; the rows of a split are written once and no row gets lost."""
    same = spark.range(100).select("id", F.lit(7).alias("k"), (F.col("id") % 2).cast("int").alias("y"))
    got = an.stratified_split(same, "y", [F.col("k")], 0.5).groupBy("y").agg(F.sum("is_train"), F.count(F.lit(1))).collect()
    assert sorted(map(tuple, got)) == [(0, 25, 50), (1, 25, 50)]
    apart = an.stratified_split(spark.range(1000).withColumn("y", F.lit(1)), "y", [F.col("id")], 0.8)
    assert apart.where("is_train = 1").count() == 800 and apart.count() == 1000
    plan = apart._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Union" not in plan and "transform" not in plan


def test_trailing_sums_are_those_of_the_frames(spark):
    """Long frames cost a row what short ones do: no frame but the running one and single rows before."""
    from pyspark.sql import Window
    from fundlens.operators import aggregates as agg
    from fundlens.operators import windows as win
    d = spark.range(400).select((F.col("id") % 3).alias("g"), "id", F.when(F.col("id") % 7 != 0, (F.col("id") * 7919 % 2003 - 1001) / 100000)
                                .cast("decimal(10,6)").alias("x"))
    w = Window.partitionBy("g").orderBy("id")
    want = d.select("id", *[c for k in (5, 20) for c in agg.integer_sums("x", win.rows_frame(w, k), 6)])
    got = win.with_window(d, "g", "id", 19, win.trailing_sums("x", (5, 20)), plan="direct")
    rows = [[tuple(0 if v is None else int(v) for v in r) for r in f.orderBy("id").collect()] for f in
            (want, got.select("id", "_n5", "_s5", "_q5", "_n20", "_s20", "_q20"))]
    assert rows[0] == rows[1]
    plan = win.anomaly_features(spark.createDataFrame([], "fund_id long, nav_date date, daily_return decimal(10,6), benchmark_return decimal(10,6), "
                                "active_return decimal(10,6), aum decimal(20,2), is_anomaly int"))._jdf.queryExecution().executedPlan().toString()
    assert "-19, currentrow" not in plan


def test_landed_files_are_conformed_once(spark, sf_small):
    """The landed copy is typed and keeps text only of rows that do not fit: later reads convert nothing."""
    from fundlens.catalog import _model_files
    from fundlens import schemas
    root = scratch_path(spark, "test-landed")
    _model_files(spark, sf_small, root)
    names = [f.name for f in schemas.CASH_FLOWS.fields]
    bad = dict.fromkeys(names, "1") | {"transaction_date": "no-date"}
    fs.write_table(spark.createDataFrame([tuple(bad[n] for n in names)], ", ".join(f"{n} string" for n in names)),
                   f"{root}/landing/cash_flows.csv", fmt="csv", mode="append")
    out = fs.ingest_files(spark, f"{root}/landing", f"{root}/tables", run_date="2024-01-02").first()
    assert out["status"] == "Succeeded" and out["cash_flows_count"] == out["source_cash_flows_count"] > 0
    landed = spark.read.parquet(f"{root}/tables/_landed/cash_flows")
    assert landed.schema["amount"].dataType == schemas.CASH_FLOWS["amount"].dataType
    held = spark.read.parquet(f"{root}/tables/_quarantine/cash_flows").collect()
    assert landed.where("_raw IS NOT NULL").count() == len(held) == 1 and held[0]["transaction_date"] == "no-date"


def test_score_table_aggregates_lineitem_once(spark, sf_small, monkeypatch):
    """Rollup, labels, forecasts and rules share one written daily table; the latest scores are found by hash."""
    from fundlens import catalog
    reads, read = [], catalog.b.read
    monkeypatch.setattr(catalog.b, "read", lambda spark, sf, name: reads.append(name) or read(spark, sf, name))
    df = catalog.QUERIES["ml_scores_fixed"](spark, sf_small)
    assert reads.count("lineitem") == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "SortAggregate(key=[fund_id" not in plan


def test_feature_columns_keep_every_row(spark, sf_small):
    """The rows with all features are those of the model frame, beside the daily table as it is."""
    from fundlens.operators import windows as win
    from fundlens.sources import bindings as b
    nav = b.nav_daily(spark, sf_small)
    every = win.feature_columns(nav).cache()
    assert every.select(*nav.columns).exceptAll(nav).isEmpty() and every.count() == nav.count()
    model = win.anomaly_features(nav)
    same = every.where("complete").select(*[F.col(c).cast(t).alias(c) for c, t in model.dtypes])
    assert same.exceptAll(model).isEmpty() and same.count() == model.count() < nav.count()
    # the condition reads the features instead of repeating their expressions
    condition = [c for c in model._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter " in c]
    assert len(condition) == 1 and "atleastnnonnulls" in condition[0].lower() and "SQRT" not in condition[0]
    every.unpersist()


def test_grouped_baseline_meets_its_model_on_the_group(spark):
    """No shuffle of the days by weekday or month; groups without a weekday, with one day or a null key keep their rows."""
    days = spark.range(800).select(
        F.when(F.col("id") % 4 < 3, F.col("id") % 4).alias("g"), F.date_add(F.lit("2023-01-02").cast("date"), (F.col("id") / 4).cast("int")).alias("ds"),
        (1000 + F.col("id") % 13 * 7).cast("decimal(20,2)").alias("y")).where("coalesce(g, 0) <> 1 OR dayofweek(ds) <> 4").where("coalesce(g, 0) <> 2 OR ds = '2023-01-02'")
    ahead = days.select("g").distinct().crossJoin(spark.sql("SELECT explode(sequence(date'2023-08-01', date'2023-08-07')) AS ds"))
    pred = fc.seasonal_baseline(days, ahead, group="g")
    plan = pred._jdf.queryExecution().optimizedPlan().toString()
    assert all("(g#" in c and " AND " not in c for c in (line for line in plan.splitlines() if "Join LeftOuter" in line))
    got = {g: sorted((r["ds"], r["yhat"], r["yhat_lower"]) for r in pred.collect() if r["g"] == g) for g in (0, 1, 2, None)}
    assert [len(got[g]) for g in (0, 1, 2, None)] == [7, 7, 7, 7]
    assert {y for _, y, _ in got[2]} == {y for _, y, _ in got[None]} == {None}
    for g in (0, 1):                                    # a group alone is the series it is
        alone = fc.seasonal_baseline(days.where(F.col("g") == g).select("ds", "y"), ahead.where(F.col("g") == g).select("ds"))
        assert sorted(map(tuple, alone.select("ds", "yhat", "yhat_lower").collect())) == got[g]
    assert None not in {y for _, y, _ in got[1]}        # the missing weekday has the neutral factor


def test_rates_are_squared_in_64_bits(spark):
    """Both parts give the decimal path's deviations to the bit, from the smallest to the widest rates; no decimal sums are left."""
    from pyspark.sql import Window
    from fundlens.operators import aggregates as agg
    from fundlens.operators import windows as win
    us = [0, 1, -1, 65535, -65535, 65536, -65536, 3037000500, -(2 ** 33) + 1, 10 ** 10 - 1, -(10 ** 10) + 1]
    parts = spark.createDataFrame([(u,) for u in us], "u long").select("u", *[c.alias(n) for n, c in zip("hl", agg.square_parts(F.col("u")))])
    assert [r["h"] * 2 ** 32 + r["l"] for r in parts.collect()] == [u * u for u in us]
    rng = np.random.default_rng(3)
    wide = {0: 10 ** 4, 1: 10 ** 6, 2: 10 ** 8, 3: 10 ** 10}
    rows = [(g, i, None if i % 11 == 5 else int(rng.integers(-top + 1, top))) for g, top in wide.items() for i in range(60)]
    d = spark.createDataFrame(rows, "g int, i int, u long").select("g", "i", (F.col("u").cast("decimal(10,0)") / 1000000).cast("decimal(10,6)").alias("x"))
    built = [win.with_window(d, "g", "i", 19, steps("x", (5, 20)), plan="direct") for steps in (win.trailing_sums, win.trailing_parts)]

    def var(f, of, names):
        return [tuple(r) for r in f.select("g", "i", *[of(*[F.col(f"{c}{k}") for c in names], 6) for k in (5, 20)]).orderBy("g", "i").collect()]
    want = var(built[0], agg.var_of_sums, ("_n", "_s", "_q"))
    assert var(built[1], agg.var_of_parts, ("_n", "_s", "_h", "_l")) == want and sum(r[2] is not None for r in want) > 200
    nav = spark.createDataFrame([], "fund_id long, nav_date date, daily_return decimal(10,6), benchmark_return decimal(10,6), "
                                "active_return decimal(10,6), aum decimal(20,2), is_anomaly int")
    assert "decimal(38,0)" not in win.feature_columns(nav)._jdf.queryExecution().optimizedPlan().toString()


def test_daily_sums_are_the_same_in_any_width(spark, tmp_path, sf_small):
    """Ordinary amounts are added as integers; a column with a wide, a null or a non-finite value keeps its digits."""
    from fundlens.sources import bindings as b
    narrow = b.nav_daily(spark, sf_small, measured=True)
    assert narrow.schema == b.nav_daily(spark, sf_small).schema
    assert sorted(map(tuple, narrow.collect())) == sorted(map(tuple, b.nav_daily(spark, sf_small).collect()))
    d = spark.sql("SELECT 999998.99D a, 1000000.0D b, -999999999.5D c, CAST(NULL AS DOUBLE) d, CAST('NaN' AS DOUBLE) e UNION ALL SELECT -1D, 1D, 1D, NULL, 1D")
    assert b.sum_digits(d, dict.fromkeys("abcde", 18)) == {"a": 8, "b": 18, "c": 18, "d": 18, "e": 18}
    li = b.read(spark, sf_small, "lineitem").limit(500).withColumn("l_extendedprice", F.col("l_extendedprice") * 1e9)
    li.write.parquet(f"{tmp_path}/lineitem.parquet")
    assert sorted(map(tuple, b.nav_daily(spark, str(tmp_path), measured=True).collect())) == sorted(map(tuple, b.nav_daily(spark, str(tmp_path)).collect()))
