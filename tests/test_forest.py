"""The classifier is fitted on every row: counts, weights, thresholds."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from fundlens.plans import anomaly as an
from fundlens.plans import forest as fo


def roots(spark, model, path):
    """Per tree the draws and class weights at the root."""
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").where("nodeData.id = 0").orderBy("treeID").select("nodeData.*")
    return [(r["rawCount"], list(r["impurityStats"])) for r in nodes.collect()]


def test_every_row_of_a_large_class_is_counted(spark, tmp_path):
    """No class is cut down and scaled up again: without a bootstrap the root holds each row once."""
    df = spark.range(60_000).select("id", (F.col("id") * 7919 % 60_013).cast("double").alias("a"), (F.col("id") % 60 == 0).cast("int").alias("y"))
    m = an.fit_random_forest(df, ["a"], "y", {0: 1, 1: 50}, trees=1, max_depth=2, key_cols=[F.col("id")], bootstrap=False)
    assert roots(spark, m, f"{tmp_path}/once") == [(60_000, [59_000.0, 50_000.0])]
    m = an.fit_random_forest(df, ["a"], "y", {0: 1, 1: 50}, trees=6, max_depth=1, key_cols=[F.col("id")])
    drawn = roots(spark, m, f"{tmp_path}/drawn")
    assert all(abs(n - 60_000) < 6 * math.sqrt(60_000) for n, _ in drawn) and len({n for n, _ in drawn}) > 1
    assert all(abs(s[1] / 50 - 1_000) < 6 * math.sqrt(1_000) for _, s in drawn)


def test_thresholds_come_from_every_row(spark):
    """A handful of rows of a large class decides a split; neither they nor their value may be left out."""
    df = spark.range(200_000).select("id", (F.col("id") % 40_000 == 77).cast("double").alias("a"), (F.col("id") % 2 == 0).cast("int").alias("y"))
    m = an.fit_random_forest(df, ["a"], "y", trees=1, max_depth=1, key_cols=[F.col("id")], bootstrap=False)
    p = an.class_probability(m, df, ["a"]).groupBy("a", "rf_anomaly_prob").count()
    assert sorted(map(tuple, p.collect())) == [(0.0, 100_000 / 199_995, 199_995), (1.0, 0.0, 5)]


def test_training_rows_of_the_model_queries_are_all_used(spark, tmp_path):
    """anomaly_metrics, feature_importance, ml_scores, model_invariants and nav_anomaly_scores share this run."""
    from fundlens import catalog
    split, _, rf, _ = catalog._anomaly_run(spark, "/root/testdata/sf0.01", trees=4)
    n = split.where("is_train = 1").count()
    assert n > 40_000
    assert all(abs(drawn - n) < 6 * math.sqrt(n) for drawn, _ in roots(spark, rf, f"{tmp_path}/rf"))


def test_a_tree_is_that_of_spark_on_all_rows(spark):
    """Two features are both candidates of every node, and 4,000 rows are no sample to Spark: the trees are equal."""
    rng = np.random.default_rng(1)
    a, b = rng.integers(-20, 20, 4000) / 4, rng.integers(0, 60, 4000) * 1.5
    y = ((a * 3 + b / 9 + rng.normal(0, 4, 4000)) > 6).astype(int) + (b > 80)
    df = spark.createDataFrame([(i, *map(float, v), int(c)) for i, (v, c) in enumerate(zip(zip(a, b), y))], "id long, a double, b double, y int")
    weights = {0: 1, 1: 7, 2: 3}
    m = an.fit_random_forest(df, ["a", "b"], "y", weights, trees=1, max_depth=6, key_cols=[F.col("id")], bootstrap=False)
    w = F.element_at(F.create_map(*[F.lit(float(x)) for kv in weights.items() for x in kv]), F.col("y").cast("double"))
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df.withColumn("w", w))
    want = DecisionTreeClassifier(labelCol="y", weightCol="w", maxDepth=6, minInstancesPerNode=3, maxBins=64).fit(data)
    assert m.trees[0].toDebugString.split("\n")[1:] == want.toDebugString.split("\n")[1:] and want.numNodes > 40
    assert np.allclose(m.featureImportances.toArray(), want.featureImportances.toArray(), rtol=1e-9)


@pytest.mark.parametrize("first,nxt", [(16, 8), (3, 1)])
def test_bins_have_equal_weight(spark, monkeypatch, first, nxt):
    """Cuts lie at the weighted quantiles of all rows, on both sides of a frequent value, and between all of few values."""
    monkeypatch.setattr(fo, "FIRST_BITS", first)
    monkeypatch.setattr(fo, "NEXT_BITS", nxt)
    rng = np.random.default_rng(2)
    n = 3000
    cols = {"smooth": rng.normal(1e6, 1e-3, n), "atom": np.where(rng.random(n) < 0.6, 0.0, rng.normal(0, 5, n)),
            "few": rng.choice([-math.inf, -3.0, -0.0, 0.0, 2.0, 1e300, math.inf], n), "one": np.full(n, 4.0)}
    y = (rng.random(n) < 0.1).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(c)) for r, c in zip(zip(*cols.values()), y)], ", ".join(f"{c} double" for c in cols) + ", y int")
    weights = np.array([1.0, 9.0])
    cuts = dict(zip(cols, fo.bin_cuts(df.repartition(5), list(cols), "y", weights, 8)))
    for name in ("smooth", "atom"):
        x = np.sort(cols[name])
        w = weights[y[np.argsort(cols[name], kind="stable")]]
        total, places = w.sum(), set()
        last = np.flatnonzero(np.diff(x, append=math.inf) > 0)             # the last row of each value
        upto = np.cumsum(w)[last]
        for t in total * np.arange(1, 8) / 8:
            at = int(np.searchsorted(upto, t))
            places.add(at - 1 if t - (upto[at - 1] if at else 0.0) < upto[at] - t else at)
        values = x[last]
        want = [(values[p], values[p + 1]) for p in sorted(places) if 0 <= p < len(values) - 1]
        assert len(want) == len(cuts[name]) and all(lo <= c < hi for c, (lo, hi) in zip(cuts[name], want))
    below, above = cols["atom"][cols["atom"] < 0].max(), cols["atom"][cols["atom"] > 0].min()
    assert len({int(cuts["atom"].searchsorted(v)) for v in (below, 0.0, above)}) == 3
    assert len(cuts["few"]) == 5 and len({int(cuts["few"].searchsorted(v)) for v in (-math.inf, -3.0, 0.0, 2.0, 1e300, math.inf)}) == 6
    assert len(cuts["one"]) == 0


def test_passes_and_partitions_do_not_change_the_forest(spark):
    """One tree a pass or all, many small blocks or one: the counts are the same."""
    df = spark.range(2000).select("id", *[(F.col("id") * p % 331).cast("double").alias(f"f{p}") for p in (7, 11, 13, 17, 19)])
    df = df.withColumn("y", (F.col("f7") + F.col("f13") > 350).cast("int"))
    args = [[f"f{p}" for p in (7, 11, 13, 17, 19)], "y", {0: 1, 1: 3}]
    a = an.fit_random_forest(df.repartition(1), *args, trees=7, max_depth=4, key_cols=[F.col("id")])
    b = an.fit_random_forest(df.repartition(40), *args, trees=7, max_depth=4, key_cols=[F.col("id")], max_memory_mb=0)
    assert a.toDebugString.split("\n")[1:] == b.toDebugString.split("\n")[1:]
    assert len({t.toDebugString.split("\n", 1)[1] for t in a.trees}) > 1


def test_odd_tables(spark):
    rows = spark.range(50).select("id", F.lit(1.0).alias("a"), F.lit(0).alias("y"))
    same = an.fit_random_forest(rows, ["a"], "y", trees=2, max_depth=3)
    assert {r["rf_anomaly_prob"] for r in an.class_probability(same, rows, ["a"]).collect()} == {0.0}
    with pytest.raises(ValueError, match="no rows"):
        an.fit_random_forest(rows.where("id < 0"), ["a"], "y")
    with pytest.raises(ValueError, match="no classes"):
        an.fit_random_forest(rows.withColumn("y", F.lit(0.5)), ["a"], "y")
    with pytest.raises(Exception, match="null or not a number"):
        an.fit_random_forest(rows.withColumn("a", F.when(F.col("id") > 3, F.col("a"))), ["a"], "y")
