"""Sketches that merge, against exact figures."""

import random

import pytest
from pyspark.sql import functions as F

from fundlens.operators import ordering as ordr
from fundlens.operators import sketches as sk


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(2)
    rows = [(i % 12, rng.choice([rng.gauss(0, 3), 1.5, 1.5]), f"u{rng.randrange(30000)}") for i in range(60000)]
    return spark.createDataFrame(rows + [(12, None, None), (3, float("nan"), "x")], "month int, v double, u string").cache()


def test_quantiles_of_merged_sketches_keep_the_rank_error(spark, frame):
    values = sorted(r["v"] for r in frame.where("v IS NOT NULL AND NOT isnan(v)").collect())
    got = sk.quantiles_of(sk.quantile_sketches(frame, "v", ["month"]), [0.01, 0.5, 0.75, 0.999]).first()
    assert got["rows"] == len(values)
    for p in (0.01, 0.5, 0.75, 0.999):
        q = got[f"q{100 * p:g}"]
        below, upto = sum(v < q for v in values) / len(values), sum(v <= q for v in values) / len(values)
        assert below - 2 * sk.rank_error() <= p <= upto + 2 * sk.rank_error()
    by = sk.quantiles_of(sk.quantile_sketches(frame, "v", ["month"]), [0.5], ["month"])
    assert by.count() == 12
    assert abs(ordr.quantile(frame.where("NOT isnan(v)"), "v", 0.9, approx=True) - ordr.quantile(frame.where("NOT isnan(v)"), "v", 0.9)) < 0.2


def test_distinct_counts_of_merged_sketches(frame):
    exact = frame.agg(F.count_distinct("u")).first()[0]
    near = sk.distinct_of(sk.distinct_sketches(frame, "u", ["month"])).first()[0]
    assert abs(near - exact) <= sk.distinct_error() * exact


def test_sketches_of_nothing(frame):
    none = frame.where("month < 0")
    assert tuple(sk.quantiles_of(sk.quantile_sketches(none, "v", ["month"]), [0.5]).first()) == (0, None)
    assert sk.distinct_of(sk.distinct_sketches(none, "u", ["month"])).first()[0] == 0
    assert ordr.quantile(none, "v", 0.5, approx=True) is None
