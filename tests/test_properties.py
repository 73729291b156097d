"""Property tests: distributed order statistics against numpy/pandas on random inputs."""

import math

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fundlens.operators import ordering as ordr
from fundlens.session import shuffle_partitions_for

SETTINGS = dict(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(vals=st.lists(st.integers(-20, 20), min_size=1, max_size=80),
       p=st.floats(0, 1, allow_nan=False))
def test_exact_quantile_property(spark, vals, p):
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = ordr.exact_quantile(df, "v", p)
    assert math.isclose(got, float(np.quantile(np.array(vals, dtype=float), p)), rel_tol=1e-12, abs_tol=1e-12)


@settings(**SETTINGS)
@given(vals=st.lists(st.integers(-10, 10), min_size=1, max_size=80))
def test_global_rank_property(spark, vals):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "id long, v double")
    got = {r["id"]: r["rank"] for r in ordr.global_rank(df, "v", descending=False).collect()}
    want = pd.Series(vals, dtype=float).rank(method="min", ascending=True)
    assert all(got[i] == int(want[i]) for i in range(len(vals)))


def test_order_statistics_edges(spark):
    df = spark.createDataFrame([(7.0,)] * 50, "v double")           # one value everywhere
    n, at = ordr.order_statistics(df, "v", [0, 25, 49, 50])
    assert n == 50 and set(at) == {0, 25, 49} and all(v == (7.0, 0) for v in at.values())


def test_shuffle_partitions_for():
    assert shuffle_partitions_for(0) == 8
    assert shuffle_partitions_for(2.5 * 2**40) == 20480
