"""Every registered query with an SQL oracle agrees with DuckDB exactly (sf0.001)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import canon, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns[0] == "asset_class" and len(rows) >= 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    got = canon(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = con.execute(E.oracle_sql()[name])
    want = canon([d[0] for d in res.description], res.fetchall())
    assert got[1] == want[1], "column names differ"
    assert len(got[0]) == len(want[0]), "row counts differ"
    assert got[0] == want[0], "values differ"
