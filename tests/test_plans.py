"""Physical-plan properties that matter at scale, checked on the real plans."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from fundlens.operators import joins as jn

SF = "/root/testdata/sf0.001"
MODEL_QUERIES = {"nav_anomaly_scores", "anomaly_metrics", "feature_importance", "kmeans_elbow",
                 "fund_segments", "ml_scores", "forecast_model"}


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - MODEL_QUERIES))
def test_no_cartesian_or_nested_loop_join(spark, name):
    p = plan_text(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["aum_by_asset_class", "fund_performance", "cashflow_summary",
                                  "nav_anomalies"])
def test_views_aggregate_partially_and_read_pruned_columns(spark, name):
    p = plan_text(E.queries()[name](spark, SF))
    assert "partial_sum" in p or "partial_count" in p          # map-side combine before the shuffle
    assert "ReadSchema: struct<l_orderkey" not in p           # scans are pruned


def test_lineitem_scan_reads_only_needed_columns(spark):
    p = plan_text(E.queries()["daily_total_aum"](spark, SF))
    schema = [line for line in p.splitlines() if line.startswith("ReadSchema")]
    assert schema and all("l_comment" not in s and "l_partkey" not in s for s in schema)


def test_a_dimension_is_never_hinted(spark):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        jn.with_dimension(spark.range(100), spark.range(10), "id").explain(True)
    assert "strategy=broadcast" not in buf.getvalue()


def nodes(p: str, kind: str) -> list[str]:
    """Operators of a kind in the tree part of a formatted plan."""
    tree = p.split("\n\n")[0]
    return re.findall(rf"\b{kind} \(\d+\)", tree)


def test_windows_use_one_window_node(spark):
    p = plan_text(E.queries()["anomaly_features"](spark, SF))
    # all rolling columns share one window node; one exchange builds the days, one brings a fund's days together
    assert 1 <= len(nodes(p, "Window")) <= 3
    assert len(nodes(p, "Exchange")) == 2


def test_ranking_joins_nothing_on_the_value(spark):
    p = plan_text(E.queries()["active_return_ranking"](spark, SF))
    assert not nodes(p, "SortMergeJoin")
    assert len(nodes(p, "BroadcastHashJoin")) <= 1               # the partitions' offsets


def test_features_of_a_bucketed_table_need_no_exchange(spark):
    p = plan_text(E.queries()["anomaly_features_bucketed"](spark, SF))
    assert not nodes(p, "Exchange") and nodes(p, "Window")
