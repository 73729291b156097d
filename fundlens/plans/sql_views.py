"""The relational model as Spark SQL temp views.

``register_views`` makes ``fund_master``, ``nav_daily``, ``cash_flows``,
``trades`` and ``monthly_performance`` temp views, and the results of the four
view operators beside them, so SQL such as ``SELECT * FROM vw_fund_performance``
runs unchanged on the operators' own plans.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from fundlens.operators.aggregates import monthly_rollup
from fundlens.plans import views
from fundlens.sources import bindings

#: View name: (operator, the fact table it reads beside ``fund_master``).
VIEWS = {
    "vw_aum_by_asset_class": (views.aum_by_asset_class, "nav_daily"),
    "vw_fund_performance": (views.fund_performance, "monthly_performance"),
    "vw_cashflow_summary": (views.cashflow_summary, "cash_flows"),
    "vw_nav_anomalies": (views.nav_anomalies, "nav_daily"),
}


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame] | None = None,
                   sf_dir: str | None = None) -> list[str]:
    """Register the model tables (given, or bound from ``sf_dir``) and the views over them."""
    if tables is None:
        fm = bindings.fund_dimension(spark, sf_dir)
        nav = bindings.nav_daily(spark, sf_dir)
        tables = {"fund_master": fm, "nav_daily": nav, "trades": bindings.trades(spark, sf_dir),
                  "monthly_performance": monthly_rollup(nav, fm)}
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    made = [name for name, (_, fact) in VIEWS.items() if "fund_master" in tables and fact in tables]
    for name in made:
        operator, fact = VIEWS[name]
        operator(tables["fund_master"], tables[fact]).createOrReplaceTempView(name)
    return made
