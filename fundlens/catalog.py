"""Registered queries: one per operator (or natural group of operators).

Each entry takes (spark, sf_dir) and returns a DataFrame computed from the
parquet tables under ``sf_dir``.  Decimal results are returned as doubles.
"""

from __future__ import annotations

import datetime as dt

import numpy as np
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens import schemas
from fundlens.functions import calendar as cal
from fundlens.functions import scalars as sc
from fundlens.operators import aggregates as agg
from fundlens.operators import joins as jn
from fundlens.operators import ordering as ordr
from fundlens.operators import quality as qa
from fundlens.operators import sketches as sk
from fundlens.operators import windows as win
from fundlens.plans import anomaly as an
from fundlens.plans import evaluate as ev
from fundlens.plans import forecast as fc
from fundlens.plans import panel
from fundlens.plans import reports as rp
from fundlens.plans import scores as scr
from fundlens.plans import segment as sg
from fundlens.plans import sql_views
from fundlens.plans import views
from fundlens.session import cut_lineage, scratch_path, written
from fundlens.sources import bindings as b
from fundlens.sources import files as fs
from fundlens.sources import layout as lay
from fundlens.sources import publish as pub
from fundlens.streaming import ingest as ing
from fundlens.streaming import rollup as roll

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def as_doubles(df: DataFrame) -> DataFrame:
    """Cast every DECIMAL column to double (result presentation)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def _monthly(spark, sf):
    return agg.monthly_rollup(b.nav_daily(spark, sf), b.fund_dimension(spark, sf))


# --- bindings --------------------------------------------------------------

@register("fund_dimension")
def q_fund_dimension(spark, sf):
    return as_doubles(b.fund_dimension(spark, sf))


@register("nav_daily")
def q_nav_daily(spark, sf):
    return as_doubles(b.nav_daily(spark, sf))


@register("cash_flows")
def q_cash_flows(spark, sf):
    return as_doubles(b.cash_flows(spark, sf))


# --- views (D1-D5) ----------------------------------------------------------

@register("aum_by_asset_class")
def q_aum_by_asset_class(spark, sf):
    return views.aum_by_asset_class(b.fund_dimension(spark, sf), b.nav_daily(spark, sf))


@register("fund_performance")
def q_fund_performance(spark, sf):
    return views.fund_performance(b.fund_dimension(spark, sf), _monthly(spark, sf))


@register("cashflow_summary")
def q_cashflow_summary(spark, sf):
    return views.cashflow_summary(b.customer_dimension(spark, sf), b.cash_flows(spark, sf))


@register("nav_anomalies")
def q_nav_anomalies(spark, sf):
    return views.nav_anomalies(b.fund_dimension(spark, sf), b.nav_daily(spark, sf))


@register("daily_total_aum")
def q_daily_total_aum(spark, sf):
    return views.daily_total(b.nav_daily(spark, sf))


# --- rollup (D6-D10) --------------------------------------------------------

@register("monthly_rollup")
def q_monthly_rollup(spark, sf):
    return as_doubles(_monthly(spark, sf))


@register("fund_features")
def q_fund_features(spark, sf):
    return as_doubles(agg.fund_features(_monthly(spark, sf), b.fund_dimension(spark, sf)))


# --- windows (E1-E7) --------------------------------------------------------


@register("anomaly_features_bucketed")
def q_anomaly_features_bucketed(spark, sf):
    """The feature frame from a table bucketed by fund: no exchange."""
    path = scratch_path(spark, "nav-by-fund")
    nav = lay.write_by_key(b.nav_daily(spark, sf), path.rsplit("/", 1)[1].replace("-", "_"), path, "fund_id", "nav_date")
    return as_doubles(win.anomaly_features(nav))


@register("anomaly_features")
def q_anomaly_features(spark, sf):
    return win.anomaly_features(b.nav_daily(spark, sf))


@register("anomaly_features_dense")
def q_anomaly_features_dense(spark, sf):
    return win.anomaly_features(b.nav_daily_dense(spark, sf))


@register("return_index")
def q_return_index(spark, sf):
    nav = b.nav_daily(spark, sf).select("fund_id", "nav_date", "daily_return")
    return win.return_index(nav, "fund_id", "nav_date", "daily_return").select(
        "fund_id", "nav_date", "return_index")


# --- ordering, ranks, quantiles (D11-D15, E6, F1-F6) -----------------------


def _perf(spark, sf):
    return views.fund_performance(b.fund_dimension(spark, sf), _monthly(spark, sf))


@register("active_return_ranking")
def q_active_return_ranking(spark, sf):
    p = _perf(spark, sf).select("fund_id", "fund_name", "total_active_return_pct")
    return ordr.global_rank(p, "total_active_return_pct", descending=True, out="active_rank")


@register("top_sharpe_funds")
def q_top_sharpe_funds(spark, sf):
    p = _perf(spark, sf).select("fund_id", "fund_name", "avg_sharpe_ratio")
    return ordr.top_k(p, "avg_sharpe_ratio", 5, tie_break="fund_id")


@register("aum_last_90_days")
def q_aum_last_90_days(spark, sf):
    return ordr.tail_by(views.daily_total(b.nav_daily(spark, sf)), "ds", 90)


@register("nav_first_last")
def q_nav_first_last(spark, sf):
    nav = b.nav_daily(spark, sf)
    return ordr.first_last(nav, "nav_date", "aum", group="fund_id").select(
        "fund_id", F.col("first_value").cast("double").alias("first_aum"),
        F.col("last_value").cast("double").alias("last_aum"), "first_at", "last_at",
        sc.fround(F.abs(F.col("last_value") - F.col("first_value")).cast("double")
                  / F.col("first_value").cast("double"), 8).alias("abs_change"))


@register("largest_fund")
def q_largest_fund(spark, sf):
    f = agg.fund_features(_monthly(spark, sf)).select("fund_id", "avg_aum")
    return ordr.arg_extreme(f, "avg_aum", "fund_id", largest=True)


@register("best_class_by_active_return")
def q_best_class(spark, sf):
    m = _monthly(spark, sf).withColumn("active_return", F.col("active_return").cast("double"))
    g = agg.group_argmax(m, "asset_class", "active_return")
    return g.select("asset_class", sc.fround("mean_value", 10).alias("mean_value"))


@register("fund_master_stats")
def q_fund_master_stats(spark, sf):
    d = b.fund_dimension(spark, sf)
    return d.agg(
        F.count(F.lit(1)).alias("funds"),
        F.count_distinct("asset_class").alias("asset_classes"),
        F.sum("initial_aum").cast("double").alias("total_initial_aum"),
        F.min("initial_aum").cast("double").alias("min_initial_aum"),
        F.max("initial_aum").cast("double").alias("max_initial_aum"),
        agg.exact_mean("initial_aum").alias("mean_initial_aum"),
        F.min("management_fee").cast("double").alias("min_fee"),
        F.max("management_fee").cast("double").alias("max_fee"))


@register("return_quantiles")
def q_return_quantiles(spark, sf):
    # the quantiles read the column several times: it is computed and written once
    feats = cut_lineage(win.anomaly_features(b.nav_daily(spark, sf)).select("return_z_score"))
    ps = (0.5, 0.9, 0.99)
    qs = dict(zip([f"q{int(p * 100)}" for p in ps],
                  ordr.exact_quantiles(feats, "return_z_score", list(ps))))
    row = spark.createDataFrame([tuple(qs.values())], ", ".join(f"{k} double" for k in qs))
    return row.select(*[sc.fround(k, 8).alias(k) for k in qs])


@register("quantiles_from_sketches")
def q_quantiles_from_sketches(spark, sf):
    """Quantiles of daily AUM merged from stored monthly sketches, against the exact values a rank error away."""
    nav = cut_lineage(b.nav_daily(spark, sf).select("nav_date", F.col("aum").cast("double").alias("aum")))
    path = scratch_path(spark, "sketches")
    sk.quantile_sketches(nav, "aum", [F.date_format("nav_date", "yyyy-MM").alias("month")]).write.partitionBy("month").parquet(path)
    ps, eps = (0.1, 0.5, 0.9, 0.99), 0.01
    got = sk.quantiles_of(spark.read.parquet(path), ps).first()
    ends = [min(max(p + d, 0.0), 1.0) for p in ps for d in (-eps, eps)]
    exact = ordr.exact_quantiles(nav, "aum", ends)
    rows = [(p, got["rows"], lo, hi, lo <= got[f"q{100 * p:g}"] <= hi) for p, lo, hi in zip(ps, exact[::2], exact[1::2])]
    out = spark.createDataFrame(rows, "p double, rows long, lo double, hi double, inside boolean")
    return out.select("p", "rows", sc.fround("lo", 4).alias("lo"), sc.fround("hi", 4).alias("hi"), "inside")


@register("distinct_from_sketches")
def q_distinct_from_sketches(spark, sf):
    """Distinct parts and suppliers by year from stored monthly sketches, against the exact counts."""
    li = b.read(spark, sf, "lineitem").select("l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("day"))
    path = scratch_path(spark, "distinct")
    month = [F.year("day").alias("year"), F.month("day").alias("month")]
    parts = sk.distinct_sketches(li, "l_partkey", month).withColumnRenamed("sketch", "parts")
    sk.distinct_sketches(li, "l_suppkey", month).join(parts, ["year", "month"]).write.partitionBy("year").parquet(path)
    kept = spark.read.parquet(path)
    near = sk.distinct_of(kept, ["year"], "suppliers").join(
        sk.distinct_of(kept.select("year", F.col("parts").alias("sketch")), ["year"], "parts"), "year")
    exact = li.groupBy(F.year("day").alias("year")).agg(F.count_distinct("l_partkey").alias("exact_parts"),
                                                        F.count_distinct("l_suppkey").alias("exact_suppliers"))
    off = sk.distinct_error()
    return exact.join(near, "year").select("year", "exact_parts", "exact_suppliers", *[
        (F.abs(F.col(c) - F.col(f"exact_{c}")) <= F.ceil(off * F.col(f"exact_{c}"))).alias(f"{c}_inside") for c in ("parts", "suppliers")])


@register("zscore_above_q99")
def q_zscore_above_q99(spark, sf):
    feats = cut_lineage(win.anomaly_features(b.nav_daily(spark, sf)))
    q = ordr.exact_quantile(feats, "return_z_score", 0.99)
    return feats.filter(F.col("return_z_score") > F.lit(q)).select(
        "fund_id", "nav_date", "return_z_score")


@register("zscore_auc")
def q_zscore_auc(spark, sf):
    feats = win.anomaly_features(b.nav_daily(spark, sf))
    a = ev.auc(feats, "is_anomaly", "return_z_score")
    return a.select(sc.fround("auc", 10).alias("auc"), "positives", "negatives")


@register("zscore_classification")
def q_zscore_classification(spark, sf):
    feats = win.anomaly_features(b.nav_daily(spark, sf))
    pred = feats.withColumn("pred", sc.threshold("return_z_score", 1.0, strict=True))
    m = ev.classification_metrics(pred, "is_anomaly", "pred")
    return m.select("tp", "fp", "fn", "tn", *[sc.fround(c, 10).alias(c)
                                              for c in ("precision", "recall", "f1")])


# --- scalar functions and calendars (B3, B4, B16, H1-H19) ------------------

@register("fund_scalars")
def q_fund_scalars(spark, sf):
    d = b.fund_dimension(spark, sf)
    return d.select(
        "fund_id",
        sc.padded_id("FND", "fund_id", 6).alias("fund_code"),
        sc.fee_accrual("management_fee", "initial_aum").cast("double").alias("monthly_fee"),
        F.year("inception_date").alias("inception_year"),
        F.month("inception_date").alias("inception_month"),
        sc.month_bucket("inception_date").alias("inception_bucket"),
        F.date_add("inception_date", 90).alias("first_review"),
        F.date_sub("inception_date", 30).alias("onboarding"),
        sc.period_flag("inception_date", "2016-01-01", "2016-12-31").alias("launched_2016"),
        sc.threshold("initial_aum", 5000, strict=True).alias("large_fund"),
        sc.floor_at(F.col("initial_aum").cast("double"), 0.0).alias("aum_floor"),
        F.abs(F.col("initial_aum")).cast("double").alias("abs_aum"),
        sc.fround(sc.annualised_vol(F.col("target_volatility").cast("double")), 6).alias("annual_vol"),
        F.lit(0).alias("covid_period"),
        F.date_format(F.col("inception_date"), "yyyy-MM-dd").alias("inception_text"))


@register("trade_notional")
def q_trade_notional(spark, sf):
    li = b.read(spark, sf, "lineitem")
    price = sc.to_decimal(F.col("l_extendedprice") / F.col("l_quantity"), 18, 4)
    return li.select(
        "l_orderkey", "l_linenumber", price.cast("double").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        sc.notional(price, F.col("l_quantity").cast("int")).cast("double").alias("notional"),
        sc.fround(F.col("l_extendedprice") * F.col("l_tax"), 2).alias("commission"))


@register("market_regime")
def q_market_regime(spark, sf):
    # the events lie in one month: dealt over the 73 months up to it they meet every rule
    ev_ = b.read(spark, sf, "events").select(
        "event_id", F.add_months(F.to_date("ts"), -(F.col("event_id") % 73).cast("int")).alias("d"))
    nav = b.nav_daily(spark, sf).select("fund_id", F.col("nav_date").alias("d"))
    dim = b.fund_dimension(spark, sf).select("fund_id", "asset_class")
    rows = nav.join(dim, "fund_id")
    classes = ["Equity", "Fixed Income", "Money Market", "Alternative"]
    cls = F.element_at(F.array(*[F.lit(c) for c in classes]), (F.col("event_id") % 4 + 1).cast("int"))
    ev_rows = ev_.select(F.col("event_id").alias("fund_id"), "d", cls.alias("asset_class"))
    both = rows.unionByName(ev_rows)
    return both.groupBy("asset_class", F.year("d").alias("year"), F.month("d").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(sc.market_regime("d", "asset_class")).cast("double").alias("factor"))


@register("business_days")
def q_business_days(spark, sf):
    nav = b.nav_daily(spark, sf)
    lo, hi = cal.date_range_of(nav, "nav_date")
    days = cal.business_days(spark, lo, hi)
    return days.groupBy(F.year("ds").alias("year")).agg(
        F.count(F.lit(1)).alias("business_days"), F.min("ds").alias("first_day"),
        F.max("ds").alias("last_day"))


@register("month_ends")
def q_month_ends(spark, sf):
    cf = b.cash_flows(spark, sf)
    lo, hi = cal.date_range_of(cf, "transaction_date")
    return cal.month_ends(spark, lo, hi)


@register("forecast_horizon_days")
def q_forecast_horizon_days(spark, sf):
    nav = b.nav_daily(spark, sf)
    return cal.next_business_days(spark, nav.select(F.max("nav_date")).scalar(), 90)


# --- data quality and constraints (L1-L17, N1-N6, C3, C6, C7, G1, G2) -------


REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("quality_fund_master")
def q_quality_fund_master(spark, sf):
    d = b.fund_dimension(spark, sf)
    return qa.expect(d, [
        qa.row_count(at_least=1), qa.unique(["fund_id"]), qa.in_set("asset_class", REGIONS),
        qa.in_range("management_fee", 0, 3, lo_strict=True),
        qa.in_range("initial_aum", 0, None, lo_strict=True),
        qa.not_null(["fund_id", "fund_name"])])


@register("quality_nav_daily")
def q_quality_nav_daily(spark, sf):
    n = b.nav_daily(spark, sf)
    return qa.expect(n, [
        qa.row_count(at_least=1), qa.unique(["fund_id", "nav_date"]),
        qa.in_range("nav", 0, None, lo_strict=True), qa.in_set("is_anomaly", [0, 1]),
        qa.rate_between("is_anomaly", F.col("is_anomaly") == 1, 0.005, 0.02),
        qa.date_range("nav_date", "1992-01-01", "2001-12-31")])


@register("quality_cash_flows")
def q_quality_cash_flows(spark, sf):
    c = b.cash_flows(spark, sf)
    t, amt = F.col("transaction_type"), F.col("amount")
    return qa.expect(c, [
        qa.in_set("transaction_type", PRIORITIES), qa.in_set("status", list(rp.STATUSES)),
        qa.share_above("amount_nonzero", amt != 0, 0.95),
        qa.implies("urgent_positive", t == "1-URGENT", amt > 0),
        qa.implies("low_negative", t == "5-LOW", amt < 0)])


@register("quality_monthly")
def q_quality_monthly(spark, sf):
    m = _monthly(spark, sf)
    return qa.expect(m, [
        qa.row_count(at_least=1),
        qa.share_above("sharpe_within_5", F.col("sharpe_ratio").between(-5, 5), 0.95),
        qa.distinct_count("month"), qa.not_null(["fund_id", "month"])])


@register("duplicate_trade_keys")
def q_duplicate_trade_keys(spark, sf):
    return qa.duplicate_keys(b.trades(spark, sf), ["trade_id"])


@register("duplicate_nav_keys")
def q_duplicate_nav_keys(spark, sf):
    nav = b.nav_daily(spark, sf)
    return qa.duplicate_keys(nav.unionByName(nav.where("fund_id % 10 = 4")), ["fund_id", "nav_date"])


@register("orphan_counts")
def q_orphan_counts(spark, sf):
    li = b.read(spark, sf, "lineitem").select(F.col("l_suppkey").alias("fund_id"))
    # a tenth of each dimension's keys is taken away, so that the checks have something to find
    sup = b.read(spark, sf, "supplier").select(F.col("s_suppkey").alias("fund_id")).where("fund_id % 10 <> 3")
    cash = b.cash_flows(spark, sf)
    cust = b.read(spark, sf, "customer").select(F.col("c_custkey").alias("fund_id")).where("fund_id % 10 <> 3")
    nav_or = jn.orphans(b.nav_daily(spark, sf), b.fund_dimension(spark, sf).where("fund_id % 10 <> 3"), "fund_id")

    def total(o):
        return o.select(F.coalesce(F.sum("rows"), F.lit(0)).cast("long"))
    return total(jn.orphan_keys(li, sup, "fund_id")).toDF("lineitem_orphans").select(
        "lineitem_orphans",
        total(jn.orphan_keys(cash, cust, "fund_id")).scalar().alias("cash_orphans"),
        nav_or.select(F.count(F.lit(1))).scalar().alias("nav_orphans"))


@register("null_counts")
def q_null_counts(spark, sf):
    cash = b.cash_flows(spark, sf)
    for col, every in (("fund_id", 11), ("amount", 10), ("status", 7)):
        cash = cash.withColumn(col, F.when(F.col("transaction_id") % every != 0, F.col(col)))
    return qa.null_counts(cash, schemas.NOT_NULL["cash_flows"] + ["amount", "status"])


@register("defaults_applied")
def q_defaults_applied(spark, sf):
    nav = b.nav_daily(spark, sf).withColumn("is_anomaly", F.when(F.col("fund_id") % 10 != 5, F.col("is_anomaly")))
    filled = qa.with_defaults(nav, fs.DEFAULTS["nav_daily"])
    return filled.groupBy("is_anomaly").agg(F.count(F.lit(1)).alias("rows"))


@register("schema_violations")
def q_schema_violations(spark, sf):
    order = F.split_part("trade_id", F.lit("-"), F.lit(1)).cast("long")
    t = b.trades(spark, sf).withColumns({
        "trade_id": F.concat("trade_id", F.when(order % 10 == 0, "-amended-late").otherwise("")),
        "quantity": F.when(order % 8 == 0, F.lit(3_000_000_000)).otherwise(F.col("quantity").cast("long")),
        "commission": F.col("notional") * F.when(order % 9 == 0, 10_000_000).otherwise(0)})
    declared = fs.project_schema(schemas.TRADES, ["trade_id", "trade_date", "quantity", "commission"])
    return qa.schema_violations(t, declared, schemas.MAX_LENGTH["trades"])


@register("key_sets")
def q_key_sets(spark, sf):
    return jn.key_set_diff(b.nav_daily(spark, sf).where("fund_id % 10 <> 1"),
                           b.fund_dimension(spark, sf).where("fund_id % 10 <> 2"), "fund_id")


@register("cash_on_nav_dates")
def q_cash_on_nav_dates(spark, sf):
    cash = b.cash_flows(spark, sf).groupBy(F.col("transaction_date").alias("ds")).agg(
        F.sum("amount").cast("double").alias("amount"))
    navd = views.daily_total(b.nav_daily(spark, sf))
    return jn.present_in(cash, navd, "ds")


# --- reports (M1-M9, B17) ---------------------------------------------------

@register("kpis")
def q_kpis(spark, sf):
    return rp.kpis(b.fund_dimension(spark, sf), b.nav_daily(spark, sf))


@register("aum_share")
def q_aum_share(spark, sf):
    return rp.aum_share(b.fund_dimension(spark, sf), b.nav_daily(spark, sf))


@register("return_trend")
def q_return_trend(spark, sf):
    return rp.return_trend(_monthly(spark, sf))


@register("asia_return_trend")
def q_asia_return_trend(spark, sf):
    return rp.return_trend(rp.slice_by(_monthly(spark, sf), "asset_class", "ASIA"))


@register("risk_return_by_class")
def q_risk_return_by_class(spark, sf):
    f = agg.fund_features(_monthly(spark, sf), b.fund_dimension(spark, sf))
    return rp.risk_return(f, "asset_class")


@register("leaderboard")
def q_leaderboard(spark, sf):
    seg = b.fund_dimension(spark, sf).select("fund_id", F.col("region").alias("segment"))
    return rp.leaderboard(_perf_full(spark, sf), seg)


def _perf_full(spark, sf):
    return views.fund_performance(b.fund_dimension(spark, sf), _monthly(spark, sf))


@register("anomalies_over_time")
def q_anomalies_over_time(spark, sf):
    return rp.anomalies_over_time(b.nav_daily(spark, sf))


@register("cashflow_by_status")
def q_cashflow_by_status(spark, sf):
    tenth = F.col("transaction_id") % 10
    status = F.when(tenth == 3, "Cancelled").when(tenth == 7, F.lit(None)).otherwise(F.col("status"))
    return rp.cashflow_by_status(b.cash_flows(spark, sf).withColumn("status", status))


@register("status_breakdown")
def q_status_breakdown(spark, sf):
    return rp.status_breakdown(b.cash_flows(spark, sf))


# --- sources, sinks, ingestion (A1-A12, I1) ---------------------------------


NAV_CSV_COLUMNS = ["fund_id", "nav_date", "aum", "daily_return", "benchmark_return",
                   "active_return", "is_anomaly"]


@register("csv_roundtrip_nav")
def q_csv_roundtrip_nav(spark, sf):
    path = scratch_path(spark, "nav-csv")
    fs.write_table(b.nav_daily(spark, sf), path, fmt="csv", columns=NAV_CSV_COLUMNS)
    back = fs.read_table(spark, path, schemas.NAV_DAILY, fmt="csv", glob="*.csv",
                         columns=NAV_CSV_COLUMNS)
    return as_doubles(back.select(*NAV_CSV_COLUMNS))


@register("conform_cash_flows")
def q_conform_cash_flows(spark, sf):
    raw = fs.as_text(b.cash_flows(spark, sf))
    good, _ = fs.conform(raw, schemas.CASH_FLOWS)
    return as_doubles(good)


@register("conform_quarantine")
def q_conform_quarantine(spark, sf):
    """Faults by key; every row is either good (no errors) or kept with the names of its faults."""
    raw, k = fs.as_text(b.cash_flows(spark, sf)), F.col("transaction_id").cast("long")
    raw = raw.withColumns({"fund_id": F.when(k % 13 != 0, F.col("fund_id")),
                           "transaction_date": F.when(k % 11 == 0, "soon").otherwise(F.col("transaction_date")),
                           "amount": F.when(k % 10 == 1, "n/a").otherwise(F.col("amount"))})
    good, bad = fs.conform(raw, schemas.CASH_FLOWS)
    errors = good.select(F.lit("").alias("errors")).unionByName(bad.select(F.array_join("_errors", ",").alias("errors")))
    return errors.groupBy("errors").agg(F.count(F.lit(1)).alias("rows"))


@register("row_counts")
def q_row_counts(spark, sf):
    return fs.row_counts({"fund_master": b.fund_dimension(spark, sf),
                          "nav_daily": b.nav_daily(spark, sf),
                          "cash_flows": b.cash_flows(spark, sf),
                          "trades": b.trades(spark, sf)})


def _model_files(spark, sf, root, missing=None):
    """Land the four model tables as delimited files: one dimension for both kinds of fund.

    ``missing`` takes dimension keys away by the given conditions on suppliers and customers.
    """
    fund, cash_fund, prefixed = b.fund_dimension(spark, sf), b.customer_dimension(spark, sf), "CAST(fund_id AS STRING)"
    if missing:
        fund, cash_fund = fund.where(f"NOT ({missing[0]})"), cash_fund.where(f"NOT ({missing[1]})")

    def keyed(df, kind):
        return df.withColumn("fund_id", F.concat(F.lit(kind), F.expr(prefixed)))

    def declared(df, schema):
        return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast("string").alias(f.name)
                           for f in schema.fields])

    landed = {"fund_master": keyed(fund, "S").unionByName(keyed(cash_fund, "C"), allowMissingColumns=True),
              "nav_daily": keyed(b.nav_daily(spark, sf), "S"), "cash_flows": keyed(b.cash_flows(spark, sf), "C"),
              "trades": keyed(b.trades(spark, sf), "S")}
    for name, df in landed.items():
        fs.write_table(fs.as_text(declared(df, fs.SCHEMAS[name])), f"{root}/landing/{fs.FILE_NAMES[name]}", fmt="csv")


@register("ingest_run")
def q_ingest_run(spark, sf):
    """Land all four model tables, run the daily file load, return its counts and its log record."""
    root = scratch_path(spark, "ingest")
    _model_files(spark, sf, root)
    out = fs.ingest_files(spark, f"{root}/landing", f"{root}/tables", run_date="2024-01-02")
    log = spark.read.parquet(f"{root}/tables/_run_log")
    return out.select("*", *[log.select(c).scalar().alias(f"logged_{c.removesuffix('_name')}")
                             for c in ("pipeline_name", "status", "run_date")])


@register("ingest_orphans")
def q_ingest_orphans(spark, sf):
    """A load whose facts have keys without a dimension row: it must fail and log what is missing."""
    root = scratch_path(spark, "ingest-orphans")
    _model_files(spark, sf, root, ("fund_id % 10 = 3", "fund_id % 10 = 4"))
    try:
        fs.ingest_files(spark, f"{root}/landing", f"{root}/tables", run_date="2024-01-02")
    except ValueError:
        return spark.read.parquet(f"{root}/tables/_run_log").select("status", "details")
    raise AssertionError("the orphan gate did not fire")


EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), False), T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("user_id", T.LongType(), True), T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DecimalType(18, 2), True), T.StructField("day", T.DateType(), True)])


@register("ingest_quarantine")
def q_ingest_quarantine(spark, sf):
    """Events with faults made by key: what conforms is appended, the rest is kept aside and counted."""
    root, k = scratch_path(spark, "stream-bad"), F.col("event_id")
    ev_ = b.read(spark, sf, "events").select("event_id", "ts", "user_id", "event_type",
                                             F.col("value").cast("decimal(18,2)").alias("value"), F.to_date("ts").alias("day"))
    text = fs.as_text(ev_).withColumn("value", F.when(k.cast("long") % 10 == 2, "?").otherwise(F.col("value")))
    text = text.withColumn("event_id", F.when(k.cast("long") % 17 != 0, k))
    fs.write_table(text, f"{root}/landing/w1", fmt="csv")
    got = ing.ingest_incremental(spark, landing=f"{root}/landing/*", target=f"{root}/events", schema=EVENT_SCHEMA,
                                 checkpoint=f"{root}/_checkpoint", key=["event_id"], partition_col="day",
                                 quarantine=f"{root}/_quarantine")
    bad = spark.read.parquet(f"{root}/_quarantine")
    return bad.select(F.lit(got.appended).cast("long").alias("appended"), F.lit(got.quarantined).cast("long").alias("quarantined"),
                      "_errors").groupBy("appended", "quarantined").agg(
        F.count_if(F.array_contains("_errors", "value")).alias("bad_values"),
        F.count_if(F.array_contains("_errors", "event_id")).alias("missing_ids"))


@register("incremental_ingest")
def q_incremental_ingest(spark, sf):
    """Land events as daily CSV files in two waves; ingest after each and once more."""
    root = scratch_path(spark, "stream")
    ev_ = b.read(spark, sf, "events").select("event_id", "ts", "user_id", "event_type",
                                             F.col("value").cast("decimal(18,2)").alias("value"),
                                             F.to_date("ts").alias("day"))
    day = F.to_date("ts")
    mid = ev_.select(F.percentile_approx(F.dayofmonth("ts"), 0.5)).scalar()
    wave1 = ev_.filter(F.dayofmonth(day) <= mid)
    wave2 = ev_.filter(F.dayofmonth(day) > mid)
    # the second wave re-delivers a slice of the first: duplicates must not land twice
    redelivered = wave1.filter(F.dayofmonth(day) == mid)
    fs.write_table(fs.as_text(wave1), f"{root}/landing/w1", fmt="csv")
    args = dict(landing=f"{root}/landing/*", target=f"{root}/events", schema=EVENT_SCHEMA,
                checkpoint=f"{root}/_checkpoint", key=["event_id"], partition_col="day",
                quarantine=f"{root}/_quarantine")
    ing.ingest_incremental(spark, **args)
    fs.write_table(fs.as_text(wave2.unionByName(redelivered)), f"{root}/landing/w2", fmt="csv")
    ing.ingest_incremental(spark, **args)
    ing.ingest_incremental(spark, **args)
    out = spark.read.schema(EVENT_SCHEMA).parquet(f"{root}/events").drop("day")
    return as_doubles(out)


NAV_ROWS = T.StructType([
    T.StructField("fund_id", T.LongType(), False), T.StructField("nav_date", T.DateType(), False),
    T.StructField("nav", T.DoubleType(), True), T.StructField("aum", T.DecimalType(20, 2), True),
    T.StructField("daily_return", T.DecimalType(10, 6), True), T.StructField("benchmark_return", T.DecimalType(10, 6), True),
    T.StructField("is_anomaly", T.IntegerType(), True)])


@register("rollup_two_waves")
def q_rollup_two_waves(spark, sf):
    """The monthly rollup kept by two waves of days, the second with days of the first; compacted in between."""
    root = scratch_path(spark, "rollup")
    nav = cut_lineage(b.nav_daily(spark, sf).select(*NAV_ROWS.fieldNames()))
    day = F.dayofmonth("nav_date")
    args = dict(landing=f"{root}/landing/*", root=f"{root}/tables", schema=NAV_ROWS, checkpoint=f"{root}/_checkpoint")
    fs.write_table(fs.as_text(nav.where(day <= 15)), f"{root}/landing/w1", fmt="csv")
    roll.ingest_with_rollup(spark, **args)
    roll.compact(spark, f"{root}/tables", NAV_ROWS)
    fs.write_table(fs.as_text(nav.where(day >= 14)), f"{root}/landing/w2", fmt="csv")
    roll.ingest_with_rollup(spark, **args)
    roll.ingest_with_rollup(spark, **args)
    return as_doubles(roll.current_rollup(spark, f"{root}/tables", NAV_ROWS, b.fund_dimension(spark, sf)))


@register("load_all_or_none")
def q_load_all_or_none(spark, sf):
    """Four tables are loaded; a run whose third table breaks and a run with orphans change nothing; a whole run does."""
    root = scratch_path(spark, "publish")
    fund = b.fund_dimension(spark, sf).select("fund_id", "asset_class")
    cash = b.cash_flows(spark, sf).select((F.col("fund_id") % 10).alias("fund_id"), "transaction_id", "amount")
    first = {"fund_master": fund, "nav_daily": b.nav_daily(spark, sf).select("fund_id", "nav_date", "aum"), "cash_flows": cash,
             "trades": b.trades(spark, sf).select("fund_id", F.col("trade_id"))}
    pub.load_all(spark, first, root, "2024-01-02")
    broken = F.when(F.col("transaction_id") % 7 == 3, F.raise_error(F.lit("damaged row"))).otherwise(F.col("amount"))
    runs = [{**first, "nav_daily": first["nav_daily"].where("false"), "cash_flows": cash.withColumn("amount", broken.cast("decimal(20,2)"))},
            {**first, "fund_master": fund.where("fund_id > 1")}]
    refused = 0
    for tables in runs:
        try:
            pub.load_all(spark, tables, root, "2024-01-03")
        except pub.NotPublished:
            refused += 1
    kept = {n: pub.read_current(spark, root, n) for n in first}
    pub.load_all(spark, {"cash_flows": cash.where("transaction_id % 2 = 0")}, root, "2024-01-04")
    now = pub.manifest(spark, root)["tables"]
    log = spark.read.parquet(f"{root}/_run_log")
    return fs.row_counts(kept).select(
        "*", kept["cash_flows"].agg(F.sum("amount")).scalar().cast("double").alias("cash_kept"),
        pub.read_current(spark, root, "cash_flows").agg(F.count(F.lit(1))).scalar().alias("cash_now"),
        F.lit(now["cash_flows"]["rows"]).cast("long").alias("cash_observed"), F.lit(refused).alias("refused"),
        log.where("status = 'Failed'").agg(F.count(F.lit(1))).scalar().alias("failed_runs"))


# --- forecasting (K1-K3, B1, C2, C3, D16) ----------------------------------


HORIZON = 90


def _forecast_inputs(spark, sf):
    # one row per day: materialised once, every later step works on it
    daily = cut_lineage(views.daily_total(b.nav_daily(spark, sf)))
    train, test = fc.time_split(daily, "ds", fc.split_point(daily, "ds", 0.8))
    horizon = cal.next_business_days(spark, train.select(F.max("ds")).scalar(), HORIZON)
    return daily, train, test, horizon


@register("forecast_baseline")
def q_forecast_baseline(spark, sf):
    _, train, _, horizon = _forecast_inputs(spark, sf)
    return fc.seasonal_baseline(train, horizon)


@register("forecast_evaluation")
def q_forecast_evaluation(spark, sf):
    _, train, test, horizon = _forecast_inputs(spark, sf)
    pred = fc.seasonal_baseline(train, horizon)
    e = ev.forecast_error(jn.present_in(test, pred, "ds"), pred)
    return e.select("n", sc.fround("mape", 8).alias("mape"), sc.fround("mae", 6).alias("mae"))


@register("forecast_model")
def q_forecast_model(spark, sf):
    _, train, _, horizon = _forecast_inputs(spark, sf)
    span = train.agg(F.min("ds"), F.max("ds")).first()
    lo = span[0]
    model = fc.LogLinearForecaster(regressors=_periods(lo, span[1])).fit(train)
    return model.predict(horizon, overrides={"early_period": 0.0})


def _periods(first, last):
    """Two period regressors: an early one, set to zero on a horizon, and a late one that reaches into it."""
    return {"early_period": (first.isoformat(), (first + dt.timedelta(days=365)).isoformat()),
            "late_period": ((last - dt.timedelta(days=365)).isoformat(), (last + dt.timedelta(days=60)).isoformat())}


@register("forecast_features")
def q_forecast_features(spark, sf):
    """The forecaster's inputs on the training days and the horizon, rounded to 8 places."""
    _, train, _, horizon = _forecast_inputs(spark, sf)
    lo, hi = train.agg(F.min("ds"), F.max("ds")).first()
    both = train.select("ds").unionByName(horizon.select("ds"))
    feats, names = fc.forecast_features(both, "ds", F.lit(lo), float((hi - lo).days), regressors=_periods(lo, hi))
    return feats.select("ds", *[sc.fround(n, 8).alias(n) for n in names])


def _fund_horizon(spark, nav, steps=(30, 60, 90)):
    """(fund_id, ds, step): the given business days after the last day, for every fund."""
    days = cal.next_business_days(spark, nav.select(F.max("ds")).scalar(), max(steps))
    picked = days.withColumn("step", F.row_number().over(Window.orderBy("ds"))) \
        .filter(F.col("step").isin(list(steps)))   # a 90-row calendar frame
    funds = nav.select("fund_id").distinct()
    marks = [(r["ds"], r["step"]) for r in picked.collect()]          # three dates
    return funds.select("fund_id", F.explode(F.array(*[
        F.struct(F.lit(d).alias("ds"), F.lit(s).alias("step")) for d, s in marks])).alias("_h")) \
        .select("fund_id", "_h.ds", "_h.step")


def _fund_days(spark, sf):
    """Every fund's daily AUM, written once: the models read it several times."""
    return written(b.nav_daily(spark, sf).select("fund_id", F.col("nav_date").alias("ds"), F.col("aum").alias("y")), "fund-days")


def _fund_forecasts(spark, nav, steps=(30, 60, 90)):
    horizon = _fund_horizon(spark, nav, steps)
    pred = fc.seasonal_baseline(nav, horizon.select("fund_id", "ds"), group="fund_id")
    return pred.join(horizon, ["fund_id", "ds"])


@register("fund_forecasts")
def q_fund_forecasts(spark, sf):
    return _fund_forecasts(spark, _fund_days(spark, sf))


#: the trend model that SQL can recompute: intercept, trend and one hinge
TREND_MODEL = dict(changepoints=1, yearly=0, weekly=0)


@register("fund_trend_model")
def q_fund_trend_model(spark, sf):
    """Coefficients of the trend model of every fund."""
    fit = panel.fit_forecast(_fund_days(spark, sf), group="fund_id", **TREND_MODEL)
    return fit.select("fund_id", "n", "last_ds", *[sc.fround(F.element_at("beta", i), 6).alias(c) for i, c in
                                                  enumerate(("intercept", "trend", "cp1"), 1)], sc.fround("sigma", 6).alias("sigma"))


@register("fund_trend_forecasts")
def q_fund_trend_forecasts(spark, sf):
    """The trend model's forecasts; intervals widen with the step the trend took."""
    nav = _fund_days(spark, sf)
    fit = panel.fit_forecast(nav, group="fund_id", **TREND_MODEL)
    pred = panel.predict_forecast(fit, _fund_horizon(spark, nav), group="fund_id", **TREND_MODEL)
    return pred.select("fund_id", "ds", "step", *[sc.fround(c, 2).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")])


@register("fund_trend_coverage")
def q_fund_trend_coverage(spark, sf):
    """Share of the held-out days of all funds inside the trend model's interval."""
    nav = _fund_days(spark, sf)
    train, test = fc.time_split(nav, "ds", fc.split_point(nav, "ds", 0.8))
    fit = panel.fit_forecast(train, group="fund_id", **TREND_MODEL)
    pred = panel.predict_forecast(fit, test.select("fund_id", "ds"), group="fund_id", **TREND_MODEL)
    e = ev.interval_coverage(test, pred, ["fund_id", "ds"])
    return e.select("n", "inside", sc.fround("coverage", 8).alias("coverage"))


@register("fund_model_forecasts")
def q_fund_model_forecasts(spark, sf):
    """One full model per fund: 25 changepoints, yearly and weekly seasons, two period regressors."""
    nav = _fund_days(spark, sf)
    lo, hi = nav.agg(F.min("ds"), F.max("ds")).first()
    periods = _periods(lo, hi)
    fit = cut_lineage(panel.fit_forecast(nav, group="fund_id", start=F.lit(lo), span=float(max((hi - lo).days, 1)), regressors=periods))
    return panel.predict_forecast(fit, _fund_horizon(spark, nav), group="fund_id", regressors=periods, overrides={"early_period": 0.0})


# --- anomaly models (K4-K12) -------------------------------------------------

def feature_keys():
    return [F.col("fund_id"), an.day_number("nav_date")]


@register("rolling_aum_std")
def q_rolling_aum_std(spark, sf):
    w = Window.partitionBy("fund_id").orderBy("nav_date")
    return b.nav_daily(spark, sf).select("fund_id", "nav_date", win.rolling_std("aum", w, 20, scale=2).alias("aum_20d_std"))


@register("stratified_split")
def q_stratified_split(spark, sf):
    f = win.anomaly_features(b.nav_daily(spark, sf)).select("fund_id", "nav_date", "is_anomaly")
    return an.stratified_split(f, "is_anomaly", feature_keys(), 0.8, seed=42)


def _rule_inputs():
    return [F.least(F.col("return_20d_std") * 20, F.lit(1.0)).alias("p"),
            (F.lit(-0.4) - F.least(F.abs("return_z_score"), F.lit(10.0)) * 0.02).alias("iso")]


def _ensemble_rule(inputs):
    e = an.ensemble(inputs, "p", "iso")
    return e.select("fund_id", "nav_date", sc.fround("ensemble_score", 10).alias("ensemble_score"),
                    "rf_is_anomaly")


@register("ensemble_rule")
def q_ensemble_rule(spark, sf):
    f = win.anomaly_features(b.nav_daily(spark, sf)).select("fund_id", "nav_date", *_rule_inputs())
    return _ensemble_rule(written(f, "rule-inputs"))


def _anomaly_run(spark, sf, trees=200):
    # the split writes the feature frame once, with the hash of the isolation forest's draws: both models and scoring read it
    feats = an.with_hash(win.anomaly_features(b.nav_daily(spark, sf)), feature_keys(), 42, "_iso_hash")
    split = an.stratified_split(feats, "is_anomaly", feature_keys(), 0.8, seed=42)
    train = split.filter("is_train = 1")
    iso = an.IsolationForest(trees=trees, contamination=0.01, seed=42).fit(
        train, win.FEATURES, feature_keys(), hashed="_iso_hash")
    rf = an.fit_random_forest(train, win.FEATURES, "is_anomaly", {0: 1, 1: 50}, trees=trees, key_cols=feature_keys())
    # both scores feed the offset, the forest output and the ensemble: one pass makes them, written once
    probs = written(an.class_probability(rf, iso.score(split), win.FEATURES).select(
        "fund_id", "nav_date", "is_anomaly", "is_train", "iso_score", "rf_anomaly_prob"), "anomaly-scores")
    iso.set_offset(probs.filter("is_train = 1"))
    return split, iso, rf, probs


@register("nav_anomaly_scores")
def q_nav_anomaly_scores(spark, sf):
    _, iso, rf, probs = _anomaly_run(spark, sf)
    out = an.ensemble(iso.predict(probs), "rf_anomaly_prob", "iso_score")
    return out.select("fund_id", "nav_date", "rf_anomaly_prob", "iso_score", "ensemble_score",
                      "rf_is_anomaly", "iso_outlier")


#: a small forest: (tree, node, depth, feature, threshold, left, right, size)
FIXED_FOREST = [(0, 0, 0, win.FEATURES.index("return_z_score"), 1.5, 1, 2, 256),
                (0, 1, 1, win.FEATURES.index("return_20d_std"), 0.02, 3, 4, 230), (0, 2, 1, -1, 0.0, -1, -1, 26),
                (0, 3, 2, -1, 0.0, -1, -1, 180), (0, 4, 2, -1, 0.0, -1, -1, 50),
                (1, 0, 0, win.FEATURES.index("aum_change_pct"), 0.0, 1, 2, 256), (1, 1, 1, -1, 0.0, -1, -1, 100),
                (1, 2, 1, win.FEATURES.index("daily_return"), 0.01, 3, 4, 156), (1, 3, 2, -1, 0.0, -1, -1, 155),
                (1, 4, 2, -1, 0.0, -1, -1, 1), (2, 0, 0, -1, 0.0, -1, -1, 2)]


@register("forest_scores_fixed")
def q_forest_scores_fixed(spark, sf):
    """A fixed forest, written as a node table and read back, scores every row of the feature frame."""
    path = scratch_path(spark, "forest")
    fs.write_table(spark.createDataFrame(FIXED_FOREST, an.TREE_SCHEMA), path)
    forest = an.IsolationForest.from_nodes(spark.read.parquet(path), win.FEATURES)
    scored = forest.score(win.anomaly_features(b.nav_daily(spark, sf)))
    return scored.select("fund_id", "nav_date", sc.fround("iso_score", 9).alias("iso_score"))


@register("forest_split_fixed")
def q_forest_split_fixed(spark, sf):
    """One split of the classifier over all rows on ten levels of the AUM rise: class-1 probability per level.

    Two leaves that predict the same class are one leaf.
    """
    f = cut_lineage(win.anomaly_features(b.nav_daily(spark, sf)).select(
        F.least(F.floor(F.greatest("aum_change_pct", F.lit(0.0)) * 2), F.lit(9)).cast("double").alias("level"), "is_anomaly"))
    model = an.fit_random_forest(f, ["level"], "is_anomaly", {0: 1, 1: 44}, trees=1, max_depth=1, bootstrap=False)
    levels = f.groupBy("level").agg(F.count(F.lit(1)).alias("rows"))
    out = an.class_probability(model, levels, ["level"])
    return out.select("level", "rows", sc.fround("rf_anomaly_prob", 9).alias("rf_anomaly_prob"))


@register("anomaly_metrics")
def q_anomaly_metrics(spark, sf):
    _, _, _, probs = _anomaly_run(spark, sf)
    test = probs.filter("is_train = 0").withColumn(
        "pred", sc.threshold("rf_anomaly_prob", 0.3, strict=False))
    a = ev.auc(test, "is_anomaly", "rf_anomaly_prob").select("auc")
    m = ev.classification_metrics(test, "is_anomaly", "pred")
    return m.select("*", a.scalar().alias("auc"))


@register("feature_importance")
def q_feature_importance(spark, sf):
    _, _, rf, _ = _anomaly_run(spark, sf)
    imp = an.importance(rf, win.FEATURES)                 # ten features
    return ordr.top_k(spark.createDataFrame(imp, "feature string, importance double"),
                      "importance", 5, tie_break="feature")


# --- segmentation (K13-K16, B15, C4, C5, D10) -------------------------------

def _seg_features(spark, sf):
    return agg.fund_features(_monthly(spark, sf), b.fund_dimension(spark, sf))


@register("standardised_features")
def q_standardised_features(spark, sf):
    f = _seg_features(spark, sf)
    return sg.standardise(f.select("fund_id", *sg.CLUSTER_FEATURES), sg.CLUSTER_FEATURES)


def _fixed_labels(features):
    return sg.label_clusters(agg.cluster_profile(features.withColumn("cluster_id", F.col("fund_id") % 5)))


@register("cluster_labels_fixed")
def q_cluster_labels_fixed(spark, sf):
    return _fixed_labels(_seg_features(spark, sf))


@register("map_values_fixed")
def q_map_values_fixed(spark, sf):
    """Labels of the first three clusters mapped onto funds; the other clusters take the default."""
    f = _seg_features(spark, sf).select("fund_id", (F.col("fund_id") % 5).alias("cluster_id"))
    labels = q_cluster_labels_fixed(spark, sf).where("cluster_id < 3").select("cluster_id", "cluster_label")
    return sg.map_values(f, "cluster_id", labels, "cluster_id", "cluster_label", "cluster_label", "Unassigned")


@register("ml_scores_fixed")
def q_ml_scores_fixed(spark, sf):
    """The score table from the rule-based ensemble, fixed clusters and the baseline forecasts.

    The daily table and the rules' inputs come from one aggregate of lineitem and one shuffle by fund.  They are
    written in that order, so rollup, forecasts and latest scores add up a fund's days before any shuffle.
    """
    days = written(win.feature_columns(b.nav_daily(spark, sf, measured=True)).select(
        "fund_id", "nav_date", "nav", "aum", "daily_return", "benchmark_return", "is_anomaly", "complete", *_rule_inputs()), "fund-days")
    dim = b.fund_dimension(spark, sf)
    f = written(agg.fund_features(agg.monthly_rollup(days, dim), dim), "fund-features")
    segments = f.select("fund_id", (F.col("fund_id") % 5).cast("int").alias("cluster_id")).join(
        _fixed_labels(f).select("cluster_id", "cluster_label"), "cluster_id")
    fc_ = _fund_forecasts(spark, days.select("fund_id", F.col("nav_date").alias("ds"), F.col("aum").alias("y")))
    return as_doubles(scr.assemble_scores(_ensemble_rule(days.where("complete")), segments,
                                          fc_.select("fund_id", "step", "yhat"), "fixed"))


@register("model_invariants")
def q_model_invariants(spark, sf):
    """What must hold for the trained models on any data, as one row."""
    split, iso, rf, probs = _anomaly_run(spark, sf)
    e = an.ensemble(iso.predict(probs), "rf_anomaly_prob", "iso_score")
    weights = sum(w for _, w in an.importance(rf, win.FEATURES))
    return e.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("fund_id", "nav_date").alias("keys"),
                 F.count_if(~F.col("rf_anomaly_prob").between(0, 1)).alias("bad_probabilities"),
                 F.count_if(~F.col("iso_score").between(-1, 0)).alias("bad_iso_scores"),
                 (F.avg("rf_is_anomaly") <= 0.011).alias("flag_rate_fits"),
                 (F.avg(F.when(F.col("is_train") == 1, F.col("iso_outlier"))) <= 0.011).alias("outlier_rate_fits"),
                 F.lit(abs(weights - 1) < 1e-6).alias("importances_sum_to_one"))


@register("lloyd_steps_fixed")
def q_lloyd_steps_fixed(spark, sf):
    """Centres of the five first funds after three exact passes over the standardised features."""
    cols = sg.CLUSTER_FEATURES
    z = cut_lineage(q_standardised_features(spark, sf).withColumn("features", F.array(*cols)))
    first = [r["features"] for r in z.orderBy("fund_id").limit(5).collect()]
    fit = sg.lloyd(z, {"fixed": np.array(first)}, max_iter=3, tol=0.0)["fixed"]
    rows = [(i, fit.cost, *map(float, c)) for i, c in enumerate(fit.centres)]
    out = spark.createDataFrame(rows, "centre int, cost double, " + ", ".join(f"{c} double" for c in cols))
    return out.select("centre", sc.fround("cost", 4).alias("cost"), *[sc.fround(c, 6).alias(c) for c in cols])


@register("elbow_falls")
def q_elbow_falls(spark, sf):
    e = sg.elbow(_seg_features(spark, sf), sg.CLUSTER_FEATURES)
    w = Window.orderBy("k")                                # six rows
    return e.select("k", (F.col("inertia") <= F.coalesce(F.lag("inertia").over(w), F.col("inertia"))).alias("falls"))


@register("kmeans_elbow")
def q_kmeans_elbow(spark, sf):
    return sg.elbow(_seg_features(spark, sf), sg.CLUSTER_FEATURES)


def _segments(spark, sf):
    f = _seg_features(spark, sf)
    seg = sg.segment(f, sg.CLUSTER_FEATURES, k=5, restarts=10, seed=42)
    labels = sg.label_clusters(agg.cluster_profile(seg)).select("cluster_id", "cluster_label")
    return sg.map_values(seg, "cluster_id", labels, "cluster_id", "cluster_label", "cluster_label")


@register("fund_segments")
def q_fund_segments(spark, sf):
    return _segments(spark, sf)


@register("ml_scores")
def q_ml_scores(spark, sf):
    _, iso, rf, probs = _anomaly_run(spark, sf)
    anomaly = an.ensemble(iso.predict(probs), "rf_anomaly_prob", "iso_score")
    fc_ = _fund_forecasts(spark, _fund_days(spark, sf)).select("fund_id", "step", "yhat")
    return as_doubles(scr.assemble_scores(anomaly, _segments(spark, sf), fc_, "r1"))


@register("quality_forecast")
def q_quality_forecast(spark, sf):
    _, train, _, horizon = _forecast_inputs(spark, sf)
    pred = fc.seasonal_baseline(train, horizon)
    return qa.expect(pred, [
        qa.row_count(equals=HORIZON), qa.columns_exist(pred.columns, ["yhat", "yhat_lower", "yhat_upper"]),
        qa.in_range("yhat", 0, None, lo_strict=True), qa.ordered("yhat_lower", "yhat", "yhat_upper"),
        qa.relative_change("ds", "yhat", 0.5)])


@register("quality_segments")
def q_quality_segments(spark, sf):
    f = _seg_features(spark, sf).withColumn("cluster_id", F.col("fund_id") % 5)
    labels = sg.label_clusters(agg.cluster_profile(f)).select("cluster_id", "cluster_label")
    seg = f.join(labels, "cluster_id")
    return qa.expect(seg, [
        qa.row_count(at_least=1), qa.distinct_count("cluster_id", 5), qa.not_null(["cluster_label"]),
        qa.in_range("avg_return", -1, 1), qa.in_range("consistency", 0, 1),
        qa.mean_below("underperformers", F.col("cluster_label") == "Underperformers", "avg_return", 0.01)])


# --- the same views through Spark SQL ------------------------------------------


@register("sql_vw_aum_by_asset_class")
def q_sql_vw_aum_by_asset_class(spark, sf):
    sql_views.register_views(spark, sf_dir=sf)
    return spark.sql("SELECT * FROM vw_aum_by_asset_class")


@register("sql_vw_fund_performance")
def q_sql_vw_fund_performance(spark, sf):
    sql_views.register_views(spark, sf_dir=sf)
    return spark.sql("SELECT * FROM vw_fund_performance")


@register("sql_vw_cashflow_summary")
def q_sql_vw_cashflow_summary(spark, sf):
    fm = b.customer_dimension(spark, sf)
    sql_views.register_views(spark, tables={"fund_master": fm, "cash_flows": b.cash_flows(spark, sf)})
    return spark.sql("SELECT * FROM vw_cashflow_summary")


@register("sql_vw_nav_anomalies")
def q_sql_vw_nav_anomalies(spark, sf):
    sql_views.register_views(spark, sf_dir=sf)
    return spark.sql("SELECT * FROM vw_nav_anomalies")


# --- file layout (indexes as partitioning and clustering) ---------------------



@register("nav_latest_from_layout")
def q_nav_latest_from_layout(spark, sf):
    path = scratch_path(spark, "nav-by-month")
    lay.write_by_month(b.nav_daily(spark, sf), path, "nav_date", "fund_id")
    return as_doubles(lay.read_latest(spark, path, "nav_date"))
