"""Bindings: the driver's star-schema tables seen as the fund model.

The operators in this package take column names, so they run on any table.
These bindings give them realistic shapes from the parquet tables under an
``sf_dir``:

* fund dimension (NAV side)  = supplier ⋈ nation ⋈ region
* fund dimension (cash side) = customer ⋈ nation ⋈ region
* nav_daily                  = lineitem grouped by (supplier, ship day)
* nav_daily (dense)          = events grouped by (user, day)
* cash_flows                 = orders
* trades                     = lineitem (it has no natural key)

Money is summed as DECIMAL and cast to double once, so every engine that
follows the same steps produces bit-identical values.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.session import table_path

# Fixed values of the bindings (chosen here, shared with the SQL oracle).
RETURN_BASE = Decimal("0.05")      # daily_return = mean(l_discount) - 0.05
BENCH_BASE = Decimal("0.04")       # benchmark_return = mean(l_tax) - 0.04
ANOMALY_QTY = 50                   # is_anomaly = any line with l_quantity >= 50
STATUS_MAP = {"O": "Settled", "P": "Pending", "F": "Failed"}
CURRENCIES = ["USD", "EUR", "GBP"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation")
    region = read(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")


def fund_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fund master on the NAV side: one row per supplier."""
    s = read(spark, sf_dir, "supplier")
    dim = s.join(_geo(spark, sf_dir), s.s_nationkey == F.col("n_nationkey"))
    key = F.col("s_suppkey")
    return dim.select(
        key.alias("fund_id"),
        F.col("s_name").alias("fund_name"),
        F.col("r_name").alias("asset_class"),
        F.col("n_name").alias("region"),
        F.element_at(F.array(*[F.lit(c) for c in CURRENCIES]),
                     (F.col("s_nationkey") % 3 + 1).cast("int")).alias("currency"),
        F.concat(F.col("r_name"), F.lit(" Composite")).alias("benchmark"),
        F.concat(F.lit("PM-"), F.lpad((F.col("s_nationkey") % 5).cast("string"), 2, "0"))
        .alias("fund_manager"),
        F.date_add(F.lit("2015-01-01").cast("date"), (key % 2000).cast("int"))
        .alias("inception_date"),
        ((key % 12 + 1).cast("decimal(5,2)") * F.lit(Decimal("0.25")))
        .cast("decimal(5,2)").alias("management_fee"),
        (F.lit(Decimal("0.05")) + (F.col("s_nationkey") % 5).cast("decimal(8,4)")
         * F.lit(Decimal("0.025"))).cast("decimal(8,4)").alias("target_volatility"),
        F.col("s_acctbal").cast("decimal(20,2)").alias("initial_aum"),
        F.lit("Active").alias("status"),
    )


def customer_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fund master on the cash side: one row per customer."""
    c = read(spark, sf_dir, "customer")
    dim = c.join(_geo(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"))
    return dim.select(
        F.col("c_custkey").alias("fund_id"),
        F.col("c_name").alias("fund_name"),
        F.col("r_name").alias("asset_class"),
        F.col("n_name").alias("region"),
        F.col("c_mktsegment").alias("fund_manager"),
        F.col("c_acctbal").cast("decimal(20,2)").alias("initial_aum"),
    )


def sum_digits(df: DataFrame, digits: dict[str, int], narrow: int = 8) -> dict[str, int]:
    """The same digits, or ``narrow`` for columns whose values all fit DECIMAL(narrow, 2) (one pass).

    Spark adds DECIMAL columns of up to 8 digits as 64-bit integers; the sums are equal.
    """
    top = df.agg(*[F.max(F.abs(F.col(c))).alias(c) for c in digits]).first()
    fits = {c for c in digits if top[c] is not None and top[c] < 10 ** (narrow - 2) - 1}
    return {c: min(d, narrow) if c in fits else d for c, d in digits.items()}


LINE_DIGITS = {"l_extendedprice": 18, "l_quantity": 18, "l_discount": 12, "l_tax": 12}


def nav_daily(spark: SparkSession, sf_dir: str, measured: bool = False) -> DataFrame:
    """Daily NAV per fund: lineitem grouped by (supplier, ship day).

    Unique on (fund_id, nav_date) by construction.  A hot supplier is no
    problem here: the aggregate is combined map-side before the shuffle.
    ``measured`` reads the columns' ranges first, so that ordinary amounts are added as integers.
    """
    li = read(spark, sf_dir, "lineitem")
    digits = sum_digits(li, LINE_DIGITS) if measured else LINE_DIGITS

    def total(c: str):
        return F.sum(F.col(c).cast(f"decimal({digits[c]},2)"))

    g = li.groupBy(F.col("l_suppkey").alias("fund_id"),
                   F.to_date("l_shipdate").alias("nav_date")).agg(
        total("l_extendedprice").alias("_px"),
        total("l_quantity").alias("_qty"),
        total("l_discount").alias("_disc"),
        total("l_tax").alias("_tax"),
        F.count(F.lit(1)).alias("_n"),
        F.max((F.col("l_quantity") >= ANOMALY_QTY).cast("int")).alias("is_anomaly"),
    )
    ret = (F.col("_disc").cast("double") / F.col("_n") - float(RETURN_BASE)).cast("decimal(10,6)")
    bench = (F.col("_tax").cast("double") / F.col("_n") - float(BENCH_BASE)).cast("decimal(10,6)")
    return g.select(
        "fund_id", "nav_date",
        (F.col("_px").cast("double") / F.col("_qty").cast("double")).alias("nav"),
        F.col("_px").cast("decimal(20,2)").alias("aum"),
        ret.alias("daily_return"),
        bench.alias("benchmark_return"),
        (ret - bench).cast("decimal(10,6)").alias("active_return"),
        "is_anomaly",
    )


def nav_daily_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dense daily series: events grouped by (user, day)."""
    ev = read(spark, sf_dir, "events")
    g = ev.groupBy(F.col("user_id").alias("fund_id"), F.to_date("ts").alias("nav_date")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).alias("_v"),
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("event_type") == "purchase").alias("_buy"),
        F.count_if(F.col("event_type") == "error").alias("_err"),
        F.count_if(F.col("event_type") == "view").alias("_view"),
        F.count_if(F.col("event_type") == "click").alias("_click"),
        F.max(((F.col("event_type") == "error") & (F.col("value") > 100)).cast("int"))
        .alias("is_anomaly"),
    )
    ret = ((F.col("_buy") - F.col("_err")).cast("double") / F.col("_n") / 100).cast("decimal(10,6)")
    bench = ((F.col("_view") - F.col("_click")).cast("double") / F.col("_n") / 100).cast("decimal(10,6)")
    return g.select(
        "fund_id", "nav_date",
        F.col("_v").cast("decimal(20,2)").alias("aum"),
        ret.alias("daily_return"),
        bench.alias("benchmark_return"),
        (ret - bench).cast("decimal(10,6)").alias("active_return"),
        "is_anomaly",
    )


def cash_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    status = F.create_map(*[x for kv in STATUS_MAP.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return o.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("fund_id"),
        F.to_date("o_orderdate").alias("transaction_date"),
        F.col("o_orderpriority").alias("transaction_type"),
        F.col("o_totalprice").cast("decimal(20,2)").alias("amount"),
        F.lit("USD").alias("currency"),
        F.concat(F.lit("CP"), F.lpad((F.col("o_custkey") % 49 + 1).cast("string"), 3, "0"))
        .alias("counterparty"),
        status[F.col("o_orderstatus")].alias("status"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("trade_id"),
        F.col("l_suppkey").alias("fund_id"),
        F.to_date("l_shipdate").alias("trade_date"),
        F.col("l_returnflag").alias("direction"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(20,2)").alias("notional"),
        F.col("l_tax").alias("tax_rate"),
        F.col("l_linestatus").alias("status"),
    )
