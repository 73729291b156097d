"""Explicit schemas of the fund-operations tables (never inferred)."""

from pyspark.sql import types as T

S, D, I, L = T.StringType(), T.DateType(), T.IntegerType(), T.LongType()


def dec(p, s):
    return T.DecimalType(p, s)


FUND_MASTER = T.StructType([
    T.StructField("fund_id", S, False),
    T.StructField("fund_name", S, False),
    T.StructField("asset_class", S, True),
    T.StructField("region", S, True),
    T.StructField("currency", S, True),
    T.StructField("benchmark", S, True),
    T.StructField("fund_manager", S, True),
    T.StructField("inception_date", D, True),
    T.StructField("management_fee", dec(5, 2), True),
    T.StructField("target_volatility", dec(8, 4), True),
    T.StructField("initial_aum", dec(20, 2), True),
    T.StructField("status", S, True),
])

NAV_DAILY = T.StructType([
    T.StructField("fund_id", S, False),
    T.StructField("nav_date", D, False),
    T.StructField("nav", dec(12, 4), True),
    T.StructField("aum", dec(20, 2), True),
    T.StructField("daily_return", dec(10, 6), True),
    T.StructField("benchmark_return", dec(10, 6), True),
    T.StructField("active_return", dec(10, 6), True),
    T.StructField("is_anomaly", I, True),
])

CASH_FLOWS = T.StructType([
    T.StructField("transaction_id", S, False),
    T.StructField("fund_id", S, False),
    T.StructField("transaction_date", D, False),
    T.StructField("transaction_type", S, True),
    T.StructField("amount", dec(20, 2), True),
    T.StructField("currency", S, True),
    T.StructField("counterparty", S, True),
    T.StructField("status", S, True),
])

TRADES = T.StructType([
    T.StructField("trade_id", S, False),
    T.StructField("fund_id", S, False),
    T.StructField("trade_date", D, False),
    T.StructField("security", S, True),
    T.StructField("security_type", S, True),
    T.StructField("direction", S, True),
    T.StructField("quantity", I, True),
    T.StructField("price", dec(12, 4), True),
    T.StructField("notional", dec(20, 2), True),
    T.StructField("commission", dec(10, 2), True),
    T.StructField("status", S, True),
])

MONTHLY_PERFORMANCE = T.StructType([
    T.StructField("fund_id", S, False),
    T.StructField("asset_class", S, True),
    T.StructField("month", S, False),
    T.StructField("monthly_return", dec(10, 6), True),
    T.StructField("benchmark_return", dec(10, 6), True),
    T.StructField("active_return", dec(10, 6), True),
    T.StructField("avg_aum", dec(20, 2), True),
    T.StructField("month_end_nav", dec(12, 4), True),
    T.StructField("anomaly_count", I, True),
    T.StructField("sharpe_ratio", dec(10, 4), True),
])

ML_SCORES = T.StructType([
    T.StructField("fund_id", S, False),
    T.StructField("score_date", D, False),
    T.StructField("model_type", S, True),
    T.StructField("model_version", S, True),
    T.StructField("anomaly_score", dec(10, 6), True),
    T.StructField("is_anomaly", I, True),
    T.StructField("cluster_id", I, True),
    T.StructField("cluster_label", S, True),
    T.StructField("forecast_30d", dec(20, 2), True),
    T.StructField("forecast_60d", dec(20, 2), True),
    T.StructField("forecast_90d", dec(20, 2), True),
])

# Not-null columns and lengths as declared by the relational model.
NOT_NULL = {
    "fund_master": ["fund_id", "fund_name"],
    "nav_daily": ["fund_id", "nav_date"],
    "cash_flows": ["transaction_id", "fund_id", "transaction_date"],
    "trades": ["trade_id", "fund_id", "trade_date"],
}
MAX_LENGTH = {
    "fund_master": {"fund_id": 10, "fund_name": 100, "asset_class": 30},
    "cash_flows": {"transaction_id": 15},
    "trades": {"trade_id": 15},
}
