"""Independent SQL (DuckDB dialect) for every registered query that SQL can express.

The SQL repeats the computation from the base tables with the same exact
decimal sums and the same order of floating-point operations.
"""

from __future__ import annotations

import math

ORACLE: dict[str, str] = {}


def fround(expr: str, places: int) -> str:
    return f"COALESCE(CAST(ROUND(TRY_CAST({expr} AS DECIMAL(38,10)), {places}) AS DOUBLE), {expr})"


def to_decimal(expr: str, p: int, s: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {s}) AS DECIMAL({p},{s}))"


def mean_of(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / COUNT({x}))"


def std_exact(x: str) -> str:
    xd = f"CAST({x} AS DECIMAL(12,6))"
    n = f"COUNT({xd})"
    s1 = f"CAST(SUM({xd}) AS DECIMAL(18,6))"
    s2 = f"CAST(SUM({xd} * {xd}) AS DECIMAL(26,12))"
    num = f"(CAST({n} AS DECIMAL(10,0)) * {s2} - {s1} * {s1})"
    return f"SQRT(CASE WHEN {n} > 1 THEN CAST({num} AS DOUBLE) / CAST({n} * ({n} - 1) AS DOUBLE) END)"


GEO = "geo AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)"

FUND_DIM = """fund_dim AS (
  SELECT s_suppkey AS fund_id, s_name AS fund_name, r_name AS asset_class, n_name AS region,
         ['USD','EUR','GBP'][CAST(s_nationkey % 3 + 1 AS INTEGER)] AS currency,
         r_name || ' Composite' AS benchmark,
         'PM-' || lpad(CAST(s_nationkey % 5 AS VARCHAR), 2, '0') AS fund_manager,
         DATE '2015-01-01' + CAST(s_suppkey % 2000 AS INTEGER) AS inception_date,
         CAST(CAST(s_suppkey % 12 + 1 AS DECIMAL(5,2)) * 0.25 AS DECIMAL(5,2)) AS management_fee,
         CAST(0.05 + CAST(s_nationkey % 5 AS DECIMAL(8,4)) * 0.025 AS DECIMAL(8,4)) AS target_volatility,
         CAST(s_acctbal AS DECIMAL(20,2)) AS initial_aum, 'Active' AS status
  FROM supplier JOIN geo ON s_nationkey = n_nationkey)"""

CUST_DIM = """cust_dim AS (
  SELECT c_custkey AS fund_id, c_name AS fund_name, r_name AS asset_class, n_name AS region,
         c_mktsegment AS fund_manager, CAST(c_acctbal AS DECIMAL(20,2)) AS initial_aum
  FROM customer JOIN geo ON c_nationkey = n_nationkey)"""

NAV = """nav_daily AS (
  SELECT fund_id, nav_date, nav, aum, daily_return, benchmark_return,
         CAST(daily_return - benchmark_return AS DECIMAL(10,6)) AS active_return, is_anomaly
  FROM (
    SELECT fund_id, nav_date,
           CAST(_px AS DOUBLE) / CAST(_qty AS DOUBLE) AS nav,
           CAST(_px AS DECIMAL(20,2)) AS aum,
           CAST(CAST(_disc AS DOUBLE) / _n - 0.05 AS DECIMAL(10,6)) AS daily_return,
           CAST(CAST(_tax AS DOUBLE) / _n - 0.04 AS DECIMAL(10,6)) AS benchmark_return,
           is_anomaly
    FROM (
      SELECT l_suppkey AS fund_id, CAST(l_shipdate AS DATE) AS nav_date,
             SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS _px,
             SUM(CAST(l_quantity AS DECIMAL(18,2))) AS _qty,
             SUM(CAST(l_discount AS DECIMAL(12,2))) AS _disc,
             SUM(CAST(l_tax AS DECIMAL(12,2))) AS _tax,
             COUNT(*) AS _n,
             MAX(CASE WHEN l_quantity >= 50 THEN 1 ELSE 0 END) AS is_anomaly
      FROM lineitem GROUP BY 1, 2)))"""

NAV_DENSE = """nav_dense AS (
  SELECT fund_id, nav_date, aum, daily_return, benchmark_return,
         CAST(daily_return - benchmark_return AS DECIMAL(10,6)) AS active_return, is_anomaly
  FROM (
    SELECT fund_id, nav_date, CAST(_v AS DECIMAL(20,2)) AS aum,
           CAST(CAST(_buy - _err AS DOUBLE) / _n / 100 AS DECIMAL(10,6)) AS daily_return,
           CAST(CAST(_view - _click AS DOUBLE) / _n / 100 AS DECIMAL(10,6)) AS benchmark_return,
           is_anomaly
    FROM (
      SELECT user_id AS fund_id, CAST(ts AS DATE) AS nav_date,
             SUM(CAST(value AS DECIMAL(18,2))) AS _v, COUNT(*) AS _n,
             COUNT(*) FILTER (WHERE event_type = 'purchase') AS _buy,
             COUNT(*) FILTER (WHERE event_type = 'error') AS _err,
             COUNT(*) FILTER (WHERE event_type = 'view') AS _view,
             COUNT(*) FILTER (WHERE event_type = 'click') AS _click,
             MAX(CASE WHEN event_type = 'error' AND value > 100 THEN 1 ELSE 0 END) AS is_anomaly
      FROM events GROUP BY 1, 2)))"""

CASH = """cash_flows AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS fund_id,
         CAST(o_orderdate AS DATE) AS transaction_date, o_orderpriority AS transaction_type,
         CAST(o_totalprice AS DECIMAL(20,2)) AS amount, 'USD' AS currency,
         'CP' || lpad(CAST(o_custkey % 49 + 1 AS VARCHAR), 3, '0') AS counterparty,
         CASE o_orderstatus WHEN 'O' THEN 'Settled' WHEN 'P' THEN 'Pending'
                            WHEN 'F' THEN 'Failed' END AS status
  FROM orders)"""

MONTHLY = f"""monthly AS (
  SELECT m.*, d.asset_class FROM (
    SELECT fund_id, month,
           CAST(_r AS DECIMAL(10,6)) AS monthly_return,
           CAST(_b AS DECIMAL(10,6)) AS benchmark_return,
           CAST(_r - _b AS DECIMAL(10,6)) AS active_return,
           {to_decimal('_aum', 20, 2)} AS avg_aum,
           {to_decimal('_nav', 12, 4)} AS month_end_nav,
           anomaly_count,
           {to_decimal('CAST(_r AS DOUBLE) / (_std * SQRT(252.0) + 1e-8)', 20, 4)} AS sharpe_ratio
    FROM (
      SELECT fund_id, strftime(nav_date, '%Y-%m') AS month,
             SUM(daily_return) AS _r, SUM(benchmark_return) AS _b,
             {mean_of('aum')} AS _aum, arg_max(nav, nav_date) AS _nav,
             CAST(SUM(is_anomaly) AS INTEGER) AS anomaly_count,
             {std_exact('daily_return')} AS _std
      FROM nav_daily GROUP BY 1, 2)) m
  JOIN fund_dim d USING (fund_id))"""

FEATURES = f"""features AS (
  SELECT f.*, d.asset_class, CAST(d.management_fee AS DOUBLE) AS management_fee,
         CAST(d.target_volatility AS DOUBLE) AS target_volatility
  FROM (
    SELECT fund_id,
           COALESCE({mean_of('monthly_return')}, 0) AS avg_return,
           COALESCE({std_exact('monthly_return')}, 0) AS return_vol,
           COALESCE({mean_of('active_return')}, 0) AS avg_active_ret,
           COALESCE({mean_of('sharpe_ratio')}, 0) AS avg_sharpe,
           COALESCE({mean_of('avg_aum')}, 0) AS avg_aum,
           COALESCE(CAST(SUM(anomaly_count) AS BIGINT), 0) AS total_anomalies,
           COALESCE(CAST(COUNT(*) FILTER (WHERE monthly_return > 0) AS DOUBLE) / COUNT(*), 0) AS consistency
    FROM monthly GROUP BY fund_id) f
  JOIN fund_dim d USING (fund_id))"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql


NAV_BASE = with_ctes(GEO, FUND_DIM, NAV)
MONTHLY_BASE = with_ctes(GEO, FUND_DIM, NAV, MONTHLY)
FEATURE_BASE = with_ctes(GEO, FUND_DIM, NAV, MONTHLY, FEATURES)

register("fund_dimension", with_ctes(GEO, FUND_DIM) + """
SELECT fund_id, fund_name, asset_class, region, currency, benchmark, fund_manager, inception_date,
       CAST(management_fee AS DOUBLE) AS management_fee,
       CAST(target_volatility AS DOUBLE) AS target_volatility,
       CAST(initial_aum AS DOUBLE) AS initial_aum, status FROM fund_dim""")

register("nav_daily", with_ctes(NAV) + """
SELECT fund_id, nav_date, nav, CAST(aum AS DOUBLE) AS aum,
       CAST(daily_return AS DOUBLE) AS daily_return,
       CAST(benchmark_return AS DOUBLE) AS benchmark_return,
       CAST(active_return AS DOUBLE) AS active_return, is_anomaly FROM nav_daily""")

register("cash_flows", with_ctes(CASH) + """
SELECT transaction_id, fund_id, transaction_date, transaction_type,
       CAST(amount AS DOUBLE) AS amount, currency, counterparty, status FROM cash_flows""")

register("aum_by_asset_class", NAV_BASE + f"""
, day AS (SELECT fund_id, aum, daily_return, active_return, is_anomaly FROM nav_daily
          QUALIFY nav_date = MAX(nav_date) OVER ()),
sums AS (
  SELECT asset_class, COUNT(DISTINCT fund_id) AS funds, SUM(aum) AS a, COUNT(aum) AS na,
         SUM(daily_return) AS r, COUNT(daily_return) AS nr, SUM(active_return) AS x, COUNT(active_return) AS nx,
         SUM(is_anomaly) AS flagged
  FROM day JOIN fund_dim USING (fund_id) GROUP BY asset_class)
SELECT asset_class, funds AS fund_count, CAST(flagged AS BIGINT) AS total_anomalies,
       {fround('CAST(a AS DOUBLE) / 1e9', 2)} AS total_aum_billions,
       {fround('CAST(a AS DOUBLE) / na / 1e6', 2)} AS avg_fund_aum_millions,
       {fround('CAST(r AS DOUBLE) / nr * 252 * 100', 2)} AS annualized_return_pct,
       {fround('CAST(x AS DOUBLE) / nx * 252 * 100', 2)} AS avg_active_return_pct
FROM sums""")

register("fund_performance", MONTHLY_BASE + f"""
, per_fund AS (
  SELECT fund_id, CAST(SUM(monthly_return) AS DOUBLE) AS r, CAST(SUM(benchmark_return) AS DOUBLE) AS b,
         CAST(SUM(active_return) AS DOUBLE) AS x, {mean_of('sharpe_ratio')} AS s, {mean_of('avg_aum')} AS a,
         CAST(SUM(anomaly_count) AS BIGINT) AS total_anomalies
  FROM monthly GROUP BY fund_id)
SELECT per_fund.fund_id, total_anomalies, {fround('r * 100', 2)} AS total_return_pct,
       {fround('b * 100', 2)} AS benchmark_return_pct, {fround('x * 100', 2)} AS total_active_return_pct,
       {fround('s', 4)} AS avg_sharpe_ratio, {fround('a / 1e6', 2)} AS avg_aum_millions,
       d.fund_name, d.asset_class, d.benchmark, d.fund_manager
FROM per_fund JOIN fund_dim d USING (fund_id)""")

register("cashflow_summary", with_ctes(GEO, CUST_DIM, CASH) + f"""
, per_fund AS (
  SELECT fund_id, transaction_type, COUNT(*) AS transaction_count, CAST(SUM(amount) AS DOUBLE) AS total,
         {mean_of('amount')} AS mean, COUNT(*) FILTER (WHERE status = 'Failed') AS failed_count
  FROM cash_flows GROUP BY ALL)
SELECT per_fund.fund_id, transaction_type, transaction_count, failed_count,
       {fround('total / 1e6', 2)} AS total_amount_millions, {fround('mean / 1e3', 2)} AS avg_amount_thousands,
       d.fund_name, d.asset_class
FROM per_fund JOIN cust_dim d USING (fund_id)""")

register("nav_anomalies", NAV_BASE + f"""
, per_fund AS (
  SELECT fund_id, COUNT(*) AS total_nav_records, CAST(SUM(is_anomaly) AS BIGINT) AS anomaly_count, {mean_of('aum')} AS a
  FROM nav_daily GROUP BY fund_id)
SELECT per_fund.fund_id, total_nav_records, anomaly_count,
       {fround('CAST(anomaly_count AS DOUBLE) / total_nav_records * 100', 2)} AS anomaly_rate_pct,
       {fround('a / 1e6', 2)} AS avg_aum_millions, d.fund_name, d.asset_class, d.fund_manager
FROM per_fund JOIN fund_dim d USING (fund_id)""")

register("daily_total_aum", with_ctes(NAV) + """
SELECT nav_date AS ds, CAST(SUM(aum) AS DOUBLE) AS y FROM nav_daily GROUP BY nav_date""")

register("monthly_rollup", MONTHLY_BASE + """
SELECT fund_id, month, CAST(monthly_return AS DOUBLE) AS monthly_return,
       CAST(benchmark_return AS DOUBLE) AS benchmark_return,
       CAST(active_return AS DOUBLE) AS active_return, CAST(avg_aum AS DOUBLE) AS avg_aum,
       CAST(month_end_nav AS DOUBLE) AS month_end_nav, anomaly_count,
       CAST(sharpe_ratio AS DOUBLE) AS sharpe_ratio, asset_class FROM monthly""")

register("fund_features", FEATURE_BASE + "SELECT * FROM features")


def feature_sql(src: str) -> str:
    w = "PARTITION BY fund_id ORDER BY nav_date"
    w5 = f"({w} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"
    w20 = f"({w} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"

    def wmean(x, f):
        return f"(CAST(SUM({x}) OVER {f} AS DOUBLE) / COUNT({x}) OVER {f})"

    def wstd(x, f):
        xd = f"CAST({x} AS DECIMAL(12,6))"
        n = f"COUNT({xd}) OVER {f}"
        s1 = f"CAST(SUM({xd}) OVER {f} AS DECIMAL(18,6))"
        s2 = f"CAST(SUM({xd} * {xd}) OVER {f} AS DECIMAL(26,12))"
        num = f"(CAST({n} AS DECIMAL(10,0)) * {s2} - {s1} * {s1})"
        return f"SQRT(CASE WHEN {n} > 1 THEN CAST({num} AS DOUBLE) / CAST(({n}) * (({n}) - 1) AS DOUBLE) END)"

    lag = f"LAG(aum, 1) OVER ({w})"
    return f"""
SELECT * FROM (
  SELECT fund_id, nav_date, is_anomaly,
         CAST(daily_return AS DOUBLE) AS daily_return,
         CAST(benchmark_return AS DOUBLE) AS benchmark_return,
         CAST(active_return AS DOUBLE) AS active_return,
         {wmean('daily_return', w5)} AS return_5d_avg,
         {wmean('daily_return', w20)} AS return_20d_avg,
         COALESCE({wstd('daily_return', w5)}, 0.0) AS return_5d_std,
         COALESCE({wstd('daily_return', w20)}, 0.0) AS return_20d_std,
         {wmean('aum', w5)} AS aum_5d_avg,
         CASE WHEN {lag} IS NULL THEN 0.0
              ELSE CAST(aum - {lag} AS DOUBLE) / NULLIF(CAST({lag} AS DOUBLE), 0) END AS aum_change_pct,
         CAST(daily_return - benchmark_return AS DOUBLE) AS return_vs_bench,
         CASE WHEN COUNT(daily_return) OVER {w20} >= 5 THEN
              (CAST(daily_return AS DOUBLE) - {wmean('daily_return', w20)}) / ({wstd('daily_return', w20)} + 1e-8)
         END AS return_z_score
  FROM {src}) t
WHERE return_z_score IS NOT NULL"""


register("anomaly_features", with_ctes(NAV) + feature_sql("nav_daily"))
register("anomaly_features_dense", with_ctes(NAV_DENSE) + feature_sql("nav_dense"))
register("return_index", with_ctes(NAV) + f"""
SELECT fund_id, nav_date,
       {fround('EXP(SUM(LN(1 + CAST(daily_return AS DOUBLE))) OVER (PARTITION BY fund_id ORDER BY nav_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) * 1.0', 8)} AS return_index
FROM nav_daily""")


FEATS = f"feats AS ({feature_sql('nav_daily')})"
FEATURE_ROWS = with_ctes(NAV, FEATS)

PERF = f"""perf AS (
SELECT f.fund_id, f.fund_name,
       {fround('CAST(SUM(m.active_return) AS DOUBLE) * 100', 2)} AS total_active_return_pct,
       {fround(mean_of('m.sharpe_ratio'), 4)} AS avg_sharpe_ratio
FROM fund_dim f JOIN monthly m ON f.fund_id = m.fund_id GROUP BY f.fund_id, f.fund_name)"""

register("active_return_ranking", with_ctes(GEO, FUND_DIM, NAV, MONTHLY, PERF) + """
SELECT fund_id, fund_name, total_active_return_pct,
       RANK() OVER (ORDER BY total_active_return_pct DESC) AS active_rank FROM perf""")

register("top_sharpe_funds", with_ctes(GEO, FUND_DIM, NAV, MONTHLY, PERF) + """
SELECT fund_id, fund_name, avg_sharpe_ratio FROM perf
ORDER BY avg_sharpe_ratio DESC, fund_id LIMIT 5""")

register("aum_last_90_days", with_ctes(NAV) + """
SELECT * FROM (SELECT nav_date AS ds, CAST(SUM(aum) AS DOUBLE) AS y FROM nav_daily GROUP BY nav_date)
ORDER BY ds DESC LIMIT 90""")

register("nav_first_last", with_ctes(NAV) + f"""
SELECT fund_id, CAST(arg_min(aum, nav_date) AS DOUBLE) AS first_aum,
       CAST(arg_max(aum, nav_date) AS DOUBLE) AS last_aum,
       MIN(nav_date) AS first_at, MAX(nav_date) AS last_at,
       {fround('CAST(ABS(arg_max(aum, nav_date) - arg_min(aum, nav_date)) AS DOUBLE) / CAST(arg_min(aum, nav_date) AS DOUBLE)', 8)} AS abs_change
FROM nav_daily GROUP BY fund_id""")

register("largest_fund", MONTHLY_BASE + """
SELECT fund_id, COALESCE(CAST(SUM(avg_aum) AS DOUBLE) / COUNT(avg_aum), 0) AS avg_aum
FROM monthly GROUP BY fund_id ORDER BY avg_aum DESC, fund_id LIMIT 1""")

register("best_class_by_active_return", MONTHLY_BASE + f"""
SELECT asset_class, {fround('AVG(CAST(active_return AS DOUBLE))', 10)} AS mean_value
FROM monthly GROUP BY asset_class ORDER BY AVG(CAST(active_return AS DOUBLE)) DESC, asset_class LIMIT 1""")

register("fund_master_stats", with_ctes(GEO, FUND_DIM) + f"""
SELECT COUNT(*) AS funds, COUNT(DISTINCT asset_class) AS asset_classes,
       CAST(SUM(initial_aum) AS DOUBLE) AS total_initial_aum,
       CAST(MIN(initial_aum) AS DOUBLE) AS min_initial_aum,
       CAST(MAX(initial_aum) AS DOUBLE) AS max_initial_aum,
       {mean_of('initial_aum')} AS mean_initial_aum,
       CAST(MIN(management_fee) AS DOUBLE) AS min_fee, CAST(MAX(management_fee) AS DOUBLE) AS max_fee
FROM fund_dim""")

register("return_quantiles", FEATURE_ROWS + f"""
SELECT {fround('quantile_cont(return_z_score, 0.5)', 8)} AS q50,
       {fround('quantile_cont(return_z_score, 0.9)', 8)} AS q90,
       {fround('quantile_cont(return_z_score, 0.99)', 8)} AS q99 FROM feats""")

register("zscore_above_q99", FEATURE_ROWS + """
SELECT fund_id, nav_date, return_z_score FROM feats
WHERE return_z_score > (SELECT quantile_cont(return_z_score, 0.99) FROM feats)""")

register("zscore_auc", FEATURE_ROWS + f""",
v AS (SELECT return_z_score AS s, SUM(is_anomaly) AS p, SUM(1 - is_anomaly) AS q FROM feats GROUP BY 1),
c AS (SELECT p, q, COALESCE(SUM(q) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS qb FROM v)
SELECT {fround('SUM(CAST(p AS DOUBLE) * (CAST(qb AS DOUBLE) + q * 0.5)) / (CAST(SUM(p) AS DOUBLE) * CAST(SUM(q) AS DOUBLE))', 10)} AS auc,
       CAST(SUM(p) AS BIGINT) AS positives, CAST(SUM(q) AS BIGINT) AS negatives FROM c""")

register("zscore_classification", FEATURE_ROWS + f""",
m AS (SELECT COUNT(*) FILTER (WHERE is_anomaly = 1 AND return_z_score > 1.0) AS tp,
             COUNT(*) FILTER (WHERE is_anomaly <> 1 AND return_z_score > 1.0) AS fp,
             COUNT(*) FILTER (WHERE is_anomaly = 1 AND NOT return_z_score > 1.0) AS fn,
             COUNT(*) FILTER (WHERE is_anomaly <> 1 AND NOT return_z_score > 1.0) AS tn FROM feats),
r AS (SELECT *, COALESCE(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fp AS DOUBLE), 0), 0.0) AS precision,
             COALESCE(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0.0) AS recall FROM m)
SELECT tp, fp, fn, tn, {fround('precision', 10)} AS precision, {fround('recall', 10)} AS recall,
       {fround('COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0.0)', 10)} AS f1 FROM r""")

register("fund_scalars", with_ctes(GEO, FUND_DIM) + f"""
SELECT fund_id, 'FND' || lpad(CAST(fund_id AS VARCHAR), 6, '0') AS fund_code,
       CAST(ROUND(CAST(management_fee AS DECIMAL(10,4)) * CAST(initial_aum AS DECIMAL(20,2)) / 1200, 2) AS DOUBLE) AS monthly_fee,
       year(inception_date) AS inception_year, month(inception_date) AS inception_month,
       strftime(inception_date, '%Y-%m') AS inception_bucket,
       CAST(inception_date + INTERVAL 90 DAY AS DATE) AS first_review,
       CAST(inception_date - INTERVAL 30 DAY AS DATE) AS onboarding,
       CASE WHEN inception_date BETWEEN DATE '2016-01-01' AND DATE '2016-12-31' THEN 1 ELSE 0 END AS launched_2016,
       CASE WHEN initial_aum > 5000 THEN 1 ELSE 0 END AS large_fund,
       GREATEST(CAST(initial_aum AS DOUBLE), 0.0) AS aum_floor,
       CAST(ABS(initial_aum) AS DOUBLE) AS abs_aum,
       {fround('CAST(target_volatility AS DOUBLE) * SQRT(252.0)', 6)} AS annual_vol,
       0 AS covid_period, strftime(inception_date, '%Y-%m-%d') AS inception_text
FROM fund_dim""")

register("trade_notional", f"""
SELECT l_orderkey, l_linenumber, CAST(price AS DOUBLE) AS price, quantity,
       CAST(ROUND(CAST(price AS DECIMAL(18,4)) * CAST(quantity AS DECIMAL(12,0)), 2) AS DOUBLE) AS notional,
       commission
FROM (SELECT l_orderkey, l_linenumber, {to_decimal('l_extendedprice / l_quantity', 18, 4)} AS price,
             CAST(l_quantity AS INTEGER) AS quantity,
             {fround('l_extendedprice * l_tax', 2)} AS commission FROM lineitem)""")

REGIME = """CAST(CASE
  WHEN year(d) = 2020 AND month(d) IN (3, 4) THEN CASE WHEN asset_class <> 'Money Market' THEN -0.0025 ELSE 0.0001 END
  WHEN year(d) IN (2020, 2021) AND month(d) > 4 THEN 0.0008
  WHEN year(d) = 2022 THEN CASE WHEN asset_class IN ('Equity', 'Fixed Income') THEN -0.0004 ELSE 0.0002 END
  WHEN year(d) IN (2023, 2024) THEN 0.0005
  ELSE 0.0003 END AS DECIMAL(6,4))"""

register("market_regime", with_ctes(GEO, FUND_DIM, NAV) + f"""
, rows_ AS (
  SELECT n.nav_date AS d, f.asset_class FROM nav_daily n JOIN fund_dim f USING (fund_id)
  UNION ALL
  SELECT CAST(CAST(ts AS DATE) - to_months(CAST(event_id % 73 AS INTEGER)) AS DATE) AS d,
         ['Equity', 'Fixed Income', 'Money Market', 'Alternative'][CAST(event_id % 4 + 1 AS INTEGER)] AS asset_class
  FROM events)
SELECT asset_class, year(d) AS year, month(d) AS month, COUNT(*) AS rows,
       CAST(MAX({REGIME}) AS DOUBLE) AS factor
FROM rows_ GROUP BY 1, 2, 3""")

register("business_days", with_ctes(NAV) + """
, days AS (SELECT CAST(generate_series AS DATE) AS ds
           FROM generate_series((SELECT MIN(nav_date) FROM nav_daily)::TIMESTAMP,
                                (SELECT MAX(nav_date) FROM nav_daily)::TIMESTAMP, INTERVAL 1 DAY))
SELECT year(ds) AS year, COUNT(*) AS business_days, MIN(ds) AS first_day, MAX(ds) AS last_day
FROM days WHERE isodow(ds) <= 5 GROUP BY 1""")

register("month_ends", with_ctes(CASH) + """
SELECT CAST(last_day(generate_series) AS DATE) AS month_end
FROM generate_series(date_trunc('month', (SELECT MIN(transaction_date) FROM cash_flows))::TIMESTAMP,
                     date_trunc('month', (SELECT MAX(transaction_date) FROM cash_flows))::TIMESTAMP,
                     INTERVAL 1 MONTH)""")

register("forecast_horizon_days", with_ctes(NAV) + """
SELECT CAST(generate_series AS DATE) AS ds
FROM generate_series(((SELECT MAX(nav_date) FROM nav_daily) + INTERVAL 1 DAY)::TIMESTAMP,
                     ((SELECT MAX(nav_date) FROM nav_daily) + INTERVAL 200 DAY)::TIMESTAMP, INTERVAL 1 DAY)
WHERE isodow(CAST(generate_series AS DATE)) <= 5
ORDER BY ds LIMIT 90""")


def checks_sql(src_cte: str, table: str, checks: list[tuple[str, str, str, str]]) -> str:
    parts = [f"SELECT '{name}' AS \"check\", CAST({ok} AS BOOLEAN) AS passed, CAST({fail} AS BIGINT) AS failing_rows, "
             f"CAST({obs} AS DOUBLE) AS observed FROM {table}" for name, ok, fail, obs in checks]
    return src_cte + "\nUNION ALL\n".join(parts)


def _bad(pred):
    return f"COUNT(*) FILTER (WHERE NOT COALESCE({pred}, FALSE))"


REG = "('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')"
PRI = "('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')"

register("quality_fund_master", checks_sql(with_ctes(GEO, FUND_DIM), "fund_dim", [
    ("row_count(eq=None,min=1)", "COUNT(*) >= 1", "CASE WHEN COUNT(*) >= 1 THEN 0 ELSE 1 END", "COUNT(*)"),
    ("unique(fund_id)", "COUNT(*) = COUNT(DISTINCT fund_id)", "COUNT(*) - COUNT(DISTINCT fund_id)", "COUNT(DISTINCT fund_id)"),
    ("in_set(asset_class)", f"{_bad('asset_class IN ' + REG)} = 0", _bad('asset_class IN ' + REG), _bad('asset_class IN ' + REG)),
    ("in_range(management_fee,0,3)", f"{_bad('management_fee > 0 AND management_fee <= 3')} = 0", _bad('management_fee > 0 AND management_fee <= 3'), _bad('management_fee > 0 AND management_fee <= 3')),
    ("in_range(initial_aum,0,None)", f"{_bad('initial_aum > 0')} = 0", _bad('initial_aum > 0'), _bad('initial_aum > 0')),
    ("not_null(fund_id,fund_name)", "COUNT(*) FILTER (WHERE fund_id IS NULL OR fund_name IS NULL) = 0",
     "COUNT(*) FILTER (WHERE fund_id IS NULL OR fund_name IS NULL)", "COUNT(*) FILTER (WHERE fund_id IS NULL OR fund_name IS NULL)"),
]))

_rate = "CAST(COUNT(*) FILTER (WHERE is_anomaly = 1) AS DOUBLE) / COUNT(*)"
_out = "COUNT(*) FILTER (WHERE nav_date < DATE '1992-01-01' OR nav_date > DATE '2001-12-31')"
register("quality_nav_daily", checks_sql(with_ctes(NAV), "nav_daily", [
    ("row_count(eq=None,min=1)", "COUNT(*) >= 1", "CASE WHEN COUNT(*) >= 1 THEN 0 ELSE 1 END", "COUNT(*)"),
    ("unique(fund_id,nav_date)", "COUNT(*) = COUNT(DISTINCT (fund_id, nav_date))", "COUNT(*) - COUNT(DISTINCT (fund_id, nav_date))", "COUNT(DISTINCT (fund_id, nav_date))"),
    ("in_range(nav,0,None)", f"{_bad('nav > 0')} = 0", _bad('nav > 0'), _bad('nav > 0')),
    ("in_set(is_anomaly)", f"{_bad('is_anomaly IN (0, 1)')} = 0", _bad('is_anomaly IN (0, 1)'), _bad('is_anomaly IN (0, 1)')),
    ("rate_between(is_anomaly,0.005,0.02)", f"{_rate} BETWEEN 0.005 AND 0.02", "NULL", _rate),
    ("date_range(nav_date,1992-01-01,2001-12-31)", f"MIN(nav_date) >= DATE '1992-01-01' AND MAX(nav_date) <= DATE '2001-12-31'", _out, _out),
]))

_nz = "CAST(COUNT(*) FILTER (WHERE amount <> 0) AS DOUBLE) / COUNT(*)"
_urg = "COUNT(*) FILTER (WHERE transaction_type = '1-URGENT' AND NOT COALESCE(amount > 0, FALSE))"
_low = "COUNT(*) FILTER (WHERE transaction_type = '5-LOW' AND NOT COALESCE(amount < 0, FALSE))"
register("quality_cash_flows", checks_sql(with_ctes(CASH), "cash_flows", [
    ("in_set(transaction_type)", f"{_bad('transaction_type IN ' + PRI)} = 0", _bad('transaction_type IN ' + PRI), _bad('transaction_type IN ' + PRI)),
    ("in_set(status)", f"{_bad(chr(32) + 'status IN (' + repr('Settled') + ', ' + repr('Pending') + ', ' + repr('Failed') + ')')} = 0",
     _bad("status IN ('Settled', 'Pending', 'Failed')"), _bad("status IN ('Settled', 'Pending', 'Failed')")),
    ("share_above(amount_nonzero,0.95)", f"{_nz} > 0.95", "COUNT(*) - COUNT(*) FILTER (WHERE amount <> 0)", _nz),
    ("implies(urgent_positive)", f"{_urg} = 0", _urg, _urg),
    ("implies(low_negative)", f"{_low} = 0", _low, _low),
]))

_sh = "CAST(COUNT(*) FILTER (WHERE sharpe_ratio BETWEEN -5 AND 5) AS DOUBLE) / COUNT(*)"
register("quality_monthly", checks_sql(MONTHLY_BASE, "monthly", [
    ("row_count(eq=None,min=1)", "COUNT(*) >= 1", "CASE WHEN COUNT(*) >= 1 THEN 0 ELSE 1 END", "COUNT(*)"),
    ("share_above(sharpe_within_5,0.95)", f"{_sh} > 0.95", "COUNT(*) - COUNT(*) FILTER (WHERE sharpe_ratio BETWEEN -5 AND 5)", _sh),
    ("distinct_count(month,None)", "TRUE", "0", "COUNT(DISTINCT month)"),
    ("not_null(fund_id,month)", "COUNT(*) FILTER (WHERE fund_id IS NULL OR month IS NULL) = 0",
     "COUNT(*) FILTER (WHERE fund_id IS NULL OR month IS NULL)", "COUNT(*) FILTER (WHERE fund_id IS NULL OR month IS NULL)"),
]))

register("duplicate_trade_keys", """
SELECT trade_id, COUNT(*) AS occurrences
FROM (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS trade_id FROM lineitem)
GROUP BY trade_id HAVING COUNT(*) > 1""")

register("duplicate_nav_keys", with_ctes(NAV) + """
SELECT fund_id, nav_date, COUNT(*) AS occurrences
FROM (SELECT fund_id, nav_date FROM nav_daily UNION ALL SELECT fund_id, nav_date FROM nav_daily WHERE fund_id % 10 = 4)
GROUP BY 1, 2 HAVING COUNT(*) > 1""")

register("orphan_counts", with_ctes(GEO, FUND_DIM, NAV, CASH) + """
SELECT (SELECT COUNT(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 <> 3)) AS lineitem_orphans,
       (SELECT COUNT(*) FROM cash_flows WHERE fund_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 3)) AS cash_orphans,
       (SELECT COUNT(*) FROM nav_daily WHERE fund_id NOT IN (SELECT fund_id FROM fund_dim WHERE fund_id % 10 <> 3)) AS nav_orphans""")

register("null_counts", with_ctes(CASH) + """
SELECT 0 AS transaction_id, COUNT(*) FILTER (WHERE fund_id IS NULL OR transaction_id % 11 = 0) AS fund_id,
       COUNT(*) FILTER (WHERE transaction_date IS NULL) AS transaction_date,
       COUNT(*) FILTER (WHERE amount IS NULL OR transaction_id % 10 = 0) AS amount,
       COUNT(*) FILTER (WHERE status IS NULL OR transaction_id % 7 = 0) AS status FROM cash_flows""")

register("schema_violations", """
SELECT COUNT(*) FILTER (WHERE length(id) > 15) AS trade_id, 0 AS trade_date,
       COUNT(*) FILTER (WHERE k % 8 = 0) AS quantity,
       COUNT(*) FILTER (WHERE k % 9 = 0 AND px * 10000000 >= 99999999.995) AS commission
FROM (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)
             || CASE WHEN l_orderkey % 10 = 0 THEN '-amended-late' ELSE '' END AS id,
             l_orderkey AS k, CAST(l_extendedprice AS DECIMAL(20,2)) AS px FROM lineitem)""")

register("defaults_applied", with_ctes(NAV) + """
SELECT CASE WHEN fund_id % 10 = 5 THEN 0 ELSE is_anomaly END AS is_anomaly, COUNT(*) AS rows FROM nav_daily GROUP BY 1""")

register("key_sets", with_ctes(GEO, FUND_DIM, NAV) + """
, a AS (SELECT DISTINCT fund_id FROM nav_daily WHERE fund_id % 10 <> 1),
b AS (SELECT DISTINCT fund_id FROM fund_dim WHERE fund_id % 10 <> 2),
o AS (SELECT COUNT(*) FILTER (WHERE b.fund_id IS NULL) AS l, COUNT(*) FILTER (WHERE a.fund_id IS NULL) AS r
      FROM a FULL JOIN b ON a.fund_id = b.fund_id)
SELECT l AS only_left, r AS only_right, l = 0 AND r = 0 AS equal FROM o""")

register("cash_on_nav_dates", with_ctes(NAV, CASH) + """
SELECT transaction_date AS ds, CAST(SUM(amount) AS DOUBLE) AS amount FROM cash_flows
WHERE transaction_date IN (SELECT nav_date FROM nav_daily) GROUP BY 1""")

register("kpis", MONTHLY_BASE + f"""
SELECT CAST(SUM(aum) AS DOUBLE) AS total_aum, (SELECT COUNT(*) FROM fund_dim) AS funds,
       (SELECT {mean_of('sharpe_ratio')} FROM monthly) AS mean_sharpe,
       (SELECT CAST(SUM(is_anomaly) AS BIGINT) FROM nav_daily) AS anomalies
FROM nav_daily WHERE nav_date = (SELECT MAX(nav_date) FROM nav_daily)""")

register("aum_share", NAV_BASE + f"""
SELECT asset_class, CAST(a AS DOUBLE) AS aum,
       {fround('CAST(a AS DOUBLE) / CAST(SUM(a) OVER () AS DOUBLE) * 100', 4)} AS share_pct
FROM (SELECT f.asset_class, SUM(n.aum) AS a FROM nav_daily n JOIN fund_dim f USING (fund_id)
      WHERE n.nav_date = (SELECT MAX(nav_date) FROM nav_daily) GROUP BY 1)""")

register("return_trend", MONTHLY_BASE + f"""
SELECT asset_class, month, {mean_of('monthly_return')} AS avg_monthly_return, COUNT(*) AS funds
FROM monthly GROUP BY 1, 2""")

register("asia_return_trend", MONTHLY_BASE + f"""
SELECT asset_class, month, {mean_of('monthly_return')} AS avg_monthly_return, COUNT(*) AS funds
FROM monthly WHERE asset_class = 'ASIA' GROUP BY 1, 2""")

register("risk_return_by_class", FEATURE_BASE + f"""
SELECT asset_class, COUNT(*) AS funds, {fround('AVG(avg_return)', 8)} AS avg_return,
       {fround('AVG(return_vol)', 8)} AS avg_risk, {fround('AVG(avg_sharpe)', 6)} AS avg_sharpe
FROM features GROUP BY 1""")

register("leaderboard", MONTHLY_BASE + f"""
SELECT f.fund_id, f.fund_name, f.region AS segment,
       {fround(mean_of('m.sharpe_ratio'), 4)} AS avg_sharpe_ratio,
       {fround('CAST(SUM(m.monthly_return) AS DOUBLE) * 100', 2)} AS total_return_pct,
       {fround('CAST(SUM(m.active_return) AS DOUBLE) * 100', 2)} AS total_active_return_pct
FROM fund_dim f JOIN monthly m ON f.fund_id = m.fund_id
GROUP BY f.fund_id, f.fund_name, f.region ORDER BY avg_sharpe_ratio DESC, fund_id""")

register("anomalies_over_time", with_ctes(NAV) + """
SELECT strftime(nav_date, '%Y-%m') AS month, CAST(SUM(is_anomaly) AS BIGINT) AS anomalies,
       COUNT(*) AS records FROM nav_daily GROUP BY 1""")

register("cashflow_by_status", with_ctes(CASH) + """
SELECT transaction_type,
       CAST(COALESCE(SUM(amount) FILTER (WHERE status = 'Settled'), 0) AS DOUBLE) AS settled,
       CAST(COALESCE(SUM(amount) FILTER (WHERE status = 'Pending'), 0) AS DOUBLE) AS pending,
       CAST(COALESCE(SUM(amount) FILTER (WHERE status = 'Failed'), 0) AS DOUBLE) AS failed,
       CAST(COALESCE(SUM(amount) FILTER (WHERE status IS NULL OR status NOT IN ('Settled', 'Pending', 'Failed')), 0) AS DOUBLE) AS other
FROM (SELECT * REPLACE (CASE WHEN transaction_id % 10 = 3 THEN 'Cancelled' WHEN transaction_id % 10 = 7 THEN NULL ELSE status END AS status)
      FROM cash_flows) GROUP BY 1""")

register("status_breakdown", with_ctes(CASH) + f"""
SELECT status, COUNT(*) AS transactions,
       {fround('CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () * 100', 4)} AS share_pct
FROM cash_flows GROUP BY status""")

register("csv_roundtrip_nav", with_ctes(NAV) + """
SELECT CAST(fund_id AS VARCHAR) AS fund_id, nav_date, CAST(aum AS DOUBLE) AS aum,
       CAST(daily_return AS DOUBLE) AS daily_return, CAST(benchmark_return AS DOUBLE) AS benchmark_return,
       CAST(active_return AS DOUBLE) AS active_return, is_anomaly FROM nav_daily""")

register("conform_cash_flows", with_ctes(CASH) + """
SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(fund_id AS VARCHAR) AS fund_id,
       transaction_date, transaction_type, CAST(amount AS DOUBLE) AS amount, currency, counterparty, status
FROM cash_flows""")

register("row_counts", with_ctes(GEO, FUND_DIM, NAV) + """
SELECT (SELECT COUNT(*) FROM fund_dim) AS fund_master_count,
       (SELECT COUNT(*) FROM nav_daily) AS nav_daily_count,
       (SELECT COUNT(*) FROM orders) AS cash_flows_count,
       (SELECT COUNT(*) FROM lineitem) AS trades_count""")

MODEL_COUNTS = """SELECT (SELECT COUNT(*) FROM fund_dim) + (SELECT COUNT(*) FROM cust_dim) AS fund_master_count,
       (SELECT COUNT(*) FROM nav_daily) AS nav_daily_count, (SELECT COUNT(*) FROM orders) AS cash_flows_count,
       (SELECT COUNT(*) FROM lineitem) AS trades_count"""

register("ingest_run", with_ctes(GEO, FUND_DIM, CUST_DIM, NAV) + f"""
, c AS ({MODEL_COUNTS})
SELECT *, fund_master_count AS source_fund_master_count, nav_daily_count AS source_nav_daily_count,
       cash_flows_count AS source_cash_flows_count, trades_count AS source_trades_count, 'Succeeded' AS status,
       'daily_fund_ingestion' AS logged_pipeline, 'Succeeded' AS logged_status, DATE '2024-01-02' AS logged_run_date FROM c""")

register("ingest_orphans", with_ctes(NAV) + """
SELECT 'Failed' AS status, 'nav_daily=' || (SELECT COUNT(*) FROM nav_daily WHERE fund_id % 10 = 3)
       || ',cash_flows=' || (SELECT COUNT(*) FROM orders WHERE o_custkey % 10 = 4)
       || ',trades=' || (SELECT COUNT(*) FROM lineitem WHERE l_suppkey % 10 = 3) AS details""")

register("conform_quarantine", with_ctes(CASH) + """
SELECT errors, COUNT(*) AS rows FROM (
  SELECT concat_ws(',', CASE WHEN transaction_id % 13 = 0 THEN 'fund_id' END,
                        CASE WHEN transaction_id % 11 = 0 THEN 'transaction_date' END,
                        CASE WHEN transaction_id % 10 = 1 THEN 'amount' END) AS errors FROM cash_flows) GROUP BY 1""")

register("ingest_quarantine", """
SELECT COUNT(*) FILTER (WHERE event_id % 10 <> 2 AND event_id % 17 <> 0) AS appended,
       COUNT(*) FILTER (WHERE event_id % 10 = 2 OR event_id % 17 = 0) AS quarantined,
       COUNT(*) FILTER (WHERE event_id % 10 = 2) AS bad_values,
       COUNT(*) FILTER (WHERE event_id % 17 = 0) AS missing_ids FROM events""")

register("rolling_aum_std", with_ctes(NAV) + """
, u AS (SELECT fund_id, nav_date, CAST(aum * 100 AS HUGEINT) AS u FROM nav_daily),
w AS (SELECT fund_id, nav_date, COUNT(u) OVER f AS n, SUM(u) OVER f AS s1, SUM(u * u) OVER f AS s2 FROM u
      WINDOW f AS (PARTITION BY fund_id ORDER BY nav_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT fund_id, nav_date,
       COALESCE(SQRT(CASE WHEN n > 1 THEN CAST(n * s2 - s1 * s1 AS DOUBLE) / 10000.0 / CAST(n * (n - 1) AS DOUBLE) END), 0.0) AS aum_20d_std
FROM w""")

register("incremental_ingest", """
SELECT event_id, ts, user_id, event_type, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value FROM events""")


def hash_sql(cols: list[str], seed: int = 0) -> str:
    """Fifth powers modulo a prime, the seed added before every one of them."""
    def fifth(x: str) -> str:
        square = f"list_transform([{x}], lambda x: [x, x * x % 2147483647])[1]"
        return f"list_transform([{square}], lambda p: p[2] * p[2] % 2147483647 * p[1] % 2147483647)[1]"

    s = seed % 2147483647
    h = fifth(f"CAST({s} AS BIGINT)")
    for c in cols:
        h = fifth(f"(({h}) * 48271 + ({c}) % 2147483647 + {s}) % 2147483647")
    for _ in range(2):
        h = fifth(f"(({h}) * 48271 + 1 + {s}) % 2147483647")
    return h


FORECAST = f"""daily AS (SELECT nav_date AS ds, SUM(aum) AS y FROM nav_daily GROUP BY 1),
cut AS (SELECT MIN(ds) + CAST(FLOOR(datediff('day', MIN(ds), MAX(ds)) * 0.8::DOUBLE) AS INTEGER) AS c FROM daily),
train AS (SELECT ds, y FROM daily WHERE ds < (SELECT c FROM cut)),
test AS (SELECT ds, y FROM daily WHERE ds >= (SELECT c FROM cut)),
tr AS (SELECT ds, CAST(datediff('day', (SELECT MIN(ds) FROM train), ds) AS BIGINT) AS t,
              CAST(y AS DECIMAL(20,2)) AS y_ FROM train),
s AS (SELECT COUNT(*) AS n, SUM(t) AS st, SUM(t * t) AS stt, CAST(SUM(y_) AS DECIMAL(20,2)) AS sy,
             CAST(SUM(CAST(t AS DECIMAL(10,0)) * y_) AS DECIMAL(28,2)) AS sty, MAX(ds) AS last_ds FROM tr),
c1 AS (SELECT *, CAST(CAST(n AS DECIMAL(9,0)) * sty - CAST(st AS DECIMAL(18,0)) * sy AS DOUBLE)
                 / NULLIF(CAST(n * stt - st * st AS DOUBLE), 0) AS b FROM s),
coef AS (SELECT *, (CAST(sy AS DOUBLE) - b * CAST(st AS DOUBLE)) / CAST(n AS DOUBLE) AS a FROM c1),
fit AS (SELECT tr.*, coef.a + coef.b * CAST(tr.t AS DOUBLE) AS trend, dayofweek(ds) AS wd, month(ds) AS mo
        FROM tr, coef),
swd AS (SELECT wd, {fround('AVG(CAST(y_ AS DOUBLE) / trend)', 12)} AS s_wd FROM fit GROUP BY wd),
fit2 AS (SELECT fit.*, s_wd FROM fit JOIN swd USING (wd)),
smo AS (SELECT mo, {fround('AVG(CAST(y_ AS DOUBLE) / (trend * s_wd))', 12)} AS s_mo FROM fit2 GROUP BY mo),
fit3 AS (SELECT fit2.*, s_mo FROM fit2 JOIN smo USING (mo)),
sig AS (SELECT {fround('SQRT(AVG((CAST(y_ AS DOUBLE) - trend * s_wd * s_mo) * (CAST(y_ AS DOUBLE) - trend * s_wd * s_mo)))', 4)} AS sigma FROM fit3),
hz AS (SELECT CAST(generate_series AS DATE) AS ds
       FROM generate_series(((SELECT last_ds FROM coef) + INTERVAL 1 DAY)::TIMESTAMP,
                            ((SELECT last_ds FROM coef) + INTERVAL 200 DAY)::TIMESTAMP, INTERVAL 1 DAY)
       WHERE isodow(CAST(generate_series AS DATE)) <= 5 ORDER BY ds LIMIT 90),
h AS (SELECT hz.ds, CAST(datediff('day', (SELECT MIN(ds) FROM train), hz.ds) AS BIGINT) AS t,
             CAST(datediff('day', coef.last_ds, hz.ds) AS DOUBLE) AS step, coef.a, coef.b, coef.n,
             dayofweek(hz.ds) AS wd, month(hz.ds) AS mo FROM hz, coef),
p AS (SELECT h.ds, (h.a + h.b * CAST(h.t AS DOUBLE)) * COALESCE(swd.s_wd, 1.0::DOUBLE) * COALESCE(smo.s_mo, 1.0::DOUBLE) AS yhat,
             1.2815515655446004 * sig.sigma * SQRT(1 + h.step / CAST(h.n AS DOUBLE)) AS width
      FROM h LEFT JOIN swd USING (wd) LEFT JOIN smo USING (mo), sig),
pred AS (SELECT ds, {fround('yhat', 2)} AS yhat, {fround('yhat - width', 2)} AS yhat_lower,
                {fround('yhat + width', 2)} AS yhat_upper FROM p)"""

register("forecast_baseline", with_ctes(NAV, FORECAST) + "SELECT * FROM pred")

register("forecast_evaluation", with_ctes(NAV, FORECAST) + f"""
SELECT COUNT(*) AS n,
       {fround('AVG(ABS((CAST(t.y AS DOUBLE) - p.yhat) / CAST(t.y AS DOUBLE))) * 100', 8)} AS mape,
       {fround('AVG(ABS(CAST(t.y AS DOUBLE) - p.yhat))', 6)} AS mae
FROM test t JOIN pred p USING (ds)""")

_H = hash_sql(["fund_id", "datediff('day', DATE '1970-01-01', nav_date)"], 42)
register("stratified_split", FEATURE_ROWS + f"""
, h AS (SELECT fund_id, nav_date, is_anomaly, {_H} AS _h FROM feats)
SELECT fund_id, nav_date, is_anomaly,
       CASE WHEN ROW_NUMBER() OVER (PARTITION BY is_anomaly ORDER BY _h, fund_id, datediff('day', DATE '1970-01-01', nav_date))
                 <= FLOOR(COUNT(*) OVER (PARTITION BY is_anomaly) * 0.8::DOUBLE) THEN 1 ELSE 0 END AS is_train
FROM h""")

register("ensemble_rule", FEATURE_ROWS + f"""
, e AS (SELECT fund_id, nav_date,
               LEAST(return_20d_std * 20, 1.0::DOUBLE) * 0.6::DOUBLE
               + ((-0.4::DOUBLE - LEAST(ABS(return_z_score), 10.0::DOUBLE) * 0.02::DOUBLE) + 1) * 0.4::DOUBLE AS s
        FROM feats)
SELECT fund_id, nav_date, {fround('s', 10)} AS ensemble_score,
       CASE WHEN s > (SELECT quantile_cont(s, 0.99) FROM e) THEN 1 ELSE 0 END AS rf_is_anomaly FROM e""")

_SF = ["avg_return", "return_vol", "avg_active_ret", "avg_sharpe", "avg_aum", "total_anomalies",
       "consistency", "management_fee", "target_volatility"]
register("standardised_features", FEATURE_BASE + "SELECT fund_id, " + ", ".join(
    f"{fround(f'(CAST({c} AS DOUBLE) - AVG({c}) OVER ()) / CASE WHEN STDDEV_POP({c}) OVER () = 0 THEN 1.0 ELSE STDDEV_POP({c}) OVER () END', 8)} AS {c}"
    for c in _SF) + " FROM features")

_rules = [("avg_return", "DESC", "High Growth"), ("avg_sharpe", "DESC", "Risk-Adjusted Leaders"),
          ("avg_aum_m", "DESC", "Large Cap Stable"), ("avg_anomalies", "DESC", "High Operational Risk"),
          ("avg_return", "ASC", "Underperformers")]
register("cluster_labels_fixed", FEATURE_BASE + f"""
, prof AS (SELECT fund_id % 5 AS cluster_id, COUNT(fund_id) AS fund_count,
                  {fround('AVG(avg_return)', 4)} AS avg_return, {fround('AVG(return_vol)', 4)} AS avg_vol,
                  {fround('AVG(avg_sharpe)', 4)} AS avg_sharpe, {fround('AVG(avg_aum) / 1e6', 4)} AS avg_aum_m,
                  {fround('CAST(SUM(total_anomalies) AS DOUBLE) / COUNT(*)', 4)} AS avg_anomalies,
                  {fround('AVG(consistency)', 4)} AS consistency
           FROM features GROUP BY 1),
wins AS (""" + "\n UNION ALL ".join(
    f"(SELECT cluster_id, {i} AS r, '{lab}' AS label FROM prof ORDER BY {m} {d}, cluster_id LIMIT 1)"
    for i, (m, d, lab) in enumerate(_rules)) + """),
named AS (SELECT cluster_id, arg_max(label, r) AS label FROM wins GROUP BY cluster_id)
SELECT prof.*, COALESCE(named.label, 'Cluster ' || CAST(prof.cluster_id AS VARCHAR)) AS cluster_label
FROM prof LEFT JOIN named USING (cluster_id)""")


_rc = "ABS(CAST(arg_max(yhat, ds) AS DOUBLE) - CAST(arg_min(yhat, ds) AS DOUBLE)) / CAST(arg_min(yhat, ds) AS DOUBLE)"
register("quality_forecast", checks_sql(with_ctes(NAV, FORECAST), "pred", [
    ("row_count(eq=90,min=None)", "COUNT(*) = 90", "CASE WHEN COUNT(*) = 90 THEN 0 ELSE 1 END", "COUNT(*)"),
    ("columns_exist(yhat,yhat_lower,yhat_upper)", "COUNT(*) >= 0", "COUNT(*) * 0", "COUNT(*) * 0"),
    ("in_range(yhat,0,None)", f"{_bad('yhat > 0')} = 0", _bad('yhat > 0'), _bad('yhat > 0')),
    ("ordered(yhat_lower<=yhat<=yhat_upper)", f"{_bad('yhat_lower <= yhat AND yhat <= yhat_upper')} = 0",
     _bad('yhat_lower <= yhat AND yhat <= yhat_upper'), _bad('yhat_lower <= yhat AND yhat <= yhat_upper')),
    ("relative_change(yhat,<0.5)", f"{_rc} < 0.5", "NULL", _rc),
]))

_up = fround("AVG(CASE WHEN cluster_label = 'Underperformers' THEN avg_return END)", 10)
register("quality_segments", FEATURE_BASE + f"""
, prof AS (SELECT fund_id % 5 AS cluster_id,
                  {fround('AVG(avg_return)', 4)} AS avg_return, {fround('AVG(avg_sharpe)', 4)} AS avg_sharpe,
                  {fround('AVG(avg_aum) / 1e6', 4)} AS avg_aum_m,
                  {fround('CAST(SUM(total_anomalies) AS DOUBLE) / COUNT(*)', 4)} AS avg_anomalies
           FROM features GROUP BY 1),
wins AS (""" + "\n UNION ALL ".join(
    f"(SELECT cluster_id, {i} AS r, '{lab}' AS label FROM prof ORDER BY {m} {d}, cluster_id LIMIT 1)"
    for i, (m, d, lab) in enumerate(_rules)) + """),
named AS (SELECT cluster_id, arg_max(label, r) AS label FROM wins GROUP BY cluster_id),
seg AS (SELECT f.*, f.fund_id % 5 AS cluster_id,
               COALESCE(n.label, 'Cluster ' || CAST(f.fund_id % 5 AS VARCHAR)) AS cluster_label
        FROM features f LEFT JOIN named n ON n.cluster_id = f.fund_id % 5)
""" + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS \"check\", CAST({ok} AS BOOLEAN) AS passed, CAST({fl} AS BIGINT) AS failing_rows, CAST({ob} AS DOUBLE) AS observed FROM seg"
    for n, ok, fl, ob in [
        ("row_count(eq=None,min=1)", "COUNT(*) >= 1", "CASE WHEN COUNT(*) >= 1 THEN 0 ELSE 1 END", "COUNT(*)"),
        ("distinct_count(cluster_id,5)", "COUNT(DISTINCT cluster_id) = 5", "0", "COUNT(DISTINCT cluster_id)"),
        ("not_null(cluster_label)", "COUNT(*) FILTER (WHERE cluster_label IS NULL) = 0",
         "COUNT(*) FILTER (WHERE cluster_label IS NULL)", "COUNT(*) FILTER (WHERE cluster_label IS NULL)"),
        ("in_range(avg_return,-1,1)", f"{_bad('avg_return >= -1 AND avg_return <= 1')} = 0",
         _bad('avg_return >= -1 AND avg_return <= 1'), _bad('avg_return >= -1 AND avg_return <= 1')),
        ("in_range(consistency,0,1)", f"{_bad('consistency >= 0 AND consistency <= 1')} = 0",
         _bad('consistency >= 0 AND consistency <= 1'), _bad('consistency >= 0 AND consistency <= 1')),
        ("mean_below(underperformers,0.01)", f"({_up} IS NULL OR {_up} < 0.01)",
         "COUNT(*) FILTER (WHERE cluster_label = 'Underperformers')", _up),
    ]))

for _v in ("aum_by_asset_class", "fund_performance", "cashflow_summary", "nav_anomalies"):
    register(f"sql_vw_{_v}", ORACLE[_v])

FUND_FORECAST = f"""train AS (SELECT fund_id, nav_date AS ds, aum AS y FROM nav_daily),
tr AS (SELECT fund_id, ds, CAST(datediff('day', (SELECT MIN(ds) FROM train), ds) AS BIGINT) AS t,
              CAST(y AS DECIMAL(20,2)) AS y_ FROM train),
s AS (SELECT fund_id, COUNT(*) AS n, SUM(t) AS st, SUM(t * t) AS stt, CAST(SUM(y_) AS DECIMAL(20,2)) AS sy,
             CAST(SUM(CAST(t AS DECIMAL(10,0)) * y_) AS DECIMAL(28,2)) AS sty, MAX(ds) AS last_ds
      FROM tr GROUP BY fund_id),
c1 AS (SELECT *, CAST(CAST(n AS DECIMAL(9,0)) * sty - CAST(st AS DECIMAL(18,0)) * sy AS DOUBLE)
                 / NULLIF(CAST(n * stt - st * st AS DOUBLE), 0) AS b FROM s),
coef AS (SELECT *, (CAST(sy AS DOUBLE) - b * CAST(st AS DOUBLE)) / CAST(n AS DOUBLE) AS a FROM c1),
fit AS (SELECT tr.*, coef.a + coef.b * CAST(tr.t AS DOUBLE) AS trend, dayofweek(ds) AS wd, month(ds) AS mo
        FROM tr JOIN coef USING (fund_id)),
swd AS (SELECT fund_id, wd, {fround('AVG(CAST(y_ AS DOUBLE) / trend)', 12)} AS s_wd FROM fit GROUP BY 1, 2),
fit2 AS (SELECT fit.*, s_wd FROM fit JOIN swd USING (fund_id, wd)),
smo AS (SELECT fund_id, mo, {fround('AVG(CAST(y_ AS DOUBLE) / (trend * s_wd))', 12)} AS s_mo FROM fit2 GROUP BY 1, 2),
fit3 AS (SELECT fit2.*, s_mo FROM fit2 JOIN smo USING (fund_id, mo)),
sig AS (SELECT fund_id, {fround('SQRT(AVG((CAST(y_ AS DOUBLE) - trend * s_wd * s_mo) * (CAST(y_ AS DOUBLE) - trend * s_wd * s_mo)))', 4)} AS sigma
        FROM fit3 GROUP BY fund_id),
hz AS (SELECT CAST(generate_series AS DATE) AS ds
       FROM generate_series(((SELECT MAX(nav_date) FROM nav_daily) + INTERVAL 1 DAY)::TIMESTAMP,
                            ((SELECT MAX(nav_date) FROM nav_daily) + INTERVAL 200 DAY)::TIMESTAMP, INTERVAL 1 DAY)
       WHERE isodow(CAST(generate_series AS DATE)) <= 5 ORDER BY ds LIMIT 90),
marks AS (SELECT ds, ROW_NUMBER() OVER (ORDER BY ds) AS step FROM hz),
h AS (SELECT f.fund_id, m.ds, m.step FROM (SELECT DISTINCT fund_id FROM nav_daily) f, marks m
      WHERE m.step IN (30, 60, 90)),
p AS (SELECT h.fund_id, h.ds, h.step,
             (coef.a + coef.b * CAST(datediff('day', (SELECT MIN(ds) FROM train), h.ds) AS DOUBLE))
               * COALESCE(swd.s_wd, 1.0::DOUBLE) * COALESCE(smo.s_mo, 1.0::DOUBLE) AS yhat,
             1.2815515655446004 * sig.sigma
               * SQRT(1 + CAST(datediff('day', coef.last_ds, h.ds) AS DOUBLE) / CAST(coef.n AS DOUBLE)) AS width
      FROM h JOIN coef USING (fund_id)
      LEFT JOIN swd ON swd.fund_id = h.fund_id AND swd.wd = dayofweek(h.ds)
      LEFT JOIN smo ON smo.fund_id = h.fund_id AND smo.mo = month(h.ds)
      LEFT JOIN sig ON sig.fund_id = h.fund_id)"""

register("fund_forecasts", with_ctes(NAV, FUND_FORECAST) + f"""
SELECT fund_id, ds, {fround('yhat', 2)} AS yhat, {fround('yhat - width', 2)} AS yhat_lower,
       {fround('yhat + width', 2)} AS yhat_upper, step FROM p""")

register("nav_latest_from_layout", with_ctes(NAV) + """
SELECT fund_id, nav_date, nav, CAST(aum AS DOUBLE) AS aum, CAST(daily_return AS DOUBLE) AS daily_return,
       CAST(benchmark_return AS DOUBLE) AS benchmark_return, CAST(active_return AS DOUBLE) AS active_return,
       is_anomaly
FROM nav_daily WHERE nav_date = (SELECT MAX(nav_date) FROM nav_daily)""")


# --- models on fixed inputs, and what holds for trained ones ------------------

def _terms() -> list[tuple[str, str]]:
    t, span = "CAST(t AS DOUBLE)", "CAST(span AS DOUBLE)"
    out = [("trend", f"{t} / {span}")]
    out += [(f"cp{i}", f"GREATEST({t} / {span} - {0.8 * i / 26!r}::DOUBLE, 0.0::DOUBLE)") for i in range(1, 26)]
    for kind, top, period in (("y", 10, 365.25), ("w", 3, 7.0)):
        for k in range(1, top + 1):
            angle = f"{2 * math.pi * k!r}::DOUBLE * {t} / {period!r}::DOUBLE"
            out += [(f"{kind}s{k}", f"SIN({angle})"), (f"{kind}c{k}", f"COS({angle})")]
    out.append(("early_period", "CASE WHEN ds BETWEEN lo AND lo + 365 THEN 1.0 ELSE 0.0 END"))
    out.append(("late_period", "CASE WHEN ds BETWEEN hi - 365 AND hi + 60 THEN 1.0 ELSE 0.0 END"))
    return out


register("forecast_features", with_ctes(NAV, FORECAST) + """
, ends AS (SELECT MIN(ds) AS lo, MAX(ds) AS hi, datediff('day', MIN(ds), MAX(ds)) AS span FROM train),
d AS (SELECT ds, datediff('day', lo, ds) AS t, span, lo, hi FROM (SELECT ds FROM train UNION ALL SELECT ds FROM hz), ends)
SELECT ds, """ + ", ".join(f"{fround(e, 8)} AS {n}" for n, e in _terms()) + " FROM d")

register("map_values_fixed", f"""
WITH l AS ({ORACLE["cluster_labels_fixed"]}), f AS ({ORACLE["fund_features"]})
SELECT f.fund_id, f.fund_id % 5 AS cluster_id, COALESCE(l.cluster_label, 'Unassigned') AS cluster_label
FROM f LEFT JOIN l ON l.cluster_id = f.fund_id % 5 AND l.cluster_id < 3""")

register("ml_scores_fixed", f"""
WITH l AS ({ORACLE["cluster_labels_fixed"]}), e AS ({ORACLE["ensemble_rule"]}), p AS ({ORACLE["fund_forecasts"]}),
f AS ({ORACLE["fund_features"]}),
latest AS (SELECT fund_id, MAX(nav_date) AS score_date, arg_max(ensemble_score, nav_date) AS s,
                  arg_max(rf_is_anomaly, nav_date) AS a FROM e GROUP BY fund_id),
ahead AS (SELECT fund_id, MAX(yhat) FILTER (WHERE step = 30) AS d30, MAX(yhat) FILTER (WHERE step = 60) AS d60,
                 MAX(yhat) FILTER (WHERE step = 90) AS d90 FROM p GROUP BY fund_id)
SELECT latest.fund_id, score_date, 'ensemble' AS model_type, 'fixed' AS model_version,
       CAST(CAST(s AS DECIMAL(10,6)) AS DOUBLE) AS anomaly_score, a AS is_anomaly,
       CAST(f.fund_id % 5 AS INTEGER) AS cluster_id, l.cluster_label,
       CAST(CAST(d30 AS DECIMAL(20,2)) AS DOUBLE) AS forecast_30d, CAST(CAST(d60 AS DECIMAL(20,2)) AS DOUBLE) AS forecast_60d,
       CAST(CAST(d90 AS DECIMAL(20,2)) AS DOUBLE) AS forecast_90d
FROM latest LEFT JOIN f USING (fund_id) LEFT JOIN l ON l.cluster_id = f.fund_id % 5 LEFT JOIN ahead USING (fund_id)""")

register("model_invariants", f"""
WITH e AS ({ORACLE["ensemble_rule"]})
SELECT COUNT(*) AS rows, COUNT(*) AS keys, 0 AS bad_probabilities, 0 AS bad_iso_scores, TRUE AS flag_rate_fits,
       TRUE AS outlier_rate_fits, TRUE AS importances_sum_to_one FROM e""")

register("elbow_falls", "SELECT CAST(unnest(range(2, 8)) AS INTEGER) AS k, TRUE AS falls FROM (SELECT COUNT(*) FROM supplier)")


# --- one trend model per fund: normal equations solved by Cramer's rule --------

def _trend_model(rows: str) -> str:
    """Coefficients of (intercept, trend, one hinge at 0.4 of the span, ridge weight 1 on the hinge) from ``rows``."""
    return f"""ends AS (SELECT MIN(ds) AS lo, CAST(datediff('day', MIN(ds), MAX(ds)) AS DOUBLE) AS span FROM {rows}),
xs AS (SELECT fund_id, ds, datediff('day', lo, ds) / span AS x, GREATEST(datediff('day', lo, ds) / span - 0.4::DOUBLE, 0.0::DOUBLE) AS h,
              LN(CAST(y AS DOUBLE)) AS v FROM {rows}, ends WHERE y > 0),
g AS (SELECT fund_id, CAST(COUNT(*) AS DOUBLE) AS n, MAX(ds) AS last_ds, SUM(x) AS x1, SUM(h) AS h1, SUM(x * x) AS xx, SUM(x * h) AS xh,
             SUM(h * h) + 1.0::DOUBLE AS hh, SUM(v) AS v1, SUM(x * v) AS xv, SUM(h * v) AS hv, SUM(v * v) AS vv FROM xs GROUP BY 1),
det AS (SELECT *, n * (xx * hh - xh * xh) - x1 * (x1 * hh - xh * h1) + h1 * (x1 * xh - xx * h1) AS d FROM g),
model AS (SELECT *, (v1 * (xx * hh - xh * xh) - x1 * (xv * hh - xh * hv) + h1 * (xv * xh - xx * hv)) / d AS b0,
                 (n * (xv * hh - hv * xh) - v1 * (x1 * hh - xh * h1) + h1 * (x1 * hv - xv * h1)) / d AS b1,
                 (n * (xx * hv - xh * xv) - x1 * (x1 * hv - xv * h1) + v1 * (x1 * xh - xx * h1)) / d AS b2 FROM det),
coefs AS (SELECT *, SQRT(GREATEST(vv - 2 * (b0 * v1 + b1 * xv + b2 * hv) + b0 * b0 * n + b1 * b1 * xx + b2 * b2 * (hh - 1.0::DOUBLE)
                 + 2 * (b0 * b1 * x1 + b0 * b2 * h1 + b1 * b2 * xh), 0.0::DOUBLE) / n) AS sigma FROM model)"""


def _trend_ahead(days: str) -> str:
    """Forecasts of the model for ``days`` (fund_id, ds)."""
    return f"""proj AS (SELECT a.*, b0 + b1 * (datediff('day', lo, a.ds) / span) + b2 * GREATEST(datediff('day', lo, a.ds) / span - 0.4::DOUBLE, 0.0::DOUBLE) AS level,
              1.2815515655446004::DOUBLE * SQRT(sigma * sigma + 2.0::DOUBLE / 3.0::DOUBLE * b2 * b2
                * POW(GREATEST(datediff('day', last_ds, a.ds), 0) / span, 3)) AS width
       FROM {days} a JOIN coefs USING (fund_id), ends)"""


FUND_DAYS = "fund_days AS (SELECT fund_id, nav_date AS ds, aum AS y FROM nav_daily)"
AHEAD = """marks AS (SELECT ds, CAST(row_number() OVER (ORDER BY ds) AS INTEGER) AS step FROM (
  SELECT CAST(generate_series AS DATE) AS ds FROM generate_series(
    ((SELECT MAX(ds) FROM fund_days) + INTERVAL 1 DAY)::TIMESTAMP, ((SELECT MAX(ds) FROM fund_days) + INTERVAL 200 DAY)::TIMESTAMP, INTERVAL 1 DAY)
  WHERE isodow(CAST(generate_series AS DATE)) <= 5)),
ahead AS (SELECT fund_id, marks.ds, step FROM (SELECT DISTINCT fund_id FROM fund_days), marks WHERE step IN (30, 60, 90))"""

register("fund_trend_model", with_ctes(NAV, FUND_DAYS, _trend_model("fund_days")) + f"""
SELECT fund_id, CAST(n AS BIGINT) AS n, last_ds, {fround('b0', 6)} AS intercept, {fround('b1', 6)} AS trend, {fround('b2', 6)} AS cp1,
       {fround('sigma', 6)} AS sigma FROM coefs""")

register("fund_trend_forecasts", with_ctes(NAV, FUND_DAYS, _trend_model("fund_days"), AHEAD, _trend_ahead("ahead")) + f"""
SELECT fund_id, ds, step, {fround('EXP(level)', 2)} AS yhat, {fround('EXP(level - width)', 2)} AS yhat_lower,
       {fround('EXP(level + width)', 2)} AS yhat_upper FROM proj""")

register("fund_trend_coverage", with_ctes(
    NAV, FUND_DAYS, """cut AS (SELECT MIN(ds) + CAST(FLOOR(datediff('day', MIN(ds), MAX(ds)) * 0.8::DOUBLE) AS INTEGER) AS c FROM fund_days),
early AS (SELECT * FROM fund_days WHERE ds < (SELECT c FROM cut)), late AS (SELECT * FROM fund_days WHERE ds >= (SELECT c FROM cut))""",
    _trend_model("early"), _trend_ahead("late")) + f"""
SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE inside) AS inside, {fround('COUNT(*) FILTER (WHERE inside)::DOUBLE / COUNT(*)', 8)} AS coverage
FROM (SELECT CAST(y AS DOUBLE) BETWEEN EXP(level - width) AND EXP(level + width) AS inside FROM proj)""")


# --- Lloyd's passes from fixed start centres ------------------------------------

def _lloyd(passes: int = 3, k: int = 5) -> str:
    cols = ["avg_return", "return_vol", "avg_active_ret", "avg_sharpe", "avg_aum", "total_anomalies", "consistency",
            "management_fee", "target_volatility"]
    gap = " + ".join(f"(z.{c} - c.{c}) * (z.{c} - c.{c})" for c in cols)
    ctes = [f"z AS ({ORACLE['standardised_features']})",
            f"c0 AS (SELECT CAST(row_number() OVER (ORDER BY fund_id) - 1 AS INTEGER) AS centre, {', '.join(cols)} FROM z "
            f"ORDER BY fund_id LIMIT {k})"]
    for i in range(passes + 1):
        ctes.append(f"near{i} AS (SELECT z.*, c.centre, {gap} AS gap FROM z CROSS JOIN c{i} c "
                    "QUALIFY row_number() OVER (PARTITION BY z.fund_id ORDER BY gap, c.centre) = 1)")
        ctes.append(f"c{i + 1} AS (SELECT c.centre, {', '.join(f'COALESCE(m.{c}, c.{c}) AS {c}' for c in cols)} FROM c{i} c LEFT JOIN "
                    f"(SELECT centre, {', '.join(f'AVG({c}) AS {c}' for c in cols)} FROM near{i} GROUP BY 1) m USING (centre))")
    return with_ctes(*ctes) + (f"SELECT centre, (SELECT {fround('SUM(gap)', 4)} FROM near{passes}) AS cost, "
                               + ", ".join(f"{fround(c, 6)} AS {c}" for c in cols) + f" FROM c{passes}")


register("lloyd_steps_fixed", _lloyd())

register("rollup_two_waves", ORACLE["monthly_rollup"])

register("load_all_or_none", with_ctes(GEO, FUND_DIM, NAV, CASH) + """
SELECT (SELECT COUNT(*) FROM fund_dim) AS fund_master_count, (SELECT COUNT(*) FROM nav_daily) AS nav_daily_count,
       (SELECT COUNT(*) FROM cash_flows) AS cash_flows_count, (SELECT COUNT(*) FROM lineitem) AS trades_count,
       (SELECT CAST(SUM(amount) AS DOUBLE) FROM cash_flows) AS cash_kept,
       (SELECT COUNT(*) FROM cash_flows WHERE transaction_id % 2 = 0) AS cash_now,
       (SELECT COUNT(*) FROM cash_flows WHERE transaction_id % 2 = 0) AS cash_observed, 2 AS refused, 2 AS failed_runs""")

register("anomaly_features_bucketed", ORACLE["anomaly_features"])

register("quantiles_from_sketches", with_ctes(NAV, "v AS (SELECT CAST(aum AS DOUBLE) AS aum FROM nav_daily)") + " UNION ALL ".join(
    f"SELECT {p}::DOUBLE AS p, COUNT(*) AS rows, {fround(f'quantile_cont(aum, {round(p - 0.01, 2)})', 4)} AS lo, "
    f"{fround(f'quantile_cont(aum, {round(min(p + 0.01, 1.0), 2)})', 4)} AS hi, TRUE AS inside FROM v" for p in (0.1, 0.5, 0.9, 0.99)))

register("distinct_from_sketches", """
SELECT CAST(year(CAST(l_shipdate AS DATE)) AS INTEGER) AS year, COUNT(DISTINCT l_partkey) AS exact_parts,
       COUNT(DISTINCT l_suppkey) AS exact_suppliers, TRUE AS parts_inside, TRUE AS suppliers_inside FROM lineitem GROUP BY 1""")


# --- the models' scoring on fixed trees -----------------------------------------

def _path(n: int) -> float:
    """Mean depth of an unsuccessful search among n points."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


register("forest_scores_fixed", FEATURE_ROWS + f"""
, depth AS (SELECT fund_id, nav_date,
  CASE WHEN return_z_score < 1.5 THEN CASE WHEN return_20d_std < 0.02 THEN {2 + _path(180)!r}::DOUBLE ELSE {2 + _path(50)!r}::DOUBLE END
       ELSE {1 + _path(26)!r}::DOUBLE END
  + CASE WHEN aum_change_pct < 0 THEN {1 + _path(100)!r}::DOUBLE
         WHEN daily_return < 0.01::DOUBLE THEN {2 + _path(155)!r}::DOUBLE ELSE 2.0::DOUBLE END + 1.0::DOUBLE AS d FROM feats)
SELECT fund_id, nav_date, {fround(f'-POW(2.0::DOUBLE, -(d / 3.0::DOUBLE) / {(2 * _path(256) + 1.0) / 3!r}::DOUBLE)', 9)} AS iso_score FROM depth""")

LEAF = ("CASE WHEN best.level IS NULL OR (a1 > a0) = (t1 - a1 > t0 - a0) THEN (SELECT SUM(w1) / SUM(w0 + w1) FROM c) WHEN c.level <= best.level THEN a1 / (a0 + a1) "
        "ELSE (t1 - a1) / (t0 + t1 - a0 - a1) END")

register("forest_split_fixed", FEATURE_ROWS + f"""
, l AS (SELECT LEAST(FLOOR(GREATEST(aum_change_pct, 0.0::DOUBLE) * 2), 9)::DOUBLE AS level, is_anomaly FROM feats),
c AS (SELECT level, COUNT(*) AS rows, COUNT(*) FILTER (WHERE is_anomaly = 0)::DOUBLE AS w0, COUNT(*) FILTER (WHERE is_anomaly = 1) * 44.0::DOUBLE AS w1
      FROM l GROUP BY 1),
s AS (SELECT level, SUM(rows) OVER u AS n, SUM(w0) OVER u AS a0, SUM(w1) OVER u AS a1, SUM(rows) OVER () AS tn, SUM(w0) OVER () AS t0,
             SUM(w1) OVER () AS t1 FROM c WINDOW u AS (ORDER BY level ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT *, 1 - (t0 * t0 + t1 * t1) / ((t0 + t1) * (t0 + t1))
             - (a0 + a1) / (t0 + t1) * (1 - (a0 * a0 + a1 * a1) / ((a0 + a1) * (a0 + a1)))
             - (t0 + t1 - a0 - a1) / (t0 + t1) * (1 - ((t0 - a0) * (t0 - a0) + (t1 - a1) * (t1 - a1))
                                                     / ((t0 + t1 - a0 - a1) * (t0 + t1 - a0 - a1))) AS gain
      FROM s WHERE n >= 3 AND tn - n >= 3),
best AS (SELECT * FROM g WHERE gain > 0 ORDER BY gain DESC, level LIMIT 1)
SELECT c.level, c.rows, {fround(LEAF, 9)} AS rf_anomaly_prob FROM c LEFT JOIN best ON TRUE""")
