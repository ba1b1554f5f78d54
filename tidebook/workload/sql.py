"""The bindings of ``bindings.py`` written once more as SQL, for the compared engine."""

from __future__ import annotations

POSITIONS_RAW = """
positions_base AS (
  SELECT CAST(o_orderdate AS DATE) AS as_of_date,
         'ACCT' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS account_id,
         'SEC' || lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS security_id,
         CAST(l_quantity AS DECIMAL(18,4)) AS quantity,
         CAST(l_extendedprice AS DECIMAL(20,2)) AS market_value,
         CAST(round(CAST(l_extendedprice AS DECIMAL(20,2))
              * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(20,2)) AS cost_basis,
         CASE WHEN l_linenumber % 7 <> 0 THEN
           CAST(round(CAST(l_extendedprice AS DECIMAL(20,2))
                * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(20,2)) END AS accrued_income,
         CAST(1 + l_tax AS DECIMAL(10,6)) AS fx_rate,
         CASE l_returnflag WHEN 'N' THEN 'SETTLED' WHEN 'A' THEN 'PENDING'
              WHEN 'R' THEN 'FAILED' END AS settlement_status,
         CASE l_linestatus WHEN 'F' THEN 'ADVANTAGE' WHEN 'O' THEN 'STAR' END AS source_system
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
positions AS (
  SELECT strftime(as_of_date, '%Y-%m-%d') || '|' || account_id || '|' || security_id
           AS position_hash,
         as_of_date, account_id, security_id, quantity,
         (2 * CAST(cost_basis * 100 AS HUGEINT) * 10000 + CAST(quantity AS HUGEINT))
           // (2 * CAST(quantity AS HUGEINT)) / 1000000.0 AS unit_cost,
         (2 * CAST(market_value * 100 AS HUGEINT) * 10000 + CAST(quantity AS HUGEINT))
           // (2 * CAST(quantity AS HUGEINT)) / 1000000.0 AS unit_price,
         cost_basis, market_value,
         CAST(market_value - cost_basis AS DECIMAL(20,2)) AS unrealized_gl,
         accrued_income, fx_rate, settlement_status, source_system
  FROM positions_base)"""

SECURITIES = """
securities AS (
  SELECT 'SEC' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS security_id,
         'C' || lpad(CAST(p_partkey % 100000000 AS VARCHAR), 8, '0') AS cusip,
         'US' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS isin,
         upper(substr(p_name, 1, 4)) AS ticker, p_name AS security_name,
         CASE p_type WHEN 'STANDARD' THEN 'EQUITY' WHEN 'ECONOMY' THEN 'FIXED_INCOME'
              WHEN 'MEDIUM' THEN 'CASH' WHEN 'PROMO' THEN 'ALTERNATIVE'
              WHEN 'SMALL' THEN 'DERIVATIVE' WHEN 'LARGE' THEN 'DERIVATIVE' END AS asset_class,
         p_brand AS sub_asset_class,
         CASE p_partkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS currency,
         CASE p_partkey % 2 WHEN 0 THEN 'US' ELSE 'GB' END AS country,
         CASE WHEN p_type = 'STANDARD' THEN 'NYSE' END AS exchange,
         CAST(DATE '1990-01-01' + p_size AS DATE) AS issue_date,
         CASE WHEN p_type = 'ECONOMY'
              THEN CAST(DATE '1995-01-01' + CAST(p_partkey % 2500 AS INTEGER) AS DATE) END
           AS maturity_date,
         CASE WHEN p_size < 45 THEN 1 ELSE 0 END AS is_active
  FROM part)"""

ACCOUNTS = """
accounts AS (
  SELECT 'ACCT' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS account_id,
         c_name AS account_name,
         'CLT' || lpad(CAST(c_custkey // 10 AS VARCHAR), 6, '0') AS client_id,
         c_mktsegment AS account_type,
         CASE c_custkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS base_currency,
         substr(n_name, 1, 2) AS domicile_country,
         CAST(DATE '2010-01-01' + CAST(c_custkey % 5000 AS INTEGER) AS DATE) AS inception_date,
         'PM' || lpad(CAST(c_custkey % 200 AS VARCHAR), 4, '0') AS portfolio_manager,
         CASE WHEN c_custkey % 10 < 7 THEN 1 ELSE 0 END AS is_discretionary,
         CASE WHEN c_acctbal < 0 THEN 'SMALL' WHEN c_acctbal < 3000 THEN 'MID'
              WHEN c_acctbal < 7000 THEN 'LARGE' ELSE 'UHNW' END AS aum_tier
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

ENRICHED = """
enriched AS (
  SELECT position_hash, as_of_date, p.account_id, account_name, account_type,
         base_currency AS account_base_ccy, portfolio_manager, aum_tier, p.security_id,
         cusip, isin, ticker, security_name, asset_class, sub_asset_class,
         currency AS security_ccy, country AS security_country, quantity, unit_cost,
         unit_price, cost_basis, market_value, unrealized_gl,
         CAST(coalesce(accrued_income, 0) AS DECIMAL(20,2)) AS accrued_income, fx_rate,
         CAST(round(market_value * fx_rate, 2) AS DECIMAL(20,2)) AS market_value_base,
         CAST(round(cost_basis * fx_rate, 2) AS DECIMAL(20,2)) AS cost_basis_base,
         CAST(round(unrealized_gl * fx_rate, 2) AS DECIMAL(20,2)) AS unrealized_gl_base,
         settlement_status, source_system,
         CASE WHEN asset_class = 'CASH' THEN 1 ELSE 0 END AS is_cash,
         CASE WHEN settlement_status = 'FAILED' THEN 1 ELSE 0 END AS is_failed,
         CASE WHEN maturity_date IS NOT NULL AND maturity_date < as_of_date + 90
              THEN 1 ELSE 0 END AS matures_within_90d
  FROM positions p JOIN securities s ON p.security_id = s.security_id
                   JOIN accounts a ON p.account_id = a.account_id)"""


def with_tables(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


STAR = (POSITIONS_RAW, SECURITIES, ACCOUNTS, ENRICHED)

RUN_STATS = """
stats_base AS (
  SELECT user_id, event_type, sum(CAST(value AS DECIMAL(20,2))) AS elapsed,
         CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum,
         max(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k_max, count(*) AS n
  FROM events GROUP BY user_id, event_type),
stats AS (
  SELECT 'run-' || CAST(user_id AS VARCHAR) AS run_id, event_type AS model_name,
         CASE WHEN n % 2 = 0 THEN 'table' ELSE 'view' END AS materialization,
         CASE user_id % 4 WHEN 0 THEN 'small' WHEN 1 THEN 'medium' WHEN 2 THEN 'large'
              ELSE 'xlarge' END AS pod_size,
         CASE WHEN user_id % 11 <> 0 THEN user_id % 3 + 2 END AS dbt_threads,
         user_id % 2 * 4 + 4 AS parallel_degree,
         CASE WHEN n % 5 <> 0 THEN CAST(elapsed AS DOUBLE) END AS elapsed_seconds,
         CAST(k_sum AS DOUBLE) / 100 AS cpu_seconds,
         k_max * 1048576 + n AS pga_peak_bytes, k_sum * 4096 AS physical_reads_bytes,
         CASE WHEN n % 3 <> 0 THEN k_sum END AS logical_reads, n * 100000 AS rows_processed
  FROM stats_base)"""


def cents(expression: str) -> str:
    """A money expression as a whole number of cents."""
    return f"CAST(CAST({expression} AS DECIMAL(24,2)) * 100 AS HUGEINT)"


def half_up(numerator: str, denominator: str, scale: int) -> str:
    """``numerator / denominator`` of whole numbers, rounded half away from zero, exactly.

    The denominator must be positive. Doubles would round ties to whichever side their binary
    form falls.
    """
    power = 10**scale
    magnitude = (
        f"((2 * abs({numerator}) * {power} + ({denominator})) // (2 * ({denominator})))"
    )
    return (
        f"(CASE WHEN ({numerator}) < 0 THEN -1 ELSE 1 END"
        f" * CAST({magnitude} AS DOUBLE) / {power}.0)"
    )


def percent(part: str, whole: str, scale: int) -> str:
    """SQL for ``percent_of`` over money expressions."""
    value = half_up(f"(100 * {cents(part)})", cents(whole), scale)
    return f"CASE WHEN {whole} > 0 THEN {value} END"


def doubles(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
