"""Bronze, silver and gold queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import marts
from ..session import checkpointed
from . import bindings as b
from . import sql as q
from .registry import query

POSITION_MEASURES = (
    "quantity", "unit_cost", "unit_price", "cost_basis", "market_value", "unrealized_gl",
    "accrued_income", "fx_rate",
)
_MEASURES = q.doubles(*POSITION_MEASURES)

query("stg_positions", q.with_tables(q.POSITIONS_RAW, select=f"""
SELECT position_hash, as_of_date, account_id, security_id, {_MEASURES},
       settlement_status, source_system FROM positions"""))(b.staged_positions)

query("stg_securities", q.with_tables(q.SECURITIES, select="SELECT * FROM securities"))(
    b.staged_securities
)

query("stg_accounts", q.with_tables(q.ACCOUNTS, select="SELECT * FROM accounts"))(
    b.staged_accounts
)

query("positions_enriched", q.with_tables(*q.STAR, select=f"""
SELECT position_hash, as_of_date, account_id, account_name, account_type, account_base_ccy,
       portfolio_manager, aum_tier, security_id, cusip, isin, ticker, security_name,
       asset_class, sub_asset_class, security_ccy, security_country, {_MEASURES},
       {q.doubles("market_value_base", "cost_basis_base", "unrealized_gl_base")},
       settlement_status, source_system, is_cash, is_failed, matures_within_90d
FROM enriched"""))(b.enriched_positions)


@query("fx_conversion", q.with_tables(*q.STAR, select="""
SELECT account_base_ccy, CAST(sum(market_value_base) AS DOUBLE) AS market_value_base,
       CAST(sum(cost_basis_base) AS DOUBLE) AS cost_basis_base,
       CAST(sum(unrealized_gl_base) AS DOUBLE) AS unrealized_gl_base
FROM enriched GROUP BY account_base_ccy"""))
def fx_conversion(t):
    amounts = ("market_value_base", "cost_basis_base", "unrealized_gl_base")
    return b.enriched_positions(t).groupBy("account_base_ccy").agg(
        *[F.sum(c).alias(c) for c in amounts]
    )


@query("maturity_flag", q.with_tables(*q.STAR, select="""
SELECT asset_class, matures_within_90d, is_cash, is_failed, count(*) AS n_rows
FROM enriched GROUP BY asset_class, matures_within_90d, is_cash, is_failed"""))
def maturity_flag(t):
    return b.enriched_positions(t).groupBy(
        "asset_class", "matures_within_90d", "is_cash", "is_failed"
    ).agg(F.count(F.lit(1)).alias("n_rows"))


NAV_SQL = """
rollup_ AS (
  SELECT as_of_date, account_id, account_name, account_type, account_base_ccy,
         portfolio_manager, aum_tier, count(*) AS position_count,
         count(DISTINCT security_id) AS distinct_securities,
         count(DISTINCT asset_class) AS distinct_asset_classes,
         sum(market_value_base) AS nav_base, sum(cost_basis_base) AS cost_basis_base,
         sum(unrealized_gl_base) AS unrealized_gl_base,
         sum(accrued_income) AS accrued_income_total,
         sum(CASE WHEN is_cash = 1 THEN market_value_base ELSE 0 END) AS cash_base,
         CAST(sum(is_failed) AS BIGINT) AS failed_trade_count,
         sum(CASE WHEN matures_within_90d = 1 THEN market_value_base ELSE 0 END)
           AS maturing_90d_base,
         max(market_value_base) AS top_position_base
  FROM enriched
  GROUP BY as_of_date, account_id, account_name, account_type, account_base_ccy,
           portfolio_manager, aum_tier),
nav AS (
  SELECT *, lag(nav_base) OVER (PARTITION BY account_id ORDER BY as_of_date)
           AS prior_day_nav_base FROM rollup_)"""
_NAV_MONEY = q.doubles(
    "nav_base", "cost_basis_base", "unrealized_gl_base", "accrued_income_total", "cash_base",
    "maturing_90d_base", "top_position_base", "prior_day_nav_base",
)
_RETURN = q.percent("(nav_base - prior_day_nav_base)", "prior_day_nav_base", 4)


@query("nav_by_account_daily", q.with_tables(*q.STAR, NAV_SQL, select=f"""
SELECT as_of_date, account_id, account_name, account_type, account_base_ccy,
       portfolio_manager, aum_tier, position_count, distinct_securities,
       distinct_asset_classes, failed_trade_count, {_NAV_MONEY},
       {q.percent("cash_base", "nav_base", 2)} AS cash_pct_nav,
       {q.percent("top_position_base", "nav_base", 2)} AS top_position_pct,
       {_RETURN} AS daily_return_pct
FROM nav"""))
def nav_by_account_daily(t):
    return marts.nav_by_account_daily(b.enriched_positions(t))


_JUNE = [date(1997, 6, day) for day in range(1, 31)]


@query("nav_refreshed", q.with_tables(*q.STAR, NAV_SQL, select=f"""
SELECT as_of_date, account_id, account_name, position_count, distinct_securities, {_NAV_MONEY},
       {q.percent("top_position_base", "nav_base", 2)} AS top_position_pct,
       {_RETURN} AS daily_return_pct
FROM nav"""))
def nav_refreshed(t):
    """The mart without half of the accounts' June 1997, after their positions arrive."""
    enriched = b.enriched_positions(t)
    late = F.col("as_of_date").isin(_JUNE) & (F.right("account_id", F.lit(1)) >= "5")
    stored = marts.nav_by_account_daily(enriched.where(~late))
    rows = checkpointed(marts.refreshed_nav(stored, enriched, _JUNE))
    replaced = [r[0] for r in rows.select("as_of_date").distinct().collect()]
    whole = stored.where(~F.col("as_of_date").isin([*_JUNE, *replaced])).unionByName(rows)
    return whole.select(
        "as_of_date", "account_id", "account_name", "position_count", "distinct_securities",
        "nav_base", "cost_basis_base", "unrealized_gl_base", "accrued_income_total", "cash_base",
        "maturing_90d_base", "top_position_base", "prior_day_nav_base", "top_position_pct",
        "daily_return_pct")


@query("nav_lag", q.with_tables(*q.STAR, NAV_SQL, select=f"""
SELECT account_id, as_of_date, {q.doubles("nav_base", "prior_day_nav_base")} FROM nav"""))
def nav_lag(t):
    nav = marts.nav_by_account_daily(b.enriched_positions(t))
    return nav.select("account_id", "as_of_date", "nav_base", "prior_day_nav_base")


@query("daily_return", q.with_tables(*q.STAR, NAV_SQL, select=f"""
SELECT account_id, as_of_date, {_RETURN} AS daily_return_pct FROM nav"""))
def daily_return(t):
    nav = marts.nav_by_account_daily(b.enriched_positions(t))
    return nav.select("account_id", "as_of_date", "daily_return_pct")


@query("exposure_by_asset_class", q.with_tables(*q.STAR, select=f"""
SELECT as_of_date, asset_class, sub_asset_class, count(*) AS position_count,
       count(DISTINCT account_id) AS distinct_accounts,
       count(DISTINCT security_id) AS distinct_securities,
       CAST(sum(market_value_base) AS DOUBLE) AS total_exposure_base,
       CAST(sum(cost_basis_base) AS DOUBLE) AS total_cost_base,
       CAST(sum(unrealized_gl_base) AS DOUBLE) AS total_unrealized_gl_base,
       {q.half_up(q.cents("sum(market_value_base)"), "(count(*) * 100)", 2)}
         AS avg_position_base,
       CAST(max(market_value_base) AS DOUBLE) AS largest_position_base,
       CAST(sum(is_failed) AS BIGINT) AS failed_count
FROM enriched GROUP BY as_of_date, asset_class, sub_asset_class"""))
def exposure_by_asset_class(t):
    return marts.exposure_by_asset_class(b.enriched_positions(t))
