"""Gold: account NAV per day and exposure per asset class."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import mean_of, percent_of
from ..session import checkpointed

# Grouping keys and output columns of the two marts.
NAV_KEYS = [
    "as_of_date", "account_id", "account_name", "account_type", "account_base_ccy",
    "portfolio_manager", "aum_tier",
]
NAV_COLUMNS = [
    *NAV_KEYS, "position_count", "distinct_securities", "distinct_asset_classes", "nav_base",
    "cost_basis_base", "unrealized_gl_base", "accrued_income_total", "cash_base",
    "cash_pct_nav", "failed_trade_count", "maturing_90d_base", "top_position_base",
    "top_position_pct", "prior_day_nav_base", "daily_return_pct",
]
EXPOSURE_KEYS = ["as_of_date", "asset_class", "sub_asset_class"]


def _amount_where(flag_column: str):
    return F.sum(
        F.when(F.col(flag_column) == 1, F.col("market_value_base")).otherwise(
            F.lit(0).cast("decimal(20,2)")
        )
    )


def nav_rollup(enriched: DataFrame) -> DataFrame:
    """One row per account and day, before anything that looks at other days.

    Only one distinct count is left to the optimizer: two would copy every position three times
    before the shuffle. With one, positions are combined per group *and* security before they
    are shuffled by both, so an account with a large share of all positions is spread over the
    whole cluster instead of meeting in one task. The asset classes are few by contract
    (``schemas.ASSET_CLASSES``), so a set of them travels with the sums.
    """
    return enriched.groupBy(*NAV_KEYS).agg(
        F.count(F.lit(1)).alias("position_count"),
        F.count_distinct("security_id").alias("distinct_securities"),
        F.size(F.collect_set("asset_class")).cast("bigint").alias("distinct_asset_classes"),
        F.sum("market_value_base").alias("nav_base"),
        F.sum("cost_basis_base").alias("cost_basis_base"),
        F.sum("unrealized_gl_base").alias("unrealized_gl_base"),
        F.sum("accrued_income").alias("accrued_income_total"),
        _amount_where("is_cash").alias("cash_base"),
        F.sum("is_failed").alias("failed_trade_count"),
        _amount_where("matures_within_90d").alias("maturing_90d_base"),
        F.max("market_value_base").alias("top_position_base"),
    )


def _prior_nav() -> Column:
    """NAV of the account's previous existing day.

    The window partition is one account's days after the rollup: it grows with the calendar,
    not with the number of positions.
    """
    by_account = Window.partitionBy("account_id").orderBy("as_of_date")
    return F.lag("nav_base").over(by_account)


def _finished(nav: DataFrame) -> DataFrame:
    """The mart's columns from the rollup with ``prior_day_nav_base``."""
    prior = F.col("prior_day_nav_base")
    change = F.col("nav_base").cast("decimal(24,2)") - prior.cast("decimal(24,2)")
    return nav.withColumns({
        "daily_return_pct": percent_of(change, prior, 4),
        "top_position_pct": percent_of(F.col("top_position_base"), F.col("nav_base"), 2),
        "cash_pct_nav": percent_of(F.col("cash_base"), F.col("nav_base"), 2),
    }).select(*NAV_COLUMNS, F.current_timestamp().alias("dbt_built_at"))


def nav_by_account_daily(enriched: DataFrame) -> DataFrame:
    return _finished(nav_rollup(enriched).withColumn("prior_day_nav_base", _prior_nav()))


def refreshed_nav(stored: DataFrame, enriched: DataFrame, days: Sequence[date]) -> DataFrame:
    """The rows of all days of the stored mart that change when positions of ``days`` did.

    Those are ``days``, rolled up anew from their positions alone, and the days on which an account
    has its next row after one of them, if what it follows on changed. Other days are looked at
    through four columns of the mart, one narrow row per account and day. Whole days are returned,
    ready to replace their partitions; the days found are collected, for a calendar is short.
    """
    fresh = checkpointed(nav_rollup(enriched.where(F.col("as_of_date").isin(list(days)))))
    kept = stored.where(~F.col("as_of_date").isin(list(days)))
    linked = ["account_id", "as_of_date", "nav_base"]
    lagged = kept.select(*linked, "prior_day_nav_base", F.lit(False).alias("is_fresh")).unionByName(
        fresh.select(*linked, F.lit(None).cast("decimal(38,2)").alias("prior_day_nav_base"),
                     F.lit(True).alias("is_fresh"))).withColumn("prior", _prior_nav())
    lagged = checkpointed(lagged)
    moved = ~F.col("is_fresh") & ~F.col("prior").eqNullSafe(F.col("prior_day_nav_base"))
    later = [r[0] for r in lagged.where(moved).select("as_of_date").distinct().collect()]
    rows = fresh.unionByName(kept.where(F.col("as_of_date").isin(later)).select(*fresh.columns))
    links = lagged.select("account_id", "as_of_date", F.col("prior").alias("prior_day_nav_base"))
    links = links.where(F.col("as_of_date").isin([*days, *later]))
    return _finished(rows.join(links, ["account_id", "as_of_date"]))


def refreshed_exposure(stored: DataFrame, enriched: DataFrame, days: Sequence[date]) -> DataFrame:
    """The rows of ``days``, which depend on no other day."""
    return exposure_by_asset_class(enriched.where(F.col("as_of_date").isin(list(days))))


def exposure_by_asset_class(enriched: DataFrame) -> DataFrame:
    """Firm-level exposure per day, class and sub-class.

    Positions are read and joined once. For the two exact distinct counts Spark expands each into
    three narrow rows, of sums, account and security, which combine in the map tasks: the sums per
    group, the others per group *and* value, so a group with a large share of all positions is
    spread by value. On the shared tables that takes a fifth less time than a second aggregate over
    a second scan.
    """
    total = F.sum("market_value_base")
    sums = enriched.groupBy(*EXPOSURE_KEYS).agg(
        F.count(F.lit(1)).alias("position_count"),
        F.count_distinct("account_id").alias("distinct_accounts"),
        F.count_distinct("security_id").alias("distinct_securities"),
        total.alias("total_exposure_base"),
        F.sum("cost_basis_base").alias("total_cost_base"),
        F.sum("unrealized_gl_base").alias("total_unrealized_gl_base"),
        mean_of(total, F.count("market_value_base")).alias("avg_position_base"),
        F.max("market_value_base").alias("largest_position_base"),
        F.sum("is_failed").alias("failed_count"),
    )
    return sums.select(
        *EXPOSURE_KEYS, "position_count", "distinct_accounts", "distinct_securities",
        "total_exposure_base", "total_cost_base", "total_unrealized_gl_base",
        "avg_position_base", "largest_position_base", "failed_count",
        F.current_timestamp().alias("dbt_built_at"),
    )
