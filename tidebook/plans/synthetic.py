"""Synthetic feed: securities, accounts and positions for any number of ids.

Every value is a function of the row's id and the seed, so the feed does not depend on how the
rows are partitioned, and a lost task produces the same rows again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import half_even, padded_id

SEED = 42

# The domains of the drawn columns.
SUB_CLASSES = {
    "EQUITY": ("COMMON_STOCK", "PREFERRED_STOCK", "ADR", "ETF"),
    "FIXED_INCOME": ("CORPORATE_BOND", "GOVT_BOND", "MUNI_BOND", "MBS"),
    "CASH": ("USD_CASH", "FX_CASH", "MMF"),
    "ALTERNATIVE": ("HEDGE_FUND", "PRIVATE_EQUITY", "REAL_ESTATE"),
    "DERIVATIVE": ("OPTION", "FUTURE", "SWAP", "FORWARD"),
}
CURRENCIES = ("USD", "EUR", "GBP", "JPY", "CHF", "CAD", "AUD", "HKD")
COUNTRIES = ("US", "GB", "DE", "FR", "JP", "CH", "CA", "AU", "HK", "SG")
EXCHANGES = ("NYSE", "NASDAQ", "LSE", "XETR", "TSE", "SIX", "TSX", "ASX")
ACCOUNT_TYPES = ("TRUST", "IRA", "TAXABLE", "401K", "ENDOWMENT")
BASE_CURRENCIES = ("USD", "EUR", "GBP")
AUM_TIERS = ("SMALL", "MID", "LARGE", "UHNW")
FIRST_DAY, LAST_DAY = "2025-01-01", "2025-03-31"
SETTLEMENT_SHARES = (("SETTLED", 0.95), ("PENDING", 0.04), ("FAILED", 0.01))
SOURCE_SHARES = (("ADVANTAGE", 0.7), ("STAR", 0.3))
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"


class Draws:
    """Independent random columns of one table; each name is its own stream."""

    def __init__(self, table: str, seed: int = SEED):
        self.table, self.seed = table, seed

    def uniform(self, name: str) -> Column:
        """Between 0 inclusive and 1 exclusive."""
        salt = F.lit(f"{self.table}.{name}")
        bits = F.shiftrightunsigned(F.xxhash64("id", F.lit(self.seed), salt), 11)
        return bits.cast("double") * F.lit(2.0**-53)

    def below(self, name: str, bound: int) -> Column:
        """A whole number from 0 to ``bound`` - 1."""
        return F.floor(self.uniform(name) * bound).cast("bigint")

    def normal(self, name: str, mean: float, deviation: float) -> Column:
        # 1 - u is never 0, so the logarithm is finite.
        radius = F.sqrt(-2 * F.log(1 - self.uniform(f"{name}.radius")))
        angle = F.cos(2 * math.pi * self.uniform(f"{name}.angle"))
        return radius * angle * deviation + mean

    def lognormal(self, name: str, mean: float, deviation: float) -> Column:
        return F.exp(self.normal(name, mean, deviation))

    def one_of(self, name: str, values: Sequence[str]) -> Column:
        at = (self.below(name, len(values)) + 1).cast("int")
        return F.element_at(F.array(*map(F.lit, values)), at)

    def weighted(self, name: str, shares: Sequence[tuple[str, float]]) -> Column:
        u, bound, result = self.uniform(name), 0.0, None
        for value, share in shares[:-1]:
            bound += share
            result = (F if result is None else result).when(u < bound, F.lit(value))
        return result.otherwise(F.lit(shares[-1][0]))

    def letters(self, name: str, length: int, alphabet: str) -> Column:
        return F.concat(*[
            F.substring(F.lit(alphabet), (self.below(f"{name}.{i}", len(alphabet)) + 1)
                        .cast("int"), F.lit(1))
            for i in range(length)
        ])

    def day(self, name: str, first: str, days: int) -> Column:
        return F.date_add(F.lit(first).cast("date"), self.below(name, days).cast("int"))


def ids(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    return spark.range(0, n, 1, partitions)


def business_days(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    """Mondays to Fridays in the range, both ends included."""
    bounds = (F.lit(first).cast("date"), F.lit(last).cast("date"))
    days = spark.range(1).select(F.explode(F.sequence(*bounds)).alias("day"))
    return days.where(F.weekday("day") < 5)


def _business_days(first: str, last: str) -> Column:
    bounds = (F.lit(first).cast("date"), F.lit(last).cast("date"))
    return F.filter(F.sequence(*bounds), lambda d: F.weekday(d) < 5)


def securities(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """A security for every ``id``."""
    d = Draws("securities", seed)
    rows = rows.withColumns({
        "asset_class": d.one_of("asset_class", list(SUB_CLASSES)),
        "country": d.one_of("country", COUNTRIES),
    })
    kind = F.col("asset_class")
    sub = None
    for name, values in SUB_CLASSES.items():
        sub = (F if sub is None else sub).when(kind == name, d.one_of("sub_class", values))
    return rows.select(
        padded_id("SEC", F.col("id"), 8).alias("security_id"),
        d.letters("cusip", 9, LETTERS + DIGITS).alias("cusip"),
        F.concat("country", d.letters("isin", 10, DIGITS)).alias("isin"),
        d.letters("ticker", 4, LETTERS).alias("ticker"),
        F.concat(F.lit("Security "), F.col("id").cast("string"), F.lit(" Holdings"))
        .alias("security_name"),
        "asset_class",
        sub.alias("sub_asset_class"),
        d.one_of("currency", CURRENCIES).alias("currency"),
        "country",
        F.when(kind == "EQUITY", d.one_of("exchange", EXCHANGES)).alias("exchange"),
        d.day("issue", "2000-01-01", 9000).alias("issue_date"),
        F.when(kind == "FIXED_INCOME", d.day("maturity", "2030-01-01", 3650))
        .alias("maturity_date"),
        F.when(d.uniform("active") > 0.02, "True").otherwise("False").alias("is_active"),
    )


def accounts(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """An account for every ``id``; ten neighbours share a client."""
    d = Draws("accounts", seed)
    return rows.select(
        padded_id("ACCT", F.col("id"), 7).alias("account_id"),
        F.concat(F.lit("Client Account "), F.col("id").cast("string")).alias("account_name"),
        padded_id("CLT", F.floor(F.col("id") / 10), 6).alias("client_id"),
        d.one_of("type", ACCOUNT_TYPES).alias("account_type"),
        d.one_of("currency", BASE_CURRENCIES).alias("base_currency"),
        d.one_of("country", COUNTRIES).alias("domicile_country"),
        d.day("inception", "2010-01-01", 5000).alias("inception_date"),
        padded_id("PM", d.below("manager", 200) + 1, 4).alias("portfolio_manager"),
        F.when(d.uniform("discretionary") > 0.3, "True").otherwise("False")
        .alias("is_discretionary"),
        d.one_of("tier", AUM_TIERS).alias("aum_tier"),
    )


def positions(
    rows: DataFrame, n_securities: int, n_accounts: int, seed: int = SEED
) -> DataFrame:
    """A position for every ``id``, in the landing contract's columns and types."""
    d = Draws("positions", seed)
    days = _business_days(FIRST_DAY, LAST_DAY)
    cents = "decimal(20,2)"
    keyed = rows.select(
        F.element_at(days, (F.floor(d.uniform("day") * F.size(days)) + 1).cast("int"))
        .alias("as_of_date"),
        padded_id("ACCT", d.below("account", n_accounts), 7).alias("account_id"),
        padded_id("SEC", d.below("security", n_securities), 8).alias("security_id"),
        half_even(d.lognormal("quantity", 6, 1.5), 2).alias("quantity"),
        half_even(d.lognormal("cost", 4, 0.8), 4).alias("unit_cost"),
        d.normal("price", 1.05, 0.15).alias("drift"),
        d.uniform("accrued").alias("accrual"),
        (d.uniform("no_accrual") < 0.01).alias("no_accrual"),
        half_even(d.uniform("fx") * 0.7 + 0.8, 6).alias("fx_rate"),
        d.weighted("status", SETTLEMENT_SHARES).alias("settlement_status"),
        d.weighted("source", SOURCE_SHARES).alias("source_system"),
    )
    valued = keyed.withColumn(
        "unit_price",
        half_even(F.greatest(F.col("unit_cost") * F.col("drift"), F.lit(0.01)), 4),
    ).withColumns({
        "cost_basis": half_even(F.col("quantity") * F.col("unit_cost"), 2),
        "market_value": half_even(F.col("quantity") * F.col("unit_price"), 2),
    })
    return valued.select(
        F.concat_ws("|", F.col("as_of_date").cast("string"), "account_id", "security_id")
        .alias("position_hash"),
        "as_of_date", "account_id", "security_id",
        F.col("quantity").cast("decimal(18,4)").alias("quantity"),
        F.col("unit_cost").cast("decimal(18,6)").alias("unit_cost"),
        F.col("unit_price").cast("decimal(18,6)").alias("unit_price"),
        F.col("cost_basis").cast(cents).alias("cost_basis"),
        F.col("market_value").cast(cents).alias("market_value"),
        (F.col("market_value").cast(cents) - F.col("cost_basis").cast(cents)).cast(cents)
        .alias("unrealized_gl"),
        F.when(
            ~F.col("no_accrual"),
            half_even(F.col("market_value") * F.col("accrual") * 0.005, 2).cast(cents),
        ).alias("accrued_income"),
        F.col("fx_rate").cast("decimal(10,6)").alias("fx_rate"),
        "settlement_status", "source_system",
    )
