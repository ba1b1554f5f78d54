"""Silver: positions with their security and account, base-currency amounts and flags."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import flag, matures_within, to_base_currency

MATURITY_WINDOW_DAYS = 90

# Output columns of the silver table in order, without the update time.
ENRICHED_COLUMNS = [
    "position_hash", "as_of_date", "account_id", "account_name", "account_type",
    "account_base_ccy", "portfolio_manager", "aum_tier", "security_id", "cusip", "isin",
    "ticker", "security_name", "asset_class", "sub_asset_class", "security_ccy",
    "security_country", "quantity", "unit_cost", "unit_price", "cost_basis", "market_value",
    "unrealized_gl", "accrued_income", "fx_rate", "market_value_base", "cost_basis_base",
    "unrealized_gl_base", "settlement_status", "source_system", "is_cash", "is_failed",
    "matures_within_90d",
]


@dataclass(frozen=True)
class PositionParts:
    """Positions as they arrive: lines that share a header with the account and the day.

    ``headers`` and ``lines`` have the columns ``on``; headers also a staged ``account_id``, lines
    a staged ``security_id``. ``typed`` makes the staged positions out of a line with its header,
    and keeps the columns named to it.
    """

    headers: DataFrame
    lines: DataFrame
    on: tuple[str, ...]
    typed: Callable[[DataFrame, list[str]], DataFrame]

    def joined(self, security: DataFrame, account: DataFrame) -> DataFrame:
        """Staged positions with the columns of both reference tables.

        Accounts are joined to headers, which are fewer than lines. Lines travel as they are;
        what follows from them is worked out behind the last shuffle. Headers grow as the lines
        do, so that join is always a shuffle join.
        """
        headers = self.headers.join(account, "account_id").hint("merge")
        whole = self.lines.join(headers, [*self.on]).join(security, "security_id")
        kept = [c for c in [*account.columns, *security.columns]
                if c not in ("account_id", "security_id")]
        return self.typed(whole, kept)


def enrich_positions(
    positions: DataFrame | PositionParts, securities: DataFrame, accounts: DataFrame
) -> DataFrame:
    """Star join on the two reference tables; positions missing either one fall out.

    No join hint: the reference tables grow with the business, so whether a side is broadcast
    is left to the optimizer's size check, and adaptive execution splits the partition of a
    security or account that holds a large share of the positions. Both reference tables hold
    one row per key, so splitting the position side is always enough.
    """
    security = securities.select(
        "security_id", "cusip", "isin", "ticker", "security_name", "asset_class",
        "sub_asset_class", "maturity_date",
        F.col("currency").alias("security_ccy"),
        F.col("country").alias("security_country"),
    )
    account = accounts.select(
        "account_id", "account_name", "account_type", "portfolio_manager", "aum_tier",
        F.col("base_currency").alias("account_base_ccy"),
    )
    if isinstance(positions, PositionParts):
        joined = positions.joined(security, account)
    else:
        joined = positions.join(security, "security_id").join(account, "account_id")
    derived = {
        "accrued_income": F.coalesce("accrued_income", F.lit(0).cast("decimal(20,2)")),
        "is_cash": flag(F.col("asset_class") == "CASH"),
        "is_failed": flag(F.col("settlement_status") == "FAILED"),
        "matures_within_90d": matures_within(
            F.col("maturity_date"), F.col("as_of_date"), MATURITY_WINDOW_DAYS
        ),
    }
    for amount in ("market_value", "cost_basis", "unrealized_gl"):
        derived[f"{amount}_base"] = to_base_currency(F.col(amount), F.col("fx_rate"))
    return joined.withColumns(derived).select(
        *ENRICHED_COLUMNS, F.current_timestamp().alias("dbt_updated_at")
    )
