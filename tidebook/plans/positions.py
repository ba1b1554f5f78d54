"""The medallion build: landing tables to bronze views, silver table and gold marts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import quality as q
from ..operators.enrichment import enrich_positions
from ..operators.marts import (
    exposure_by_asset_class,
    nav_by_account_daily,
    refreshed_exposure,
    refreshed_nav,
)
from ..operators.staging import (
    SMOKE_TEST_ROWS,
    stage_accounts,
    stage_positions,
    stage_securities,
)
from ..sinks.tables import (
    incremental_build,
    partition_days,
    partition_places,
    read_table,
    replace_partitions,
)
from ..sources.tables import bronze_views
from .run_recording import RunRecorder

SILVER_KEY = ["position_hash"]
#: Order inside a day: an account's pages are found by their bounds, a security's by Bloom filters.
SILVER_ORDER = ["account_id", "security_id"]
#: Under this name a mart's commit notes the silver partitions it was built from.
SOURCE = "positions_enriched"


@dataclass(frozen=True)
class Layout:
    """Where the layers live."""

    root: str

    @property
    def landing(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/positions_enriched"

    def gold(self, mart: str) -> str:
        return f"{self.root}/gold/{mart}"


def build(
    spark: SparkSession,
    layout: Layout,
    recorder: RunRecorder | None = None,
    smoke_rows: int | None = None,
    smoke: bool = False,
    check: bool = False,
    full_marts: bool = False,
) -> dict[str, int]:
    """Run every model once; returns the rows each wrote.

    The marts are built whole the first time, or with ``full_marts``. Later runs roll up only the
    days whose silver partitions changed since the marts were last built, and replace the days of
    the marts that depend on them.

    Bronze stays lazy, so column pruning and the look-back filter reach the landing scan. A smoke
    run takes ``smoke_rows`` positions, or the usual number. With ``check`` the declared checks
    run at the end, and a violation is an error.
    """
    if smoke and smoke_rows is None:
        smoke_rows = SMOKE_TEST_ROWS
    recorder = recorder or RunRecorder()
    bronze = bronze_views(spark, layout.landing, {
        "positions_raw": lambda raw: stage_positions(raw, smoke_rows),
        "securities": stage_securities,
        "accounts": stage_accounts,
    })

    def silver() -> int:
        return incremental_build(
            bronze["stg_positions"],
            lambda p: enrich_positions(p, bronze["stg_securities"], bronze["stg_accounts"]),
            layout.silver,
            SILVER_KEY,
            # Copies of one position: the one with the highest value is kept.
            [F.col("market_value").desc()],
            sort_by=SILVER_ORDER,
        )

    written = {"positions_enriched": recorder.run("positions_enriched", "incremental", silver)}
    enriched = read_table(spark, layout.silver)
    marts = {
        "nav_by_account_daily": (nav_by_account_daily, refreshed_nav),
        "exposure_by_asset_class": (exposure_by_asset_class, refreshed_exposure),
    }
    places = partition_places(spark, layout.silver)

    def mart(name: str) -> int:
        """Build or refresh one mart, which notes the silver partitions it was built from."""
        whole, refreshed = marts[name]
        stored = None if full_marts else read_table(spark, layout.gold(name))
        seen = None if stored is None else partition_places(spark, layout.gold(name), SOURCE)
        if not seen:
            gone = partition_days(spark, layout.gold(name))
            return replace_partitions(whole(enriched), layout.gold(name), emptied=gone,
                                      notes={SOURCE: places})
        days = [day for day, place in places.items() if seen.get(day) != place]
        if not days:
            return 0
        rows = refreshed(stored, enriched, [date.fromisoformat(d) for d in days])
        return replace_partitions(rows, layout.gold(name), emptied=days, notes={SOURCE: places})

    for name in marts:
        written[name] = recorder.run(name, "incremental", lambda name=name: mart(name))
    if check:
        failed = q.quality_report(declared_checks(spark, layout)).where("violations > 0")
        rows = [f"{r[0]}: {r[1]}" for r in failed.collect()]  # a row per declared check
        if rows:
            raise q.QualityError("; ".join(rows))
    return written


def declared_checks(spark: SparkSession, layout: Layout) -> dict:
    """Every data check declared on the layers, by name, as its violations."""
    raw = {
        name: spark.read.schema(schemas.landing_schema(name)).parquet(f"{layout.landing}/{name}")
        for name in schemas.LANDING_TABLES
    }
    positions, securities, accounts = (
        raw["positions_raw"], raw["securities"], raw["accounts"]
    )
    silver = read_table(spark, layout.silver)
    nav = read_table(spark, layout.gold("nav_by_account_daily"))
    exposure = read_table(spark, layout.gold("exposure_by_asset_class"))
    required = {
        "positions_raw": (positions, ["position_hash", "as_of_date", "account_id",
                                      "security_id", "market_value"]),
        "securities": (securities, ["security_id"]),
        "accounts": (accounts, ["account_id"]),
        "positions_enriched": (silver, ["position_hash", "market_value_base"]),
        "nav_by_account_daily": (nav, ["as_of_date", "account_id", "nav_base"]),
        "exposure_by_asset_class": (exposure, ["as_of_date", "asset_class",
                                               "total_exposure_base"]),
    }
    checks = {
        f"{table}.{c} not null": q.check_not_null(df, c)
        for table, (df, columns) in required.items() for c in columns
    }
    checks |= {
        "positions_raw.position_hash unique": q.check_unique(positions, "position_hash"),
        "securities.security_id unique": q.check_unique(securities, "security_id"),
        "accounts.account_id unique": q.check_unique(accounts, "account_id"),
        "positions_enriched.position_hash unique": q.check_unique(silver, "position_hash"),
        "positions_raw.settlement_status accepted": q.check_accepted(
            positions, "settlement_status", schemas.SETTLEMENT_STATUSES
        ),
        "securities.asset_class accepted": q.check_accepted(
            securities, "asset_class", schemas.ASSET_CLASSES
        ),
        "positions_enriched.asset_class accepted": q.check_accepted(
            silver, "asset_class", schemas.ASSET_CLASSES
        ),
        "positions_enriched.account_id known": q.check_relationship(
            silver, "account_id", stage_accounts(accounts), "account_id"
        ),
        "positions_enriched.security_id known": q.check_relationship(
            silver, "security_id", stage_securities(securities), "security_id"
        ),
        "nav_by_account_daily day and account unique": q.check_unique_combination(
            nav, ["as_of_date", "account_id"]
        ),
    }
    return checks
