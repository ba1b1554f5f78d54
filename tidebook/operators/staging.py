"""Bronze: typed views over the landing tables. Nothing here is materialised."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.values import typed

#: Row cap of a smoke run.
SMOKE_TEST_ROWS = 200_000


def stage(raw: DataFrame, contract: dict[str, str], kept: Sequence[str] = ()) -> DataFrame:
    """Cast every contracted column; columns outside the contract, but those kept, are dropped."""
    cast = [typed(F.col(name), kind).alias(name) for name, kind in contract.items()]
    return raw.select(*cast, *kept)


def stage_positions(
    raw: DataFrame, limit: int | None = None, kept: Sequence[str] = ()
) -> DataFrame:
    """Typed positions with their load time; ``limit`` caps the rows of a smoke run."""
    if limit is not None:
        raw = raw.limit(limit)
    staged = stage(raw, schemas.POSITIONS, kept)
    return staged.withColumn("dbt_loaded_at", F.current_timestamp())


def stage_securities(raw: DataFrame) -> DataFrame:
    return stage(raw, schemas.SECURITIES)


def stage_accounts(raw: DataFrame) -> DataFrame:
    return stage(raw, schemas.ACCOUNTS)
