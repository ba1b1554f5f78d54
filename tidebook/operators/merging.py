"""Keyed upserts as DataFrames, the look-back filter and duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Start of time for a target without rows.
EPOCH_DAY = date(1900, 1, 1)
LOOKBACK_DAYS = 3


def lookback_filter(
    source: DataFrame, target: DataFrame, column: str, days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Source rows not older than the target's latest day minus ``days``.

    The latest day is a scalar subquery: it runs once, before the source scan, and prunes the
    source's partitions when ``column`` is its partition column.
    """
    latest = target.agg(F.coalesce(F.max(column), F.lit(EPOCH_DAY)).alias("latest"))
    return source.where(F.col(column) >= F.date_sub(latest.scalar(), days))


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key: the first under ``order_by``, ties broken by the other columns.

    The ``= 1`` filter lets every map task keep a single row per key before the shuffle, so a
    key with very many copies never meets in one task.
    """
    ties = [
        F.col(f.name) for f in df.schema.fields if f.name not in keys and _orderable(f.dataType)
    ]
    window = Window.partitionBy(*keys).orderBy(*order_by, *ties)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    protect: Sequence[str] = (),
    append_new_columns: bool = True,
) -> DataFrame:
    """The target after upserting ``source``, which holds one row per key.

    New keys are inserted with all their columns. For known keys every non-key source column
    overwrites the stored value, also with NULL, except the protected ones; columns only the
    target has stay as they are. Columns only the source has are appended, or ignored when
    ``append_new_columns`` is false.
    """
    if not append_new_columns:
        source = source.select([c for c in source.columns if c in target.columns])
    shared_protected = [c for c in protect if c in source.columns and c in target.columns]
    kept_aside = [c for c in target.columns if c not in source.columns]

    if not shared_protected and not kept_aside:
        # Whole rows are replaced: only the source's keys have to meet the target.
        untouched = target.join(source.select(*keys), list(keys), "left_anti")
        return untouched.unionByName(source, allowMissingColumns=True)

    old, new = target.alias("old"), source.withColumn("_new", F.lit(True)).alias("new")
    on = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    joined = old.withColumn("_old", F.lit(True)).alias("old").join(new, on, "full")
    is_new, is_old = F.col("_new").isNotNull(), F.col("_old").isNotNull()

    def merged(name: str) -> Column:
        if name in keys:
            return F.coalesce(f"new.{name}", f"old.{name}")
        if name not in source.columns:
            return F.col(f"old.{name}")
        if name not in target.columns:
            return F.col(f"new.{name}")
        overwrite = is_new & ~is_old if name in shared_protected else is_new
        return F.when(overwrite, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))

    columns = target.columns + [c for c in source.columns if c not in target.columns]
    return joined.select([merged(c).alias(c) for c in columns])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    protect: Sequence[str] = (),
    append_new_columns: bool = True,
) -> DataFrame:
    """``merge_rows`` after keeping the first source row per key under ``order_by``."""
    latest = dedupe_latest(source, keys, order_by)
    return merge_rows(target, latest, keys, protect, append_new_columns)
