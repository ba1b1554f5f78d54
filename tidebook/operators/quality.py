"""Data checks. Each returns its violations; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A check that gates a write found violations."""


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their number of rows."""
    return check_unique_combination(df.where(F.col(column).isNotNull()), [column])


def check_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where(F.col("n_rows") > 1)


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def check_accepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is not in the list; NULL passes."""
    return df.where(~F.col(column).isin(*values))


def check_relationship(
    child: DataFrame, column: str, parent: DataFrame, field: str
) -> DataFrame:
    """Non-NULL child values without a parent row, with their number of child rows.

    Child rows are counted per value before the join, so a value shared by a large part of
    the table enters the join once.
    """
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return values.join(parent.select(F.col(field).alias(column)), column, "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column from a single scan, one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_rows")


def quality_report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per named check with its number of violations."""
    rows = [
        violations.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("check_name"), "violations"
        )
        for name, violations in checks.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def require(name: str, violations: DataFrame) -> None:
    """Raise before a write when a check has any violation."""
    if not violations.isEmpty():
        raise QualityError(f"check failed: {name}")
