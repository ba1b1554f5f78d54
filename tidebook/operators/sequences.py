"""Row numbers and as-of lookups that do not gather a whole group in one task.

A plain window sorts a group in a single task, which fails for a group that holds a large
share of all rows. Both operators cut a group into chunks along its order, work inside the
chunks, and carry one summary row per chunk across. The chunk must be small enough for one
task in the largest group; summaries of one group meet in a task, so it should not be smaller
than needed.

Summaries have the same keys as the rows and may be nearly as many, so they are never
broadcast: the hint keeps the join on the partitioning the rows already have.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_within(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], chunk: Column, name: str
) -> DataFrame:
    """1-based position of each row in its group.

    ``chunk`` must not decrease along ``order_by``; it decides how far one group is spread.
    """
    chunked = df.withColumn("_chunk", chunk)
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order_by)
    numbered = chunked.withColumn("_local", F.row_number().over(inside))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        chunked.groupBy(*keys, "_chunk")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(*keys, "_chunk", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    )
    return (
        numbered.join(offsets.hint("merge"), [*keys, "_chunk"])
        .withColumn(name, F.col("_base") + F.col("_local"))
        .drop("_chunk", "_local", "_base")
    )


def latest_before(
    rows: DataFrame, keys: Sequence[str], order: str, value: str, chunk: Column,
    opening: str | None = None,
) -> DataFrame:
    """Rows without a ``value``, each with the latest value strictly before it in its group.

    Rows with a value only set it and are not returned; a row without an earlier value keeps
    NULL, and rows with a NULL key or chunk fall out. ``chunk`` is an expression over ``order``
    that does not decrease along it. ``opening`` names a column that is true in rows of the least
    chunk there can be: nothing comes before it, so its rows are done without a summary.
    """
    chunked = rows.withColumn("_chunk", chunk)
    # At one position the rows that set come last: strictly earlier values only.
    inside = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(order, F.col(value).isNotNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )

    def within(part: DataFrame) -> DataFrame:
        seen = F.last(value, ignorenulls=True).over(inside)
        return part.withColumn("_seen", seen).where(F.col(value).isNull())

    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    last = F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_last")
    carry = F.last("_last", ignorenulls=True).over(before).alias("_carried")

    def found(part: DataFrame, carried: DataFrame) -> DataFrame:
        return (
            within(part).join(carried.hint("merge"), [*keys, "_chunk"])
            .withColumn(value, F.coalesce("_seen", "_carried"))
            .select(*rows.columns)
        )

    if opening is None:
        summaries = chunked.groupBy(*keys, "_chunk").agg(last)
        return found(chunked, summaries.select(*keys, "_chunk", carry))
    later = ~F.col(opening)
    summaries = chunked.where(F.col(value).isNotNull() | later).groupBy(*keys, "_chunk").agg(
        last, F.max(opening).alias("_opening"))
    carried = summaries.select(*keys, "_chunk", "_opening", carry).where(~F.col("_opening"))
    opened = chunked.where(F.col(opening))
    for name in (*keys, "_chunk"):
        opened = opened.where(F.col(name).isNotNull())
    return found(chunked.where(later), carried.drop("_opening")).unionByName(
        within(opened).withColumn(value, F.col("_seen")).select(*rows.columns))
