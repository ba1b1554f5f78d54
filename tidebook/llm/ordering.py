"""Positions in ordered groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm.stages import Stages

#: Bits of a generated id that count rows of one partition.
_ROW_BITS = 33


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], stages: Stages, name: str
) -> DataFrame:
    """``df`` with ``position`` (from 0) and ``size`` of each row's group; null keys are a group.

    Rows are sorted over range partitions, so a group may span many of them; one row per group and
    partition carries the counts across. Rows equal in ``keys`` and ``order`` get any order among
    themselves, but a fixed one, for the sorted rows are written.
    """
    sort = [*keys, *order]
    placed = df.withColumn("_tie", F.monotonically_increasing_id())
    rows = stages.write(
        placed.repartitionByRange(*sort, "_tie").sortWithinPartitions(*sort, "_tie").drop("_tie")
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", _ROW_BITS)), name)
    within = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    chunks = rows.groupBy(*keys, "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = within.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_part").alias("_chunk"), "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(within).alias("size"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys],
                  F.col("_part") == F.col("_chunk"))
    return rows.join(chunks, same).select(
        *df.columns, (F.col("_before") + F.col("_id") - F.col("_first")).alias("position"), "size")
