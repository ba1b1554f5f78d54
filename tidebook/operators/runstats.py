"""Counters, run statistics and the configuration report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.values import mebibytes, yes_no

CONFIG_KEYS = ["pod_size", "dbt_threads", "parallel_degree"]

# Default targets of the report.
TARGET_ROWS_PER_SECOND = 60_000
TARGET_ELAPSED_SECONDS = 120


def pivot_counters(
    counters: DataFrame, by: Sequence[str], names: Mapping[str, str] = schemas.COUNTER_COLUMNS
) -> DataFrame:
    """Long ``(…, name, value)`` rows to one row per ``by`` with the largest value per name.

    The names are given, so no extra job looks for them, and other counters never reach the
    shuffle.
    """
    wide = (
        counters.where(F.col("name").isin(*names))
        .groupBy(*by)
        .pivot("name", list(names))
        .agg(F.max("value"))
    )
    return wide.withColumnsRenamed(dict(names))


def session_counters(
    counters: DataFrame, counter_names: DataFrame, by: Sequence[str] = ("sid",)
) -> DataFrame:
    """Counters joined to their names and pivoted; CPU comes in hundredths of a second.

    There are few counter ids, each with a large share of the rows: they are combined per
    session before the join.
    """
    largest = counters.groupBy(*by, "statistic_id").agg(F.max("value").alias("value"))
    named = largest.join(counter_names, "statistic_id")
    return pivot_counters(named, by).withColumn(
        "cpu_seconds", (F.col("cpu_seconds") / 100).cast("decimal(18,3)")
    )


def attach_pod_metrics(stats: DataFrame, pods: DataFrame) -> DataFrame:
    """Peaks of each model's pod; models without a measurement keep NULLs."""
    peaks = pods.select(
        "model_name",
        F.col("peak_cpu_cores").alias("pod_peak_cpu_cores"),
        F.col("peak_mem_mib").alias("pod_peak_mem_mib"),
    )
    return stats.join(peaks, "model_name", "left")


def union_runs(runs: Sequence[DataFrame]) -> DataFrame:
    """Runs stacked by column name; a column a run lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), runs)


def sizing_matrix(stats: DataFrame) -> DataFrame:
    """One row per configuration. Rows without a full configuration are left out, and a sum
    over nothing but NULLs is 0."""

    def total(column: str):
        return F.coalesce(F.sum(F.col(column).cast("double")), F.lit(0.0))

    matrix = (
        stats.na.drop(subset=CONFIG_KEYS)
        .groupBy(*CONFIG_KEYS)
        .agg(
            total("elapsed_seconds").alias("total_elapsed_s"),
            total("cpu_seconds").alias("total_cpu_s"),
            mebibytes(F.max("pga_peak_bytes")).alias("peak_pga_mb"),
            F.coalesce(F.sum("rows_processed"), F.lit(0)).alias("total_rows"),
            F.count_distinct("model_name").alias("models_run"),
        )
    )
    return matrix.withColumns({
        "throughput_rows_s": F.try_divide(
            F.col("total_rows").cast("double"), F.col("total_elapsed_s")
        ),
        "cpu_efficiency": F.try_divide(F.col("total_cpu_s"), F.col("total_elapsed_s")),
    })


def with_sla(
    matrix: DataFrame,
    min_rate: float = TARGET_ROWS_PER_SECOND,
    max_elapsed: float = TARGET_ELAPSED_SECONDS,
) -> DataFrame:
    meets = (F.col("throughput_rows_s") >= min_rate) & (F.col("total_elapsed_s") <= max_elapsed)
    return matrix.withColumn("meets_sla", yes_no(meets, "YES", "NO"))


def recommend(matrix: DataFrame) -> DataFrame:
    """The first configuration, in key order, that meets the targets; none gives no row."""
    return matrix.where(F.col("meets_sla") == "YES").orderBy(*CONFIG_KEYS).limit(1)


def by_model(stats: DataFrame) -> DataFrame:
    """Per-model view with byte counts in mebibytes and missing measures as 0."""
    def measure(column):
        return F.coalesce(column, F.lit(0.0))

    view = stats.select(
        *CONFIG_KEYS, "model_name", "materialization",
        measure(F.col("elapsed_seconds").cast("double")).alias("elapsed_s"),
        measure(F.col("cpu_seconds").cast("double")).alias("cpu_s"),
        measure(mebibytes(F.col("pga_peak_bytes"))).alias("peak_pga_mb"),
        F.coalesce("logical_reads", F.lit(0)).alias("logical_reads"),
        measure(mebibytes(F.col("physical_reads_bytes"))).alias("phys_mb"),
    )
    return view.orderBy(*CONFIG_KEYS, "model_name")


def run_summary(stats: DataFrame) -> DataFrame:
    """How many rows and runs were loaded."""
    return stats.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct("run_id").alias("run_count")
    )
