"""One statistics row per model run."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, field
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators.runstats import session_counters
from ..sinks.tables import append_rows, ensure_table


@contextmanager
def job_group(spark: SparkSession, description: str) -> Iterator[str]:
    """Jobs started inside belong to a new group, whose name is given; the old one is put back."""
    context, group = spark.sparkContext, f"model-{uuid.uuid4()}"
    before = {key: context.getLocalProperty(key)
              for key in ("spark.jobGroup.id", "spark.job.description")}
    context.setJobGroup(group, description)
    try:
        yield group
    finally:
        for key, value in before.items():
            context.setLocalProperty(key, value)


def stage_counters(spark: SparkSession, group: str) -> dict:
    """What Spark measured in the stages of a job group, under the names of the statistics.

    CPU time, bytes and rows read and bytes written are sums over all stages, memory is the largest
    peak of one. Reused stages count once. CPU is that of the executors' JVMs; Python workers are
    not in it.
    """
    context = spark.sparkContext
    scala_context = context._jsc.sc()
    scala_context.listenerBus().waitUntilEmpty()  # the last tasks' figures arrive a little late
    tracker, store = context.statusTracker(), scala_context.statusStore()
    jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(group)]
    stages = sorted({stage for job in jobs if job for stage in job.stageIds})
    ran = [store.lastStageAttempt(stage) for stage in stages if tracker.getStageInfo(stage)]
    ran = [stage for stage in ran if stage.numCompleteTasks()]
    if not ran:
        return {}
    return {
        "cpu_seconds": Decimal(sum(s.executorCpuTime() for s in ran)).scaleb(-9).quantize(
            Decimal("0.001")),
        "pga_peak_bytes": max(s.peakExecutionMemory() for s in ran),
        "physical_reads_bytes": sum(s.inputBytes() for s in ran),
        "logical_reads": sum(s.inputRecords() + s.shuffleReadRecords() for s in ran),
        "redo_size_bytes": sum(s.outputBytes() + s.shuffleWriteBytes() for s in ran),
    }


@dataclass
class RunRecorder:
    """Times model runs and appends a row for each; without a target it only runs them.

    The target is a folder, or a catalog table, which is created when it is missing.

    Counters are those of Spark's stages (see ``stage_counters``); ``counters`` gives long counter
    rows and counter names instead, when the platform collects them.
    """

    spark: SparkSession | None = None
    path: str | None = None
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    threads: int | None = None
    counters: Callable[[], tuple[DataFrame, DataFrame]] | None = None
    table: str | None = None

    def run(self, model: str, materialization: str, write: Callable[[], int]) -> int:
        """Run ``write``, which returns its number of rows, and record it, failed or not."""
        started, clock = datetime.now(timezone.utc), time.monotonic()
        rows, status = None, "ERROR"
        recorded = self.path is not None or self.table is not None
        with job_group(self.spark, model) if recorded else nullcontext() as group:
            try:
                rows = write()
                status = "SUCCESS"
            finally:
                self._append(model, materialization, started, time.monotonic() - clock, rows,
                             status, group)
        return rows

    def _append(self, model, materialization, started, elapsed, rows, status, group) -> None:
        if self.path is None and self.table is None:
            return
        spark = self.spark
        row = {
            "run_id": self.run_id,
            "run_started_at": started,
            "model_name": model,
            "materialization": materialization,
            "dbt_threads": self.threads or spark.sparkContext.defaultParallelism,
            "parallel_degree": int(spark.conf.get("spark.sql.shuffle.partitions")),
            "elapsed_seconds": Decimal(str(round(elapsed, 3))),
            "rows_processed": rows,
            "status": status,
        }
        measured = self._measured(group)
        values = tuple(row.get(c, measured.get(c)) for c in schemas.RUN_STATS.names)
        row = spark.createDataFrame([values], schemas.RUN_STATS)
        if self.path is not None:
            append_rows(row, self.path)
        if self.table is not None:
            ensure_table(spark, self.table, schemas.RUN_STATS)
            row.write.insertInto(self.table)

    def _measured(self, group: str) -> dict:
        """The session's counters: one row after the pivot."""
        if self.counters is None:
            return stage_counters(self.spark, group)
        long_rows, names = self.counters()
        first = session_counters(long_rows, names).first()
        return first.asDict() if first else {}
