"""Landing folders as streams.

The pipelines are batch jobs; this runs the same upsert per micro-batch, for feeds that arrive
as files during the day.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..sinks.tables import upsert_partitions


def stream_landing(
    spark: SparkSession, path: str, table: str, files_per_batch: int | None = None
) -> DataFrame:
    """New Parquet files of a landing table as a stream."""
    reader = spark.readStream.schema(schemas.landing_schema(table))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def upsert_stream(
    stream: DataFrame,
    model: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order_by: Sequence[Column],
) -> StreamingQuery:
    """Upsert ``model`` of every micro-batch; stops when the files at hand are done.

    A batch that is repeated after a failure gives the same table, since the upsert is keyed.
    """
    def upsert_batch(batch: DataFrame, _: int) -> None:
        upsert_partitions(model(batch), path, keys, order_by)

    return (
        stream.writeStream.foreachBatch(upsert_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
