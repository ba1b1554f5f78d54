"""Session defaults. Every operator also runs on a session it did not build."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

#: Bytes one shuffle partition should hold; AQE merges smaller ones.
SHUFFLE_TARGET_BYTES = 256 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, cores: int, expansion: float = 2.0) -> int:
    """Initial shuffle partitions for a job that reads ``input_bytes`` of Parquet.

    Compressed columns grow when they become rows, hence ``expansion``. The number is an upper
    start value: adaptive execution merges partitions that turn out small, but cannot split an
    aggregation's partition that turns out too big.
    """
    return max(cores, int(input_bytes * expansion / SHUFFLE_TARGET_BYTES) + 1)


def build_session(
    app_name: str = "tidebook",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    input_bytes: int | None = None,
    cores: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings the sinks and plans are written for.

    ``input_bytes`` and ``cores`` set the shuffle partitions where their number is not given.
    """
    if shuffle_partitions is None and input_bytes is not None:
        shuffle_partitions = shuffle_partitions_for(input_bytes, cores or 1)
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Temporary folders of local sessions that name no shared one, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one in a local session without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="tidebook-")
    return _LOCAL_FOLDERS[application]


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows written once to the shared folder (see ``shared_folder``).

    Used where several relations come from one expensive parse. They are a Parquet table there:
    one pass writes it, readers take only the columns they need, and a lost executor costs a
    re-read.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
