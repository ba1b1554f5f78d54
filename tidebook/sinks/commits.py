"""Commit records: one row per version says where each part of a table is.

New parts are written to folders of their version first and become visible with the row, which is
one small file that Spark's committer moves into place. Readers take the newest row, so a job that
dies half way leaves nothing they can see, and its leftovers are overwritten by the next one. One
writer at a time.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "_commits"
_RECORD = ("version long, locations map<string, string>, columns string,"
           " notes map<string, map<string, string>>")


class Commit(NamedTuple):
    """A version (0 before the first), the folder of each part, the table's columns as JSON, and
    what else the writer noted, such as the state of a source."""

    version: int
    locations: dict[str, str]
    columns: str | None = None
    notes: dict[str, dict[str, str]] = {}


def _log(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"{_RECORD}, committed_at timestamp").parquet(f"{root}/{_LOG}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def newest(spark: SparkSession, root: str) -> Commit:
    log = _log(spark, root)
    row = None if log is None else log.orderBy(F.desc("version")).first()
    return Commit(0, {}) if row is None else Commit(
        row.version, dict(row.locations), row.columns, dict(row.notes or {}))


def record(spark: SparkSession, root: str, version: int, locations: Mapping[str, str],
           columns: str | None = None, notes: Mapping[str, Mapping[str, str]] | None = None
           ) -> None:
    """Make a version visible."""
    row = spark.createDataFrame(
        [(version, dict(locations), columns, dict(notes or {}))], _RECORD)
    row.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode(
        "append").parquet(f"{root}/{_LOG}")


def version_folder(version: int) -> str:
    return f"version={version:08d}"


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(folder))


def remove_old(spark: SparkSession, root: str, keep: int, below: str = "") -> list[str]:
    """Delete parts in version folders of ``below`` that no one of the newest ``keep`` commits
    points to, and return their folders."""
    log = _log(spark, root)
    if log is None:
        return []
    recent = log.orderBy(F.desc("version")).limit(keep).collect()
    wanted = {place for row in recent for place in row.locations.values()}
    removed = []
    for version in listed(spark, f"{root}/{below}"):
        if not version.startswith("version="):
            continue
        for part in listed(spark, f"{root}/{below}{version}"):
            place = f"{below}{version}/{part}"
            if "=" not in part or place in wanted:  # marker files
                continue
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{place}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
            removed.append(place)
    return sorted(removed)
