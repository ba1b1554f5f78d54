"""Tables on Parquet: full rebuilds, partitioned upserts, appends and exports."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Mapping, Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.merging import LOOKBACK_DAYS, dedupe_latest, merge_rows
from ..operators.quality import check_not_null, check_unique, require
from . import commits

log = logging.getLogger(__name__)

PARTITION_COLUMN = "as_of_date"
SAMPLE_ROWS = 1000


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, counted while an action reads them."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def read_if_present(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The table at ``path``, or None when nothing has been written there."""
    reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _parts(spark: SparkSession, path: str, column: str | None = None) -> commits.Commit:
    """The newest commit of a partitioned table.

    A table written by other means, or before commits were kept, has none: its partitions are the
    folders found, as version 0.
    """
    commit = commits.newest(spark, path)
    if commit.version:
        return commit
    found = [n for n in commits.listed(spark, path)
             if "=" in n and (column is None or n.startswith(f"{column}="))]
    return commits.Commit(0, {name: name for name in found})


def partition_days(spark: SparkSession, path: str, column: str = PARTITION_COLUMN) -> list[str]:
    """Values of the partition column: no data file is opened."""
    return sorted(name.split("=", 1)[1] for name in _parts(spark, path, column).locations
                  if name.startswith(f"{column}="))


def partition_places(
    spark: SparkSession, path: str, note: str | None = None, column: str = PARTITION_COLUMN
) -> dict[str, str]:
    """Folder of each partition value, which changes when the partition is replaced.

    With ``note`` those of a source instead, as the table's newest commit noted them.
    """
    commit = _parts(spark, path, column)
    if note is not None:
        return commit.notes.get(note, {})
    return {name.split("=", 1)[1]: place for name, place in commit.locations.items()}


#: Partitions of committed versions lie below this folder, so nobody reads them by accident.
_DATA = "_data"


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A partitioned table with every column it ever got, or None before the first write.

    Partitions are taken from the folders the newest commit names. The columns are kept with the
    commit, so no footer has to be opened to merge schemas.
    """
    commit = _parts(spark, path)
    if not commit.locations:
        return None
    if not commit.version:  # written by other means: all footers have to tell
        return read_if_present(spark, path)
    schema = T.StructType.fromJson(json.loads(commit.columns))
    read = None
    for base in (f"{path}/{_DATA}", path):
        places = [p for p in commit.locations.values()
                  if p.startswith(f"{_DATA}/") == base.endswith(f"/{_DATA}")]
        if not places:
            continue
        part = spark.read.schema(schema).option("basePath", base).parquet(
            *[f"{path}/{place}" for place in places]).select(*schema.names)
        read = part if read is None else read.unionByName(part)
    return read


def replace_partitions(
    rows: DataFrame, path: str, partition: str = PARTITION_COLUMN, columns: T.StructType | None = None,
    emptied: Sequence[str] = (), notes: Mapping[str, Mapping[str, str]] | None = None,
    sort_by: Sequence[str] = (),
) -> int:
    """Replace the partitions that ``rows`` has values of, all at once, and return its rows.

    New files go to a folder of their own; one commit record then points to them instead of the old
    ones. A run that dies before its record leaves the table as it was, and can be repeated.
    ``columns`` are those of the whole table where they are more; ``emptied`` are values whose
    partitions go unless ``rows`` has them; ``notes`` are kept with the commit. Files are sorted by
    ``sort_by``; columns after the first, whose values lie everywhere, get Bloom filters.
    """
    spark = rows.sparkSession
    before = _parts(spark, path, partition)
    folder = f"{_DATA}/{commits.version_folder(before.version + 1)}"
    written, seen = counted(by_partition(rows, partition, sort_by))
    (
        written.write.mode("overwrite")
        .options(**_bloom_options(sort_by[1:]))
        .option("partitionOverwriteMode", "static")  # leftovers of a run without a record go
        .partitionBy(partition)
        .parquet(f"{path}/{folder}")
    )
    new = {name: f"{folder}/{name}" for name in commits.listed(spark, f"{path}/{folder}")
           if name.startswith(f"{partition}=")}
    kept = {name: place for name, place in before.locations.items()
            if name not in {f"{partition}={value}" for value in emptied}}
    schema = rows.schema if columns is None else columns
    commits.record(spark, path, before.version + 1, kept | new, json.dumps(schema.jsonValue()),
                   notes)
    return seen.get["rows"]


def remove_old_partitions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete files of partitions that none of the newest ``keep`` commits points to.

    Readers that began before the commits that are kept lose their files.
    """
    return commits.remove_old(spark, path, keep, f"{_DATA}/")


def rebuild(df: DataFrame, path: str) -> int:
    """Replace a whole table and return its number of rows.

    ``df`` must not read ``path``: an overwrite deletes the old files first.
    """
    rows, seen = counted(df)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return seen.get["rows"]


def by_partition(
    df: DataFrame, column: str = PARTITION_COLUMN, sort_by: Sequence[str] = ()
) -> DataFrame:
    """Rows gathered by partition value before a partitioned write.

    Few files per partition, and adaptive execution splits the tasks of a value that holds
    much more than the others. With ``sort_by``, files are sorted by these columns, so that the
    pages of a file hold narrow ranges of the first.
    """
    gathered = df.hint("rebalance", F.col(column))
    return gathered.sortWithinPartitions(column, *sort_by) if sort_by else gathered


#: Distinct values of a column that a row group's Bloom filter is sized for.
BLOOM_VALUES = 100_000


def _bloom_options(columns: Sequence[str]) -> dict[str, str]:
    """Filters that tell which row groups may hold a value of an unsorted column."""
    return {
        f"parquet.bloom.filter.{key}#{column}": value for column in columns
        for key, value in (("enabled", "true"), ("expected.ndv", str(BLOOM_VALUES)))}


def reload_landing(df: DataFrame, path: str, table: str, catalog_name: str | None = None) -> int:
    """Truncate and reload a landing table; keys of the reference tables are enforced first.

    With a catalog name the table is published under it and its statistics are taken.
    """
    loaded = _reload(df, path, table)
    if catalog_name:
        publish(df.sparkSession, catalog_name, path)
    return loaded


def _reload(df: DataFrame, path: str, table: str) -> int:
    typed = df.select(*schemas.LANDING_TABLES[table])
    key = {"securities": "security_id", "accounts": "account_id"}.get(table)
    if key:
        require(f"{table}.{key} is unique", check_unique(typed, key))
        require(f"{table}.{key} is present", check_not_null(typed, key))
        return rebuild(typed, path)
    rows, seen = counted(by_partition(typed))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(PARTITION_COLUMN)
        .parquet(path)
    )
    return seen.get["rows"]


def upsert_partitions(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[Column] | None,
    partition: str = PARTITION_COLUMN,
    protect: Sequence[str] = (),
    touched: DataFrame | None = None,
    sort_by: Sequence[str] = (),
) -> int:
    """Upsert into a partitioned table, rewriting only the partitions the source touches.

    Of several source rows with one key the first under ``order_by`` is taken; None says that
    the source has one row per key already.

    The key must fix the partition, as a key that contains the date does. The first run writes
    everything. Columns new in the source are appended; in partitions that are not touched
    they read as NULL. Running it again with the same source changes nothing. All partitions change
    at once, with a commit record after the files (see ``replace_partitions``).
    ``touched`` may name a cheaper DataFrame that has at least the source's partition values.
    """
    target = read_table(source.sparkSession, path)
    rows = source if order_by is None else dedupe_latest(source, keys, order_by)
    if target is not None:
        if not partition_days(source.sparkSession, path, partition):
            raise ValueError(f"{path} is not partitioned by {partition}")
        # The values of the partition column are few (days) and become a literal filter, so
        # files of other partitions are not scanned.
        found = (source if touched is None else touched).select(partition).distinct()
        days = [row[0] for row in found.collect()]
        current = target.where(F.col(partition).isin(days))
        on = [partition, *[k for k in keys if k != partition]]
        rows = merge_rows(current, rows, on, protect)
    return replace_partitions(rows, path, partition, sort_by=sort_by)


def incremental_build(
    positions: DataFrame,
    model: Callable[[DataFrame], DataFrame],
    path: str,
    keys: Sequence[str],
    order_by: Sequence[Column],
    partition: str = PARTITION_COLUMN,
    sort_by: Sequence[str] = (),
) -> int:
    """Build ``model`` over the positions the target has not settled yet, then upsert it.

    The first run takes everything; later runs only days within the look-back, counted from the
    newest partition. The model adds columns to positions and must not multiply them: copies of
    a position are removed before it, while the rows are narrow, and their number is logged.
    """
    days = partition_days(positions.sparkSession, path, partition)
    fresh = positions
    if days:
        first = date.fromisoformat(days[-1]) - timedelta(days=LOOKBACK_DAYS)
        fresh = positions.where(F.col(partition) >= F.lit(first))
    nothing = fresh.isEmpty()
    if nothing and days:
        return 0
    read, arrived = counted(fresh)
    unique, kept = counted(dedupe_latest(read, keys, order_by))
    written = upsert_partitions(
        model(unique), path, keys, None, partition, touched=fresh.select(partition),
        sort_by=sort_by)
    # A plan without rows is cut short, and counts nothing.
    copies = 0 if nothing else arrived.get["rows"] - kept.get["rows"]
    if copies:
        log.warning("%s: %d copies of positions left out", path, copies)
    return written


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Create an empty catalog table unless it exists."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def publish(spark: SparkSession, name: str, path: str) -> None:
    """A catalog table over the files at ``path``, with fresh statistics."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    if spark.catalog.listColumns(name) and any(
            c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)
    analyze(spark, name)


def analyze(spark: SparkSession, name: str) -> None:
    """Statistics of a catalog table for the cost-based optimizer."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def export(df: DataFrame, path: str, fmt: str = "parquet", files: int | None = None) -> int:
    """A data set as snappy Parquet or gzipped CSV; returns its number of rows."""
    rows, seen = counted(df.repartition(files) if files else df)
    if fmt == "parquet":
        rows.write.mode("overwrite").parquet(path, compression="snappy")
    elif fmt == "csv.gz":
        rows.write.mode("overwrite").csv(path, header=True, compression="gzip")
    else:
        raise ValueError(f"unknown format {fmt}")
    return seen.get["rows"]


def export_sample(df: DataFrame, path: str, order_by: Sequence[str]) -> None:
    """The first rows under an explicit order, as one CSV for a quick look."""
    df.orderBy(*order_by).limit(SAMPLE_ROWS).write.mode("overwrite").csv(path, header=True)


def write_run_file(stats: DataFrame, pods: DataFrame, pod_size: str, path: str) -> int:
    """One run's statistics with its pods' peaks; an empty run writes only a header."""
    from ..operators.runstats import attach_pod_metrics

    rows = attach_pod_metrics(stats, pods).withColumn("pod_size", F.lit(pod_size))
    ordered = rows.select(*schemas.RUN_FILE.names).orderBy("run_started_at")
    written, seen = counted(ordered.coalesce(1))
    written.write.mode("overwrite").csv(path, header=True)
    if not seen.get["rows"]:
        log.warning("%s: no statistics matched the run", path)
    return seen.get["rows"]
