"""The workflow scheduler's metadata, from its database or from JSON dumps
``{"dag": [[…]], "dag_tag": [[…]], "task_instance": [[…]]}``."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import path_parts
from ..functions.values import blank_to_null, truthy
from .documents import read_files

#: Rows of the newest task instances when no limit is asked for.
DEFAULT_TASK_LIMIT = 500

Fetch = Callable[..., DataFrame]

# The relations and columns that are read.
COLUMNS = {
    "dag": ["dag_id", "is_paused", "owners"],
    "dag_tag": ["dag_id", "name"],
    "task_instance": ["dag_id", "task_id", "state", "start_date", "end_date"],
}


def dump_rejects(dumps: DataFrame) -> DataFrame:
    """Dumps that cannot be read; they add no rows to any relation."""
    return dumps.where(
        F.from_json("content", schemas.SCHEDULER_DOC).isNull()
    ).select("path")


def dump_rows(dumps: DataFrame, table: str) -> DataFrame:
    """Rows of one relation with their place in the dumps."""
    rows = F.from_json("content", schemas.SCHEDULER_DOC)[table]
    exploded = dumps.select("path", F.posexplode(rows).alias("position", "cells"))
    cells = [F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(COLUMNS[table])]
    return exploded.select("path", "position", *cells)


def newest_first(tasks: DataFrame, limit: int | None = None) -> DataFrame:
    """The newest task instances; equal start times keep their order in the dumps.

    Ordering and limit together keep only ``limit`` rows per task before they are merged.
    """
    return (
        tasks.orderBy(
            F.col("start_date").desc_nulls_last(), path_parts(F.col("path")), "position"
        )
        .limit(limit or DEFAULT_TASK_LIMIT)
    )


def task_instances(dumps: DataFrame) -> DataFrame:
    """Every task instance with parsed times; a time that cannot be read is NULL."""
    return dump_rows(dumps, "task_instance").withColumns({
        c: F.try_to_timestamp(blank_to_null(F.col(c))) for c in ("start_date", "end_date")
    })


def dump_relation(dumps: DataFrame, table: str, limit: int | None = None) -> DataFrame:
    """One of the three relations, typed."""
    if table == "task_instance":
        return newest_first(task_instances(dumps), limit).drop("path", "position")
    rows = dump_rows(dumps, table).drop("path", "position")
    return rows.withColumn("is_paused", truthy(F.col("is_paused"))) if table == "dag" else rows


def jdbc_options(dsn: str, table: str, limit: int | None = None) -> dict[str, str]:
    """Reader options that leave projection, order and limit to the database."""
    parts = urlsplit(dsn)
    select = f"SELECT {', '.join(COLUMNS[table])} FROM {table}"
    if table == "task_instance":
        select += f" ORDER BY start_date DESC NULLS LAST LIMIT {limit or DEFAULT_TASK_LIMIT}"
    host = parts.hostname or "localhost"
    options = {
        "url": f"jdbc:postgresql://{host}:{parts.port or 5432}{parts.path}",
        "driver": "org.postgresql.Driver",
        "query": select,
    }
    if parts.username:
        options["user"] = unquote(parts.username)
    if parts.password:
        options["password"] = unquote(parts.password)
    return options


def jdbc_predicates(parts: int) -> list[str]:
    """Conditions that deal the rows of a relation over ``parts`` connections by their DAG.

    Every row has a DAG, and the remainder keeps the sign of the hash: a row fulfils exactly one.
    """
    return [f"abs(hashtext(dag_id) % {parts}) = {i}" for i in range(parts)]


def open_source(spark: SparkSession, dsn: str, parts: int = 1) -> Fetch:
    """``fetch(table, limit=None)`` over whatever the address names.

    ``postgres(ql)://`` reads the live database; ``file://`` or a bare path reads dump files. With
    ``parts``, a relation that is read whole comes over as many connections, each with its own
    condition and the needed columns; the newest tasks are picked by the database in one.
    """
    if dsn.startswith(("postgresql://", "postgres://")):
        def fetch_jdbc(table: str, limit: int | None = None) -> DataFrame:
            options = jdbc_options(dsn, table, limit)
            if parts > 1 and table != "task_instance":
                rest = {k: v for k, v in options.items() if k not in ("url", "query")}
                return spark.read.jdbc(
                    options["url"], table, predicates=jdbc_predicates(parts), properties=rest
                ).select(*COLUMNS[table])
            return spark.read.format("jdbc").options(**options).load()

        return fetch_jdbc

    dumps = read_files(spark, dsn.removeprefix("file://"))

    def fetch_dump(table: str, limit: int | None = None) -> DataFrame:
        return dump_relation(dumps, table, limit)

    return fetch_dump
