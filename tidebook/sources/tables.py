"""Named landing tables and feed files."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.values import once
from .quoted import quoted_records

MALFORMED = "_malformed_record"
#: A comma that is not inside double quotes. Looks ahead at every comma: for short lines.
CSV_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
QUOTED = r'"[^"]*"'
#: Width of the text columns a feed lands in when its typed column is a number or a date.
NUMBER_WIDTH, DATE_WIDTH, KEY_WIDTH, FLAG_WIDTH = 20, 10, 60, 5


def raw_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A landing table under ``root``, with its typed contract as the read schema."""
    return spark.read.schema(schemas.landing_schema(name)).parquet(f"{root}/{name}")


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make DataFrames addressable by name from SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def bronze_views(
    spark: SparkSession, root: str, stages: dict[str, Callable[[DataFrame], DataFrame]]
) -> dict[str, DataFrame]:
    """Staged landing tables as lazy views named ``stg_…``."""
    views = {
        f"stg_{name.removesuffix('_raw')}": stage(raw_table(spark, root, name))
        for name, stage in stages.items()
    }
    register_views(views)
    return views


def _check_columns(path: str, found: Iterable[str], expected: Iterable[str]) -> None:
    found, expected = list(found), list(expected)
    if found != expected:
        raise ValueError(f"{path} columns mismatch: expected {expected}, got {found}")


def read_feed(
    spark: SparkSession, path: str, table: str, partitions: int | None = None
) -> DataFrame:
    """A feed whose columns must match the contract: Parquet, or CSV, gzipped or not.

    Fields come as text, empty ones as NULL. One gzip file is one read task whatever its size:
    ``partitions`` spreads its rows for the work that follows.
    """
    schema = schemas.text_schema(table)
    if path.rstrip("/").endswith(".parquet"):
        stored = spark.read.parquet(path)
        _check_columns(path, stored.columns, schema.names)
        df = stored.select([F.col(f.name).cast(f.dataType) for f in schema.fields])
    else:
        # Without enforceSchema the reader compares every file's header with the schema.
        df = (
            spark.read.schema(schema)
            .options(header=True, enforceSchema=False, mode="FAILFAST")
            .csv(path)
        )
    return df.repartition(partitions) if partitions else df


def typed_feed(feed: DataFrame, table: str) -> DataFrame:
    """Text feed to landing types and column order; malformed values raise."""
    schema = schemas.landing_schema(table)
    return feed.select([
        F.nullif(F.col(f.name), F.lit("")).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def _width(table: str, column: str) -> int:
    kind = schemas.LANDING_TABLES[table][column]
    if kind.startswith("varchar"):
        return int(kind[len("varchar("):-1])
    return {"date": DATE_WIDTH, "string": KEY_WIDTH, "flag": FLAG_WIDTH}.get(kind, NUMBER_WIDTH)


def _text_ddl(table: str) -> str:
    return ", ".join(f"{c} string" for c in [*schemas.FEED_COLUMNS[table], MALFORMED])


def _reject_reason(table: str) -> Column:
    """Why a record is rejected, NULL for a good one. Too few fields is no reason."""
    fields = schemas.FEED_COLUMNS[table]
    commas = F.regexp_count(F.regexp_replace(MALFORMED, QUOTED, ""), F.lit(","))
    too_many = commas >= len(fields)
    too_wide = F.lit(False)
    for c in fields:
        too_wide = too_wide | F.coalesce(F.length(c) > _width(table, c), F.lit(False))
    reason = F.when(F.col(MALFORMED).isNotNull() & too_many, "too many fields").when(
        too_wide, "value too wide"
    )
    if table == "positions_raw":
        reason = reason.when(F.coalesce(*fields).isNull(), "all fields empty")
    return reason


def split_rejects(records: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected records with the reason."""
    fields = schemas.FEED_COLUMNS[table]
    judged = records.withColumn("reason", _reject_reason(table))
    text = F.coalesce(F.col(MALFORMED), F.to_csv(F.struct(*fields)))
    rejects = judged.where(F.col("reason").isNotNull()).select(text.alias("record"), "reason")
    return judged.where(F.col("reason").isNull()).select(*fields), rejects


def read_external(spark: SparkSession, path: str, table: str) -> tuple[DataFrame, DataFrame]:
    """CSV as an external text table: quoted newlines allowed, bad records never fail the scan.

    Returns good rows and rejects. A large file is read by many tasks, quoted newlines or not (see
    ``quoted_records``).
    """
    return parse_lines(quoted_records(spark, path), "record", table, multi_line=True)


def parse_lines(
    lines: DataFrame, column: str, table: str, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The same rules for CSV records that already are rows of text."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    if multi_line:
        options |= {"quote": '"', "escape": '"', "multiLine": "true"}
    parsed = once(lines, F.from_csv(column, _text_ddl(table), options), "_record")
    return split_rejects(parsed.select("_record.*"), table)
