"""Run statistics, run files and pod metrics."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.text import file_stem
from ..functions.values import blank_to_null, once, strip

POD_ROWS = T.StructType(
    [T.StructField("model_name", T.StringType()), *schemas.POD_METRICS.fields]
)


class NoRunFiles(FileNotFoundError):
    """A reports folder holds no run file."""


def read_run_stats(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """The statistics table, or one run of it with the filter pushed to the scan."""
    stats = spark.read.schema(schemas.RUN_STATS).parquet(path)
    return stats if run_id is None else stats.where(F.col("run_id") == run_id)


def run_by_parameter(spark: SparkSession, view: str, run_id: str) -> DataFrame:
    """The same selection as a parameterised statement over a registered view."""
    return spark.sql(
        "SELECT * FROM IDENTIFIER(:view) WHERE run_id = :run_id ORDER BY run_started_at",
        args={"view": view, "run_id": run_id},
    )


#: A record with the line end before it: line ends inside double quotes belong to a cell. A quote
#: without a second one is an ordinary character. Possessive, so that long files need no stack.
RECORD = r'(?:\r\n|[\r\n])(?:[^"\r\n]++|"[^"]*+"|"[^\r\n]*+)*+'
#: A cell with the comma before it; quotes count where they enclose a cell.
CELL = r',(?:\s*+"[^"]*+(?:""[^"]*+)*+"\s*+(?=,|$)|[^,]*+)'


def _cells(record: Column) -> Column:
    """All cells of one record, however many; empty ones are NULL."""
    def plain(cell: Column) -> Column:
        text = strip(F.substring(cell, F.lit(2), F.length(cell)))
        quoted = text.startswith('"') & text.endswith('"') & (F.length(text) > 1)
        inner = F.substring(text, F.lit(2), F.length(text) - 2)
        return F.when(quoted, F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(
            F.nullif(text, F.lit("")))

    found = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(CELL), F.lit(0))
    return F.transform(found, plain)


def _read_as(text: Column, dtype: T.DataType) -> Column:
    text = blank_to_null(text)
    if isinstance(dtype, T.LongType):
        # A column with gaps may have been written as a float.
        return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))
    return text.try_cast(dtype)


def _records(files: DataFrame, column: str) -> DataFrame:
    """Records of whole run files with their file's header, and whether they fit it.

    ``named`` are the places of the header's names; of a name given twice the last one counts.
    """
    found = F.regexp_extract_all(F.concat(F.lit("\n"), F.col(column)), F.lit(RECORD), F.lit(0))
    # A record begins with the line end before it, which is white space to cells.
    lines = files.select(
        F.filter(F.transform(found, lambda r: F.regexp_replace(r, r"^(\r\n|[\r\n])", "")),
                 lambda line: strip(line) != "").alias("lines")
    ).where(F.size("lines") > 1)
    headed = once(lines, _cells(F.get("lines", F.lit(0))), "names")
    # Names end with the last filled cell.
    width = F.array_max(F.transform(
        "names", lambda n, i: F.when(n.isNotNull(), i + 1).otherwise(0)))
    headed = once(headed, F.slice("names", F.lit(1), width), "header")
    headed = once(headed, F.reverse("header"), "backward")
    is_last = lambda n, i: F.array_position("backward", n) + i == F.size("header")
    rows = headed.select(
        "header", F.filter(F.transform("header", lambda n, i: F.when(is_last(n, i), i)),
                           lambda i: i.isNotNull()).alias("named"),
        F.explode(F.slice("lines", F.lit(2), F.size("lines") - 1)).alias("line"))
    parsed = once(rows, _cells(F.col("line")), "cells")
    over = F.exists(
        F.slice("cells", F.size("header") + 1, F.size("cells")), lambda c: c.isNotNull())
    return parsed.withColumn("fits", ~over)


def run_file_rejects(files: DataFrame, column: str = "value") -> DataFrame:
    """Records with a filled cell beyond their file's header; they add no rows."""
    return _records(files, column).where(~F.col("fits")).select(F.col("line").alias("record"))


def parse_run_files(files: DataFrame, column: str = "value") -> DataFrame:
    """Whole run files, one per row, as one table matched by column name.

    Every file brings its own header, so column order and columns a file lacks do not matter.
    Columns outside the contract are kept as text in ``other_columns``. Quoted cells may hold
    commas, quotes and line ends. Records that do not fit the header are left to
    ``run_file_rejects``.
    """
    fitting = _records(files, column).where("fits")
    entries = F.transform("named", lambda i: F.struct(
        F.get("header", i).alias("name"), F.get("cells", i).alias("value")))
    row = once(fitting, F.map_from_entries(entries), "row").select("row")
    known = [
        _read_as(F.try_element_at("row", F.lit(f.name)), f.dataType).alias(f.name)
        for f in schemas.RUN_FILE.fields
    ]
    other = F.map_filter("row", lambda k, _: ~k.isin(*schemas.RUN_FILE.names))
    return row.select(*known, other.alias("other_columns"))


def read_run_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every run CSV below a folder; unreadable files are skipped, none at all is an error.

    A run file holds one row per model, so a whole file is a small row; the runs, of which
    there may be many, are what is distributed.
    """
    files = spark.read.options(
        pathGlobFilter="*.csv", recursiveFileLookup=True, ignoreCorruptFiles=True
    ).text(folder, wholetext=True)
    if files.isEmpty():
        raise NoRunFiles(folder)
    return parse_run_files(files)


def read_pod_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON file per model, named after it; a folder that does not exist gives no rows."""
    try:
        pods = (
            spark.read.schema(schemas.POD_METRICS)
            .options(multiLine=True, pathGlobFilter="*.json")
            .json(folder)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], POD_ROWS)
    return pods.select(file_stem(F.col("_metadata.file_name")).alias("model_name"), "*")
