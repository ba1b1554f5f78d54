"""CSV records that may hold line ends, read from many byte ranges of a file at once.

Whether a line begins inside a quoted cell depends on all lines before it. A line turns the state it
begins in, outside or inside quotes, into the state it ends in, and so do all lines of a byte range
together. One pass over the text finds that for every range; a scan over the ranges of a file, a row
each, tells where each begins; a second pass cuts records at true ends. Only what crosses a border
is put together across tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGE = ["file", "start"]
#: The rest of a quoted cell, up to the next cell.
_REST = r'[^"]*+(?:""[^"]*+)*+"(?!")[^,]*+(?:,|\Z)'
_CLOSING = re.compile(_REST)
#: Cells from one border on, up to a cell whose quotes do not close.
_CELLS = re.compile(rf'(?:"{_REST}|[^",][^,]*+(?:,|\Z)|,)*+')

#: Where a piece of a record stands in its range.
WHOLE, END, BEGINNING, MIDDLE = range(4)


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open after ``line``, given whether one is open before it."""
    if '"' not in line:
        return inside
    at = 0
    if inside:
        closing = _CLOSING.match(line)
        if closing is None:
            return True
        at = closing.end()
    return _CELLS.match(line, at).end() < len(line)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in file order within each range; the metadata say which range a line belongs to."""
    text = spark.read.text(path, lineSep="\n")
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int, bool]]:
    """Parts of batches that lie in one range, and whether the range is a new one."""
    last = None
    for batch in batches:
        files, starts = (batch.column(c).to_pylist() for c in RANGE)
        at = 0
        for i in range(1, len(files) + 1):
            if i == len(files) or (files[i], starts[i]) != (files[at], starts[at]):
                label = (files[at], starts[at])
                yield batch, at, i, label != last
                last, at = label, i


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range the states it ends in when it begins outside, and inside, quotes."""
    found: list[list] = []
    for batch, first, end, new in _runs(batches):
        if new:
            found.append([batch.column(c)[first].as_py() for c in RANGE] + [False, True])
        effect = found[-1]
        for line in batch.column("line").slice(first, end - first).to_pylist():
            if '"' in line:
                effect[2], effect[3] = ends_inside(line, effect[2]), ends_inside(line, effect[3])
    if found:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in zip(*found, strict=True)], [*RANGE, "outside", "inside"])


def _begins(effects: DataFrame) -> DataFrame:
    """Ranges with ``open``: whether they begin inside quotes.

    A range sets the state, keeps it or turns it over: the state is that of the last range that set
    it, turned over as often as ranges since did.
    """
    before = Window.partitionBy("file").orderBy("start").rowsBetween(
        Window.unboundedPreceding, -1)
    turns = F.coalesce(F.sum(F.col("outside").cast("int") * (~F.col("inside")).cast("int")).over(
        Window.partitionBy("file").orderBy("start")), F.lit(0))
    counted = effects.withColumn("turns", turns)
    setting = F.when(F.col("outside") == F.col("inside"), F.struct("outside", "turns"))
    last = F.last(setting, ignorenulls=True).over(before)
    ahead = F.coalesce(F.last("turns").over(before), F.lit(0))
    return counted.select(*RANGE, last.alias("last"), ahead.alias("ahead")).select(
        *RANGE, ((F.coalesce(F.col("last.outside").cast("int"), F.lit(0)) + F.col("ahead")
                  - F.coalesce(F.col("last.turns"), F.lit(0))) % 2 == 1).alias("open"))


def _pieces(batches: Iterator[pa.RecordBatch], header: bool) -> Iterator[pa.RecordBatch]:
    """``file, start, kind, record``: whole records, and pieces of those that cross a border."""
    held: list[str] = []
    label: tuple = ()
    inside = borrowed = skip = False

    def piece(open_end: bool):
        if borrowed:
            kind = MIDDLE if open_end else END
        else:
            kind = BEGINNING if open_end else WHOLE
        return (*label, kind, "\n".join(held))

    for batch, first, end, new in _runs(batches):
        out = []
        if new:
            if held:
                out.append(piece(True))
            label = tuple(batch.column(c)[first].as_py() for c in RANGE)
            inside = borrowed = batch.column("open")[first].as_py()
            skip, held = header and label[1] == 0, []
        for line in batch.column("line").slice(first, end - first).to_pylist():
            held.append(line)
            inside = ends_inside(line, inside)
            if not inside:
                if skip:
                    skip = False
                else:
                    out.append(piece(False))
                held, borrowed = [], False
        if out:
            yield _table(out)
    if held:
        yield _table([piece(True)])


def _table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
         pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.string())],
        [*RANGE, "kind", "record"])


def quoted_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """``file, record``: the records of CSV files, which may hold line ends inside quotes.

    Files are read in as many ranges as Spark cuts them into (a compressed file is one). Quotes
    count where they enclose a cell; an open quote at the end of a file ends with it. Empty lines
    are no records, and with ``header`` neither is the first record of a file. The ranges, a short
    row per ``spark.sql.files.maxPartitionBytes`` of text, are broadcast, for a join that moved the
    lines would lose their order.
    """
    lines = _lines(spark, path)
    effects = lines.mapInArrow(
        _effects, "file string, start long, outside boolean, inside boolean")
    begins = _begins(effects)
    pieces = lines.join(F.broadcast(begins), RANGE).select(*RANGE, "line", "open").mapInArrow(
        lambda b: _pieces(b, header), "file string, start long, kind int, record string")
    whole = pieces.where(F.col("kind") == WHOLE).select("file", "record")
    # A record that crosses borders begins in one range, may fill others, and ends in a last one.
    in_order = Window.partitionBy("file").orderBy("start", F.col("kind") == BEGINNING)
    crossing = pieces.where(F.col("kind") != WHOLE).withColumn(
        "nth", F.sum((F.col("kind") == BEGINNING).cast("int")).over(in_order))
    joined = crossing.groupBy("file", "nth").agg(
        F.sort_array(F.collect_list(F.struct("start", "record"))).alias("parts")).select(
        "file", F.array_join("parts.record", "\n").alias("record"))
    ended = F.regexp_replace("record", r"\r$", "")
    return whole.unionByName(joined).select("file", ended.alias("record")).where("record <> ''")
