"""Packing of documents into sequences by large-item matching and best fit (4).

Every document becomes pieces of at most one capacity. Pieces are known by their length only, and
lengths are small integers, so the whole plan is made from the histogram of lengths: it has at most
as many entries as the capacity, whatever the number of documents. Pieces above a third of the
capacity fit at most two to a sequence and are matched greedily, the longest with the longest that
fits; smaller ones go, longest first, into the tightest gap. The plan assigns ranges of ranks
(within a length) to ranges of sequences, and is joined to the ranked pieces.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm.encoding import encode
from tidebook.llm.registry import query, table
from tidebook.llm.stages import Stages
from tidebook.operators.sequences import number_within

CAPACITY, END = 2048, 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
CHUNK = 64
#: Hash values over which the pieces of one length are numbered.
SPREAD = 1024


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary: str, capacity: int):
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
        out: list[tuple] = []
        for at in range(0, len(texts), CHUNK):
            part = [t or "" for t in texts.slice(at, CHUNK).to_pylist()]
            for doc, tokens in zip(ids[at:at + CHUNK], encode(vocabulary, part), strict=True):
                tokens.append(END)
                data = np.array(tokens, dtype="<u4")
                first = len(tokens) % capacity or capacity
                cuts = [0, *range(first, len(tokens) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    out.append((doc, k, a, b - a, zlib.crc32(data[a:b].tobytes())))
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(
                columns, (pa.int64(), pa.int32(), *[pa.int64()] * 3), strict=True)],
            ["doc_id", "piece", "start", "length", "ids_crc32"])


def plan_packing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """``(length, first rank, number, first sequence, offset)``: ranks count from 0.

    Works on runs of equal sequences, so its size depends on the capacity alone: a run is split
    at most once for each length, and each use of a run at least halves its gap.
    """
    placed: list[tuple[int, int, int, int, int]] = []
    used = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs (first, number)
    sequences = 0

    def put(length: int, number: int, sequence: int, offset: int) -> None:
        placed.append((length, used[length], number, sequence, offset))
        used[length] += number

    left = {k: n for k, n in counts.items() if 3 * k > capacity and n}
    sizes = sorted(left)
    while sizes:
        top = sizes[-1]
        at = bisect_left(sizes, capacity - top + 1) - 1
        mate = sizes[at] if at >= 0 else None
        if mate is None or (mate == top and left[top] == 1):
            number = left[top]
            put(top, number, sequences, 0)
            if top < capacity:
                gaps[capacity - top].append((sequences, number))
            left[top] = 0
        else:
            number = left[top] // 2 if mate == top else min(left[top], left[mate])
            put(top, number, sequences, 0)
            put(mate, number, sequences, top)
            if top + mate < capacity:
                gaps[capacity - top - mate].append((sequences, number))
            left[top] -= number
            left[mate] -= number
        sequences += number
        sizes = [k for k in sizes if left[k]]

    for length in sorted((k for k, n in counts.items() if 3 * k <= capacity and n), reverse=True):
        rest = counts[length]
        open_gaps = [g for g in gaps if g >= length]
        heapq.heapify(open_gaps)
        while rest:
            if not open_gaps:
                each = capacity // length
                number = -(-rest // each)
                gaps[capacity].append((sequences, number))
                sequences += number
                open_gaps.append(capacity)
            gap = open_gaps[0]
            first, number = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                heapq.heappop(open_gaps)
            each = gap // length
            full, more = min(number, rest // each), 0
            if full < number:
                more = rest - full * each  # the last sequence touched takes fewer
            for k in range(each):
                if full:
                    put(length, full, first, capacity - gap + k * length)
            rest -= full * each
            if full and gap - each * length:
                gaps[gap - each * length].append((first, full))
            if full < number:
                taken = 1 if more else 0
                for k in range(more):
                    put(length, 1, first + full, capacity - gap + k * length)
                if taken and gap - more * length:
                    gaps[gap - more * length].append((first + full, 1))
                if number - full - taken:
                    gaps[gap].append((first + full + taken, number - full - taken))
                rest -= more
    return placed


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", capacity: int = CAPACITY
         ) -> DataFrame:
    """A row per piece of ``docs(doc_id, text)`` with its sequence and its place there.

    A document is its ids and an end id; a null text is only the end id. Longer documents are cut
    into pieces of the capacity, the first of which may be shorter. Rows are independent, so null
    or repeated ids and repeated rows are packed like others. Other columns are ignored; an empty
    table gives no rows.
    """
    stages = Stages(docs.sparkSession, "packing")
    pieces = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda b: _pieces(b, vocabulary, capacity), PIECES)
    pieces = stages.write(pieces, "pieces")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(
        F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    plan = plan_packing(counts, capacity)
    places = docs.sparkSession.createDataFrame(
        plan or [(0, 0, 0, 0, 0)],
        "length long, first_rank long, number long, first_sequence long, offset long")
    order = ["_mix", "doc_id", "piece", "ids_crc32"]
    ranked = number_within(
        pieces.withColumn("_mix", F.xxhash64("doc_id", "piece", "ids_crc32")), ["length"], order,
        F.shiftright("_mix", 64 - SPREAD.bit_length() + 1), "rank")
    # The plan is bounded by the capacity, not by the data.
    return ranked.drop("_mix").join(F.broadcast(places), "length").where(
        "rank > first_rank and rank <= first_rank + number"
    ).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.col("rank") - 1 - F.col("first_rank")).alias("sequence_id"),
        "offset")


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
