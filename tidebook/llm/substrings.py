"""Removal of repeated word sequences by prefix-partitioned suffix trees (12).

A suffix is what follows a word of a text, up to ``window`` words; deeper edges cannot change what
is removed. Suffixes are split by variable-length prefixes: a prefix that more than ``GROUP``
suffixes begin with is made longer, so that all suffixes of one prefix fit the memory of a task.
A task sorts the suffixes of a prefix; the sorted suffixes and the lengths that neighbours have in
common are the prefix's subtree, whose internal nodes at depth ``window`` are the repeats. A suffix
below such a node goes if the node also has one of a smaller document. A prefix of full length that
is still too common is one node, and its smallest document is an aggregate.

Only suffixes that may repeat enter a tree. Every window has an anchor, its least sequence of
``ANCHOR`` words by hash; equal windows have equal anchors, so a window whose anchor stands in one
text only repeats nowhere. Anchors are a fifth of all words. Equal texts are one text in all this.

Edges carry a byte of each word's hash and the last one 64 bits of the whole window, so a suffix is
a short row, and two windows are one node if these agree.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm.registry import query, table
from tidebook.llm.stages import Stages
from tidebook.llm.words import Words, mixed, words

WINDOW = 13
#: Words of an anchor.
ANCHOR = 4
#: Suffixes of one prefix that a task holds at once.
GROUP = 1 << 18
#: Lengths that prefixes are tried at.
PREFIXES = (1, 2, 3, 4, 6, 8)

KEY = ["doc", "content"]
_WORD = re.compile(rb"[^\x20\t-\r]+")
_ROLL = np.uint64(0x9E3779B97F4A7C15)


def _rolled(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` neighbouring word hashes."""
    out = np.zeros(max(len(h) - size + 1, 0), dtype=np.uint64)
    for i in range(size):
        out = mixed(out * _ROLL + h[i:len(out) + i])
    return out


def _anchors(found: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows, the place of each one's anchor, and the hash of any place."""
    anchor = min(ANCHOR, window)
    starts = np.concatenate([np.arange(a, max(b - window + 1, a)) for a, b in zip(
        found.word_at[:-1], found.word_at[1:], strict=True)])
    hashes = _rolled(found.hash, anchor)
    if not len(starts):
        return starts.astype(np.int64), starts.astype(np.int64), hashes
    least = sliding_window_view(hashes, window - anchor + 1).argmin(axis=1)
    return starts, least[starts] + starts, hashes


def _keys(batch: pa.RecordBatch, found: Words, at: np.ndarray, names: list[str]
          ) -> tuple[list[pa.Array], np.ndarray]:
    """Columns of the texts that hold the words ``at``, and each word's place in its text."""
    text = np.searchsorted(found.word_at, at, side="right") - 1
    rows = pa.array(text + found.first)
    return [batch.column(k).take(rows) for k in names], at - found.word_at[text]


def _anchor_rows(batches: Iterator[pa.RecordBatch], window: int, placed: bool):
    for batch in batches:
        for found in words(batch.column("text"), fold=False):
            _, at, hashes = _anchors(found, window)
            at = np.unique(at)
            names = KEY if placed else KEY[1:]
            keys, place = _keys(batch, found, at, names)
            more = {"at": pa.array(place.astype(np.int32))} if placed else {}
            yield pa.RecordBatch.from_pydict(
                {"anchor": pa.array(hashes[at].view(np.int64)), **dict(zip(names, keys, strict=True)),
                 **more})


def _suffix_rows(batches: Iterator[pa.RecordBatch], window: int):
    """``edges, node, doc, content, at`` of every suffix whose anchor is among ``anchors``."""
    for batch in batches:
        listed = batch.column("anchors")
        flat, ends = listed.flatten().to_numpy(), listed.offsets.to_numpy()
        ends = ends - ends[0]
        for found in words(batch.column("text"), fold=False):
            starts, at, _ = _anchors(found, window)
            repeated = np.zeros(len(found.hash) + 1, dtype=bool)
            own = np.diff(ends[found.first:found.last + 1])
            places = flat[ends[found.first]:ends[found.last]] + np.repeat(
                found.word_at[:-1], own)
            repeated[places] = True
            starts = starts[repeated[at]]
            if not len(starts):
                continue
            keys, place = _keys(batch, found, starts, KEY)
            bytes_of = (found.hash >> np.uint64(56)).astype(np.uint8)
            edges = np.ascontiguousarray(sliding_window_view(bytes_of, window)[starts])
            offsets = pa.py_buffer(np.arange(len(starts) + 1, dtype=np.int32) * window)
            yield pa.RecordBatch.from_arrays(
                [pa.Array.from_buffers(
                    pa.binary(), len(starts), [None, offsets, pa.py_buffer(edges)]),
                 pa.array(_rolled(found.hash, window)[starts].view(np.int64)), *keys,
                 pa.array(place.astype(np.int32))], ["edges", "node", *KEY, "at"])


def subtrees(edges: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of suffixes, and for each neighbour how many edges it shares with the one
    before; sharing the last edge, the node's hash, too counts one more."""
    depth = edges.shape[1]
    order = np.lexsort((node, *(edges[:, i] for i in range(depth - 1, -1, -1))))
    edges, node = edges[order], node[order]
    differs = edges[1:] != edges[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), depth)
    common[(common == depth) & (node[1:] == node[:-1])] += 1
    return order, np.concatenate([[0], common])


def _repeats(batches: Iterator[pa.RecordBatch], window: int, group: int):
    """Suffixes sorted by prefix in; those below a deep node of a smaller document out."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None

    def grown() -> pa.RecordBatch | None:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        data = np.frombuffer(rows.column("edges").buffers()[2], dtype=np.uint8)
        first = rows.column("edges").offset * window
        edges = data[first:first + len(rows) * window].reshape(len(rows), window)
        doc = rows.column("doc").to_numpy()
        order, common = subtrees(edges, rows.column("node").to_numpy())
        deep = np.flatnonzero(common <= window)  # where the subtree of a deep node begins
        least = np.minimum.reduceat(doc[order], deep)
        least = np.repeat(least, np.diff([*deep, len(doc)]))
        gone = np.sort(order[doc[order] > least])
        return rows.select([*KEY, "at"]).take(pa.array(gone)) if len(gone) else None

    for batch in batches:
        prefix = batch.column("prefix")
        tops = prefix.to_pylist()
        # A prefix may end where the next one begins; whole prefixes are taken together.
        borders = [i for i in range(len(tops)) if tops[i] != (tops[i - 1] if i else last)]
        at = 0
        for border in borders:
            if size + border - at >= group and size + border - at > 0:
                held.append(batch.slice(at, border - at))
                out = grown()
                if out is not None:
                    yield out
                held, size, at = [], 0, border
        if at < len(tops):
            held.append(batch.slice(at))
            size += len(tops) - at
        last = tops[-1] if tops else last
    if size:
        out = grown()
        if out is not None:
            yield out


def _spans(batches: Iterator[pa.RecordBatch], window: int):
    """What is left of each text: counts and the kept words joined by one space."""
    for batch in batches:
        out = []
        for text, places, whole in zip(
                *[batch.column(c).to_pylist() for c in ("text", "places", "whole")], strict=True):
            found = _WORD.findall((text or "").encode())
            kept = found
            if whole and len(found) >= window:
                kept = []
            elif places:
                gone = np.zeros(len(found) + 1, dtype=np.int32)
                places = np.unique(places)
                np.add.at(gone, places, 1)
                np.add.at(gone, places + window, -1)
                kept = [w for w, n in zip(found, np.cumsum(gone).tolist(), strict=False) if not n]
            out.append((len(found), len(found) - len(kept), b" ".join(kept).decode()))
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(columns[0], pa.int64()),
             pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.large_string()).cast(
                 pa.string())], ["row", "n_words", "n_removed", "kept"])


def planned(suffixes: DataFrame, window: int, group: int, stages: Stages) -> list[DataFrame]:
    """Prefixes too common for one group, a table for each length tried."""
    heavy: list[DataFrame] = []
    for length in [n for n in PREFIXES if n < window] + [window]:
        rows = suffixes.select("edges")
        if heavy:
            rows = _under(rows, heavy[-1])
        counts = rows.groupBy(F.expr(f"substring(edges, 1, {length})").alias("top")).agg(
            F.count(F.lit(1)).alias("n"))
        found = stages.write(counts.where(F.col("n") > group).withColumn("length", F.lit(length)),
                             f"prefixes-{length}")
        if found.isEmpty():
            break
        heavy.append(found)
    return heavy


def _under(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """Rows whose suffixes begin with one of the prefixes, which are of one length."""
    length = heavy.first()["length"]
    return rows.join(heavy.select("top"), F.expr(f"substring(edges, 1, {length})") == F.col("top"),
                     "left_semi")


def _with_prefix(suffixes: DataFrame, heavy: list[DataFrame], window: int) -> DataFrame:
    """Suffixes with the shortest prefix that is not too common; null if none is."""
    lengths = [n for n in PREFIXES if n < window] + [window]
    prefix: Column = F.expr(f"substring(edges, 1, {lengths[len(heavy)]})") \
        if len(heavy) < len(lengths) else F.lit(None).cast("binary")
    for length, found in reversed(list(zip(lengths, heavy, strict=False))):
        own = F.expr(f"substring(edges, 1, {length})")
        suffixes = suffixes.join(
            found.select(F.col("top").alias(f"top{length}")), own == F.col(f"top{length}"), "left")
        prefix = F.when(F.col(f"top{length}").isNull(), own).otherwise(prefix)
    return suffixes.select("edges", "node", *KEY, "at", prefix.alias("prefix"))


def repeated_windows(docs: DataFrame, window: int, group: int, stages: Stages
                     ) -> tuple[DataFrame, DataFrame]:
    """``doc, content, at`` of windows a smaller document has too, and ``doc, content`` of rows
    whose whole text a smaller document has. ``docs`` has ``doc, content, text``."""
    repeated = docs.select("content", "text").mapInArrow(
        lambda b: _anchor_rows(b, window, False), "anchor long, content long").groupBy(
        "anchor").agg(F.min("content").alias("a"), F.max("content").alias("b")).where("a <> b")
    repeated = stages.write(repeated.select("anchor"), "anchors")

    known = docs.select(*KEY, F.xxhash64(F.lit(7), "text").alias("more"))
    first = known.groupBy("content", "more").agg(F.min("doc").alias("first"))
    copies = known.join(first.hint("merge"), ["content", "more"]).where("doc > first").select(*KEY)
    copies = stages.write(copies, "copies")
    hits = docs.select(*KEY, "text").mapInArrow(
        lambda b: _anchor_rows(b, window, True),
        "anchor long, doc long, content long, at int").join(
        repeated.hint("merge"), "anchor").groupBy(*KEY).agg(
        F.sort_array(F.collect_set("at")).alias("anchors"))
    hits = stages.write(hits.join(copies.hint("merge"), KEY, "left_anti"), "hits")
    texts = stages.write(docs.select(*KEY, "text").join(hits.hint("merge"), KEY), "texts")
    suffixes = texts.mapInArrow(
        lambda b: _suffix_rows(b, window),
        "edges binary, node long, doc long, content long, at int")
    heavy = planned(suffixes, window, group, stages)
    split = _with_prefix(suffixes, heavy, window)
    found = split.where("prefix is not null").repartition("prefix").sortWithinPartitions(
        "prefix").mapInArrow(
        lambda b: _repeats(b, window, group), "doc long, content long, at int")
    if heavy and heavy[-1].first()["length"] == window:
        common = _under(suffixes, heavy[-1])
        least = common.groupBy("edges", "node").agg(F.min("doc").alias("least"))
        found = found.union(common.join(least.hint("merge"), ["edges", "node"]).where(
            "doc > least").select(*KEY, "at"))
    return stages.write(found, "windows"), copies


def drop_repeated_substrings(docs: DataFrame, window: int = WINDOW, group: int = GROUP
                             ) -> DataFrame:
    """``docs`` without ``text``, with ``n_words``, ``n_removed`` and ``kept``, the words that stay
    with one space between them.

    A word goes if it stands in ``window`` neighbouring words whose sequence also starts in a
    document with a smaller ``doc_id``; case and punctuation count. Rows with one ``doc_id`` remove
    nothing from each other. A null ``doc_id`` is smaller than any other. A null text has no words;
    texts of fewer words than the window lose none. Other columns are carried along, but for
    clashing ``n_words``, ``n_removed`` and ``kept``, which are replaced. An empty table gives no
    rows.
    """
    stages = Stages(docs.sparkSession, "substring-dedup")
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = {"doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))),
            "content": F.xxhash64(text)}
    own = docs.select(*[c.alias(n) for n, c in keys.items()], text.alias("text"))
    found, copies = repeated_windows(own, window, group, stages)
    marks = found.groupBy(*KEY).agg(F.collect_set("at").alias("places")).withColumn(
        "whole", F.lit(False)).unionByName(copies.distinct().select(
            *KEY, F.lit(None).cast("array<int>").alias("places"), F.lit(True).alias("whole")))
    carried = [c for c in docs.columns if c not in ("text", "n_words", "n_removed", "kept")]
    rows = docs.select(F.struct(*carried).alias("row"), text.alias("text"),
                       *[c.alias(n) for n, c in keys.items()])
    marked = rows.join(marks.hint("merge"), KEY, "left").select(
        "row", "text", "places", F.coalesce("whole", F.lit(False)).alias("whole"))
    return marked.mapInArrow(
        lambda b: _spans(b, window),
        f"row {marked.schema['row'].dataType.simpleString()}, n_words long, n_removed long, "
        "kept string").select("row.*", "n_words", "n_removed", "kept")


#: Every window of every document by its text.
ORACLE = f"""
with w as (
    select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
        lambda x: x <> '') as w from documents),
starts as (select doc_id, w, unnest(range(1, len(w) - {WINDOW} + 2)) as i from w
    where len(w) >= {WINDOW}),
named as (select doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') as k from starts),
gone as (
    select distinct doc_id, unnest(range(i, i + {WINDOW})) as i from (
        select *, min(doc_id) over (partition by k) as least from named) where doc_id > least),
lost as (select doc_id, list(i) as i from gone group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(t.i), 0) as bigint) as n_removed,
    sha256(coalesce(array_to_string(list_filter(w, lambda x, k:
        not list_contains(coalesce(t.i, []), k)), ' '), '')) as kept_sha256
from w left join lost t using (doc_id)
"""


@query("op12_substring_dedup", ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_substrings(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
