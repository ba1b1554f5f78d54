"""Document frequencies of a bounded set of terms, counted over all documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.llm.words import lowered, slices, words

#: ASCII characters other than letters and digits end a term, as white space does.
BREAKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def positions(terms: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each hash among the sorted ``terms``, -1 if it isn't there."""
    if not len(terms):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    return np.where(terms[at] == hashes, at, -1)


def _counts(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    terms = shared.value
    counts, documents = np.zeros(len(terms), dtype=np.int64), 0
    for batch in slices(batches):
        for found in words(lowered(batch.column("text")), BREAKS):
            at = positions(terms, found.hash)
            text = np.repeat(np.arange(len(found.word_at) - 1), np.diff(found.word_at))
            once = np.unique((text * len(terms) + at)[at >= 0]) % len(terms)
            counts += np.bincount(once, minlength=len(terms))
            documents += found.last - found.first
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(counts[at], documents))],
        ["term", "n"])


def document_counts(docs: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """For sorted hashes of terms the number of documents that hold each, and of all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    rows = docs.select("text").mapInArrow(
        lambda b: _counts(b, shared), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts, total = np.zeros(len(terms)), 0
    for r in rows.toLocalIterator():  # a row per term
        if r.term < 0:
            total = r.n
        else:
            counts[r.term] = r.n
    return counts, total
