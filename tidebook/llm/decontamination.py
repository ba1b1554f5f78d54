"""Benchmark decontamination by latent semantic retrieval (10).

Benchmark items are cut into passages that fit a window. Passages, in blocks of bounded size, span a
latent space: the randomised singular value decomposition of their TF-IDF rows, with document
frequencies counted over all documents. Every window of every document is folded into that space
and compared with every passage by cosine. Around what comes near, the whole item is checked word by
word: the longest common subsequence must cover most of the item, and most of its answer, its last
sentence, so rephrased copies count and shared topics don't.

The decomposition never holds the passage matrix: tasks multiply their rows with a random test
matrix and back, and the products, one row per term and task, are summed after a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm.registry import query, table
from tidebook.llm.tfidf import BREAKS, document_counts, positions
from tidebook.llm.words import Words, lowered, slices, words

#: Passages indexed together, and spare dimensions while their space is sought. The space has a
#: dimension for each passage of a block: with fewer, passages blur into one another, and common
#: words alone bring windows near.
BLOCK, SPARE = 512, 16
#: Words of half a window; a window is two neighbouring halves. A passage has at most the words of a
#: half, so that wherever it stands one window holds all of it.
HALF = 32
#: Least cosine of a candidate, least length of its projection on the passage (a window that holds
#: a passage among other words has about the passage's), and least share of the item and of its
#: answer in common order.
COSINE, PROJECTED, COVERED, ANSWERED = 0.1, 0.5, 0.7, 0.5
#: Windows compared with all items at once.
CHUNK = 4096
#: Halves summed at once; their vectors fit the processor's cache.
SUMMED = 256
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


@dataclass
class Space:
    """A block of passages in latent space."""

    terms: np.ndarray  #: sorted hashes of the passages' words
    fold: np.ndarray  #: weight of a term times its place in the space
    passages: np.ndarray  #: unit vectors
    sizes: np.ndarray  #: their lengths before
    owner: np.ndarray  #: the item of each, in ascending order


@dataclass
class Index:
    """Items that are searched together; the passages of one may lie in several spaces."""

    spaces: list[Space]
    item_ids: list
    item_words: list[np.ndarray]  #: word hashes in order
    answers: list[np.ndarray]  #: those of the last sentence


def _passage_rows(column: pa.Array, terms: np.ndarray, weights: np.ndarray):
    """TF-IDF rows of passages: terms and weights of each."""
    for found in words(lowered(column), BREAKS):
        at = positions(terms, found.hash)
        for a, b in zip(found.word_at[:-1], found.word_at[1:], strict=True):
            own, times = np.unique(at[a:b][at[a:b] >= 0], return_counts=True)
            row = times * weights[own]
            yield own, row


def _products(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Rows of A'(A X) that this task's passages touch, for the matrix X of the round."""
    terms, weights, x = shared.value
    total = np.zeros(x.shape)
    touched = np.zeros(len(terms), dtype=bool)
    for batch in batches:
        for own, row in _passage_rows(batch.column("text"), terms, weights):
            total[own] += row[:, None] * (row @ x[own])
            touched[own] = True
    at = np.flatnonzero(touched)
    yield pa.RecordBatch.from_arrays(
        [pa.array(at, pa.int32()), pa.array(list(total[at]), pa.list_(pa.float64()))],
        ["term", "row"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per term of a partition, the sum of its rows."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        rows = batch.column("row")
        values = rows.flatten().to_numpy().reshape(len(rows), -1) if len(rows) else []
        for term, row in zip(batch.column("term").to_pylist(), values, strict=True):
            total[term] = total[term] + row if term in total else row
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))],
        ["term", "row"])


def latent_space(passages: DataFrame, terms: np.ndarray, weights: np.ndarray,
                 rank: int, rounds: int = 3) -> np.ndarray:
    """Right singular vectors (terms, rank) of the TF-IDF matrix of ``passages(text)``.

    Subspace iteration on A'A from a random start; a round is one pass over the passages and a
    sum per term. The result has as many rows as the block of items has words.
    """
    context = passages.sparkSession.sparkContext
    width = min(rank + SPARE, len(terms))
    x = np.random.default_rng(11).standard_normal((len(terms), width))
    for _ in range(rounds):
        shared = context.broadcast((terms, weights, np.linalg.qr(x)[0]))
        rows = passages.select("text").mapInArrow(
            lambda b, s=shared: _products(b, s), "term int, row array<double>"
        ).repartition("term").mapInArrow(_summed, "term int, row array<double>")
        x = np.zeros((len(terms), width))
        for r in rows.toLocalIterator():  # a row per word of the block
            x[r.term] = r.row
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    return u[:, :rank][:, s[:rank] > 1e-9 * max(s[0], 1e-300)]


def _subsequence(masks: dict[int, int], region: np.ndarray) -> int:
    """Length of the longest common subsequence of an item, given as bit masks, and a region."""
    row = -1
    for word in region.tolist():
        mask = masks.get(word)
        if mask is not None:
            kept = row & mask
            row = (row + kept) | (row - kept)
    return (~row).bit_count()


def _masks(item: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        out[word] = out.get(word, 0) | 1 << i
    return out


def covered(item: np.ndarray, region: np.ndarray) -> float:
    """Share of the item's words that the region has in the same order."""
    size = len(item)
    masks = _masks(item)
    # Bits above the item's stay set in a row that starts at -1, so they never count.
    return _subsequence(masks, region) / size if size else 0.0


def _windows(found: Words, index: Space):
    """Latent vectors of all windows, with the text and first word of each."""
    counts = np.diff(found.word_at)
    halves = np.maximum(1, -(-counts // HALF))
    base = np.cumsum(halves) - halves
    text = np.repeat(np.arange(len(counts)), halves)
    at = positions(index.terms, found.hash)
    known = np.flatnonzero(at >= 0)
    owner = np.repeat(np.arange(len(counts)), counts)[known]
    half = base[owner] + (known - found.word_at[:-1][owner]) // HALF
    vectors = np.zeros((len(text), index.fold.shape[1]), dtype=np.float32)
    if len(known):
        first = np.flatnonzero(np.diff(half, prepend=-1))
        size = np.diff(first, append=len(known))
        # Halves with most words first, so that their jth words are those of the first few rows.
        order = np.argsort(-size, kind="stable")
        for a in range(0, len(order), SUMMED):
            begin, number = first[order[a:a + SUMMED]], size[order[a:a + SUMMED]]
            total = index.fold[at[known[begin]]]
            for j in range(1, number[0]):
                begin = begin[:np.searchsorted(-number, -j)]
                total[:len(begin)] += index.fold[at[known[begin + j]]]
            vectors[half[first[order[a:a + SUMMED]]]] = total
    joined = vectors.copy()
    follows = text[1:] == text[:-1]
    joined[:-1][follows] += vectors[1:][follows]
    begin = (np.arange(len(text)) - base[text]) * HALF + found.word_at[:-1][text]
    return joined, text, begin


def _candidates(vectors: np.ndarray, space: Space, cosine: float,
                best: dict[tuple[int, int], float]) -> dict[tuple[int, int], float]:
    """``best`` with the windows and items that come near by a passage of this space."""
    norms = np.linalg.norm(vectors, axis=1)
    for a in range(0, len(vectors), CHUNK):
        near = vectors[a:a + CHUNK] @ space.passages.T
        like = near >= PROJECTED * space.sizes[None, :]
        near /= np.maximum(norms[a:a + CHUNK, None], 1e-12)
        for w, p in zip(*np.nonzero(like & (near >= cosine)), strict=True):
            key = a + int(w), int(space.owner[p])
            best[key] = max(best.get(key, 0.0), float(near[w, p]))
    return best


def _search(batches: Iterator[pa.RecordBatch], shared, cosine: float, share: float,
            answered: float) -> Iterator[pa.RecordBatch]:
    index: Index = shared.value
    masks = [_masks(x) for x in index.item_words]
    for batch in slices(batches):
        ids = batch.column("doc_id").to_pylist()
        out: dict[tuple[int, int], tuple[float, float, float]] = {}
        for found in words(lowered(batch.column("text")), BREAKS):
            near: dict[tuple[int, int], float] = {}  # best cosine of a window and an item
            for space in index.spaces:
                vectors, text, begin = _windows(found, space)
                near = _candidates(vectors, space, cosine, near)
            for (w, k), like in near.items():
                item = index.item_words[k]
                t = text[w]
                low = max(begin[w] - len(item), found.word_at[t])
                high = min(begin[w] + 2 * HALF + len(item), found.word_at[t + 1])
                region = found.hash[low:high]
                part = _subsequence(masks[k], region) / len(item)
                if part < share:
                    continue
                answer = covered(index.answers[k], region)
                key = found.first + int(t), k
                if answer >= answered and part > out.get(key, (0, -1.0, 0))[1]:
                    out[key] = like, part, answer
        rows = [(ids[t], index.item_ids[k], *v) for (t, k), v in out.items()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(
                columns, (pa.int64(), pa.int64(), *[pa.float64()] * 3), strict=True)],
            ["doc_id", "item_id", "cosine", "covered", "answered"])


FOUND = "doc_id long, item_id long, cosine double, covered double, answered double"


def _cut(texts: list[str]) -> tuple[list[np.ndarray], list[list[str]]]:
    """Word hashes of each text, and its passages of about equal numbers of words."""
    hashes, cut = [], []
    for f in words(lowered(pa.array(texts, pa.string())), BREAKS):
        for a, b in zip(f.word_at[:-1].tolist(), f.word_at[1:].tolist(), strict=True):
            hashes.append(f.hash[a:b])
            number = -(-(b - a) // HALF)
            edges = [a + (b - a) * i // number for i in range(number + 1)] if number else []
            cut.append([f.data[f.start[i]:f.end[j - 1]].tobytes().decode()
                        for i, j in zip(edges[:-1], edges[1:], strict=True)])
    return hashes, cut


def build_index(docs: DataFrame, rows: list, block: int = BLOCK) -> Index | None:
    """The index of items ``(item_id, text)``; None if none has a word."""
    texts = [r.text for r in rows]
    item_words, cut = _cut(texts)
    last = _cut([_SENTENCE.split(t.strip())[-1] for t in texts])[0]
    kept = [i for i, x in enumerate(item_words) if len(x)]
    if not kept:
        return None
    answers = [last[i] if len(last[i]) else item_words[i] for i in kept]
    all_terms = np.unique(np.concatenate([item_words[i] for i in kept]))
    counts, total = document_counts(docs, all_terms)
    all_weights = np.log((1 + total) / (1 + counts)) + 1e-3
    passages = [(k, text) for k, i in enumerate(kept) for text in cut[i]]
    spaces = []
    for a in range(0, len(passages), block):
        owner, own_texts = zip(*passages[a:a + block], strict=True)
        column = pa.array(own_texts, pa.string())
        terms = np.unique(np.concatenate([f.hash for f in words(lowered(column), BREAKS)]))
        weights = all_weights[positions(all_terms, terms)]
        place = latent_space(
            docs.sparkSession.createDataFrame([(t,) for t in own_texts], "text string"),
            terms, weights, min(len(own_texts), len(terms)))
        vectors = np.stack([
            row @ place[own] for own, row in _passage_rows(column, terms, weights)])
        size = np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)
        spaces.append(Space(
            terms, (weights[:, None] * place).astype(np.float32),
            (vectors / size[:, None]).astype(np.float32), size.astype(np.float32),
            np.array(owner)))
    return Index(spaces, [rows[i].item_id for i in kept], [item_words[i] for i in kept], answers)


def leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, share: float = COVERED,
          answered: float = ANSWERED, block: int = BLOCK) -> DataFrame:
    """``doc_id, item_id, cosine, covered, answered``: the items that documents contain.

    ``docs(doc_id, text)`` are searched whole for every item of ``benchmark(item_id, text)``. Words
    are runs of letters and digits in any case. An item is found if, near a window of sufficient
    cosine to one of its passages, at least ``share`` of its words and ``answered`` of its last
    sentence occur in order, however long it is.
    Null, empty and wordless texts on either side match nothing. Items with null ids take part,
    documents with null ids too; repeated rows give repeated results. Other columns are ignored;
    an empty table on either side gives no rows.
    """
    found = None
    part: list = []
    size = 0

    def search(rows: list) -> None:
        nonlocal found
        index = build_index(docs, rows, block)
        if index is not None:
            shared = docs.sparkSession.sparkContext.broadcast(index)
            more = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
                lambda b: _search(b, shared, cosine, share, answered), FOUND)
            found = more if found is None else found.union(more)

    items = benchmark.where("text is not null").select(F.col("item_id").cast("long"), "text")
    for row in items.distinct().orderBy("item_id", "text").toLocalIterator():
        number = max(1, sum(map(len, _cut([row.text])[1])))
        if part and size + number > block:
            search(part)
            part, size = [], 0
        part.append(row)
        size += number
    if part:
        search(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], FOUND)
    return found


@query("op10_decontamination")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
