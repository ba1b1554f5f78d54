"""Toxicity by a subsequence string kernel, Nyström landmarks and a support vector machine (6).

Strings are compared by the triples of characters they have in common in order, gaps allowed: a
triple counts less the longer the stretch it is spread over, so an insult with inserted characters
or letters spelled apart stays close to the plain one. The kernel against a set of landmark
strings, whitened (Nyström), gives the features of a linear machine. As both steps are linear in
the triples, the trained machine is one weight per triple, and scoring needs no landmark.

A sentence's score is that of its most toxic string, a document's that of its most toxic sentence.
Labels are known for documents only: training takes the strings of toxic documents that stand out
against those of nearly all clean ones, fits the machine against strings of clean sentences, and
repeats with the clean strings that look most toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm.language import remainder
from tidebook.llm.registry import query, table
from tidebook.llm.words import Words, lowered, mixed, span_hasher, words

#: Labelled documents of each class learned from at most, and the longest of them in characters.
SAMPLE, SAMPLE_CHARS = 2000, 20_000
#: Strings that stand for each class as landmarks, and clean strings learned from at most.
LANDMARKS, CLEAN_STRINGS = 64, 8_000
#: Longer strings are looked at through windows of this many bytes, half overlapping.
WINDOW = 24
#: Longest stretch of a triple, and the weight each skipped character leaves.
STRETCH, DECAY = 6, 0.7
GAPS = [(i, j) for i in range(1, STRETCH) for j in range(1, STRETCH + 1 - i)]
#: Symbols: none, a to z, and five for the bytes of other letters.
_SYMBOL = np.zeros(256, dtype=np.int32)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:] = 27 + np.arange(128) % 5
TRIPLES = 32 ** 3


@dataclass
class Model:
    weights: np.ndarray  #: of each triple
    bias: float
    slope: float  #: calibration of the largest margin of a document
    offset: float


@dataclass
class Strings:
    """Distinct strings of some texts."""

    symbols: np.ndarray  #: their symbols, with gaps between strings
    start: np.ndarray
    end: np.ndarray
    which: np.ndarray  #: string of each occurrence
    text: np.ndarray  #: text of each occurrence
    hash: np.ndarray


def _strings(found: Words) -> Strings:
    size = found.end - found.start
    step = WINDOW // 2
    number = np.maximum(1, -(-(size - step) // step))
    word = np.repeat(np.arange(len(size)), number)
    nth = np.arange(len(word)) - np.repeat(np.cumsum(number) - number, number)
    start = found.start[word] + nth * step
    end = np.minimum(start + WINDOW, found.end[word])
    hashes = span_hasher(found.data)(start, end)
    kept, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    start, end = start[first], end[first]
    length = end - start
    at = np.concatenate([[0], np.cumsum(length + STRETCH)]).astype(np.int64)
    symbols = np.zeros(at[-1] + STRETCH, dtype=np.int32)
    offset = np.repeat(at[:-1] - np.cumsum(length) + length, length) + np.arange(length.sum())
    source = np.repeat(start - np.cumsum(length) + length, length) + np.arange(length.sum())
    symbols[offset] = _SYMBOL[found.data[source]]
    text = np.repeat(np.arange(len(found.word_at) - 1), np.diff(found.word_at))[word]
    return Strings(symbols, at[:-1], at[:-1] + length, which, text, kept)


def _triples(symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each pair of gaps: where triples begin, which they are, and their weight."""
    n = len(symbols) - STRETCH
    for i, j in GAPS:
        a, b, c = symbols[:n], symbols[i:i + n], symbols[i + j:i + j + n]
        at = np.flatnonzero((a > 0) & (b > 0) & (c > 0))
        yield at, (a[at] * 32 + b[at]) * 32 + c[at], DECAY ** (i + j - 2)


def _norms(s: Strings) -> np.ndarray:
    return np.sqrt(np.maximum(_sums(s, lambda codes, w: np.float64(w * w)), 1e-9))


def _sums(s: Strings, value) -> np.ndarray:
    """Per string the sum of ``value(codes, weight)`` over its triples."""
    total = np.zeros(len(s.symbols) + 1)
    each = total[1:]
    for at, codes, w in _triples(s.symbols):
        each[at] += value(codes, w)
    np.cumsum(total, out=total)
    return total[s.end] - total[s.start]


def margins(s: Strings, weights: np.ndarray, bias: float) -> np.ndarray:
    return _sums(s, lambda codes, w: w * weights[codes]) / _norms(s) + bias


def _dense(s: Strings, chosen: np.ndarray) -> np.ndarray:
    """Normalised triple vectors of a few strings: (strings, triples)."""
    out = np.zeros((len(chosen), TRIPLES), dtype=np.float32)
    begin, finish = s.start[chosen], s.end[chosen]
    for at, codes, w in _triples(s.symbols):
        for k in range(len(chosen)):
            a, b = np.searchsorted(at, (begin[k], finish[k]))
            np.add.at(out[k], codes[a:b], w)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _kernel(s: Strings, chosen: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Kernel of the chosen strings (sorted) against the landmarks."""
    owner = np.full(len(s.symbols), -1)
    size = s.end[chosen] - s.start[chosen]
    at = np.repeat(s.start[chosen] - np.cumsum(size) + size, size) + np.arange(size.sum())
    owner[at] = np.repeat(np.arange(len(chosen)), size)
    by_triple = np.ascontiguousarray(landmarks.T)
    out = np.zeros((len(chosen), len(landmarks)))
    for at, codes, w in _triples(s.symbols):
        own = owner[at]
        codes, own = codes[own >= 0], own[own >= 0]
        if len(own):
            first = np.flatnonzero(np.diff(own, prepend=-1))
            out[own[first]] += w * np.add.reduceat(by_triple[codes], first, axis=0)
    return out / _norms(s)[chosen][:, None]


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 10.0) -> np.ndarray:
    """Linear support vector machine with squared hinge loss, by Newton steps; bias last."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6

    def loss(v):
        short = np.maximum(0, 1 - y * (x @ v))
        return v @ ridge @ v + cost * (weight * short * short).sum()

    for _ in range(60):
        inside = y * (x @ w) < 1
        xa, c = x[inside], cost * weight[inside]
        new = np.linalg.solve(ridge + xa.T @ (c[:, None] * xa), xa.T @ (c * y[inside]))
        step, before = 1.0, loss(w)
        while step > 1e-4 and loss(w + step * (new - w)) > before:
            step /= 2
        if step <= 1e-4 or np.allclose(new, w, atol=1e-6):
            break
        w = w + step * (new - w)
    return w


def fit(texts: list[str], toxic: list[int], rounds: int = 4) -> Model:
    label = np.array(toxic, dtype=int)
    if not len(label) or label.min() == label.max():
        share = 0.0 if not len(label) else float(label[0])
        return Model(np.zeros(TRIPLES, np.float32), 0.0, 0.0, 9.0 if share else -9.0)
    found = next(words(lowered(pa.array(texts, pa.string())), piece_bytes=1 << 40, spelled=True))
    s = _strings(found)
    # Documents of each class that hold a string.
    pair = np.unique(s.text.astype(np.int64) * len(s.hash) + s.which)
    text, which = pair // max(1, len(s.hash)), pair % max(1, len(s.hash))
    in_toxic = np.bincount(which[label[text] == 1], minlength=len(s.hash))
    in_clean = np.bincount(which[label[text] == 0], minlength=len(s.hash))
    rate = (in_toxic + 0.1) / label.sum(), (in_clean + 0.1) / (1 - label).sum()
    odds = np.where(_norms(s) > 1e-3, np.log(rate[0] / rate[1]) * np.log1p(in_toxic), -np.inf)
    mixed_hash = mixed(s.hash)
    clean = np.flatnonzero((in_clean > 0) & (_norms(s) > 1e-3))
    clean = clean[np.argsort(mixed_hash[clean])][:CLEAN_STRINGS]
    marks = np.unique(np.concatenate([np.argsort(-odds, kind="stable")[:LANDMARKS],
                                      clean[:LANDMARKS]]))
    dense = _dense(s, marks)
    values, vectors = np.linalg.eigh(dense.astype(np.float64) @ dense.T)
    big = values > 1e-6 * values.max()
    whiten = vectors[:, big] / np.sqrt(values[big])

    # Strings of toxic documents that stand out against the worst of nearly all clean ones.
    witness = _largest(odds, text, which, len(label))
    hard = witness[(label == 0) & (witness >= 0)]
    usual = np.quantile(odds[hard], 0.98) if len(hard) else -np.inf
    positive = np.flatnonzero((odds > usual) & (in_toxic > 0))
    if not len(positive):
        positive = np.unique(witness[(label == 1) & (witness >= 0)])
    times = np.maximum(in_toxic[positive] - 1, 0.5) ** 1.5
    negative = clean
    for _ in range(rounds):
        negative = np.setdiff1d(np.concatenate([negative, hard]), positive)
        x = np.concatenate([_kernel(s, positive, dense), _kernel(s, negative, dense)]) @ whiten
        y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
        weight = 100 * np.concatenate([
            times / times.sum(), np.full(len(negative), 1 / max(1, len(negative)))])
        w = _machine(x, y, weight)
        weights = ((whiten @ w[:-1]) @ dense).astype(np.float32)
        score = margins(s, weights, w[-1])
        # Clean strings the machine takes for toxic join the next round.
        witness = _largest(score, text, which, len(label))
        hard = witness[(label == 0) & (witness >= 0)]
    witness = _largest(score, text, which, len(label))
    top = np.where(witness >= 0, score[np.maximum(witness, 0)], -1.0)
    slope, offset = _calibrate(top, label)
    return Model(weights, float(w[-1]), slope, offset)


def _largest(score, text, which, n) -> np.ndarray:
    """String of the largest score of each text; -1 for a text without strings."""
    order = np.lexsort((which, score[which], text))
    out = np.full(n, -1)
    out[text[order]] = which[order]  # the last of a text wins
    return out


def _calibrate(x: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the margin, lightly regularised."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((p - label) * x).sum() + 1e-2 * a, (p - label).sum()])
        v = p * (1 - p)
        h = np.array([[(v * x * x).sum() + 1e-2, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
    return float(a), float(b)


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model: Model = shared.value
    for batch in batches:
        texts = batch.column("text")
        top = np.full(len(texts), -1.0)
        for found in words(lowered(texts), spelled=True):
            s = _strings(found)
            if len(s.which):
                value = margins(s, model.weights, model.bias)[s.which]
                own = np.full(found.last - found.first, -1.0)
                np.maximum.at(own, s.text, value)
                top[found.first:found.last] = own
        p = 1 / (1 + np.exp(-np.clip(model.slope * top + model.offset, -30, 30)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
            ["doc_id", "score", "predicted"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` documents of each label, those whose ids have the least hash."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    chosen = None
    for label in (0, 1):
        own = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id")
        own = own.limit(sample)
        chosen = own if chosen is None else chosen.union(own)
    # At most 2 x ``sample`` ids.
    texts = docs.select(F.col("doc_id").cast("long"), "text").where(
        F.length("text") <= SAMPLE_CHARS).join(F.broadcast(chosen), "doc_id")
    rows = sorted((r.doc_id, r.text, r.toxic) for r in texts.limit(4 * sample).collect())
    return fit([r[1] for r in rows], [r[2] for r in rows])


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted`` of every row of ``docs(doc_id, text)``.

    A null or empty text, or one without words, gets the score of the lowest margin. Rows are
    independent: null and repeated ids keep a row each. Other columns are ignored; an empty table
    gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda b: _score(b, shared), "doc_id long, score double, predicted int")


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    held_out = (F.coalesce(remainder("doc_id", 5), F.lit(1)) == 0).alias("held_out")
    return toxicity(docs, train(docs, labels)).select("doc_id", held_out, "score", "predicted")
