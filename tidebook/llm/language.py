"""Language identification by a linear-chain conditional random field (2).

Every word of a text gets a label. A word's emission scores come from its affixes, its byte n-grams
and the word itself (the lexicon); learned transitions tie neighbours, so a text may switch between
languages. Forward-backward gives each word's marginals; a text's language is the label with the
largest share of them. Everything works on arrays over the bytes of many texts.

Weights are fitted on the driver on a bounded sample: ``SAMPLE`` chains, each of a few dozen words
of one labelled text, or of two joined to teach the transitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidebook.llm.registry import query, table
from tidebook.llm.words import Words, lowered, slices, span_hasher, words

#: Labelled texts learned from at most, words and characters taken from each at most.
SAMPLE, SAMPLE_WORDS, SAMPLE_CHARS = 1500, 48, 4000
#: Words of one chain: a longer text is several chains, of which each goes on where one ends.
CHAIN = 64
#: Entries of each weight table.
TABLE = 1 << 16
UNDETERMINED = "und"
#: ASCII characters that are no letters end a word, as white space does.
_BREAKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalpha())
_LETTER = regex.compile(r"\p{L}")
#: Byte lengths of the prefixes and suffixes that are features; n-grams have two and three bytes.
PREFIXES, SUFFIXES, GRAMS = (1, 2, 3), (1, 2, 3, 4), 2


@dataclass
class Model:
    labels: list[str]
    spans: np.ndarray  #: affix and lexicon weights by hash: (kinds, labels, TABLE)
    grams: np.ndarray  #: n-gram weights by hash: (sizes, labels, TABLE)
    transitions: np.ndarray
    initial: np.ndarray


def _span_features(found: Words) -> np.ndarray:
    """Table entries of each word's affixes and of the word itself: (kinds, words)."""
    hashes = span_hasher(found.data)
    out = [hashes(found.start, np.minimum(found.start + n, found.end)) for n in PREFIXES]
    out += [hashes(np.maximum(found.end - n, found.start), found.end) for n in SUFFIXES]
    return (np.stack([*out, found.hash]) % np.uint64(TABLE)).astype(np.int32)


def _gram_features(found: Words) -> np.ndarray:
    """Table entries of the two and three bytes from each byte on: (sizes, bytes).

    What follows a word counts as its end; what follows a text as a space.
    """
    n = len(found.data)
    one = np.append(found.data, [32, 32]).astype(np.int64)
    second, third = one[1:n + 1].copy(), one[2:n + 2].copy()
    ends = found.text_at[1:]
    for back, ahead in ((1, second), (1, third), (2, third)):
        at = ends - back
        ahead[at[(at >= 0) & (at < n)]] = 32
    two = one[:n] * 256 + second
    return np.stack([two, (two * 256 + third) * 2654435761 % (1 << 32) // TABLE]).astype(np.int32)


def _emissions(found: Words, model: Model) -> np.ndarray:
    """Scores (words, labels): affix and lexicon weights, and the mean weight of the n-grams."""
    spans, grams = _span_features(found), _gram_features(found)
    length = (found.end - found.start).astype(np.float64)
    scores = np.empty((len(found.hash), len(model.labels)), np.float32)
    total = np.zeros(len(found.data) + 1)
    for k in range(len(model.labels)):
        own = sum(table[k][entries] for table, entries in zip(model.spans, spans, strict=True))
        each = sum(table[k][entries] for table, entries in zip(model.grams, grams, strict=True))
        np.cumsum(each, dtype=np.float64, out=total[1:])
        scores[:, k] = own + (total[found.end] - total[found.start]) / length
    return scores


def _chains(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and length of the chains of texts whose words begin at ``at``."""
    counts = np.diff(at)
    number = -(-counts // CHAIN)
    text = np.repeat(np.arange(len(counts)), number)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    first = at[:-1][text] + nth * CHAIN
    return first, np.minimum(at[1:][text] - first, CHAIN)


def _normalised(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=1, keepdims=True)


def _marginals(scores: np.ndarray, first: np.ndarray, length: np.ndarray, model: Model,
               with_pairs: bool = False):
    """Label probabilities of each word by forward-backward over all chains at once.

    With pairs also the expected transitions, summed.
    """
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    steps = int(length.max(initial=0))
    live = [int(np.searchsorted(-length, -t, side="left")) for t in range(steps)]
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    move = np.exp(model.transitions)
    forward = np.empty_like(emit)
    for t in range(steps):
        at = first[:live[t]] + t
        before = forward[at - 1] @ move if t else np.exp(model.initial)[None, :]
        forward[at] = _normalised(before * emit[at] + 1e-30)
    out = np.empty_like(emit)
    pairs = np.zeros_like(move)
    back = np.ones((len(first), emit.shape[1]), dtype=emit.dtype)
    for t in range(steps - 1, -1, -1):
        at = first[:live[t]] + t
        out[at] = _normalised(forward[at] * back[:live[t]] + 1e-30)
        if t:
            ahead = emit[at] * back[:live[t]]
            if with_pairs:
                joint = forward[at - 1][:, :, None] * move[None] * ahead[:, None, :]
                pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            back[:live[t]] = _normalised(ahead @ move.T + 1e-30)
    return (out, pairs) if with_pairs else out


def fit(texts: list[str], langs: list[str], epochs: int = 5, rate: float = 0.3,
        decay: float = 1e-6) -> Model:
    """Weights by stochastic gradient steps on the likelihood of labelled chains."""
    labels = sorted(set(langs))
    n = len(labels)
    model = Model(
        labels, np.zeros((len(PREFIXES) + len(SUFFIXES) + 1, n, TABLE), np.float32),
        np.zeros((GRAMS, n, TABLE), np.float32), np.zeros((n, n), np.float32),
        np.zeros(n, np.float32))
    if n < 2:
        return model
    tables = [model.spans, model.grams, model.transitions, model.initial]
    squares = [np.full_like(x, 1e-2) for x in tables]
    found = next(words(lowered(pa.array(texts, pa.string())), _BREAKS, piece_bytes=1 << 40))
    counts = np.minimum(np.diff(found.word_at), SAMPLE_WORDS)
    spans, grams = _span_features(found), _gram_features(found)
    tag = np.repeat([labels.index(x) for x in langs], np.diff(found.word_at))
    draw = np.random.default_rng(7)
    usable = np.flatnonzero(counts)
    for _ in range(epochs):
        # Half of the chains are two texts joined somewhere: there the language changes.
        order = draw.permutation(usable)
        for batch in np.array_split(order, max(1, len(order) // 64)):
            half = len(batch) // 2
            chains = [[b] for b in batch[:half]] + [
                list(p) for p in zip(batch[half::2], batch[half + 1::2], strict=False)]
            picked, first, length = [], [], []
            for chain in chains:
                start = sum(map(len, picked))
                for text in chain:
                    take = counts[text] if len(chain) == 1 else draw.integers(1, counts[text] + 1)
                    picked.append(found.word_at[text] + np.arange(take))
                first.append(start)
                length.append(sum(map(len, picked)) - start)
            if not picked:
                continue
            word = np.concatenate(picked)
            own = Words(0, 0, found.data, found.text_at, found.start[word], found.end[word],
                        found.hash[word], found.word_at)
            first, length = np.array(first), np.array(length)
            scores = _emissions(own, model)
            expected, pairs = _marginals(scores, first, length, model, with_pairs=True)
            wrong = -expected
            wrong[np.arange(len(word)), tag[word]] += 1
            step = [np.zeros_like(x) for x in tables[2:]]
            same = np.setdiff1d(np.arange(1, len(word)), first)
            np.add.at(step[0], (tag[word][same - 1], tag[word][same]), 1)
            step[0] -= pairs
            starts = np.zeros((len(first), n), np.float32)
            starts[np.arange(len(first)), tag[word][first]] = 1
            chance = np.exp(model.initial - model.initial.max())
            step[1] += (starts - chance / chance.sum()).sum(axis=0)
            for x, g, s in zip(tables[2:], step, squares[2:], strict=True):
                s += g * g
                x += rate * g / np.sqrt(s)
            for k in range(len(model.spans)):
                _add(model.spans[k], squares[0][k], spans[k][word], wrong, rate, decay)
            size = own.end - own.start
            byte = np.repeat(own.start - np.cumsum(size) + size, size) + np.arange(size.sum())
            share = np.repeat(wrong / size[:, None], size, axis=0)
            for k in range(GRAMS):
                _add(model.grams[k], squares[1][k], grams[k][byte], share, rate, decay)
    return model


def _add(weights, squares, entries, gradient, rate, decay) -> None:
    """One adaptive step on the entries of a table that a batch touches."""
    touched, inverse = np.unique(entries, return_inverse=True)
    for k in range(len(weights)):
        g = np.bincount(inverse, gradient[:, k], len(touched)) - decay * weights[k][touched]
        squares[k][touched] += g * g
        weights[k][touched] += rate * g / np.sqrt(squares[k][touched])


def train(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` rows of ``labelled(doc_id, text, lang)``, those of least hash."""
    rows = labelled.where("lang is not null and text is not null").withColumn(
        "_h", F.xxhash64("doc_id"))
    hashes = rows.select("_h").orderBy("_h").limit(sample)
    bound = hashes.agg(F.max("_h").alias("m")).first().m
    if bound is None:
        return fit([], [])
    chosen = rows.where(F.col("_h") <= bound).select(
        F.substring("text", 1, SAMPLE_CHARS).alias("text"), "lang").limit(sample).collect()
    chosen = sorted((r.text, r.lang) for r in chosen if _LETTER.search(r.text))
    return fit([" ".join(t.split()[:SAMPLE_WORDS]) for t, _ in chosen], [x for _, x in chosen])


def _labels(texts: pa.Array, model: Model) -> tuple[pa.Array, pa.Array]:
    """Language and share of each text."""
    labels = np.array([*model.labels, UNDETERMINED], dtype=object)
    # Letters of any script count; bytes alone don't tell them from other characters.
    letters = np.array([bool(t and _LETTER.search(t)) for t in texts.to_pylist()], dtype=bool)
    best = np.full(len(texts), len(model.labels))
    share = np.zeros(len(texts))
    for found in words(lowered(texts), _BREAKS):
        counts = np.diff(found.word_at)
        sums = np.zeros((len(counts), max(1, len(model.labels))))
        if len(found.hash) and model.labels:
            scores = _emissions(found, model)
            first, length = _chains(found.word_at)
            total = np.zeros((len(scores) + 1, scores.shape[1]))
            np.cumsum(_marginals(scores, first, length, model), axis=0, out=total[1:])
            sums = total[found.word_at[1:]] - total[found.word_at[:-1]]
        some = letters[found.first:found.last] & (counts > 0) & bool(model.labels)
        top = sums.argmax(axis=1)
        value = sums[np.arange(len(top)), top] / np.maximum(counts, 1)
        best[found.first:found.last] = np.where(some, top, len(model.labels))
        share[found.first:found.last] = np.where(some, np.clip(value, 0, 1), 0)
    return pa.array(labels[best], pa.string()), pa.array(share)


def annotate(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, which replace columns of these names.

    ``und`` with score 0 if the text is null, empty or has no letter, or if the model knows no
    label. Rows are independent: null and repeated ids keep a row each. Ties go to the label that
    sorts first. An empty table gives no rows.
    """
    rows = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = rows.columns.index("text")

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *_labels(batch.column(place), shared.value)],
                [*batch.schema.names, "lang_pred", "score"])

    schema = StructType([*rows.schema.fields, StructField("lang_pred", StringType()),
                         StructField("score", DoubleType())])
    return rows.mapInArrow(added, schema)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row of ``docs``, as ``annotate`` gives them."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return annotate(rows, model).drop("text")


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(column).cast("long").cast("string").cast("binary")) % divisor


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(remainder("doc_id", 3) != 1))
    return identify(docs, model).select(
        "doc_id", (F.coalesce(remainder("doc_id", 3), F.lit(0)) == 1).alias("held_out"),
        "lang_pred", "score")
