"""Personal data by candidate gradient boosting (7).

Generators with high recall propose spans, also overlapping ones: addresses spelled out, numbers
with unusual separators or without a prefix. Boosted trees judge each by its format and its
context; per kind a threshold calibrated on held-out candidates selects. What the strict patterns
find and their checks confirm is always kept; the trees only add spans that overlap none of it.

No span is labelled in the corpus, so the trees learn from the strict patterns: what they confirm,
as found and rewritten in the ways the generators allow, is personal data; what fails a check, also
after a digit is changed, and numbers cut from other strings are not. Every document gives its
candidates. Spark counts those that are alike, and each level of a tree is a pass over the counts;
only sums by node, feature and bin, and by kind and probability, reach the driver.
"""

from __future__ import annotations

import pickle
import random
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm import boosting
from tidebook.llm.registry import query, table
from tidebook.llm.stages import Stages
from tidebook.llm.words import slices

KINDS = ("email", "ip", "card", "phone")
#: Share of accepted held-out candidates that must be right.
PRECISION = 0.99
#: Steps of the probability at which a threshold may lie.
GRID = 4096
#: Tasks of a pass over the counted candidates at most: each sends its sums, 150 KB, to the driver.
TASKS = 128

# Strict patterns. A run of digits or of address characters is entered at its start only, so that
# a long run costs no square of its length; the matches are the same.
_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Generators.
_AT = r"(?:@|\x20?(?:\(at\)|\[at\]|\{at\})\x20?|\x20at\x20)"
_DOT = r"(?:\.|\x20?(?:\(dot\)|\[dot\]|\{dot\})\x20?|\x20dot\x20)"
_LOOSE = [
    (0, re.compile(
        rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}{_AT}[A-Za-z0-9-]{{1,63}}"
        rf"(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,6}}", re.I)),
    (1, re.compile(
        r"(?<![0-9.])[0-9]{1,3}(?:\x20?(?:\.|\[\.\]|\(\.\)|\x20dot\x20)\x20?[0-9]{1,3}){3}"
        r"(?![0-9])", re.I)),
    (2, re.compile(r"(?<![0-9])[0-9](?:[\x20./_-]{0,2}[0-9]){11,18}(?![0-9])")),
    (2, re.compile(r"(?<![0-9])[0-9]{12,19}(?![0-9])")),
    (3, re.compile(
        r"(?<![0-9])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[\x20./-]{0,2}\(?[0-9]{2,4}\)?){2,4}(?![0-9])")),
]
#: What a text needs for any pattern or generator to find something.
_ANY = re.compile(rf"[0-9]|{_AT}", re.I)

#: Words before a span that speak for personal data, and against it.
_FOR = frozenset("""tel telephone phone call fax mobile cell whatsapp contact mail email e-mail
    write reach ip host address addr from card visa mastercard pay payment account""".split())
_AGAINST = frozenset("""version release section chapter figure table isbn issn doi no number id
    order token hash page vol rev build model part""".split())


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        host = _HOST.match(text, at)
        if host:
            begin = at
            while begin > done and text[begin - 1] in _LOCAL_CHARS:
                begin -= 1
            if begin < at:
                yield begin, host.end()
                done = host.end()
        at = text.find("@", max(at + 1, done))


def strict(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of what the patterns find and the checks confirm, in order."""
    found = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        number = digits(m.group())
        if 12 <= len(number) <= 19 and luhn(number):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(digits(m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def loose(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of the generators' candidates."""
    return sorted({(m.start(), k, m.end()) for k, pattern in _LOOSE
                   for m in pattern.finditer(text)})


def _clear(found: list, taken: list) -> list:
    """Those of ``found`` that overlap none of ``taken``, which is in order."""
    starts, ends = [s[0] for s in taken], list(accumulate((s[2] for s in taken), max))
    return [c for c in found if not (at := bisect_left(starts, c[2])) or ends[at - 1] <= c[0]]


def features(text: str, start: int, kind: int, end: int) -> list[int]:
    """Format of the span, and what stands around it."""
    span = text[start:end]
    number = digits(span)
    groups = [len(g) for g in re.findall(r"[0-9]+", span)] or [0]
    letters = [len(g) for g in re.findall(r"[A-Za-z]+", span)] or [0]
    parts = [int(p) for p in re.findall(r"[0-9]{1,4}", span)] or [0]
    before = re.findall(r"[A-Za-z-]+", text[max(0, start - 24):start])
    cue = {w.lower() for w in before[-2:]}
    around = text[start - 1:start] + text[end:end + 1]
    return [
        kind == 0, kind == 1, kind == 2, kind == 3, len(span), len(number), len(groups),
        max(groups), min(groups), max(parts), len(letters), letters[-1], "@" in span,
        sum(span.count(c) for c in ".@"), span.count(" "), span.count("-"), span.count("("),
        span[0] == "+", span.startswith("00"), luhn(number), any(c.isalnum() for c in around),
        any(c in "\"'=#" for c in around), " at " in span, span.lower().count(" dot "),
        bool(cue & _FOR) - bool(cue & _AGAINST)]


FEATURES = len(features("0", 0, 0, 1))


@dataclass
class Model:
    trees: boosting.Boosted
    thresholds: list[float]  #: by kind


def _rewritten(kind: int, span: str, draw: random.Random) -> str:
    """A confirmed span as the generators would also find it."""
    if kind == 0:
        name, host = span.split("@", 1)
        at, dot = draw.choice([("(at)", "."), (" [at] ", " [dot] "), (" at ", " dot "),
                               (" (at) ", " (dot) "), ("@", "(dot)")])
        return f"{name}{at}{host.replace('.', dot)}"
    if kind == 1:
        return span.replace(".", draw.choice(["[.]", " . ", "(.)", " dot "]))
    number = digits(span)
    if kind == 2:
        return draw.choice([".", "/", "  ", "_"]).join(
            number[i:i + 4] for i in range(0, len(number), 4))
    sep = draw.choice([" ", "-", "."])
    tail = number[-10:]
    prefix = draw.choice(["", "", "00" + number[:-10] + sep])
    return f"{prefix}{tail[:3]}{sep}{tail[3:6]}{sep}{tail[6:]}"


def _broken(kind: int, span: str, draw: random.Random) -> str:
    """A confirmed span changed so that it is none."""
    if kind == 2:
        at = draw.choice([i for i, c in enumerate(span) if c.isdigit()])
        return span[:at] + str((int(span[at]) + draw.randint(1, 8)) % 10) + span[at + 1:]
    if kind == 1:
        return re.sub(r"[0-9]+", lambda m: str(draw.randint(256, 999)), span, count=2)
    if kind == 0:
        return span.replace("@", " at ")
    if draw.random() < 0.5:
        sep = draw.choice("-./")
        return (f"{draw.randint(1900, 2099)}{sep}{draw.randint(1, 12):02}{sep}"
                f"{draw.randint(1, 28):02} {draw.randint(0, 23):02}")
    return re.sub(r"[0-9]", lambda m: str(draw.randint(0, 9)), digits(span))[: draw.randint(3, 7)]


def examples(text: str) -> tuple[list[list[int]], list[int]]:
    """Features and labels of the weakly labelled candidates of a text."""
    x, y = [], []

    def add(text: str, start: int, kind: int, end: int, label: int) -> None:
        x.append(features(text, start, kind, end))
        y.append(label)

    sure = strict(text)
    if not sure:
        return x, y
    draw = random.Random(zlib.crc32(text.encode()))
    for start, kind, end in sure:
        add(text, start, kind, end, 1)
        for label, span in ((1, _rewritten(kind, text[start:end], draw)),
                            (0, _broken(kind, text[start:end], draw))):
            near = text[max(0, start - 40):start]
            changed = near + span + text[end:end + 20]
            kept = {s for s in strict(changed) if s[1] == kind}
            for a, k, b in loose(changed):
                if k == kind and a < len(near) + len(span) and b > len(near):
                    exact = (a, b) == (len(near), len(near) + len(span))
                    if (a, k, b) not in kept:
                        add(changed, a, k, b, int(label and exact))
    found = loose(text)
    for start, kind, end in sorted(set(found) - set(_clear(found, sure)) - set(sure)):
        add(text, start, kind, end, 0)
    return x, y


def _held(text: str) -> bool:
    """Whether a text's candidates are for the thresholds, as those of a quarter of the texts."""
    return zlib.crc32(text.encode()) % 4 == 0


COUNTED = "held boolean, x array<int>, n long, yes long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of texts, and how many are alike."""
    for batch in slices(batches):
        rows = []
        for text in batch.column("text").to_pylist():
            x, y = examples(text)
            held = _held(text)
            rows += [(held, label, *values) for values, label in zip(x, y, strict=True)]
        if rows:
            alike, n = np.unique(np.array(rows, dtype=np.int32), axis=0, return_counts=True)
            values = pa.array(np.ascontiguousarray(alike[:, 2:]).ravel())
            at = pa.array(np.arange(len(alike) + 1) * FEATURES, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(alike[:, 0] == 1), pa.ListArray.from_arrays(at, values),
                 pa.array(n.astype(np.int64)), pa.array(n * alike[:, 1].astype(np.int64))],
                ["held", "x", "n", "yes"])


@dataclass
class Block(boosting.Block):
    kind: np.ndarray


def _block(x: np.ndarray, n: np.ndarray, yes: np.ndarray, edges: list[np.ndarray]) -> Block:
    return Block(boosting.binned(x, edges), n, yes, x[:, :len(KINDS)].argmax(axis=1))


def _by_chance(block: Block, trees: boosting.Boosted) -> np.ndarray:
    """Numbers of candidates, and of right ones, by kind and step of the probability."""
    at = block.kind * (GRID + 1) + (trees.probability(block.bins) * GRID).astype(np.int64)
    return np.stack([np.bincount(at, v, len(KINDS) * (GRID + 1)).reshape(len(KINDS), -1)
                     for v in (block.n, block.yes)]).astype(np.int64)


def _model(learned: boosting.Total, held: boosting.Total, edges: list[np.ndarray]) -> Model:
    trees, by_bin = boosting.fit(learned, edges)
    n, yes = np.zeros((2, len(KINDS), GRID + 1), np.int64) + held(lambda b: _by_chance(b, by_bin))
    thresholds = []
    for kind in range(len(KINDS)):
        every, right = np.cumsum(n[kind][::-1])[::-1], np.cumsum(yes[kind][::-1])[::-1]
        good = np.flatnonzero((n[kind] > 0) & (right >= PRECISION * every))
        # Without evidence nothing is added.
        thresholds.append(max(0.5, float(good[0] / GRID)) if len(good) else 2.0)
    return Model(trees, thresholds)


def fit(texts: list[str]) -> Model:
    """Trees from three quarters of the texts, thresholds from the rest."""
    rows = [(_held(t), label, *x) for t in texts
            for x, label in zip(*examples(t), strict=True)]
    array = np.array(rows, dtype=np.int64).reshape(len(rows), FEATURES + 2)
    held, label, x = array[:, 0] == 1, array[:, 1], array[:, 2:]
    edges = [np.unique(np.quantile(v, boosting.CUTS)) if len(v) else v for v in x[~held].T]
    one = np.ones(len(rows), dtype=np.int64)
    own, rest = (_block(x[s], one[s], label[s], edges) for s in (~held, held))
    return _model(lambda f: f(own), lambda f: f(rest), edges)


def spans(text: str, model: Model | None) -> tuple[list, list]:
    """Strict spans, and all spans, each ``start, kind, end`` in order."""
    return _spans([text], model)[0]


def _spans(texts: list[str], model: Model | None) -> list[tuple[list, list]]:
    """``spans`` of each text; the trees judge all candidates at once."""
    sure = [strict(t) if _ANY.search(t) else [] for t in texts]
    if model is None:
        return [(s, s) for s in sure]
    free = [_clear(loose(t), s) if _ANY.search(t) else [] for t, s in zip(texts, sure, strict=True)]
    x = [features(t, *c) for t, own in zip(texts, free, strict=True) for c in own]
    chances = iter(model.trees.probability(np.array(x, dtype=np.float64)).tolist() if x else [])
    out = []
    for s, own in zip(sure, free, strict=True):
        starts: list[int] = []
        added: list = []  # in order; they overlap none of each other
        for chance, c in sorted(((next(chances), c) for c in own), key=lambda v: (-v[0], v[1])):
            if chance >= model.thresholds[c[1]]:
                at = bisect_left(starts, c[2])
                if not at or added[at - 1][2] <= c[0]:
                    starts.insert(at, c[0])
                    added.insert(at, c)
        out.append((s, sorted(s + added)))
    return out


def _find(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                      ("strict", pa.bool_())])
    for batch in slices(batches):
        out = []
        for sure, found in _spans([t or "" for t in batch.column("text").to_pylist()],
                                  shared.value):
            known = set(sure)
            out.append([{"kind": KINDS[k], "start": a, "end": b, "strict": (a, k, b) in known}
                        for a, k, b in found])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(out, pa.list_(kind))], ["doc_id", "spans"])


FOUND = ("doc_id long, "
         "spans array<struct<kind: string, start: long, end: long, strict: boolean>>")


def _total(rows: DataFrame, edges: list[np.ndarray]):
    """The rows as blocks kept by the executors, and a function that sums over them."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, FEATURES)
            block = _block(x, batch.column("n").to_numpy(), batch.column("yes").to_numpy(), edges)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)])], ["block"])

    tasks = min(TASKS, rows.sparkSession.sparkContext.defaultParallelism)
    kept = rows.select("x", "n", "yes").coalesce(tasks).mapInArrow(blocks, "block binary").rdd.map(
        lambda r: pickle.loads(r.block)).persist(StorageLevel.MEMORY_AND_DISK)
    return kept, lambda f: sum(kept.mapPartitions(lambda own: [sum(map(f, own))]).collect())


def train(docs: DataFrame) -> Model:
    """Fit on the candidates of every document of ``docs(text)``, however long it is."""
    stages = Stages(docs.sparkSession, "personal-data")
    # Without a digit or an @ there is no strict span, and so no candidate to learn from.
    found = docs.where(F.col("text").rlike("[0-9@]")).select("text").mapInArrow(_counted, COUNTED)
    counted = stages.write(found.groupBy("held", "x").agg(
        F.sum("n").alias("n"), F.sum("yes").alias("yes")), "candidates")
    cuts = F.array(*map(F.lit, boosting.CUTS))
    row = counted.where("not held").agg(*[
        F.percentile(F.col("x")[k], cuts, F.col("n")).alias(f"e{k}")
        for k in range(FEATURES)]).first()
    edges = [np.unique(np.array(e or [], dtype=np.float64)) for e in row]
    kept, sums = zip(*[_total(counted.where(side), edges) for side in ("not held", "held")],
                     strict=True)
    model = _model(*sums, edges)
    for blocks in kept:
        blocks.unpersist()
    stages.drop(counted)
    return model


def personal_data(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, spans`` of every row of ``docs(doc_id, text)``; offsets count code points.

    Spans are in order of their start, then of their kind; strict ones may overlap each other. A
    null or empty text has none. Without a model only strict spans are found. Rows are independent:
    null and repeated ids keep a row each. Other columns are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda b: _find(b, shared), FOUND)


def redact(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, text`` with every found span replaced by its kind in brackets."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def cleared(batches):
        for batch in slices(batches):
            out = []
            texts = batch.column("text").to_pylist()
            found = _spans([t or "" for t in texts], shared.value)
            for text, (_, own) in zip(texts, found, strict=True):
                done, parts = 0, []
                for a, k, b in own:
                    if b > done:
                        parts += [text[done:max(a, done)], f"[{KINDS[k]}]"]
                        done = b
                out.append(None if text is None else "".join(parts) + text[done:])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        cleared, "doc_id long, text string")


@query("op7_personal_data")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = personal_data(docs, train(docs))
    base = F.filter("spans", lambda s: s["strict"])

    def joined(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"))
