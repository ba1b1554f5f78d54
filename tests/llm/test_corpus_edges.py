"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import numpy as np
import pyarrow as pa
import pytest

from tidebook.llm import (
    decontamination,
    language,
    licenses,
    near_copies,
    packing,
    personal_data,
    repeated_lines,
    token_counts,
    topk,
    toxicity,
)
from tidebook.llm.encoding import LONG_RUN, _own, encode
from tidebook.llm.words import shingle_sets, words

DOCS = "doc_id long, text string, rank int, bucket string, score double, runs string, n long"
LONG = " ".join(f"w{i % 997}" for i in range(60_000))
LINE = " ".join(f"word{i}" for i in range(55))
TEXTS = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "..."), (5, LONG), (6, LINE), (6, LINE),
    (None, LINE), (None, None), (7, "idiot é " + LINE + "\nend"), (8, "two words"), (8, "other text"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, 1, "b", 0.5, "r", 3) for r in TEXTS]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_line_dedup(docs, none):
    out = by_id(repeated_lines.drop_repeated_lines(docs))
    assert sum(map(len, out.values())) == len(TEXTS)
    assert out[1][0].text is None and out[1][0].n_lines == 0
    assert out[2][0].text == "" and out[2][0].n_lines == 0
    # The row without an id comes first; later copies of its line go, equal rows alike.
    assert {r.text for r in out[None]} == {None, LINE}
    assert [(r.text, r.n_removed) for r in out[6]] == [("", 1)] * 2
    assert out[7][0].n_removed == 0 and out[8][0].n == 3
    assert repeated_lines.drop_repeated_lines(none).count() == 0


def test_line_dedup_finds_runs_of_short_lines(spark):
    lines = [f"line {i} of a longer passage here" for i in range(10)]
    rows = [(1, "\n".join(["a", *lines, "b"])), (2, "\n".join(["c", *lines, "d"])),
            (3, "\n".join(lines[:3])), (4, "\n".join([*lines, *lines]))]
    out = by_id(repeated_lines.drop_repeated_lines(
        spark.createDataFrame(rows, "doc_id long, text string")))
    assert out[1][0].n_removed == 0 and out[2][0].text == "c\nd"
    assert out[3][0].n_removed == 0  # fewer than 50 words
    assert out[4][0].text == "" and out[4][0].n_removed == 20


def test_language(spark, docs, none):
    model = language.fit(["the cat sat on the mat"] * 20 + ["le chat est sur la table"] * 20,
                         ["en"] * 20 + ["fr"] * 20)
    out = by_id(language.identify(docs, model))
    assert sum(map(len, out.values())) == len(TEXTS)
    for doc in (1, 2, 3, 4):
        assert (out[doc][0].lang_pred, out[doc][0].score) == ("und", 0.0)
    assert out[6][0] == out[6][1]
    assert language.identify(none, model).count() == 0
    mixed = spark.createDataFrame(
        [(1, "the cat sat on the mat"), (2, "le chat est sur la table")], "doc_id long, text string")
    assert [r[0].lang_pred for r in by_id(language.identify(mixed, model)).values()].count("en") == 1
    unknown = language.train(none.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert {r.lang_pred for r in language.identify(docs, unknown).collect()} == {"und"}
    assert language.annotate(docs, model).columns[-2:] == ["lang_pred", "score"]


def test_language_marginals_against_all_paths():
    from itertools import product

    draw = np.random.default_rng(0)
    model = language.Model(["a", "b"], None, None, draw.normal(size=(2, 2)), draw.normal(size=2))
    scores = draw.normal(size=(5, 2))
    got = language._marginals(scores, np.array([0]), np.array([5]), model)
    want = np.zeros((5, 2))
    for path in product((0, 1), repeat=5):
        weight = np.exp(model.initial[path[0]] + sum(scores[t, k] for t, k in enumerate(path))
                        + sum(model.transitions[a, b] for a, b in zip(path, path[1:], strict=False)))
        for t, k in enumerate(path):
            want[t, k] += weight
    assert got == pytest.approx(want / want.sum(axis=1, keepdims=True))


def test_licenses(spark, none):
    mit = "Released under the MIT License."
    rows = [(1, "a/LICENSE", mit), (2, "a/b/c/x.py", "code"), (3, "a/b/LICENSE.txt", "nothing here"),
            (4, "a/b/y.py", "# Licensed under the Apache License, Version 2.0.\ncode"),
            (5, "z/x.py", None), (6, None, ""), (6, None, ""), (None, "/r/s/t.c", "x"),
            (7, "/r/COPYING", "all rights reserved"), (8, "top.py", "x")]
    files = spark.createDataFrame(rows, "file_id long, path string, text string")
    out = {r.file_id: r for r in licenses.scan(files).collect()}
    assert licenses.scan(files).count() == len(rows)
    assert [out[i].license for i in (1, 2, 3, 4, 5, 6, None, 7, 8)] == [
        "MIT", "MIT", "MIT", "Apache-2.0", None, None, "proprietary", "proprietary", None]
    assert out[2].inherited_from == "a/LICENSE" and out[None].inherited_from == "/r/COPYING"
    empty = none.selectExpr("doc_id as file_id", "text as path", "text")
    assert licenses.scan(empty).count() == 0


def test_packing(docs, none):
    rows = packing.pack(docs).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    pieces = sorted((r for r in rows if r.doc_id == 5), key=lambda r: r.piece)
    ids = encode("byte_bpe_50k.json", [LONG])[0]
    assert sum(r.length for r in pieces) == len(ids) + 1 and len(pieces) > 10
    assert [r.length for r in rows if r.doc_id == 1] == [1]
    assert packing.pack(none).count() == 0


def test_near_copies(docs, none):
    out = by_id(near_copies.near_copies(docs, percent=85))
    assert sum(map(len, out.values())) == len(TEXTS)
    for doc in (1, 2, 3):
        assert (out[doc][0].n_shingles, out[doc][0].component_id, out[doc][0].kept) == (0, doc, True)
    assert [r.kept for r in out[6]] == [True, True]
    with_text = [r for r in out[None] if r.n_shingles]
    assert [(r.component_id, r.kept) for r in with_text] == [(6, False)]
    assert {r.n_shingles for r in out[8]} == {1}
    assert near_copies.near_copies(none).count() == 0


def test_near_copies_of_a_chain_and_a_crowd(spark):
    """A chain of edits is one component though its ends differ; strangers stay apart."""
    base = [f"w{i}" for i in range(200)]
    rows, chain = [], list(base)
    for i in range(8):
        rows.append((i + 1, " ".join(chain)))
        chain[i * 20] = f"changed{i}"
    for i in range(40):  # share a third with each other, never enough
        rows.append((100 + i, " ".join(base[:60] + [f"own{i}x{j}" for j in range(120)])))
    out = by_id(near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), 85))
    assert {r[0].component_id for d, r in out.items() if d <= 8} == {1}
    assert all(r[0].component_id == d for d, r in out.items() if d >= 100)


def test_sketches_differ_no_more_than_their_sets():
    rng = np.random.default_rng(5)

    class Even:
        value = np.zeros(near_copies.ORDER, dtype=np.int64)

    base = rng.integers(0, 1 << 62, 3000)
    sets = [np.concatenate([base[:n], rng.integers(0, 1 << 62, own)])
            for n in (1, 200, 3000) for own in (0, 3, 30, 700)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([bytes([i]) for i in range(len(sets))]), pa.array(sets, pa.list_(pa.int64()))],
        ["class", "shingles"])
    found = next(near_copies._prefixes(iter([batch]), Even, 85)).to_pylist()
    close = 0
    for x, row in zip(sets, found, strict=True):
        for y, other in zip(sets, found, strict=True):
            apart = sum(((row[c] ^ other[c]) % (1 << 64)).bit_count() for c in near_copies.SKETCH)
            differ = len(set(x.tolist()) ^ set(y.tolist()))
            assert apart <= differ and (apart > 0) == (differ > 0)
            close += differ <= 60 and apart >= 0.9 * differ
    assert close > len(sets)


def test_components_against_plain_search(spark, tmp_path):
    from tidebook.llm.components import components
    from tidebook.llm.stages import Stages

    rng = np.random.default_rng(2)
    edges = [tuple(map(int, e)) for e in rng.integers(0, 300, (190, 2))]
    edges += [(i, i + 1) for i in range(1000, 1040)] + [(5000, i) for i in range(4000, 4100)]
    parent = {n: n for e in edges for n in e if e[0] != e[1]}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    stages = Stages(spark, "components-test")
    table = spark.createDataFrame(edges + edges[:50], "a long, b long")
    got = [tuple(r) for r in components(table, stages).collect()]
    assert sorted(got) == sorted((n, root(n)) for n in parent)
    assert components(table.limit(0), stages).count() == 0


def test_shingles_against_tuples():
    import re

    texts = ["", " ", "a", "A  b\tc d", "a b c d e", "a b c d e f a b c d e", "é ü\x0bx", "x" * 50]
    got = [s for w in words(pa.array(texts)) for s in shingle_sets(w, 5)]
    for text, found in zip(texts, got, strict=True):
        w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
        want = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        assert len(found) == len(want)
    assert got[4].tolist()[0] in got[5].tolist()


def test_toxicity(spark, docs, none):
    clean = [f"the {w} of them was there" for w in "sun moon tree house river cloud stone".split()]
    bad = [f"you {w} go away" for w in ("idiot", "idiot", "moron", "moron", "idiots")]
    model = toxicity.fit(clean * 10 + bad * 8, [0] * 70 + [1] * 40)
    out = by_id(toxicity.toxicity(docs, model))
    assert sum(map(len, out.values())) == len(TEXTS)
    assert out[7][0].predicted == 1 and out[8][0].predicted == 0
    assert out[1][0].score == out[2][0].score and out[6][0] == out[6][1]
    odd = ["i d i o t", "id-iot", "i.d.i.o.t", "mo_ron", "the tree there"]
    rows = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    assert [r[0].predicted for _, r in sorted(by_id(toxicity.toxicity(rows, model)).items())] == [
        1, 1, 1, 1, 0]
    assert toxicity.toxicity(none, model).count() == 0
    untaught = toxicity.train(docs, none.selectExpr("doc_id", "1 as toxic"))
    assert toxicity.toxicity(docs, untaught).where("predicted = 1").count() == 0


def test_triple_kernel_against_its_definition():
    """The machine's weights give the same value as the kernel against the landmarks."""
    found = next(words(pa.array(["idiot i-diot banana trash"])))
    s = toxicity._strings(found)
    dense = toxicity._dense(s, np.arange(len(s.hash)))
    kernel = toxicity._kernel(s, np.arange(len(s.hash)), dense)
    for k in range(len(s.hash)):
        assert toxicity.margins(s, dense[k], 0.0) == pytest.approx(kernel[:, k], rel=1e-4)


def test_personal_data(docs, none, spark):
    assert {len(r.spans) for r in personal_data.personal_data(docs, None).collect()} == {0}
    assert personal_data.personal_data(none, None).count() == 0
    text = "é a.b@c.de, 10.0.0.1, 4111 1111 1111 1111, +1 (555) 010-9999"
    rows = spark.createDataFrame([(1, text), (2, "9" * 100_000), (3, "a" * 100_000)],
                                 "doc_id long, text string")
    out = by_id(personal_data.personal_data(rows, None))
    assert [s.kind for s in out[1][0].spans] == ["email", "ip", "card", "phone"]
    assert text[out[1][0].spans[0].start:out[1][0].spans[0].end] == "a.b@c.de"
    assert out[2][0].spans == out[3][0].spans == []
    cleared = by_id(personal_data.redact(rows, None))
    assert cleared[1][0].text == "é [email], [ip], [card], [phone]"


def test_added_personal_data_keeps_off_strict_spans():
    cards = ["4111111111111111", "5500005555555559", "340000000000009"]
    texts = [f"pay {cards[i % 3]} or write u{i}@mail.example.com or call +1 (555) 010-{1000 + i}"
             f" from 10.{i}.2.3 today" for i in range(200)]
    model = personal_data.fit(texts)
    sure, found = personal_data.spans("write to jo (at) mail (dot) example (dot) com, ok", model)
    assert sure == [] and len(found) <= 1
    sure, found = personal_data.spans(texts[3], model)
    assert set(sure) <= set(found)
    for a, _, b in set(found) - set(sure):
        assert not any(a < s[2] and s[0] < b for s in sure)


def test_top_k(spark):
    rows = [(1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [1.0, 0.5]), (4, [-1.0, 0.0]), (5, None),
            (6, [None, 1.0]), (7, [float("nan"), 1.0]), (8, [float("inf"), 0.0]), (9, []),
            (None, [1.0, 0.5]), (10, [0.001, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    df = df.selectExpr("*", "1 as rank", "2 as score")
    out = [tuple(r) for r in topk.top_k(df, df.where("vec_id in (1, 5, 6)"), 3).orderBy(
        "query_id", "rank").collect()]
    score = 256 * 256 + 128 * 128
    assert out == [(1, 1, 2, score), (1, 2, 3, score), (1, 3, 10, 0)]
    few = topk.top_k(df.where("vec_id in (1, 4)"), df.where("vec_id = 1"), 3)
    assert [tuple(r) for r in few.collect()] == [(1, 1, 4, -256 * 256)]
    assert topk.top_k(df.limit(0), df, 3).count() == 0
    assert topk.top_k(df, df.limit(0), 3).count() == 0


def test_token_counts_use_and_fill_the_cache(spark, docs, none, tmp_path):
    cache = str(tmp_path / "cache")
    out = by_id(token_counts.token_counts(docs, cache))
    assert sum(map(len, out.values())) == len(TEXTS)
    assert (out[1][0].n_bytes, out[1][0].n_tokens) == (0, 0)
    assert out[5][0].over_limit
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() == len(
        {t or "" for _, t in TEXTS})
    token_counts.token_counts(docs, cache).collect()
    assert spark.read.parquet(cache).count() == stored.count()
    assert token_counts.token_counts(none, cache).count() == 0


def test_encoding_equals_the_library():
    texts = ["", " ", "a  b\n\n c", "<|endoftext|> x <|endoftext|>", "é" * (LONG_RUN + 1),
             "x" * (LONG_RUN * 2), " " * (LONG_RUN + 5) + "z", "don't 123 ... \t\r\n", "日本語 текст"]
    assert encode("byte_bpe_50k.json", texts) == _own("byte_bpe_50k.json")(texts)


def test_decontamination(spark, docs, none):
    item = "What is the tallest tower of the old harbour town? The answer is the lantern tower."
    benchmark = spark.createDataFrame(
        [(1, item), (2, None), (3, ""), (4, "?!"), (None, LINE)], "item_id long, text string")
    near = item.replace("tallest", "highest").replace("old ", "")
    other = "What is the tallest tower of the old harbour town? Nobody could ever tell us that."
    filler = " ".join(f"filler{i}" for i in range(90))
    rows = [(1, f"{filler} {item.upper()} {filler}"), (2, f"{filler}\n{near}"), (3, other),
            (4, filler), (5, None), (6, "")]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(more, benchmark).collect()} == {
        (1, 1), (2, 1)}
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, benchmark).collect()} == {
        (6, None), (None, None), (7, None)}
    assert decontamination.leaks(none, benchmark).count() == 0
    assert decontamination.leaks(docs, benchmark.limit(0)).count() == 0


def test_latent_space_against_a_dense_decomposition(spark):
    texts = [f"alpha beta gamma{i % 3} delta{i % 5}" for i in range(30)]
    found = next(words(pa.array(texts)))
    terms = np.unique(found.hash)
    weights = np.linspace(1, 2, len(terms))
    space = decontamination.latent_space(
        spark.createDataFrame([(t,) for t in texts], "text string"), terms, weights, 3, rounds=6)
    dense = np.zeros((len(texts), len(terms)))
    rows = decontamination._passage_rows(pa.array(texts), terms, weights)
    for i, (own, row) in enumerate(rows):
        dense[i, own] = row
    v = np.linalg.svd(dense)[2][:3].T
    assert np.abs(space @ space.T - v @ v.T).max() < 1e-3


@pytest.mark.parametrize("block", [512, 8])
def test_decontamination_finds_items_longer_than_a_window(spark, block):
    draw = np.random.default_rng(3)
    items, rows = [], []
    for k, size in enumerate((64, 100, 128, 150, 300, 1000)):
        item = [f"w{n}" for n in draw.integers(0, 3000, size)]
        item[-12:] = [f"answer{k}x{i}" for i in range(12)]
        item[-13] += "."
        items.append((k, " ".join(item) + "."))
        filler = [f"filler{n}" for n in draw.integers(0, 900, 400 + 17 * k)]
        kept = [w if draw.random() < 0.8 else "other" for w in item]
        half = item[:size // 2]
        for j, body in enumerate((item, kept, half, [w for w in item if draw.random() < 0.8])):
            rows.append((10 * k + j, " ".join(filler[:150 + 7 * k] + body + filler[150 + 7 * k:])))
    out = decontamination.leaks(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"), block=block).collect()
    assert sorted((r.doc_id, r.item_id) for r in out) == [
        (10 * k + j, k) for k in range(len(items)) for j in (0, 1, 3)]
    assert all(r.covered == 1 for r in out if r.doc_id % 10 == 0)


def test_added_personal_data_does_not_depend_on_other_text():
    class Sure:
        @staticmethod
        def probability(x):
            return np.ones(len(x))

    model = personal_data.Model(Sure(), [0.5] * len(personal_data.KINDS))
    for text in ("write to jo(at)mail.example.com", "JO AT MAIL DOT COM", "jo [At] mail (Dot) com",
                 "jo {at} mail.com", "jo At mail.com", "jo@mail dot com", "look at it. No dot here",
                 "nothing", ""):
        sure, found = personal_data.spans(text, model)
        assert (sure, found) == personal_data.spans(text + " 7", model)
        assert bool(found) == bool(personal_data.loose(text))


def test_licenses_by_text_version_and_family(spark):
    texts = dict(licenses.TEXTS)
    mine = "Copyright (c) 2021, Jo Example\nAll rights reserved.\n\n"
    rows = [(f"{n}/LICENSE", mine + t, n) for n, t in texts.items()]
    rows += [("AGPL/LICENSE", texts["GPL-3.0"].replace("GNU General", "GNU Affero General"), None)]
    header = ("# This {0} is free software: you can redistribute it and/or modify\n"
              "# it under the terms of the GNU {1}General Public License as published by\n"
              "# the Free Software Foundation, either version {2} of the License, or\n"
              "# (at your option) any later version.\ncode\n")
    rows += [(f"src/{i}.py", text, name) for i, (name, text) in enumerate([
        ("GPL-2.0", "licensed under the GNU General Public License, version 2"),
        ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3"),
        ("GPL-3.0", "licensed under the GNU General Public License, version 3"),
        (None, "licensed under the GNU General Public License, version 7"),
        ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."), ("CC-BY-4.0", "under CC BY 4.0"),
        ("GPL-2.0", header.format("program", "", "2")), ("GPL-3.0", header.format("program", "", "3")),
        ("LGPL-2.1", header.format("library", "Lesser ", "2.1")),
        ("AGPL-3.0", header.format("program", "Affero ", "3")),
        ("GPL-2.0", "// SPDX-License-Identifier: GPL-2.0-only"),
        ("ISC", "This library is released under the ISC License."),
        (None, "Use of this code is governed by a Foo-style license found in the LICENSE file.")])]
    files = spark.createDataFrame([(i, *r[:2]) for i, r in enumerate(rows)],
                                  "file_id long, path string, text string")
    out = {r.path: r.license for r in licenses.scan(files).collect()}
    assert {p: out[p] for p, _, n in rows if p != "AGPL/LICENSE"} == {
        p: n for p, _, n in rows if p != "AGPL/LICENSE"}
    assert out["AGPL/LICENSE"] != "GPL-3.0"


def test_personal_data_learns_from_every_text_whatever_its_length(spark):
    """All that can be learned lies in texts of more than 20,000 characters."""
    cards = ["4111111111111111", "5500005555555559", "340000000000009"]
    texts = [f"{'lorem ipsum ' * 1700}pay {cards[i % 3]} or write u{i}@mail.example.com or call "
             f"+1 (555) 010-{1000 + i} from 10.{i}.2.3 today" for i in range(60)]
    docs = spark.createDataFrame([*enumerate(texts), (98, None), (99, "")],
                                 "doc_id long, text string")
    model, dealt, local = (personal_data.train(docs), personal_data.train(docs.repartition(7)),
                           personal_data.fit(texts))
    assert min(model.thresholds) < 1
    for other in (dealt, local):
        assert other.thresholds == model.thresholds
        for a, b in zip(model.trees.trees, other.trees.trees, strict=True):
            assert [*a.feature, *a.below, *a.value] == [*b.feature, *b.below, *b.value]
    assert len(model.trees.trees) == 40
    assert personal_data.train(docs.where("doc_id > 90")).thresholds == [2.0] * 4


def test_spans_clear_of_others():
    taken = [(0, 0, 9), (2, 1, 4), (20, 0, 25)]
    found = [(5, 2, 7), (8, 2, 10), (9, 2, 20), (9, 2, 21), (25, 0, 26)]
    assert personal_data._clear(found, taken) == [(9, 2, 20), (25, 0, 26)]
    assert personal_data._clear(found, []) == found


def test_large_batches_are_worked_on_in_slices(spark, monkeypatch):
    texts = ["le chat est sur la table " * 20_000, None, "", *["the cat sat on the mat"] * 50_000,
             "é" * 3_000_000]
    batch = pa.RecordBatch.from_pydict({"doc_id": range(len(texts)), "text": texts})
    parts = list(language.slices([batch.slice(1), batch.slice(0, 0)]))
    assert [x for p in parts for x in p.column("doc_id").to_pylist()] == [*range(1, len(texts))]
    assert max(p.num_rows for p in parts) < 30_000 and parts[-1].num_rows == 1
    seen = []
    monkeypatch.setattr(language, "_labels", lambda column, model: seen.append(column.nbytes) or [
        pa.nulls(len(column), pa.string()), pa.nulls(len(column), pa.float64())])

    class Docs:  # takes the function that Spark would run
        columns = ["doc_id", "text"]
        schema = spark.createDataFrame([], "doc_id long, text string").schema
        sparkSession = spark

        def drop(self, *names):
            return self

        def mapInArrow(self, function, schema):
            return list(function([batch.slice(3, 50_000)]))

    out = language.annotate(Docs(), language.fit([], []))
    assert sum(b.num_rows for b in out) == 50_000 and max(seen) < 1 << 20
