"""The registered corpus queries against SQL or brute force on the smallest shared tables."""

import re
import zlib
from collections import Counter, defaultdict

import __spark_entry__ as entry_point
import corpus_pipeline
import duckdb
import pytest
from compare import DATA, differences

from tidebook.llm import decontamination, licenses, packing
from tidebook.llm.encoding import encode
from tidebook.llm.personal_data import KINDS, digits, luhn
from tidebook.llm.registry import ORACLE, QUERIES

SF = "sf0.001"
DIR = f"{DATA}/{SF}"


def plain(name):
    return duckdb.sql(f"select * from '{DIR}/{name}.parquet' order by 1").fetchall()


@pytest.fixture(scope="module")
def documents():
    return {r[0]: r[1] for r in plain("documents")}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twin(spark, name):
    assert differences(name, QUERIES[name](spark, DIR), ORACLE[name], SF) == []


def test_all_are_registered():
    numbers = sorted(int(m[1]) for m in (re.match(r"op(\d+)_", q) for q in QUERIES) if m)
    assert numbers == list(range(1, 14))
    assert "pipeline" in entry_point.queries()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "line dedup", "near-dedup", "decontamination", "packing"]


def test_line_dedup_is_native(spark):
    from tidebook.llm.repeated_lines import line_table, windows

    plan = windows(line_table(spark.read.parquet(f"{DIR}/documents.parquet")), 50)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", text)


def test_languages_of_held_out_documents(spark):
    truth = {r[0]: r[2] for r in plain("documents")}
    rows = QUERIES["op2_language_id"](spark, DIR).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_licenses_by_brute_force(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op3_license_scan"](spark, DIR).collect()}
    assert rows.keys() == documents.keys()
    own = {}
    for doc, text in documents.items():
        named = {n for n, t in licenses.TEMPLATES for line in text.split("\n")
                 if re.findall(r"\w+", line.lower()) == re.findall(r"\w+", t.lower())}
        if named:
            own[doc] = named
            assert rows[doc].license in named and rows[doc].cosine == pytest.approx(1)
    granted = defaultdict(list)
    for r in rows.values():
        folder, name = r.path.rsplit("/", 1)
        if name.startswith("LICENSE") and r.inherited_from is None and r.license:
            granted[folder].append(r)
    for r in rows.values():
        if r.cosine >= licenses.COSINE:
            continue
        folder, best = r.path.rsplit("/", 1)[0], None
        while best is None and folder:
            if granted[folder]:
                best = min(granted[folder], key=lambda g: (-g.cosine, g.path))
            folder = folder.rpartition("/")[0]
        assert (r.license, r.inherited_from) == ((best.license, best.path) if best else (None, None))


def packed_as_asked(rows, texts, capacity=2048):
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == texts.keys()
    for doc, own in pieces.items():
        ids = encode("byte_bpe_50k.json", [texts[doc] or ""])[0] + [0]
        own.sort(key=lambda r: r.piece)
        at = 0
        for k, r in enumerate(own):
            assert (r.piece, r.start) == (k, at)
            at += r.length
            data = b"".join(i.to_bytes(4, "little") for i in ids[r.start:at])
            assert r.ids_crc32 == zlib.crc32(data)
        assert at == len(ids)
        assert all(r.length == capacity for r in own[1:])
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in rows)
    large = sum(2 * r.length > capacity for r in rows)
    assert len(sequences) <= max(-(-total // capacity), large) * 1.03 + 1


def test_packing(spark, documents):
    packed_as_asked(QUERIES["op4_best_fit_packing"](spark, DIR).collect(), documents)


def test_toxicity_of_held_out_documents(spark):
    folder = f"{DATA}/sf0.1"
    toxic = dict(duckdb.sql(f"select doc_id, toxic from '{folder}/labels.parquet'").fetchall())
    rows = QUERIES["op6_toxicity"](spark, folder).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    assert sum(r.predicted == toxic[r.doc_id] for r in held) >= 0.93 * len(held)
    found = [r.predicted for r in held if toxic[r.doc_id]]
    assert sum(found) >= 0.7 * len(found)


PATTERNS = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
)


def base_spans(text):
    return sorted((m.start(), k, m.end()) for k, (pattern, fits) in enumerate(PATTERNS)
                  for m in re.finditer(pattern, text) if fits(m.group()))


def test_personal_data(spark, documents):
    from hashlib import sha256

    rows = QUERIES["op7_personal_data"](spark, DIR).collect()
    assert {r.doc_id for r in rows} == documents.keys()
    for r in rows:
        base = base_spans(documents[r.doc_id])
        shown = [f"{KINDS[k]}:{a}:{b}" for a, k, b in base]
        count = Counter(KINDS[k] for _, k, _ in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(count[k] for k in KINDS)
        assert r.base_sha256 == sha256(",".join(shown).encode()).hexdigest()
        assert set(shown) <= set(r.spans.split(","))


def test_token_counts(spark, documents):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path("byte_bpe_50k.json"))
    for r in QUERIES["op9_token_counts"](spark, DIR).collect():
        text = documents[r.doc_id] or ""
        n = len(own.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 1024)


def holds(item, text):
    word = re.compile(r"[^\W_]+")
    return " ".join(word.findall(item.lower())) in " ".join(word.findall(text.lower()))


def test_decontamination(spark, documents):
    found = {(r.doc_id, r.item_id)
             for r in QUERIES["op10_decontamination"](spark, DIR).collect()}
    planted = {(d, i) for i, item in plain("benchmark") for d, t in documents.items()
               if holds(item, t)}
    assert planted and found == planted
    assert decontamination.COSINE < 0.2


def test_pipeline_stage_by_stage(spark, documents):
    """Each stage against its definition on what the one before kept."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns = corpus_pipeline.COLUMNS
    steps = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, DIR).collect(), docs.schema)
        assert docs.columns == columns
        steps.append({r.doc_id: r for r in docs.collect()})
    language, lines, near, clean = steps
    assert language.keys() == {d for d, t in documents.items() if re.search(r"[^\W\d_]", t)}
    assert all(r.n_chars == len(r.text) for r in lines.values())
    assert lines.keys() <= language.keys()

    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = {d: shingles(r.text) for d, r in lines.items()}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    low, high = sorted((root(a), root(b)))
                    parent[high] = low
    assert near.keys() == {d for d in sets if root(d) == d}
    leaked = {d for d, r in near.items() if any(holds(i, r.text) for _, i in plain("benchmark"))}
    assert leaked and clean.keys() == near.keys() - leaked
    packed_as_asked(corpus_pipeline.STAGES[-1][1](spark, docs, DIR).collect(),
                    {d: r.text for d, r in clean.items()})


EXTRA = "doc_id long, text string, lang string, source string, n_chars long, content string, bucket int"


def test_pipeline_stages_keep_rows_apart_that_share_an_id(spark):
    item = next(i for _, i in plain("benchmark"))
    copy = " ".join(f"word{i}" for i in range(60))
    other = " ".join(f"other{i}" for i in range(60))
    rows = [(1, copy), (2, copy), (2, other), (2, other), (None, copy), (None, "lone words"),
            (3, f"before {item} after"), (3, "clean words"), (4, None), (5, "")]
    docs = spark.createDataFrame([(*r, "en", "s", 1, "c", 2) for r in rows], EXTRA)
    near = corpus_pipeline.keep_one_of_near_copies(spark, docs, DIR)
    assert near.columns == corpus_pipeline.COLUMNS
    kept = [(r.doc_id, r.text) for r in near.collect()]
    want = [r for i, r in enumerate(rows) if i not in (1, 3, 4)]
    assert sorted(kept, key=repr) == sorted(want, key=repr)
    clean = corpus_pipeline.drop_leaks(spark, docs, DIR)
    assert clean.columns == corpus_pipeline.COLUMNS
    kept = [(r.doc_id, r.text) for r in clean.collect()]
    assert sorted(kept, key=repr) == sorted(rows[:6] + rows[7:], key=repr)


def test_pipeline_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], EXTRA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DIR).count() == 0


def test_packing_plan_bounds():
    import random

    draw = random.Random(1)
    for _ in range(100):
        capacity = draw.choice([12, 64, 2048])
        counts = {draw.randint(1, capacity): draw.randint(1, 40) for _ in range(60)}
        taken, bins = Counter(), defaultdict(list)
        for length, first, number, sequence, offset in packing.plan_packing(counts, capacity):
            assert first == taken[length]
            taken[length] += number
            for i in range(number):
                bins[sequence + i].append((offset, length))
        assert taken == Counter(counts)
        for own in bins.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= capacity
