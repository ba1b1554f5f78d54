"""Merkle manifest, repeated substrings and conversation trie against brute force and edge cases."""

import random
import re
import subprocess
import sys
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tidebook.llm import conversations, manifest, substrings

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TURNS = "conv_id long, turn long, role string, text string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def plain_tree(digests):
    """Levels of digests from the leaves to the root."""
    levels = [digests]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([h(*row[i:i + 2]) for i in range(0, len(row), 2)])
    return levels


def plain_siblings(levels, i):
    out = []
    for row in levels[:-1]:
        if i ^ 1 < len(row):
            out.append(row[i ^ 1])
        i //= 2
    return out


def plain_manifest(rows):
    """``(leaf, subroot, root, siblings)`` of every row, as a sorted list."""
    by_lang = defaultdict(list)
    for d, text, lang, source, n in rows:
        leaf = h(field(d), field(source), field(lang), field(n), field(text))
        by_lang[lang].append((d is not None, d or 0, leaf))
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: plain_tree([x[2] for x in sorted(by_lang[lang])]) for lang in order}
    top = plain_tree([trees[lang][-1][0] for lang in order])
    return sorted(
        (leaf, trees[lang][-1][0], top[-1][0],
         tuple(plain_siblings(trees[lang], i) + plain_siblings(top, k)))
        for k, lang in enumerate(order) for i, leaf in enumerate(trees[lang][0]))


def random_docs(n, seed):
    r = random.Random(seed)
    rows = [(i, "x" * r.randrange(5) if r.random() < .9 else None,
             r.choice(["de", "en", "en", "en", "é", "", None]),
             r.choice(["web", None, "bücher"]), r.choice([None, i, 7])) for i in range(n)]
    return rows + [(None, "a", "en", None, None), (None, None, None, None, None), rows[0], rows[0]]


@pytest.mark.parametrize("n, levels", [(1, 12), (9, 2), (70, 1), (300, 3)])
def test_manifest_of_any_size(spark, n, levels):
    rows = random_docs(n, n)
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, DOCS).withColumn("leaf", F.lit(1)).withColumn(
        "position", F.lit("clash"))
    found = manifest.manifest(docs, levels).withColumn("again", manifest.fold(
        F.col("proof"), F.col("leaf"))).collect()
    assert all(r.again == r.root for r in found)
    steps = [[s for s in r.proof if s != manifest.ALONE] for r in found]
    assert sorted((r.leaf, r.subroot, r.root, tuple(s[1:] for s in p))
                  for r, p in zip(found, steps, strict=True)) == plain_manifest(rows)


def test_manifest_of_nothing_and_of_one(spark):
    assert manifest.manifest(spark.createDataFrame([], DOCS)).count() == 0
    one = manifest.manifest(spark.createDataFrame([(5, "", None, None, 0)], DOCS)).first()
    assert one.leaf == one.subroot == one.root == h("1:5", "-", "-", "1:0", "0:")
    assert one.proof == []


def test_manifest_finds_a_changed_row(spark):
    docs = spark.createDataFrame([(i, "t", "en", "s", i) for i in range(20)], DOCS)
    found = manifest.manifest(docs, 2, {"given": manifest.leaf_digest(
        F.when(F.col("doc_id") == 7, 99).otherwise(F.col("n_chars")))})
    found = found.withColumn("ok", manifest.fold(F.col("proof"), F.col("given")) == F.col("root"))
    assert [r.doc_id for r in found.where("not ok").collect()] == [7]


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        k = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:k] + ts[k:])
    members = defaultdict(list)
    for c, s in built.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    members.setdefault((), [])
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        w = (len(members[k]) - 1) * len(k[-1][1]) if k else 0
        saved[k] = w + sum(saved[x] for x in children[k])
    return sorted(((
        min(m, default=None), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]),
        leaves[k], saved[k], h(",".join(str(c) for c in sorted(m) if len(built[c]) == len(k))))
        for k, m in members.items()), key=repr)


COLUMNS = ("conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"
           ).split()


def random_turns(seed, convs, longest):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(350), convs):
        n = r.choice([1, 2, 3, 5, 8, longest])
        rows += [(c, t if r.random() < .95 else None, r.choice(["user", None, "bot"]),
                  r.choice(["hi", "hi", "", None, "\U0001f600 ok"])) for t in range(n)]
    return rows + [(None, 1, "user", "nobody"), rows[0], rows[0]]


@pytest.mark.parametrize("seed, convs, longest", [(1, 60, 9), (2, 40, 150), (3, 12, 400)])
def test_trie_against_brute_force(spark, seed, convs, longest):
    rows = random_turns(seed, convs, longest)
    # A long conversation that others share far down, past several cuts.
    shared = [(900, t, "user", f"t{t}") for t in range(longest)]
    rows += shared + [(901 + i, t, role, text if t < longest - i else "other")
                      for i in range(3) for _, t, role, text in shared]
    random.Random(0).shuffle(rows)
    turns = spark.createDataFrame(rows, TURNS).withColumn("depth", F.lit("clash"))
    found = conversations.prefix_trie(turns).select(*COLUMNS).collect()
    assert sorted(map(tuple, found), key=repr) == plain_trie(rows)


def test_trie_of_nothing_and_of_one_text_many_times(spark):
    empty = conversations.prefix_trie(spark.createDataFrame([], TURNS)).select(*COLUMNS).collect()
    assert list(map(tuple, empty)) == plain_trie([])
    same = [(c, 0, "user", "same") for c in range(9000)]
    found = conversations.prefix_trie(spark.createDataFrame(same, TURNS)).select(*COLUMNS)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_trie(same)


def plain_substrings(rows, window):
    """``(doc_id, n_words, n_removed, kept)`` of every row, by comparing all windows."""
    split = [(d, re.findall(r"[^\x20\t-\r]+", t or "")) for d, t in rows]

    def rank(d):
        return (d is not None, d or 0)

    least = {}
    for d, w in split:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            least[k] = min(least.get(k, rank(d)), rank(d))
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < rank(d):
                gone |= set(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), " ".join(kept)))
    return sorted(out, key=repr)


def random_texts(seed, n):
    r = random.Random(seed)
    vocabulary = ["a", "b", "A", "c.", "é", "word", "x" * 50]
    shared = [" ".join(r.choices(vocabulary, k=r.randrange(3, 60))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [r.choice(shared) if r.random() < .4 else " ".join(
            r.choices(vocabulary, k=r.randrange(12))) for _ in range(r.randrange(4))]
        rows.append((i, r.choice([" ", "\n", "\t \u00a0 ", "\x1f"]).join(parts)))
    long = " ".join(r.choices([str(i) for i in range(40)], k=3000))
    rows += [(500, long), (501, long + " end"), (502, "z " * 400), (503, "z " * 300)]
    rows += [(504, rows[3][1]), (504, rows[4][1]), (504, rows[3][1]), (None, rows[5][1]),
             (None, shared[0]), (505, None), (506, ""), (507, " \n ")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("window, group", [(3, 1 << 18), (13, 50), (4, 7), (13, 1 << 18)])
def test_substrings_against_brute_force(spark, window, group):
    rows = random_texts(window, 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn(
        "n_words", F.lit("clash")).withColumn("prefix", F.lit("kept along"))
    found = substrings.drop_repeated_substrings(docs, window, group)
    assert found.columns == ["doc_id", "prefix", "n_words", "n_removed", "kept"]
    assert sorted(map(tuple, found.drop("prefix").collect()), key=repr) == plain_substrings(
        rows, window)


def test_substrings_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.drop_repeated_substrings(empty).count() == 0


def test_subtrees_have_the_shared_depths():
    import numpy as np

    edges = np.array([[1, 2, 3], [1, 2, 3], [0, 9, 9], [1, 2, 4], [1, 2, 3]], dtype=np.uint8)
    order, common = substrings.subtrees(edges, np.array([5, 7, 1, 1, 5]))
    assert order.tolist() == [2, 0, 4, 1, 3]
    assert common.tolist() == [0, 0, 4, 3, 2]


def test_operators_start_without_a_checkpoint_folder(tmp_path):
    """In a process of its own: the session has neither the setting nor Spark's default file."""
    code = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config(
    "spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from tidebook.llm import manifest, near_copies, packing, repeated_lines, token_counts
from tidebook.llm.stages import Stages
docs = spark.createDataFrame(
    [(i, "one two three four five six", "en", "s", 27) for i in range(4)],
    "doc_id long, text string, lang string, source string, n_chars long")
assert repeated_lines.drop_repeated_lines(docs).count() == 4
assert near_copies.near_copies(docs).where("kept").count() == 1
assert packing.pack(docs).count() == 4
assert token_counts.token_counts(docs, Stages(spark, "t").folder + "/cache").count() == 4
assert manifest.manifest(docs).count() == 4
print("all ran")
"""
    (tmp_path / "conf").mkdir()
    import os

    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": ":".join(sys.path)}
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, timeout=300,
                          capture_output=True, text=True)
    assert "all ran" in done.stdout, done.stderr[-3000:]
