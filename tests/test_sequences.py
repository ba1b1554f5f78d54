"""Chunked operators against brute force, with one key holding a third of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidebook.operators.sequences import latest_before, number_within


def keys(rng, n):
    return [0 if rng.random() < 0.34 else rng.randrange(1, 9) for _ in range(n)]


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_number_within(spark, rows, width):
    rng = random.Random(width)
    data = [(k, rng.randrange(60), i) for i, k in enumerate(keys(rng, 400))]
    df = spark.createDataFrame(data, "k int, at int, id int")
    chunk = F.floor(F.col("at") / width)
    found = number_within(df, ["k"], ["at", "id"], chunk, "n")
    expected = []
    for k in {r[0] for r in data}:
        group = sorted((r for r in data if r[0] == k), key=lambda r: r[1:])
        expected += [(*r, i) for i, r in enumerate(group, 1)]
    assert rows(found) == sorted(expected, key=repr)


@pytest.mark.parametrize("width", [1, 5, 1000])
def test_latest_before(spark, rows, width):
    rng = random.Random(100 + width)
    steps = [(k, rng.choice("ab"), at, f"e{at}" if rng.random() < 0.3 else None)
             for at, k in enumerate(keys(rng, 300))]
    # Some steps both use and set: a use never sees its own step.
    steps += [(k, v, at, None) for k, v, at, e in steps if e and at % 2]
    df = spark.createDataFrame(steps, "k int, v string, at int, endpoint string")
    found = latest_before(df, ["k", "v"], "at", "endpoint", F.floor(F.col("at") / width))
    expected = []
    for k, v, at, e in steps:
        if e is None:
            earlier = [s for s in steps if s[:2] == (k, v) and s[2] < at and s[3]]
            latest = max(earlier, key=lambda s: s[2])[3] if earlier else None
            expected.append((k, v, at, latest))
    assert rows(found) == sorted(expected, key=repr)


@pytest.mark.parametrize("width", [1, 5, 1000])
def test_latest_before_with_known_opening_chunk(spark, rows, width):
    """Rows of the least chunk need no summary; rows with a NULL key fall out."""
    rng = random.Random(200 + width)
    steps = [(k or None, at, f"e{at}" if rng.random() < 0.3 else None)
             for at, k in enumerate(keys(rng, 300))]
    df = spark.createDataFrame(steps, "k int, at int, endpoint string")
    chunk = F.floor(F.col("at") / width)
    found = latest_before(df.withColumn("opening", chunk == 0), ["k"], "at", "endpoint", chunk,
                          "opening")
    expected = latest_before(df, ["k"], "at", "endpoint", chunk)
    assert rows(found.drop("opening")) == rows(expected) != []
    assert found.where("k is null").isEmpty()
