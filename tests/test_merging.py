import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidebook.operators import merging, quality


def test_dedupe_keeps_the_latest_and_is_deterministic(spark, rows):
    data = [("k", 1, "a"), ("k", 3, "z"), ("k", 3, "b"), ("j", 2, "c")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "key string, at int, value string").repartition(3)
        latest = merging.dedupe_latest(df, ["key"], [F.col("at").desc()])
        assert rows(latest) == [("j", 2, "c"), ("k", 3, "b")]


def test_dedupe_of_a_hot_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select(F.floor(F.col("id") / 2000).alias("key"), "id")
    latest = merging.dedupe_latest(df, ["key"], [F.col("id").desc()])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert [tuple(r) for r in latest.collect()] == [(0, 999)]


def test_merge_rules(spark, rows):
    target = spark.createDataFrame(
        [(1, "kept", "mine", "note"), (2, "old", "mine", "note")],
        "id int, value string, curated string, extra string",
    )
    source = spark.createDataFrame(
        [(2, None, "theirs", 20), (3, "new", "theirs", 30)],
        "id int, value string, curated string, added int",
    )
    merged = merging.merge_rows(target, source, ["id"], protect=["curated"])
    assert merged.columns == ["id", "value", "curated", "extra", "added"]
    assert rows(merged) == [
        (1, "kept", "mine", "note", None),
        (2, None, "mine", "note", 20),
        (3, "new", "theirs", None, 30),
    ]
    again = merging.merge_rows(merged, source, ["id"], protect=["curated"])
    assert rows(again) == rows(merged)
    fixed = merging.merge_rows(target, source, ["id"], append_new_columns=False)
    assert fixed.columns == target.columns


def test_merge_of_whole_rows_appends_columns(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, value string")
    source = spark.createDataFrame([(2, None, 5)], "id int, value string, added int")
    assert rows(merging.merge_rows(target, source, ["id"])) == [(1, "a", None), (2, None, 5)]


def test_upsert_against_brute_force(spark, rows):
    rng = random.Random(7)
    for _ in range(3):
        stored = {k: (k, rng.randrange(9), "s") for k in rng.sample(range(20), 10)}
        batch = [(rng.choice([1, 1, 1, *range(20)]), rng.randrange(50), "b") for _ in range(60)]
        target = spark.createDataFrame(list(stored.values()), "k int, at int, v string")
        source = spark.createDataFrame(batch, "k int, at int, v string")
        expected = dict(stored)
        for row in sorted(batch, key=lambda r: r[1]):
            expected[row[0]] = row
        found = merging.upsert(target, source, ["k"], [F.col("at").desc()])
        assert rows(found) == sorted(expected.values(), key=repr)


@pytest.mark.parametrize("loaded, kept", [([], 6), ([0], 6), ([5], 4), ([40], 0)])
def test_lookback(spark, loaded, kept):
    start = date(2025, 1, 1)
    days = [(start + timedelta(d),) for d in range(6)]
    source = spark.createDataFrame(days, "day date")
    target = spark.createDataFrame([(start + timedelta(d),) for d in loaded], "day date")
    assert merging.lookback_filter(source, target, "day").count() == kept


def test_checks(spark, rows):
    df = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, None), (None, "a"), (None, "x")], "id int, kind string"
    )
    parent = spark.createDataFrame([(1,)], "key int")
    assert rows(quality.check_unique(df, "id")) == [(1, 2)]
    assert quality.check_not_null(df, "kind").count() == 1
    assert rows(quality.check_accepted(df, "kind", ["a", "b"])) == [(None, "x")]
    assert rows(quality.check_relationship(df, "id", parent, "key")) == [(2, 1)]
    assert quality.check_unique_combination(df, ["id", "kind"]).isEmpty()
    assert rows(quality.null_counts(df, ["id", "kind"])) == [("id", 2), ("kind", 1)]
    report = quality.quality_report({
        "unique": quality.check_unique(df, "id"),
        "known": quality.check_relationship(df, "id", parent, "key"),
        "pairs": quality.check_unique_combination(df, ["id", "kind"]),
    })
    assert rows(report) == [("known", 1), ("pairs", 0), ("unique", 1)]
    with pytest.raises(quality.QualityError, match="unique"):
        quality.require("unique", quality.check_unique(df, "id"))
