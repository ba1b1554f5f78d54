"""Removal of repeated line runs by a suffix array over line ids (1).

Lines become ids, documents sequences of ids. Prefix doubling sorts the suffixes of all sequences:
round k ranks the first 2**k lines of each suffix by the pair of ranks of its two halves. A suffix
whose first 2**k lines are unique has its place and drops out, so the rounds work on repeated lines
only, and a pair's rank comes from a range-partitioned sort of the distinct pairs.

A run is removed if it holds ``min_words`` words and its lines also occur, in the same order, at an
earlier place. Suffixes that share that many words form an interval of the suffix array with a
common prefix of at least those lines, and two ranks that overlap tell whether two prefixes of any
length agree. So the array is only sorted as deep as a window of ``min_words`` words can be long,
which makes the number of rounds independent of the data. A run is covered by the shortest windows
that begin at, and that end at, its lines; the first window of an interval stays, the lines of the
later ones go, and together they are the maximal repeated runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidebook.llm.registry import query, table
from tidebook.llm.stages import Stages

MIN_WORDS = 50


def line_table(docs: DataFrame) -> DataFrame:
    """``doc, pos, h1, h2, weight``: the lines of every distinct document.

    Lines are compared exactly but for a trailing carriage return; 128 bits stand for one. The
    weight is the number of words, at least 1, so that every window has a bounded length.
    """
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    return docs.select(
        document_key().alias("doc"),
        F.transform(lines, lambda x: F.struct(
            F.xxhash64(F.rtrim(x, F.lit("\r"))).alias("h1"),
            F.xxhash64(F.lit(7), F.rtrim(x, F.lit("\r"))).alias("h2"),
            F.greatest(F.lit(1), F.size(F.split(F.trim(x), r"\s+"))).alias("weight"),
        )).alias("lines"),
    ).groupBy("doc").agg(F.first("lines").alias("lines")).select(
        "doc", F.posexplode("lines").alias("pos", "line")).select("doc", "pos", "line.*")


def document_key():
    """Id and content: rows with equal ids but other texts are other documents."""
    return F.struct(
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("content"))


def windows(lines: DataFrame, min_words: int) -> DataFrame:
    """``doc, pos, length``: shortest windows of ``min_words`` from, and up to, each line."""
    upto = F.sum("weight").over(Window.partitionBy("doc").orderBy("pos"))
    summed = lines.select("doc", "pos", "weight", upto.alias("upto")).withColumn(
        "before", F.col("upto") - F.col("weight"))
    ahead = Window.partitionBy("doc").orderBy("before").rangeBetween(0, min_words - 1)
    behind = Window.partitionBy("doc").orderBy("upto").rangeBetween(1 - min_words, 0)
    both = summed.select(
        "doc", "pos", "before", "upto",
        F.struct(F.last("pos").over(ahead).alias("pos"), F.last("upto").over(ahead).alias("upto"))
        .alias("to"),
        F.struct(F.first("pos").over(behind).alias("pos"),
                 F.first("before").over(behind).alias("before")).alias("since"))
    starting = F.when(F.col("to.upto") - F.col("before") >= min_words, F.struct(
        F.col("pos"), (F.col("to.pos") - F.col("pos") + 1).alias("length")))
    ending = F.when(F.col("upto") - F.col("since.before") >= min_words, F.struct(
        F.col("since.pos").alias("pos"), (F.col("pos") - F.col("since.pos") + 1).alias("length")))
    return both.select("doc", F.explode(F.array_distinct(F.array(starting, ending))).alias("w")
                       ).where("w is not null").select("doc", "w.*").distinct()


def _ranked(rows: DataFrame, keys: list[str], stages: Stages, name: str) -> DataFrame:
    """Rows whose ``keys`` occur more than once, with the rank of the keys in sorted order."""
    repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # Distinct keys, sorted across partitions: the generated ids follow their order.
    order = stages.write(
        repeated.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("place", F.monotonically_increasing_id()), f"{name}-order")
    ranked = rows.join(order.hint("merge"), keys)
    return stages.write(ranked.select("doc", "pos", F.col("place").alias("rank")), name)


def later_copies(lines: DataFrame, min_words: int, stages: Stages) -> DataFrame:
    """``doc, pos, length`` of every window that also occurs at an earlier place."""
    ranks = _ranked(lines.select("doc", "pos", "h1", "h2"), ["h1", "h2"], stages, "suffixes-0")
    sought = windows(lines, min_words)
    # Only windows made of repeated lines can be repeated: unknown first lines drop out here.
    sought = stages.write(
        sought.join(ranks.select("doc", "pos").hint("merge"), ["doc", "pos"]), "windows")
    intervals, k = [], 0
    while True:
        size = 1 << k
        here = sought.where(f"length >= {size} and length < {2 * size}")
        first = here.join(ranks.hint("merge"), ["doc", "pos"]).withColumn(
            "at", F.col("pos") + F.col("length") - size)
        second = ranks.select("doc", F.col("pos").alias("at"), F.col("rank").alias("rank2"))
        intervals.append(first.join(second.hint("merge"), ["doc", "at"]).select(
            "doc", "pos", "length", "rank", "rank2"))
        if 2 * size > min_words:
            break
        half = ranks.select("doc", (F.col("pos") - size).alias("pos"), F.col("rank").alias("rank2"))
        pairs = ranks.join(half.hint("merge"), ["doc", "pos"])
        ranks = _ranked(pairs, ["rank", "rank2"], stages, f"suffixes-{k + 1}")
        k += 1
    found = intervals[0]
    for more in intervals[1:]:
        found = found.union(more)
    found = stages.write(found, "intervals")
    keys = ["length", "rank", "rank2"]
    earliest = found.groupBy(*keys).agg(F.min(F.struct("doc", "pos")).alias("first"),
                                        F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return found.join(earliest.hint("merge"), keys).where(
        F.struct("doc", "pos") > F.col("first")).select("doc", "pos", "length")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc, runs``: per document the maximal runs (first and last line) that repeat earlier ones.

    Earlier is by document id (null first), then content, then line.
    """
    stages = Stages(docs.sparkSession, "line-dedup")
    lines = stages.write(line_table(docs), "lines")
    copies = later_copies(lines, min_words, stages)
    # Windows of a document that overlap or touch make one run.
    before = Window.partitionBy("doc").orderBy("pos", "length").rowsBetween(
        Window.unboundedPreceding, -1)
    upto = Window.partitionBy("doc").orderBy("pos", "length")
    joined = copies.withColumn("to", F.col("pos") + F.col("length") - 1).withColumn(
        "new", (F.coalesce(F.max("to").over(before), F.lit(-2)) + 1 < F.col("pos")).cast("int")
    ).withColumn("run", F.sum("new").over(upto))
    runs = joined.groupBy("doc", "run").agg(F.min("pos").alias("first"), F.max("to").alias("last"))
    return runs.groupBy("doc").agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``text`` cleared of later copies of repeated line runs, and ``n_lines``,
    ``n_removed``.

    A run counts if it has at least ``min_words`` words; a line without words counts as one. The
    first copy stays, wherever it is; copies inside one document count too. A null text stays null
    and has no lines; an empty text has none either. Rows that are equal in id and text are one
    document: none loses lines to the other. Rows with a null id take part. Columns other than
    ``doc_id`` and ``text`` are carried along, but for clashing ``n_lines`` and ``n_removed``,
    which are replaced. An empty table gives no rows.
    """
    runs = repeated_runs(docs, min_words)
    keyed = docs.drop("n_lines", "n_removed").withColumn("_key", document_key())
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda x, i: ~F.exists(
        "_runs", lambda r: (i >= r["first"]) & (i <= r["last"])))
    both = keyed.join(
        runs.select(F.col("doc").alias("_doc"), F.col("runs").alias("_runs")).hint("merge"),
        (F.col("_key.content") == F.col("_doc.content"))
        & F.col("_key.id").eqNullSafe(F.col("_doc.id")), "left")
    text = F.when(F.col("_runs").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    removed = F.aggregate("_runs", F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
    count = F.when(F.length("text") > 0, F.size(lines)).otherwise(0)
    return both.select(
        *[text.alias("text") if c == "text" else F.col(c) for c in docs.columns
          if c not in ("n_lines", "n_removed")],
        count.alias("n_lines"), F.coalesce(removed, F.lit(0)).alias("n_removed"))


#: Windows by content and brute force; expects ``doc_id`` to be a key.
ORACLE = f"""
with split as (
    select doc_id, string_split(text, chr(10)) as l from documents),
lines as (
    select doc_id, l, list_transform(l, lambda x: greatest(1,
        len(string_split_regex(trim(x, ' '), '\\s+')))) as w from split),
ends as (
    select doc_id, l, list_transform(range(1, len(l) + 1), lambda i: list_sum(w[1:i])) as c
    from lines),
spans as (
    select doc_id, l, c, unnest(range(1, len(l) + 1)) as i from ends),
windows as (
    select doc_id, l, i as a,
        list_filter(range(i, len(l) + 1), lambda e: c[e] - coalesce(c[i - 1], 0)
            >= {MIN_WORDS})[1] as b from spans
    union
    select doc_id, l, list_filter(range(1, i + 1), lambda s: c[i] - coalesce(c[s - 1], 0)
            >= {MIN_WORDS})[-1] as a, i as b from spans),
named as (
    select doc_id, a, b, array_to_string(l[a:b], chr(10)) as content from windows
    where a is not null and b is not null),
ranked as (
    select *, row_number() over (partition by content order by doc_id, a) as place from named),
gone as (
    select distinct doc_id, unnest(range(a, b + 1)) as i from ranked where place > 1),
lost as (select doc_id, list(i) as i from gone group by doc_id)
select doc_id,
    coalesce(array_to_string(list_filter(l, lambda x, k: not list_contains(coalesce(t.i, []), k)),
        chr(10)), '') as text,
    cast(case when len(s.l) = 1 and s.l[1] = '' then 0 else len(s.l) end as int) as n_lines,
    cast(coalesce(len(t.i), 0) as int) as n_removed
from split s left join lost t using (doc_id)
"""


@query("op1_line_dedup", ORACLE)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_lines(docs)
