"""Near-copies by min-max hashing (5).

Every permutation of a document's shingles gives two signature values, the smallest and the
largest hash, so half the hash evaluations make a signature of the same length. Bands of values
propose pairs; every pair that links is confirmed on the full shingle sets.

Only connectivity is wanted, so not all pairs of a bucket are made. First the most central document
of a bucket (the star) is compared with the rest of it, then the most central of those that stay
outside the bucket's largest component. What may still be unconnected is compared exactly but
sparsely: two sets as similar as asked must share one of their rarest shingles, so only documents
that do, lie in different components and have sketches near enough meet. A sketch holds, for each
of 1024 slots, whether the set has an odd number of shingles there; sketches differ in no more
slots than their sets differ in shingles, so none that links is lost. No bucket is gathered in one
task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidebook.llm.components import components
from tidebook.llm.registry import query, table
from tidebook.llm.stages import Stages
from tidebook.llm.words import mixed, shingle_sets, slices, words

#: 20 bands of 4 values: a pair at similarity 0.85 shares no band with probability 4e-7, one at
#: 0.8 with probability 3e-5.
BANDS, ROWS = 20, 4

#: Slots by which shingles are counted to order them from rare to common.
ORDER = 1 << 16

#: Slots of a sketch and the columns that hold 64 of them each.
SLOTS = 1024
SKETCH = [f"sketch{i}" for i in range(SLOTS // 64)]

SIGNATURE = "doc_id long, n_shingles long, class binary, bands array<long>"


def _signature(sets: list[np.ndarray]) -> np.ndarray:
    """Band hashes of non-empty sets, one row per set."""
    values, at = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    perms = BANDS * ROWS // 2
    kept = np.empty((2 * perms, len(sets)), dtype=np.uint64)
    seeds = mixed(np.arange(1, perms + 1, dtype=np.uint64))
    for k, seed in enumerate(seeds):
        v = (values ^ seed) * (seed | np.uint64(1))
        v ^= v >> np.uint64(32)
        kept[k] = np.minimum.reduceat(v, at)
        kept[perms + k] = np.maximum.reduceat(v, at)  # never in one band with its minimum
    bands = np.empty((len(sets), BANDS), dtype=np.uint64)
    for b in range(BANDS):
        h = np.full(len(sets), b + 1, dtype=np.uint64)
        for r in range(ROWS):
            h = mixed(h * np.uint64(31) + kept[b * ROWS + r])
        bands[:, b] = h
    return bands.view(np.int64)


def _class_of(values: np.ndarray) -> bytes:
    """128 bits of a shingle set."""
    return np.array([mixed(values).sum(), mixed(values * np.uint64(0x9FB21C651E98DF25)).sum()
                     + np.uint64(len(values))], dtype=np.uint64).tobytes()


def _batches(batches: Iterator[pa.RecordBatch], size: int, with_sets: bool):
    for batch in slices(batches):
        ids, texts = batch.column("doc_id"), batch.column("text")
        for found in words(texts):
            sets = shingle_sets(found, size)
            full = [i for i, s in enumerate(sets) if len(s)]
            own = ids.slice(found.first, found.last - found.first)
            classes = pa.array([_class_of(s) if len(s) else None for s in sets], pa.binary())
            if with_sets:
                if full:
                    flat = pa.array(np.concatenate([sets[i] for i in full]).view(np.int64))
                    at = pa.array(np.cumsum([0, *(len(sets[i]) for i in full)]), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [classes.take(pa.array(full)), pa.ListArray.from_arrays(at, flat)],
                        ["class", "shingles"])
                continue
            bands: list = [None] * len(sets)
            if full:
                for i, row in zip(full, _signature([sets[i] for i in full]), strict=True):
                    bands[i] = row
            more = [c for c in batch.schema.names if c == "content"]
            yield pa.RecordBatch.from_arrays(
                [own, pa.array([len(s) for s in sets], pa.int64()), classes,
                 pa.array(bands, pa.list_(pa.int64())),
                 *[batch.column(c).slice(found.first, found.last - found.first) for c in more]],
                ["doc_id", "n_shingles", "class", "bands", *more])


def signatures(docs: DataFrame, size: int, content: bool = False) -> DataFrame:
    more = [F.xxhash64("text").alias("content")] if content else []
    return docs.select(F.col("doc_id").cast("long"), "text", *more).mapInArrow(
        lambda b: _batches(b, size, False), SIGNATURE + ", content long" * content)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` with the fact whether their full sets reach the similarity."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    shared = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - F.col("shared")
    return both.withColumn("shared", shared).select(
        "a", "b", (100 * F.col("shared") >= percent * union).alias("linked"))


def _prefixes(batches: Iterator[pa.RecordBatch], shared, percent: int):
    """Of each set the rarest shingles, one of which any similar set has, how common they are, and
    the sketch.

    The order of shingles is that of the counts of their slots; any fixed order is exact.
    """
    counts = shared.value
    for batch in batches:
        prefixes, central, odd = [], [], []
        column = batch.column("shingles")
        flat, at = column.flatten().to_numpy(), column.offsets.to_numpy()
        for a, b in zip((at - at[0])[:-1], (at - at[0])[1:], strict=True):
            values = flat[a:b]
            often = counts[values % ORDER]
            size = len(values) - (percent * len(values) + 99) // 100 + 1
            order = np.lexsort((values, often))[:size]
            prefixes.append(values[order])
            central.append(float(often[order].mean()))
            odd.append(np.bincount(values % SLOTS, minlength=SLOTS) & 1)
        sketch = np.packbits(np.array(odd, dtype=np.uint8).reshape(-1, SLOTS), axis=1).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("class"), pa.array(central, pa.float64()),
             pa.array(prefixes, pa.list_(pa.int64())), *map(pa.array, sketch.T.copy())],
            ["class", "central", "prefix", *SKETCH])


def _by_main(placed: DataFrame, key: str) -> DataFrame:
    """Rows of groups with more than one root, with the root most of the group's rows have."""
    sizes = placed.groupBy(key, "root").agg(F.count(F.lit(1)).alias("c"))
    main = sizes.groupBy(key).agg(
        F.max(F.struct("c", "root")).alias("main"), F.count(F.lit(1)).alias("roots")
    ).where("roots > 1").select(key, F.col("main.root").alias("main"))
    return placed.join(main.hint("merge"), key)


def near_copies(docs: DataFrame, percent: int = 80, size: int = 5,
                content: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs(doc_id, text)``.

    Documents link if ``100 * |intersection| >= percent * |union|`` of their shingle sets. Null
    and empty texts have no shingles and link with nothing. Rows with a null ``doc_id`` take part;
    a component's id is its smallest non-null one, and such a row is kept only in a component
    without ids. Rows that repeat a ``doc_id`` are told apart by their texts; equal rows get equal
    results. With ``content`` a row also has the hash of its text (``xxhash64``), which with the id
    names it where ids repeat. Other columns are ignored; an empty table gives no rows.
    """
    stages = Stages(docs.sparkSession, "near-copies")
    rows = stages.write(signatures(docs, size, content), "signatures")
    classes = rows.where("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands"))
    bands = classes.select("class", "n", F.explode("bands").alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = stages.write(
        bands.join(shared.drop("members").hint("merge"), "bucket"), "members")

    wanted = members.select("class").distinct()
    found = rows.select("doc_id", "class").join(wanted.hint("merge"), "class", "left_semi")
    chosen = found.groupBy("class").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    texts = texts.join(chosen.hint("merge"), texts.doc_id.eqNullSafe(chosen.doc_id), "left_semi")
    sets = texts.mapInArrow(
        lambda b: _batches(b, size, True), "class binary, shingles array<long>")
    sets = stages.write(sets.dropDuplicates(["class"]), "sets")

    counts = np.zeros(ORDER, dtype=np.int64)
    slot = F.explode(F.transform("shingles", lambda x: F.pmod(x, F.lit(ORDER)))).alias("slot")
    for r in sets.select(slot).groupBy("slot").count().collect():  # at most ORDER rows
        counts[r["slot"]] = r["count"]
    shared_counts = docs.sparkSession.sparkContext.broadcast(counts)
    rare = stages.write(sets.mapInArrow(
        lambda b: _prefixes(b, shared_counts, percent),
        "class binary, central double, prefix array<long>, "
        + ", ".join(f"{c} long" for c in SKETCH)), "prefixes")
    members = stages.write(
        members.join(rare.select("class", "central").hint("merge"), "class"), "placed")

    links = tested = labels = None  # confirmed pairs, all pairs compared, (node, root)

    def rooted(rows: DataFrame) -> DataFrame:
        if labels is None:
            return rows.withColumn("root", F.col("class"))
        own = labels.withColumnRenamed("node", "class")
        return rows.join(own.hint("merge"), "class", "left").withColumn(
            "root", F.coalesce("root", "class"))

    for step in ("star", "second star", "rest"):
        placed = rooted(members)
        if step == "rest":
            # Documents that share a bucket with another component, by their rarest shingles.
            mixed_up = _by_main(placed, "bucket").select("class", "n", "root").distinct()
            prefixes = mixed_up.join(rare.drop("central").hint("merge"), "class")
            placed = stages.write(prefixes.select(
                "class", "n", "root", *SKETCH,
                F.posexplode("prefix").alias("at", "bucket")), "rest")
        unsure = _by_main(placed, "bucket")
        # At first nothing is connected, and any document may be the star.
        chosen = unsure if step == "star" else unsure.where("root <> main")
        if step != "rest":
            by_center = Window.partitionBy("bucket").orderBy(F.desc("central"), "class")
            chosen = chosen.withColumn("place", F.row_number().over(by_center)).where("place = 1")
        chosen = chosen.select(*[F.col(c).alias(f"star_{c}") for c in chosen.columns])
        near = f"root <> star_root and 100 * least(n, star_n) >= {percent} * greatest(n, star_n)"
        if step == "rest":
            # At the first shingle two sets share, what follows must hold the whole intersection.
            near += (f" and (100 + {percent}) * least(n - at, star_n - star_at)"
                     f" >= {percent} * (n + star_n)")
            apart = " + ".join(f"bit_count({c} ^ star_{c})" for c in SKETCH)
            near += f" and (100 + {percent}) * ({apart}) <= (100 - {percent}) * (n + star_n)"
        pairs = unsure.join(
            chosen.hint("merge"), (F.col("bucket") == F.col("star_bucket")) & F.expr(near)
        ).select(F.least("class", "star_class").alias("a"),
                 F.greatest("class", "star_class").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested.hint("merge"), ["a", "b"], "left_anti")
        new = stages.write(_confirm(pairs, sets, percent), "compared")
        tested = new.select("a", "b") if tested is None else tested.union(new.select("a", "b"))
        found = new.where("linked").select("a", "b")
        if not found.isEmpty():
            links = found if links is None else links.union(found)
            labels = stages.write(components(links, stages), "labels")

    least = rooted(classes.select("class", "doc_id"))
    component = least.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_class = stages.write(least.join(component.hint("merge"), "root").select(
        "class", "component_id"), "components")
    own = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.drop("bands").join(by_class.hint("merge"), "class", "left").select(
        "doc_id", "n_shingles", own.alias("component_id"), *["content"] * content
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


_SETS = r"""
words as (
    select doc_id, list_filter(
        regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda w: w <> '') as w from documents),
sets as (
    select doc_id, case when len(w) = 0 then []
        when len(w) < 5 then [array_to_string(w, ' ')]
        else list_sort(list_distinct(list_transform(range(1, len(w) - 3),
            lambda i: array_to_string(w[i:i + 4], ' ')))) end as s from words),
classes as (
    select min(doc_id) as doc_id, s, len(s) as n from sets where len(s) > 0 group by s),
shingles as (select doc_id, n, unnest(s) as s from classes)"""

ORACLE = f"""
with recursive {_SETS},
links as materialized (
    select x.doc_id as a, y.doc_id as b from shingles x join shingles y
    on x.s = y.s and x.doc_id < y.doc_id
    and 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
    group by x.doc_id, y.doc_id, x.n, y.n
    having 100 * count(*) >= 85 * (x.n + y.n - count(*))),
both_ways as materialized (
    select a, b from links union select b, a from links),
reach(a, b) as (
    select doc_id, doc_id from classes union
    select r.a, e.b from reach r join both_ways e on r.b = e.a),
roots as (select a, min(b) as root from reach group by a)
select t.doc_id, cast(len(t.s) as bigint) as n_shingles,
    coalesce(r.root, t.doc_id) as component_id,
    t.doc_id = coalesce(r.root, t.doc_id) as kept
from sets t left join classes c on t.s = c.s left join roots r on r.a = c.doc_id
"""


@query("op5_minmax_near_dedup", ORACLE)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"), percent=85)
