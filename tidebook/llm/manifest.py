"""Merkle manifest of a dataset by time-forward processing (11).

A node's label is its level and its place in the level. Digests are messages to the parent's label,
delivered by a priority queue ordered by label. The queue is external: labels are cut into blocks
of ``2**LEVELS`` neighbours, Spark's shuffle sorts the messages by block and label, and one task
works through a block with a heap that never holds more than the block. A block's last digest is
the message to the next round, so a group of any size takes as many rounds as its size has factors
of a block, and no task sees a group.

What a child needs of its level is kept with it. The reversed sweep starts at the root and delivers
to each block what stands above it, which is the end of the proof of every leaf in the block.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm.ordering import numbered
from tidebook.llm.registry import query, table
from tidebook.llm.stages import Stages

#: Levels a task works through at once; a block has ``2**LEVELS`` nodes.
LEVELS = 12

#: A proof step is ``L`` or ``R``, the side of the sibling, and its digest; ``-`` without sibling.
ALONE = "-"


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def block_tree(digests: list[str], levels: int | None) -> tuple[str, list[list[str]]]:
    """The last digest of a block and each node's proof steps up to it.

    ``levels`` are climbed even by a single node; without it, until one node remains.
    """
    queue = [(0, i, d) for i, d in enumerate(digests)]
    heapify(queue)
    counts = {0: len(digests)}
    steps: dict[tuple[int, int], str] = {}
    while True:
        level, i, digest = heappop(queue)
        if level == levels or (levels is None and counts[level] == 1):
            break
        if queue and queue[0][:2] == (level, i + 1):
            right = heappop(queue)[2]
            steps[level, i], steps[level, i + 1] = "R" + right, "L" + digest
            digest += right
        else:
            steps[level, i] = ALONE
        counts[level + 1] = (counts[level] + 1) // 2
        heappush(queue, (level + 1, i // 2, _digest(digest)))
    # The reversed sweep inside the block: labels from high to low.
    above: dict[tuple[int, int], list[str]] = {}
    for (level, i), step in sorted(steps.items(), reverse=True):
        above[level, i] = [step, *above.get((level + 1, i // 2), [])]
    return digest, [above.get((0, i), []) for i in range(len(digests))]


def _blocks(batches: Iterator[pa.RecordBatch], keys: list[str], levels: int):
    """Rows sorted by block and position, with the block's last digest and the steps up to it."""
    held: list[pa.RecordBatch] = []
    block = None

    def done():
        rows = pa.Table.from_batches(held)
        alone = rows.column("size")[0].as_py() <= 1 << levels
        top, proofs = block_tree(rows.column("digest").to_pylist(), None if alone else levels)
        rows = rows.append_column("top", pa.array([top] * len(rows), pa.string())).append_column(
            "proof", pa.array(proofs, pa.list_(pa.string())))
        yield from rows.combine_chunks().to_batches()

    for batch in batches:
        labels = list(zip(*[batch.column(k).to_pylist() for k in (*keys, "block")], strict=True))
        first = 0
        for i, label in enumerate(labels):
            if label != block:
                if i > first:
                    held.append(batch.slice(first, i - first))
                if held:
                    yield from done()
                held, first, block = [], i, label
        if first < len(labels):
            held.append(batch.slice(first))
    if held:
        yield from done()


def _round(nodes: DataFrame, keys: list[str], levels: int) -> DataFrame:
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
    blocked = nodes.withColumn("block", F.shiftright("position", levels))
    return blocked.repartition(*keys, "block").sortWithinPartitions(
        *keys, "block", "position").mapInArrow(
        lambda b: _blocks(b, keys, levels),
        f"{schema}, block long, top string, proof array<string>")


def climb(
    nodes: DataFrame, keys: list[str], stages: Stages, levels: int = LEVELS
) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of ``nodes(*keys, position, size, digest)`` from the leaves up, and the roots.

    Every round has a row per node with its ``block``, the block's ``top`` and the ``proof`` steps
    up to it; the roots are ``*keys, digest``.
    """
    rounds, largest = [], None
    while largest is None or largest > 1:
        done = stages.write(_round(nodes, keys, levels), f"round-{len(rounds)}")
        rounds.append(done)
        if largest is None:
            largest = done.agg(F.max("size")).first()[0] or 0
        largest = -(-largest // (1 << levels))
        size = F.shiftright(F.first("size") + (1 << levels) - 1, levels)
        nodes = done.groupBy(*keys, "block").agg(
            F.first("top").alias("digest"), size.alias("size")).withColumnRenamed(
            "block", "position")
    return rounds, nodes.select(*keys, "digest")


def deliver(rounds: list[DataFrame], keys: list[str], above: DataFrame | None) -> DataFrame:
    """The leaves with whole proofs: the reversed sweep over ``rounds``.

    ``above`` has what stands over the roots: ``*keys, proof`` and columns to hand down. It is
    joined to a round by group and block, which at most ``2**levels`` nodes share.
    """
    for nodes in reversed(rounds):
        nodes = nodes.drop("top")
        if above is None:
            above = nodes
            continue
        at = [c for c in above.columns if c in ("position", *keys)]
        given = above.select(
            *[F.col(c).alias(f"_{c}") for c in at], F.col("proof").alias("_proof"),
            *[c for c in above.columns if c not in nodes.columns])
        same = F.lit(True) if "position" not in at else F.col("block") == F.col("_position")
        for key in keys:
            same &= F.col(key).eqNullSafe(F.col(f"_{key}"))
        above = nodes.join(given, same).withColumn("proof", F.concat("proof", "_proof")).drop(
            "_proof", *[f"_{c}" for c in at])
    return above.drop("block")


def _field(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(n_chars: Column) -> Column:
    """Digest of a document: each field as byte count, colon and value; ``-`` for null."""
    return F.sha2(F.concat(
        _field(F.col("doc_id").cast("long")), _field(F.col("source")), _field(F.col("lang")),
        _field(n_chars.cast("long")), _field(F.col("text"))), 256)


def fold(proof: Column, start: Column) -> Column:
    """The root that a leaf digest and its proof steps lead to."""
    def step(digest: Column, at: Column) -> Column:
        other = F.substring(at, 2, 64)
        return F.sha2(F.when(at.startswith("L"), F.concat(other, digest))
                      .when(at.startswith("R"), F.concat(digest, other)).otherwise(digest), 256)

    return F.aggregate(proof, start, step)


def manifest(docs: DataFrame, levels: int = LEVELS, carry: dict[str, Column] | None = None
             ) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof`` of every row of ``docs``, and the ``carry`` columns.

    ``docs`` has ``doc_id, source, lang, n_chars, text``; other columns are ignored. Leaves of a
    ``lang`` ascend by ``doc_id`` (null first), then by digest; equal rows are leaves of their own.
    Two neighbours become a node, a last one alone becomes the digest of itself, until one remains;
    the roots of the languages (null first, then by bytes) become the root likewise. ``proof`` has a
    step per level: ``L`` or ``R``, the side of the sibling, with its digest, or ``-`` for none.
    ``carry`` names further columns computed from ``docs`` and handed through. Null fields count as
    ``-``, unlike empty ones; an empty table gives no rows.
    """
    carry = carry or {}
    stages = Stages(docs.sparkSession, "manifest")
    leaves = stages.write(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        leaf_digest(F.col("n_chars")).alias("digest"),
        *[c.alias(name) for name, c in carry.items()]), "leaves")
    nodes = numbered(leaves, ["lang"], ["doc_id", "digest"], stages, "sorted")
    rounds, subroots = climb(nodes, ["lang"], stages, levels)
    tops = numbered(subroots.withColumn("tree", F.lit(0)), ["tree"], ["lang"], stages, "subroots")
    upper, roots = climb(tops, ["tree"], stages, levels)
    root = roots.select(F.col("digest").alias("root"), "tree",
                        F.array().cast("array<string>").alias("proof"))
    above = deliver(upper, ["tree"], root).select(
        "lang", "proof", "root", F.col("digest").alias("subroot"))
    return deliver(rounds, ["lang"], above).select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof", *carry)


#: All trees level by level, and every document's path upward.
ORACLE = """
with recursive bits as (
    select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
        lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
coded as (
    select d.*, xor(list_reduce(list_prepend(4294967295::bigint,
        list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ord(c)::bigint)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as crc
    from documents d, bits),
filled as (
    select doc_id, lang, n_chars, crc,
        coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-')
        || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-') as before,
        coalesce(strlen(text) || ':' || text, '-') as after from coded),
leaves as (
    select doc_id, lang, sha256(before || coalesce(strlen(cast(n_chars as varchar)) || ':'
            || n_chars, '-') || after) as leaf,
        sha256(before || coalesce(strlen(cast(n_chars + changed as varchar)) || ':'
            || (n_chars + changed), '-') || after) as given,
        row_number() over (partition by lang order by doc_id nulls first) - 1 as p,
        count(*) over (partition by lang) as c
    from (select *, case when crc % 7 = 0 then 1 else 0 end as changed from filled)),
nodes(lang, level, p, c, h) as (
    select lang, 0, p, c, leaf from leaves
    union all
    select a.lang, a.level + 1, a.p // 2, (a.c + 1) // 2, sha256(a.h || coalesce(b.h, ''))
    from nodes a left join nodes b
        on a.lang is not distinct from b.lang and b.p = a.p + 1
    where a.c > 1 and a.p % 2 = 0),
subroots as (
    select lang, h, level, row_number() over (order by lang nulls first) - 1 as p,
        count(*) over () as c from nodes where c = 1),
upper(level, p, c, h) as (
    select 0, p, c, h from subroots
    union all
    select a.level + 1, a.p // 2, (a.c + 1) // 2, sha256(a.h || coalesce(b.h, ''))
    from upper a left join upper b on b.p = a.p + 1
    where a.c > 1 and a.p % 2 = 0),
path(doc_id, lang, step, p, given) as (
    select doc_id, lang, 0, p, given from leaves
    union all
    select t.doc_id, t.lang, t.step + 1, t.p // 2, sha256(
        case when t.p % 2 = 1 then o.h || t.given else t.given || coalesce(o.h, '') end)
    from path t
    join nodes n on n.lang is not distinct from t.lang and n.level = t.step and n.p = t.p
    left join nodes o on o.lang is not distinct from t.lang and o.level = t.step
        and o.p = xor(t.p, 1)
    where n.c > 1),
low_end as (select doc_id, arg_max(given, step) as given from path group by doc_id),
high(doc_id, step, p, given) as (
    select e.doc_id, 0, s.p, e.given from low_end e join leaves l using (doc_id)
    join subroots s on s.lang is not distinct from l.lang
    union all
    select t.doc_id, t.step + 1, t.p // 2, sha256(
        case when t.p % 2 = 1 then o.h || t.given else t.given || coalesce(o.h, '') end)
    from high t join upper n on n.level = t.step and n.p = t.p
    left join upper o on o.level = t.step and o.p = xor(t.p, 1)
    where n.c > 1),
siblings as (
    select t.doc_id, 0 as part, t.step, o.h from path t join nodes o
        on o.lang is not distinct from t.lang and o.level = t.step and o.p = xor(t.p, 1)
    union all
    select t.doc_id, 1, t.step, o.h from high t join upper o
        on o.level = t.step and o.p = xor(t.p, 1)),
proofs as (
    select doc_id, sha256(string_agg(h, '' order by part, step)) as proof from siblings
    group by doc_id),
ends as (select doc_id, arg_max(given, step) as folded from high group by doc_id)
select l.doc_id, l.leaf, s.h as subroot, r.h as root,
    coalesce(p.proof, sha256('')) as proof_sha256, e.folded as folded_root,
    e.folded = r.h as verified
from leaves l join subroots s on s.lang is not distinct from l.lang
join (select h from upper where c = 1) r on true
left join proofs p using (doc_id) join ends e using (doc_id)
"""


@query("op11_merkle_manifest", ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 7 == 0
    tampered = F.when(changed, leaf_digest(F.col("n_chars") + 1)).otherwise(
        leaf_digest(F.col("n_chars")))
    found = manifest(table(spark, sf_dir, "documents"), carry={"given": tampered})
    siblings = F.transform(F.filter("proof", lambda x: x != ALONE),
                           lambda x: F.substring(x, 2, 64))
    folded = found.withColumn("folded_root", fold(F.col("proof"), F.col("given")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
