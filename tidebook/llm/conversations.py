"""Prefix trie of conversations by van Emde Boas recursion (13).

Sequences of turns are cut at half depth: the name of the part above the cut is the root of the
forest of the parts below. Both halves are cut again in the same way until a piece has at most
``PIECE`` turns, so the number of rounds is the logarithm of the longest conversation. A round
names the cut prefixes of all pieces at once, from what the pieces aggregate to, so the upper trie
and all lower forests are built in parallel and no task gathers a conversation.

A name is a pair of 64-bit hashes combined over the turns and their places. Combining is
commutative and can be undone, so names aggregate on the map side, a node's parent is known without
a join, and the name of a prefix does not depend on where it was cut.

Totals go the other way. A node's weight is kept by its smallest member, whose own path then holds
all ancestors that have to learn of it. Inside a piece that is a sum over at most ``PIECE`` rows;
the total of every lower half is grafted onto the turns of its upper half, round by round, and a
node sums what its members hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidebook.llm.ordering import numbered
from tidebook.llm.registry import query, table
from tidebook.llm.stages import Stages

#: Turns of a piece that is not cut further.
PIECE = 64
#: Conversations that take turns from the first of them, and the most turns they may take.
FAMILY, TAKEN = 100, 6
#: Ids that one row of a node's list of ends holds.
PACK = 4096

NAME = ["n1", "n2"]


def _turn_names() -> list:
    return [F.xxhash64(F.lit(seed), "role", "text").alias(f"t{seed}") for seed in (1, 2)]


def rebuilt(turns: DataFrame, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """Turns ``conv, d, t1, t2, chars`` (``d`` from 1) of the rebuilt conversations, and all ids."""
    own = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = numbered(own, ["conv"], ["turn", "role", "text"], stages, "ordered")
    own = stages.write(own.select(
        "conv", "position", "size", *_turn_names(), F.length("text").cast("long").alias("chars")),
        "turns")
    taken = F.crc32(F.col("conv").cast("string").cast("binary")) % TAKEN
    convs = own.groupBy("conv").agg(F.first("size").alias("size")).select(
        "conv", (F.col("conv") - F.col("conv") % FAMILY).alias("base"), taken.alias("taken"))
    opening = own.where(f"position < {TAKEN}").select(
        F.col("conv").alias("base"), "position", "t1", "t2", "chars", "size")
    given = convs.join(opening, "base").where("position < taken").select(
        "conv", (F.col("position") + 1).alias("d"), "t1", "t2", "chars")
    sizes = own.where("position = 0").select(F.col("conv").alias("base"), F.col("size").alias("has"))
    shifted = convs.join(sizes, "base", "left").select(
        "conv", "taken", F.least("taken", F.coalesce("has", F.lit(0))).alias("got"))
    rest = own.join(shifted, "conv").where("position >= taken").select(
        "conv", (F.col("got") + F.col("position") - F.col("taken") + 1).alias("d"),
        "t1", "t2", "chars")
    # A turn's place counts, so that equal turns at two places do not cancel out.
    placed = given.union(rest).select(
        "conv", "d", F.shiftright(F.col("d") - 1, PIECE.bit_length() - 1).alias("piece"),
        F.xxhash64(F.lit(3), "d", "t1", "t2").alias("x1"),
        F.xxhash64(F.lit(4), "d", "t1", "t2").alias("x2"), "chars")
    return stages.write(placed, "rebuilt"), convs.select("conv")


def halves(pieces: DataFrame, values: dict[str, str], lower: bool, largest: int) -> DataFrame:
    """What the other halves of all cuts hold for each piece: ``conv, piece`` and ``values``.

    Per level, pieces are cut into runs of ``2**level`` whose halves are a run each. A piece in a
    ``lower`` half receives the aggregate of its upper half (else the other way round); ``values``
    maps columns to their aggregate, ``bit_xor`` or ``sum``. A run is one row after aggregation, and
    the halves of a level come from those of the level below, so a level has half the rows.
    """
    into = {c: F.expr(f"{how}({c})").alias(c) for c, how in values.items()}
    half, level, given = pieces, 0, []
    while largest >> level:
        runs = half.select("conv", F.col("piece").alias("run"), *values)
        source = runs.where(f"run % 2 = {0 if lower else 1}").select(
            "conv", F.shiftright("run", 1).alias("at"), *values)
        at = pieces.select("conv", "piece").where(
            F.shiftright("piece", level) % 2 == (1 if lower else 0))
        given.append(at.withColumn("at", F.shiftright("piece", level + 1)).join(
            source, ["conv", "at"]).select("conv", "piece", *values))
        half = runs.groupBy("conv", F.shiftright("run", 1).alias("piece")).agg(*into.values())
        level += 1
    if not given:
        return pieces.limit(0)
    return reduce(DataFrame.union, given).groupBy("conv", "piece").agg(*into.values())


def named(rows: DataFrame, stages: Stages, largest: int) -> DataFrame:
    """Turns with the name ``n1, n2`` of the prefix that ends there, and ``p1, p2`` of its parent."""
    inside = Window.partitionBy("conv", "piece").orderBy("d")
    placed = rows.withColumns({
        "n1": F.bit_xor("x1").over(inside), "n2": F.bit_xor("x2").over(inside)})
    if largest:
        long = rows.groupBy("conv", "piece").agg(
            F.bit_xor("x1").alias("c1"), F.bit_xor("x2").alias("c2"))
        cut = halves(stages.write(long, "pieces"), {"c1": "bit_xor", "c2": "bit_xor"}, True,
                     largest)
        placed = placed.join(cut, ["conv", "piece"], "left").withColumns({
            n: F.col(n).bitwiseXOR(F.coalesce(c, F.lit(0))) for n, c in (("n1", "c1"), ("n2", "c2"))
        }).drop("c1", "c2")
    return stages.write(placed.withColumns({
        "p1": F.col("n1").bitwiseXOR(F.col("x1")), "p2": F.col("n2").bitwiseXOR(F.col("x2"))
    }).drop("x1", "x2"), "named")


def grafted(rows: DataFrame, weights: DataFrame, stages: Stages, largest: int) -> DataFrame:
    """Turns of ``rows`` with the ``saved`` and ``leaves`` that their conversation keeps from there
    downward."""
    kept = rows.select("conv", "d", "piece", *NAME).join(
        weights, ["conv", "d"], "left").fillna(0, ["saved", "leaves"])
    kept = stages.write(kept, "weights")
    downward = Window.partitionBy("conv", "piece").orderBy(F.desc("d"))
    summed = kept.withColumns({c: F.sum(c).over(downward) for c in ("saved", "leaves")})
    if largest:
        totals = kept.groupBy("conv", "piece").agg(
            F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"))
        below = halves(stages.write(totals, "totals"),
                       {"more_saved": "sum", "more_leaves": "sum"}, False, largest)
        summed = summed.join(below, ["conv", "piece"], "left").withColumns({
            c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("saved", "leaves")})
    return summed.select("d", *NAME, "saved", "leaves")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``d, n1, n2, conv`` as rows of at most ``PACK`` ids of one node, comma-joined."""
    out: list[tuple] = []
    node, ids = None, []

    def close():
        out.append((*node, ids[0], ",".join(map(str, ids))))

    for batch in batches:
        for *label, conv in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if label != node or len(ids) == PACK:
                if node:
                    close()
                node, ids = label, []
            ids.append(conv)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in zip(*out, strict=True)] if out else
            [pa.array([], t) for t in _PACKED.types], schema=_PACKED)
        out.clear()
    if node:
        close()
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in zip(*out, strict=True)], schema=_PACKED)


_PACKED = pa.schema([("d", pa.int64()), ("n1", pa.int64()), ("n2", pa.int64()),
                     ("first", pa.int64()), ("ids", pa.string())])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node of its packs in order, fed to the hash as they come."""
    node, digest = None, None
    for batch in batches:
        done = []
        for *label, _, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if label == node:
                digest.update(b"," + ids.encode())
                continue
            if node:
                done.append((*node, digest.hexdigest()))
            node, digest = label, sha256(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*done, strict=True)], ["d", "n1", "n2", "ends_sha256"])
    if node:
        yield pa.RecordBatch.from_arrays(
            [pa.array([x]) for x in (*node, digest.hexdigest())], ["d", "n1", "n2", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ids of ``ends(d, n1, n2, conv)`` per node.

    Ids are sorted over range partitions and packed there, so a node that ends very many
    conversations comes to the hash, which has to read it in order, as few rows.
    """
    order = ["d", *NAME, "conv"]
    packs = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _packed, "d long, n1 long, n2 long, first long, ids string")
    return packs.repartition("d", *NAME).sortWithinPartitions("d", *NAME, "first").mapInArrow(
        _hashed, "d long, n1 long, n2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of all conversations of ``turns(conv_id, turn, role, text)``.

    Conversation ``c`` is first rebuilt: its first ``h`` turns are replaced by those of the first of
    its hundred, ``h`` being the remainder of its id's CRC-32 by 6. Turns are ordered by ``turn``
    (null first), those of one number by role and text; null roles and texts are empty. Rows without
    ``conv_id`` belong to no conversation; rows that repeat a turn are turns of their own; other
    columns are ignored. The root counts every conversation, also one left without turns; an empty
    table has the root only, without members or ``conv_id``.

    Returns ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256`` and the node's name ``n1, n2`` and that of its parent ``p1, p2``.
    """
    stages = Stages(turns.sparkSession, "prefix-trie")
    rows, convs = rebuilt(turns, stages)
    largest = rows.agg(F.max("piece")).first()[0] or 0
    rows = named(rows, stages, largest)
    deepest = rows.groupBy("conv").agg(F.max(F.struct("d", *NAME)).alias("end"))
    nodes = rows.groupBy("d", *NAME).agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.first("p1").alias("p1"),
        F.first("p2").alias("p2"), F.first("chars").alias("chars"))
    root = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).select(
        *[F.lit(0).cast("long").alias(c) for c in ("d", *NAME)], "conv", "n_convs",
        *[F.lit(None).cast("long").alias(c) for c in ("p1", "p2")],
        F.lit(0).cast("long").alias("chars"))
    nodes = stages.write(nodes.unionByName(root), "nodes")
    children = nodes.where("d > 0").groupBy(
        (F.col("d") - 1).alias("d"), F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = stages.write(nodes.join(children, ["d", *NAME], "left").fillna(0, ["n_children"]),
                         "families")
    saved = F.greatest(F.col("n_convs") - 1, F.lit(0)) * F.col("chars")
    own = nodes.select("conv", "d", saved.alias("saved"),
                       (F.col("n_children") == 0).cast("long").alias("leaves"))
    totals = grafted(rows, own.where("d > 0"), stages, largest)
    totals = totals.where("saved <> 0 or leaves <> 0").groupBy("d", *NAME).agg(
        F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))
    over_all = own.agg(
        *[F.lit(0).cast("long").alias(c) for c in ("d", *NAME)],
        F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))
    ends = convs.join(deepest, "conv", "left").select(
        *[F.coalesce(F.col(f"end.{c}"), F.lit(0)).alias(c) for c in ("d", *NAME)], "conv")
    parents = nodes.select(
        (F.col("d") + 1).alias("d"), F.col("n1").alias("p1"), F.col("n2").alias("p2"),
        F.col("conv").alias("parent_conv_id"))
    return nodes.join(totals.union(over_all), ["d", *NAME], "left").join(
        end_digests(ends), ["d", *NAME], "left").join(
        parents, ["d", "p1", "p2"], "left").select(
        F.col("conv").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", "n_convs",
        "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"),
        *NAME, "p1", "p2")


ORACLE = """
with bits as (
    select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
        lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
own as (
    select conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
        order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as s
    from conversations where conv_id is not null group by conv_id),
taken as (
    select conv_id, s, xor(list_reduce(list_prepend(4294967295::bigint,
        list_transform(string_split(cast(conv_id as varchar), ''), lambda c: ord(c)::bigint)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 6 as h from own, bits),
rebuilt as (
    select c.conv_id, list_concat(coalesce(b.s[1:c.h], []), c.s[c.h + 1:]) as s
    from taken c left join own b on b.conv_id = c.conv_id - c.conv_id % 100),
members as (
    select conv_id, s, unnest(range(0, len(s) + 1)) as d from rebuilt),
nodes as (
    select s[1:d] as k, d, min(conv_id) as conv_id, count(*) as n_convs,
        sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id)
            filter (len(s) = d), '')) as ends from members group by 1, 2),
valued as (
    select n.*, (n_convs - 1) * coalesce(length(k[-1].t), 0) as w,
        (select count(*) from nodes c where c.d = n.d + 1 and c.k[1:n.d] = n.k) as n_children
    from nodes n),
above as (
    select k, unnest(range(0, d + 1)) as d, w, n_children from valued),
totals as (
    select k[1:d] as k, d, sum(w) as saved, count(*) filter (n_children = 0) as n_leaves
    from above group by 1, 2)
select v.conv_id, v.d as depth, p.conv_id as parent_conv_id, v.n_convs, v.n_children, t.n_leaves,
    cast(t.saved as bigint) as saved_tokens, v.ends as ends_sha256
from valued v join totals t on t.d = v.d and t.k = v.k
left join nodes p on p.d = v.d - 1 and p.k = v.k[1:v.d - 1]
"""


@query("op13_conversation_trie", ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations")).drop(*NAME, "p1", "p2")
