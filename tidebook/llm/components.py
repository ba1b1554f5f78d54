"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.llm.stages import Stages


def _digest(edges: DataFrame) -> tuple:
    """The number of distinct edges and 128 bits of them as a set."""
    both = [F.bit_xor(F.xxhash64(*ends)) for ends in (("a", "b"), ("b", "a"))]
    return tuple(edges.agg(F.count(F.lit(1)), *both).first())


def components(edges: DataFrame, stages: Stages) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the smallest node reachable.

    Every round points each node at the smallest node of its neighbourhood and rewires its edges
    there (large star, then small star), until nothing changes, which a digest of the edges tells.
    Groups only aggregate a minimum, so a node with very many neighbours combines on the map side;
    no group is collected.
    """
    edges = stages.write(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _digest(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        # Large star: larger neighbours move to the smallest node around.
        large = both.where("b > a").join(least.hint("merge"), "a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = stages.write(large.distinct(), "large")
        # Small star: a node and its smaller neighbours move to the smallest of them.
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower.hint("merge"), "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.*").where("a <> b")
        after = stages.write(small.distinct(), "edges")
        stages.drop(edges, large)
        edges, last = after, before
        before = _digest(edges)
        if before == last:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
