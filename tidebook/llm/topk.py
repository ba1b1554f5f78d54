"""Exact top-k search by histogram selection (8).

Queries go through in blocks of bounded size; each block scores all vectors. Instead of sorting
scores, tasks count them in histograms that are summed over all tasks; the bucket that holds a
query's kth score is cut into buckets again until it is one score wide. A last pass keeps the
scores above the kth, and of those equal to it the smallest ids: no task sends more than k rows
for a query, so a vector that fills a third of the table sends no more than others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidebook.llm.registry import query, table

#: Queries scored together, buckets of one histogram, and scores held at once in a task.
BLOCK, BUCKETS, SCORES = 2048, 256, 1 << 22
_EXACT = float(1 << 53)


def _vectors(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids (and which are null) and whole-number components of the batch."""
    ids = batch.column("vec_id")
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    return (ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False),
            flat.reshape(len(ids), dim))


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Whole-number inner products; doubles carry them as long as they are exact."""
    bound = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * queries.shape[1]
    if bound < _EXACT:
        return (queries @ vectors.T).astype(np.int64)
    as_ints = np.vectorize(int, otypes=[object])
    exact = as_ints(queries) @ as_ints(vectors).T
    return exact.astype(np.int64)  # an error if a score is no long


def _blocks(batches: Iterator[pa.RecordBatch], query_ids, queries):
    """Ids, null flags and scores, with a query's own rows marked."""
    step = max(1, SCORES // len(queries))
    for batch in batches:
        ids, missing, vectors = _vectors(batch, queries.shape[1])
        for at in range(0, len(ids), step):
            own_ids, own_missing = ids[at:at + step], missing[at:at + step]
            scores = _scores(queries, vectors[at:at + step])
            other = (own_ids[None, :] != query_ids[:, None]) | own_missing[None, :]
            yield own_ids, own_missing, scores, other


def _histogram(batches, query_ids, queries, low, width):
    """Counts of scores by query and bucket; a bucket above the range stands for all above."""
    counts = np.zeros((len(queries), BUCKETS + 1), dtype=np.int64)
    rows = np.arange(len(queries))[:, None] * (BUCKETS + 1)
    for _, _, scores, other in _blocks(batches, query_ids, queries):
        bucket = np.minimum((scores - low[:, None]) // width[:, None], BUCKETS)
        bucket = (bucket + rows)[other & (bucket >= 0)]
        counts += np.bincount(bucket, minlength=counts.size).reshape(counts.shape)
    q, b = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(q, pa.int32()), pa.array(b, pa.int32()), pa.array(counts[q, b])],
        ["q", "bucket", "n"])


def _winners(batches, query_ids, queries, kth, k):
    """Rows above the kth score, and the k smallest ids of the rows at it."""
    ties: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
    for ids, missing, scores, other in _blocks(batches, query_ids, queries):
        other &= ~missing[None, :]
        q, v = np.nonzero(other & (scores > kth[:, None]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(query_ids[q]), pa.array(ids[v]), pa.array(scores[q, v])],
            ["query_id", "vec_id", "score"])
        equal = other & (scores == kth[:, None])
        for q in np.flatnonzero(equal.any(axis=1)):
            ties[q] = np.sort(np.concatenate([ties[q], ids[equal[q]]]))[:k]
    for q, found in enumerate(ties):
        if len(found):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), query_ids[q])), pa.array(found),
                 pa.array(np.full(len(found), kth[q]))], ["query_id", "vec_id", "score"])


def _select(spark: SparkSession, vectors: DataFrame, query_ids: np.ndarray, queries: np.ndarray,
            largest: float, k: int) -> DataFrame:
    """The top k of one block of queries, from ranges known to hold all scores."""
    bound = np.ceil(np.abs(queries).sum(axis=1) * largest).astype(np.float64)
    top = np.minimum(bound, 2.0**61).astype(np.int64)
    low, width = -top, np.ones(len(queries), dtype=np.int64)
    while (wide := width * float(BUCKETS) <= 2.0 * top).any():
        width[wide] *= BUCKETS  # powers of BUCKETS: a bucket is the next pass's range exactly
    kth = np.full(len(queries), np.iinfo(np.int64).min)
    need = np.full(len(queries), k)
    undecided = np.ones(len(queries), dtype=bool)
    while undecided.any():
        part = np.flatnonzero(undecided)
        args = query_ids[part], queries[part], low[part], width[part]
        rows = vectors.mapInArrow(
            lambda b, a=args: _histogram(b, *a), "q int, bucket int, n long"
        ).groupBy("q", "bucket").agg(F.sum("n").alias("n"))
        counts = np.zeros((len(part), BUCKETS + 1), dtype=np.int64)
        for r in rows.toLocalIterator():  # at most BLOCK x BUCKETS counts
            counts[r.q, r.bucket] = r.n
        # From the second pass on all above the range is counted in ``need`` already.
        counts[:, BUCKETS] = 0
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1]  # at or above each bucket
        for i, q in enumerate(part):
            held = np.flatnonzero(above[i] >= need[q])
            if not len(held):  # fewer than k vectors: all are wanted
                undecided[q] = False
                continue
            b = held[-1]
            need[q] -= above[i, b] - counts[i, b]
            low[q] += b * width[q]
            if width[q] == 1:
                kth[q], undecided[q] = low[q], False
            else:
                width[q] //= BUCKETS
    return vectors.mapInArrow(
        lambda b: _winners(b, query_ids, queries, kth, k),
        "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k best rows of ``vectors`` but itself.

    Both tables are ``(vec_id, embedding)``; a component x counts as floor(256 * x), a score is
    the whole-number inner product, and ties go to the smaller ``vec_id``. Vectors that are null,
    empty, of another length than the queries, or hold null or non-finite components take no
    part, nor do rows without an id. Rows that repeat an id are candidates of their own; of
    repeated query ids each distinct vector is a query. Scores must fit in 62 bits. Other columns are ignored; without
    queries or candidates there are no rows.
    """
    spark = vectors.sparkSession

    def whole(df: DataFrame) -> DataFrame:
        x = F.col("embedding")
        fit = x.isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e)
                                       & (F.abs(e.cast("double")) < float("inf")))
        return df.where(fit & F.col("vec_id").isNotNull() & (F.size(x) > 0)).select(
            F.col("vec_id").cast("long"),
            F.transform(x, lambda e: F.floor(F.lit(256.0) * e.cast("double")).cast("double")
                        ).alias("v"))

    candidates, asked = whole(vectors), whole(queries)
    dims = [r.d for r in asked.select(F.size("v").alias("d")).distinct().collect()]
    found = None
    for dim in sorted(dims):
        of_dim = candidates.where(F.size("v") == dim)
        size = F.max(F.array_max(F.transform("v", F.abs))).alias("m")
        largest = of_dim.agg(size).first().m or 0.0
        block: list = []
        rows = asked.where(F.size("v") == dim).distinct().toLocalIterator()
        for row in rows:
            block.append(row)
            if len(block) == BLOCK:
                found = _add(found, _block(spark, of_dim, block, largest, k))
                block = []
        if block:
            found = _add(found, _block(spark, of_dim, block, largest, k))
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _add(found: DataFrame | None, more: DataFrame) -> DataFrame:
    return more if found is None else found.union(more)


def _block(spark, candidates, block, largest, k) -> DataFrame:
    ids = np.array([r.vec_id for r in block], dtype=np.int64)
    return _select(spark, candidates, ids, np.array([r.v for r in block]), largest, k)


ORACLE = """
with whole as (
    select vec_id, list_transform(embedding, lambda x:
        cast(floor(256 * cast(x as double)) as bigint)) as v
    from embeddings where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select q.vec_id as query_id, c.vec_id,
        cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
    from whole q join whole c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
select query_id, cast(row_number() over (
    partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
from scored qualify rank <= 5
"""


@query("op8_exact_top_k", ORACLE)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)
