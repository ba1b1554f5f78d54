"""Token counts through a digest cache (9).

A text is known by the digest of its content and of the tokenizer's vocabulary. Counts already
stored under both are joined; only distinct texts without one are encoded, once each, and appended
to the store. Normalising must not change a count, so it only makes null an empty text: case,
spaces and Unicode forms all matter to a byte-level vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm.encoding import encode, version
from tidebook.llm.registry import query, table
from tidebook.llm.stages import Stages

VOCABULARY = "byte_bpe_50k.json"
CACHE = "digest binary, tokenizer string, n_tokens long"
#: Texts encoded at once.
CHUNK = 64


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        counts: list[int] = []
        for at in range(0, len(texts), CHUNK):
            part = texts.slice(at, CHUNK).to_pylist()
            counts += [len(ids) for ids in encode(vocabulary, part)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("digest"), pa.array([version(vocabulary)] * len(counts), pa.string()),
             pa.array(counts, pa.int64())], ["digest", "tokenizer", "n_tokens"])


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; an empty table if nothing is stored yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], CACHE)
    return spark.read.schema(CACHE).parquet(path)


def token_counts(
    docs: DataFrame, cache_path: str, vocabulary: str = VOCABULARY, limit: int = 1024
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs(doc_id, text)``.

    A null text counts as an empty one: no bytes, no tokens. Rows are independent, so null or
    repeated ids and repeated rows keep a row each; equal texts are encoded once. Other columns are
    ignored; an empty table gives no rows. ``cache_path`` is a folder all executors share; entries
    that a failed or concurrent run left twice are read as one, for they are equal.
    """
    spark = docs.sparkSession
    tokenizer = version(vocabulary)
    text = F.coalesce(F.col("text"), F.lit(""))
    known = read_cache(spark, cache_path).where(F.col("tokenizer") == tokenizer)
    texts = docs.select(text.alias("text")).withColumn(
        "digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    misses = texts.join(known.select("digest").hint("merge"), "digest", "left_anti") \
        if not known.isEmpty() else texts
    # One text per digest: copies combine before and in the shuffle.
    misses = misses.groupBy("digest").agg(F.first("text").alias("text"))
    misses.mapInArrow(lambda b: _encoded(b, vocabulary), CACHE).write.mode("append").parquet(
        cache_path)
    counts = read_cache(spark, cache_path).where(F.col("tokenizer") == tokenizer).groupBy(
        "digest").agg(F.min("n_tokens").alias("n_tokens"))
    rows = docs.select(
        F.col("doc_id").cast("long"), F.octet_length(text).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    return rows.join(counts.hint("merge"), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Stages(spark, "token-counts").folder
    return token_counts(table(spark, sf_dir, "documents"), f"{store}/cache")
