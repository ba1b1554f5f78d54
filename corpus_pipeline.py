"""A training corpus from ``documents``: each stage works on all rows its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table that is written and read again as
the next one's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm import (  # noqa: F401
    conversations,
    decontamination,
    language,
    licenses,
    manifest,
    near_copies,
    packing,
    personal_data,
    repeated_lines,
    substrings,
    token_counts,
    topk,
    toxicity,
)
from tidebook.llm.registry import query, table
from tidebook.llm.stages import Stages

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, which replaces ``lang``; those without any letter go.

    The model learns from the stage's own rows with a ``lang``.
    """
    model = language.train(docs)
    found = language.annotate(docs, model)
    return found.where(F.col("lang_pred") != language.UNDETERMINED).select(
        "doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of runs of at least 50 words; texts left empty go."""
    cleared = repeated_lines.drop_repeated_lines(docs)
    return cleared.where("n_removed = 0 or trim(text) <> ''").withColumn(
        "n_chars", F.length("text").cast("long")).select(*COLUMNS)


def _key() -> Column:
    """What names a row: ids may be null and may repeat, so a hash of the text goes with them."""
    return F.struct(F.col("doc_id").cast("long").alias("doc_id"),
                    F.xxhash64("text").alias("content"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies at similarity 0.8, the one of smallest id.

    Rows equal in id and text are one document, and one of them stays. Rows that share an id only
    are judged by their own texts.
    """
    kept = near_copies.near_copies(docs, percent=80, content=True).where("kept").select(
        F.struct("doc_id", "content").alias("_key"))
    return docs.withColumn("_key", _key()).join(kept.hint("merge"), "_key", "left_semi"
                                                ).dropDuplicates(["_key"]).select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``; of rows that share an id, each by its text."""
    keyed = docs.withColumn("_key", F.xxhash64(_key()))
    found = decontamination.leaks(
        keyed.select(F.col("_key").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    found = found.select(F.col("doc_id").alias("_key")).distinct()
    return keyed.join(found.hint("merge"), "_key", "left_anti").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language", identify_language),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", keep_one_of_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: Learned models and tokenization are no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what stands between two is written to the shared folder."""
    written = Stages(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
