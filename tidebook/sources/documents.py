"""Document corpora: ``(path, content)`` with JSON text as content, one row per file."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import file_name


def _yaml_to_json(text: str | None) -> str | None:
    """JSON text of a YAML document; NULL when it cannot be read."""
    if text is None:
        return None
    import yaml

    try:
        return json.dumps(yaml.safe_load(text), default=str, ensure_ascii=False)
    except (yaml.YAMLError, TypeError, ValueError):
        return None


@F.pandas_udf(T.StringType())
def yaml_to_json(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """YAML has no reader in Spark; only YAML files are sent here, the rest is NULL."""
    for batch in texts:
        yield batch.map(_yaml_to_json)


def read_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Every file below ``root`` whose name matches, with bad UTF-8 bytes replaced."""
    files = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter=glob)
        .load(root)
    )
    return files.select(
        F.regexp_replace("path", "^file:/+", "/").alias("path"),
        F.make_valid_utf8(F.col("content").cast("string")).alias("content"),
    )


def spec_corpus(files: DataFrame) -> DataFrame:
    """API specifications among the files, YAML turned into JSON text.

    A YAML file that cannot be read keeps NULL content, which the parsers report as a reject.
    """
    name = F.lower(file_name(F.col("path")))
    is_yaml = name.rlike(r"\.ya?ml$")
    specs = files.where(
        name.rlike(r".\.(yaml|yml|json)$") & ~F.contains(name, F.lit("postman"))
    )
    converted = yaml_to_json(F.when(is_yaml, F.col("content")))
    return specs.select(
        "path", F.when(is_yaml, converted).otherwise(F.col("content")).alias("content")
    )


def collection_corpus(files: DataFrame) -> DataFrame:
    """Request collections by either naming convention; names starting with ``_`` are helpers.

    One predicate over the file list takes every file once.
    """
    name = file_name(F.col("path"))
    wanted = name.endswith(".postman_collection.json") | name.endswith(".postman.json")
    return files.where(wanted & ~name.startswith("_"))


def read_spec_corpus(spark: SparkSession, root: str) -> DataFrame:
    return spec_corpus(read_files(spark, root, "*.{yaml,yml,json,YAML,YML,JSON}"))


def read_collection_corpus(spark: SparkSession, root: str) -> DataFrame:
    return collection_corpus(read_files(spark, root, "*.json"))


def read_manifest_corpus(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Manifests and the optional catalogs beside them, tied together by their folder."""
    files = read_files(spark, root, "*.json").select(
        F.substring_index("path", "/", -1).alias("name"),
        F.regexp_replace("path", "/[^/]*$", "").alias("doc_id"),
        "path",
        "content",
    )
    manifests = files.where(F.col("name") == "manifest.json")
    catalogs = files.where(F.col("name") == "catalog.json")
    return manifests.drop("name"), catalogs.drop("name")

