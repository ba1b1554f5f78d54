"""Catalog relations that change together: new versions first, then one commit record.

A relation is cut into buckets by a hash of its key. A commit rewrites only the buckets that the
keys it brings fall in, each to a folder of its version, and one record says where every bucket of
every relation now is (see ``commits``). So a commit costs about what it changes, however large the
catalog is. ``remove_old_versions`` deletes what no recent commit points to.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.merging import dedupe_latest, merge_rows
from ..session import checkpointed
from . import commits


def current_version(spark: SparkSession, root: str) -> int:
    return commits.newest(spark, root).version


#: Buckets of a relation, fixed when it is first written.
BUCKETS = 16
_BUCKET = "_bucket"


def _bucket_of(name: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*schemas.CATALOG_KEYS[name]), F.lit(buckets)).cast("int")


def _stored(
    spark: SparkSession, root: str, name: str, commit: commits.Commit,
    touched: Collection[int] | None = None,
) -> DataFrame | None:
    """A relation, or those of its buckets that are ``touched``; None when no commit wrote it."""
    if name in commit.locations:  # written whole, before relations had buckets
        return spark.read.option("mergeSchema", True).parquet(f"{root}/{commit.locations[name]}")
    columns = commit.notes.get("columns", {}).get(name)
    if columns is None:
        return None
    schema = T.StructType.fromJson(json.loads(columns))
    places = [place for part, place in commit.locations.items()
              if part.startswith(f"{name}/{_BUCKET}=")
              and (touched is None or int(part.rpartition("=")[2]) in touched)]
    if not places:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/{name}").parquet(
        *[f"{root}/{place}" for place in places]).select(*schema.names)


def read_relation(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A relation as of the newest commit, None when no commit wrote it."""
    return _stored(spark, root, name, commits.newest(spark, root))


def merged_relation(stored: DataFrame | None, rows: DataFrame, name: str) -> DataFrame:
    """A relation after merging the bundle's rows one after another, in order of ``ordinal``.

    A row may name columns it does not have in ``absent``: those keep what earlier rows, or the
    stored relation, have.
    """
    keys = schemas.CATALOG_KEYS[name]
    order = [F.col("ordinal").desc()] if "ordinal" in rows.columns else []
    if "absent" not in rows.columns:
        latest = dedupe_latest(rows, keys, order).drop("ordinal")
    else:
        values = [c for c in rows.columns if c not in (*keys, "ordinal", "absent")]
        last = rows.groupBy(*keys).agg(*[
            F.max_by(F.struct(c), F.when(~F.array_contains("absent", c), F.col("ordinal"))).alias(c)
            for c in values])
        latest = last
        kept = [] if stored is None else [c for c in values if c in stored.columns]
        if kept:
            old = stored.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in kept])
            latest = last.join(old, keys, "left")
        latest = latest.select(*keys, *[
            F.when(F.col(c).isNull(), F.col(f"_old_{c}")).otherwise(F.col(f"{c}.{c}")).alias(c)
            if c in kept else F.col(f"{c}.{c}").alias(c) for c in values])
    if stored is None:
        return latest
    return merge_rows(stored, latest, keys, schemas.CATALOG_PROTECTED.get(name, ()))


def commit_bundle(
    spark: SparkSession, root: str, relations: Mapping[str, DataFrame], buckets: int = BUCKETS
) -> int:
    """Upsert every relation of a bundle and make all of them visible at once.

    A relation may carry an ``ordinal`` column: among rows with one key the highest wins, as if
    they had been merged one after another. Relations the bundle does not bring, and buckets none of
    its keys falls in, stay where they are.
    """
    before = commits.newest(spark, root)
    version = commits.version_folder(before.version + 1)
    locations = dict(before.locations)
    notes = {"columns": {}, "buckets": {}} | {k: dict(v) for k, v in before.notes.items()}
    for name in schemas.CATALOG_KEYS:
        rows = relations.get(name)
        if rows is None:
            continue
        count = int(notes["buckets"].setdefault(name, str(buckets)))
        rows = checkpointed(rows)  # read for its buckets, then for its rows
        found = rows.select(_bucket_of(name, count)).distinct().collect()
        merged = merged_relation(
            _stored(spark, root, name, before, {r[0] for r in found}), rows, name)
        place = f"{name}/{version}"
        merged.withColumn(_BUCKET, _bucket_of(name, count)).hint(
            "rebalance", F.col(_BUCKET)).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy(_BUCKET).parquet(f"{root}/{place}")
        for part in commits.listed(spark, f"{root}/{place}"):
            if part.startswith(f"{_BUCKET}="):
                locations[f"{name}/{part}"] = f"{place}/{part}"
        locations.pop(name, None)
        notes["columns"][name] = json.dumps(merged.schema.jsonValue())
    commits.record(spark, root, before.version + 1, locations, notes=notes)
    return before.version + 1


def remove_old_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete bucket folders that none of the newest ``keep`` commits points to."""
    return sorted(place for name in schemas.CATALOG_KEYS
                  for place in commits.remove_old(spark, root, keep, f"{name}/"))
