"""Transformation manifests to datasets, columns, transformations and lineage.

A manifest corpus has ``doc_id`` and ``content``; identifiers are resolved inside one manifest,
by joins on ``(doc_id, unique id)``. Those keys are unique on the resolving side, so a manifest
with very many models spreads over all tasks. Both sides come out of the same documents and are
larger than their files, whose size is all the optimizer knows: the hints rule out a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as x
from ..functions.projects import ProjectRules
from ..functions.values import first_filled, first_filled_map, once

PLATFORM = "dbt"
MALFORMED = "_malformed"
SOURCE = "struct<name: string, schema: string, source_name: string>"


def dataset_key(schema: Column, name: Column) -> Column:
    return F.concat(F.lit(f"{PLATFORM}."), schema, F.lit("."), name)


def _parsed(manifests: DataFrame) -> DataFrame:
    """Manifests parsed once per row; one that cannot be read is rejected whole."""
    doc = F.from_json(
        "content", f"{schemas.MANIFEST_DOC}, {MALFORMED} string",
        {"columnNameOfCorruptRecord": MALFORMED},
    )
    return once(manifests.select("doc_id", "content"), doc, "doc").withColumn(
        "bad", F.col("content").isNull() | F.col(f"doc.{MALFORMED}").isNotNull()
    )


def manifest_rejects(manifests: DataFrame) -> DataFrame:
    """Manifests that cannot be read; they add no rows to any relation."""
    return _parsed(manifests).where("bad").select("doc_id")


def _entries(manifests: DataFrame) -> DataFrame:
    """Model nodes and sources of the readable manifests, in one pass: a row has one of both."""
    nodes = F.transform(F.map_entries("doc.nodes"), lambda e: F.struct(
        e.key.alias("uid"), e.value.alias("text"), F.lit(None).cast(SOURCE).alias("source")))
    sources = F.transform(F.map_entries("doc.sources"), lambda e: F.struct(
        e.key.alias("uid"), F.lit(None).cast("string").alias("text"), e.value.alias("source")))
    none = F.array().cast(f"array<struct<uid: string, text: string, source: {SOURCE}>>")
    listed = _parsed(manifests).where(~F.col("bad")).select("doc_id", F.posexplode(
        F.concat(F.coalesce(nodes, none), F.coalesce(sources, none))).alias("at", "entry"))
    rows = once(listed.select("doc_id", "at", "entry.*"), F.from_json("text", schemas.MANIFEST_NODE),
                "node")
    schema = F.coalesce(first_filled(F.col("node.schema")), F.lit(PLATFORM))
    return rows.where(
        F.col("source").isNotNull() | (F.col("node.resource_type") == "model")
    ).select(
        "doc_id", "at", "uid", "node", "source",
        F.coalesce("node.name", x.last_dotted(F.col("uid"))).alias("name"),
        schema.alias("schema_name"),
        first_filled_map(F.col("node.config.meta"), F.col("node.meta")).alias("meta"),
    )


def models(manifests: DataFrame) -> DataFrame:
    """Model nodes with names, schema and metadata resolved; other nodes are left out."""
    return _entries(manifests).where("source is null").drop("source")


def _ordinal(*position: str) -> Column:
    """Later manifests, and later entries of one, win."""
    return F.struct("doc_id", "at", *position).alias("ordinal")


def datasets(manifests: DataFrame, rules: ProjectRules = ProjectRules()) -> DataFrame:
    return models(manifests).select(
        F.lit(PLATFORM).alias("platform_id"),
        "schema_name",
        F.col("name").alias("object_name"),
        F.lit("MODEL").alias("object_type"),
        rules.for_model(F.col("name"), F.col("meta")).alias("project_id"),
        x.layer_of(F.col("name"), F.col("node.path")).alias("layer"),
        F.col("node.description").alias("tech_desc"),
        F.try_element_at("meta", F.lit("owner")).alias("owner"),
        _ordinal(),
    )


def columns(manifests: DataFrame, catalogs: DataFrame) -> DataFrame:
    """Columns the catalog lists for a model, in catalog order, described by the manifest."""
    described = models(manifests).select(
        "doc_id", "at", "uid", "schema_name", "name", F.col("node.columns").alias("described")
    )
    cataloged = catalogs.select(
        "doc_id",
        F.explode(F.from_json("content", schemas.CATALOG_DOC).nodes).alias("uid", "entry"),
    )
    listed = described.join(cataloged.hint("merge"), ["doc_id", "uid"]).select(
        "doc_id", "at", "schema_name", "name", "described",
        F.posexplode(F.map_entries("entry.columns")).alias("place", "column"),
    )
    return listed.select(
        F.lit(PLATFORM).alias("platform_id"),
        "schema_name",
        F.col("name").alias("object_name"),
        F.col("column.key").alias("column_name"),
        (F.col("place") + 1).alias("position_order"),
        F.col("column.value.type").alias("data_type"),
        F.try_element_at("described", F.col("column.key")).description.alias("tech_desc"),
        _ordinal("place"),
    )


def transformations(manifests: DataFrame, rules: ProjectRules = ProjectRules()) -> DataFrame:
    return models(manifests).select(
        dataset_key(F.col("schema_name"), F.col("name")).alias("target_key"),
        F.lit("dbt_model").alias("transform_type"),
        F.col("name").alias("dbt_model"),
        rules.for_model(F.col("name"), F.col("meta")).alias("project_id"),
        F.coalesce(first_filled(F.col("node.compiled_code")), F.col("node.compiled_sql"))
        .alias("compiled_sql"),
        F.coalesce(first_filled(F.col("node.raw_code")), F.col("node.raw_sql"))
        .alias("raw_sql"),
        _ordinal(),
    )


def _key_of_entry() -> Column:
    of_source = dataset_key(
        first_filled(F.col("source.schema"), F.col("source.source_name"), F.lit("source")),
        F.coalesce("source.name", x.last_dotted(F.col("uid"))),
    )
    return F.when(F.col("source").isNotNull(), of_source).otherwise(
        dataset_key(F.col("schema_name"), F.col("name")))


def dataset_keys(manifests: DataFrame) -> DataFrame:
    """Unique id to dataset key, for models and sources."""
    return _entries(manifests).select("doc_id", "uid", _key_of_entry().alias("key"))


def lineage(manifests: DataFrame, rules: ProjectRules = ProjectRules()) -> DataFrame:
    """Edges between datasets; inputs the manifest does not define drop out.

    A model knows its own key, so one join resolves the input. The project comes from the
    model's name alone.
    """
    depends = models(manifests).select(
        "doc_id", "at", dataset_key(F.col("schema_name"), F.col("name")).alias("to_key"),
        F.coalesce("node.name", F.lit("")).alias("name"),
        F.posexplode("node.depends_on.nodes").alias("place", "depends_on"),
    )
    upstream = dataset_keys(manifests).select(
        "doc_id", F.col("uid").alias("depends_on"), F.col("key").alias("from_key"))
    return depends.join(upstream.hint("merge"), ["doc_id", "depends_on"]).select(
        F.concat("from_key", F.lit("->"), "to_key").alias("edge_id"),
        "from_key",
        "to_key",
        F.lit("dataset").alias("from_type"),
        F.lit("dataset").alias("to_type"),
        F.lit(PLATFORM).alias("source"),
        rules.for_model(F.col("name")).alias("project_id"),
        _ordinal("place"),
    )
