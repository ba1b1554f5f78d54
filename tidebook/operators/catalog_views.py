"""What the catalog's readers ask: lists by project, counts, edges and nested flows."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import label_method, label_without_method

#: Steps in one row of a nested flow; longer flows continue on further pages.
STEPS_PER_PAGE = 500


#: Names of project groups, which select without an id.
PROJECT_GROUPS = ("all", "sei", "non-sei")


def by_project(
    df: DataFrame, project: str, groups: Collection[str] = PROJECT_GROUPS
) -> DataFrame:
    """Rows of one project; a group name asks for every project."""
    return df if project in groups else df.where(F.col("project_id") == project)


def project_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("project_id").agg(F.count(F.lit(1)).alias("object_count"))


def distinct_edges(edges: DataFrame) -> DataFrame:
    """Each (from, to, type) once."""
    return edges.select("from_endpoint", "to_endpoint", "dep_type").distinct()


def edge_endpoints(edges: DataFrame) -> DataFrame:
    """Every endpoint on either side of an edge, once per side."""
    sides = F.array(
        F.struct(F.lit("from").alias("side"), F.col("from_endpoint").alias("endpoint")),
        F.struct(F.lit("to").alias("side"), F.col("to_endpoint").alias("endpoint")),
    )
    return edges.select(F.explode(sides).alias("end")).select("end.*").distinct()


def endpoint_labels(endpoints: DataFrame, column: str = "endpoint") -> DataFrame:
    """Endpoint labels split into method and address."""
    return endpoints.withColumns({
        "method": label_method(F.col(column)),
        "address": label_without_method(F.col(column)),
    })


def first_attribute(
    df: DataFrame, key: str, attribute: str, order_by: Sequence[str]
) -> DataFrame:
    """The attribute of each key's first row; a plain aggregate, so it combines map-side."""
    first = F.min_by(attribute, F.struct(*order_by, attribute))
    return df.groupBy(key).agg(first.alias(attribute))


def nested_flows(flows: DataFrame, steps: DataFrame, page_size: int = STEPS_PER_PAGE) -> DataFrame:
    """Flows with their ordered steps as an array.

    A row holds at most ``page_size`` steps; a longer flow goes on in rows with the next
    ``page``, so no array and no task grows with the length of a flow.
    """
    step = F.struct("step_order", "label", F.col("endpoint_key").alias("endpoint"),
                    "variable_passed")
    pages = (
        steps.withColumn("page", F.floor((F.col("step_order") - 1) / page_size).cast("bigint"))
        .groupBy("flow_key", "page")
        .agg(F.array_sort(F.collect_list(step)).alias("steps"))
    )
    no_steps = F.array().cast("array<struct<step_order:bigint,label:string,endpoint:string,"
                              "variable_passed:string>>")
    # An inner join, so that adaptive execution may split the pages of a very long flow; flows
    # without steps are added from the keys alone.
    with_steps = flows.join(pages.hint("merge"), "flow_key")
    without = flows.join(steps.select("flow_key").distinct(), "flow_key", "left_anti")
    empty = without.withColumns({"page": F.lit(0).cast("bigint"), "steps": no_steps})
    return with_steps.unionByName(empty)
