"""Interface lists to interfaces, routing hops and systems."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.projects import ProjectRules

# Catalog columns of an interface, in order, and the two that are renamed.
INTERFACE_COLUMNS = [
    "interface_id", "domain", "date_of_update", "scope", "update_owner", "application",
    "integration_name", "description", "feed_type", "source_system", "source_party",
    "target_system", "target_party", "direction", "direct_feed", "feed_routing", "intraday",
    "eod_overnight", "frequency", "extract_type", "app_contact", "migration_flag",
    "type_app_extract", "process_improvement", "notes", "source_project_id",
    "target_project_id",
]
RENAMED = {"app_owner": "app_contact", "improvement": "process_improvement"}


def interface_rows(interfaces: DataFrame) -> DataFrame:
    """Interfaces under their catalog names; columns the list lacks are NULL.

    An ``ordinal`` of the list is carried along: of interfaces with one id the last wins.
    """
    renamed = interfaces.withColumnsRenamed(RENAMED)
    return renamed.select([
        F.col(c) if c in renamed.columns else F.lit(None).cast("string").alias(c)
        for c in INTERFACE_COLUMNS
    ] + ["ordinal"] * ("ordinal" in renamed.columns))


def routing_hops(interfaces: DataFrame, rules: ProjectRules = ProjectRules()) -> DataFrame:
    """Systems an interface passes through, numbered from 0."""
    order = ["ordinal"] * ("ordinal" in interfaces.columns)
    hops = interfaces.select(
        "interface_id", *order, F.posexplode("routing_hops").alias("hop_order", "system_name")
    )
    return hops.select(
        "interface_id", "hop_order", "system_name",
        rules.for_system(F.col("system_name")).alias("project_id"), *order)


def system_traffic(
    interfaces: DataFrame, rules: ProjectRules = ProjectRules(), order: str = "ordinal"
) -> DataFrame:
    """Counts per system, and the party named last: later interfaces win, and within one the
    target side does. The last party may be NULL.

    Both sides come from one scan and are combined before the shuffle, so a system that takes
    part in most interfaces costs a row per task.
    """
    def side(role: str, is_target: int):
        return F.struct(
            F.col(f"{role}_system").alias("system_name"),
            F.col(f"{role}_party").alias("party"),
            F.lit(1 - is_target).alias("outbound"),
            F.lit(is_target).alias("inbound"),
            (F.col(order) * 2 + is_target).alias("at"),
        )

    sides = interfaces.select(
        F.explode(F.array(side("source", 0), side("target", 1))).alias("side")
    ).select("side.*")
    return (
        sides.where(F.col("system_name") != "")
        .groupBy("system_name")
        .agg(
            F.max_by("party", "at").alias("party"),
            F.sum("outbound").alias("outbound_count"),
            F.sum("inbound").alias("inbound_count"),
            F.count(F.lit(1)).alias("total_count"),
        )
        .withColumn("project_id", rules.for_system(F.col("system_name")))
    )
