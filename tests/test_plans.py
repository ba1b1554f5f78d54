"""Physical plans that have to hold at scale."""

import re

import __spark_entry__ as entry_point
import pytest
from compare import DATA
from pyspark.sql import functions as F
from test_marts import position

from tidebook import schemas
from tidebook.functions.values import once
from tidebook.operators import merging
from tidebook.session import checkpointed
from tidebook.sinks import tables
from tidebook.sources.tables import raw_table


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def query_plan(spark):
    return lambda name: plan_of(entry_point.queries()[name](spark, f"{DATA}/sf0.001"))


def test_nav_reads_only_its_columns_and_copies_no_rows(query_plan):
    plan = query_plan("nav_by_account_daily")
    assert "Expand" not in plan
    schemas_read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = next(s for s in schemas_read if "l_orderkey" in s)
    assert "l_shipdate" not in lineitem and "l_suppkey" not in lineitem
    assert "l_linestatus" not in lineitem


def test_filters_reach_the_scan(query_plan):
    assert "PushedFilters: [In(event_type" in query_plan("asof_latest_setter")
    assert "EqualTo(lang,fr)" in query_plan("list_by_project")


def test_top_k_is_merged_from_partial_top_ks(query_plan):
    for name in ("top_recent_tasks", "recommended_config"):
        assert "TakeOrderedAndProject" in query_plan(name)


def test_documents_are_not_shuffled_to_be_parsed(query_plan):
    for name in ("spec_sources", "spec_endpoints", "spec_fields", "spec_errors",
                 "manifest_datasets", "airflow_dag"):
        assert "Exchange" not in query_plan(name)


def test_as_of_lookup_windows_stay_inside_a_chunk(query_plan):
    plan = query_plan("asof_latest_setter")
    windows = re.findall(r"windowspecdefinition\((.*?) ASC", plan)
    assert len(windows) == 2
    assert sum("_chunk" in w.split("specifiedwindowframe")[0] for w in windows) == 2
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_lookback_prunes_partitions(spark, tmp_path):
    path = f"{tmp_path}/positions_raw"
    df = spark.createDataFrame(
        [position(f"2025-01-{d:02d}", "A", "S", "1") for d in range(1, 21)],
        schemas.landing_schema("positions_raw"),
    )
    assert tables.reload_landing(df, path, "positions_raw") == 20
    landed = raw_table(spark, str(tmp_path), "positions_raw")
    target = landed.where("as_of_date <= '2025-01-15'")
    fresh = merging.lookback_filter(landed, target, "as_of_date")
    assert re.search(r"PartitionFilters: \[[^]]*as_of_date#\w+ >= .*[Ss]ubquery", plan_of(fresh))
    assert fresh.count() == 9
    assert len(fresh.inputFiles()) > 0


def test_merge_of_whole_rows_moves_only_the_keys_of_the_source(spark):
    target = spark.range(100).selectExpr("id", "id AS v")
    source = spark.range(50, 150).selectExpr("id", "-id AS v")
    plan = plan_of(merging.merge_rows(target, source, ["id"]))
    assert "LeftAnti" in plan and "FullOuter" not in plan


def test_once_keeps_a_parse_out_of_filters(spark):
    docs = spark.createDataFrame([('{"a": 1, "b": 2}',)], "text string")
    parse = F.from_json("text", "a int, b int")
    kept = once(docs, parse, "doc").where("doc.a = 1 AND doc.b = 2").select("doc.*")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and kept.count() == 1


def test_hot_security_is_split(spark):
    """A third of all positions in one security: its join partition is read by several tasks."""
    from tidebook.operators.enrichment import enrich_positions
    from tidebook.operators.staging import stage_accounts, stage_positions, stage_securities
    from tidebook.plans import synthetic

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    n = 30_000
    positions = synthetic.positions(synthetic.ids(spark, n, 8), 400, 50).withColumn(
        "security_id",
        F.when(F.xxhash64("position_hash") % 3 == 0, "SEC00000001").otherwise(F.col("security_id")),
    )
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        enriched = enrich_positions(
            stage_positions(positions),
            stage_securities(synthetic.securities(synthetic.ids(spark, 400))),
            stage_accounts(synthetic.accounts(synthetic.ids(spark, 50))),
        )
        assert len(enriched.collect()) == n
        assert "skew=true" in plan_of(enriched)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_checkpoint_uses_the_folder_the_session_names(spark):
    from pathlib import Path

    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    cut = checkpointed(spark.range(5).selectExpr("id * 2 AS id"))
    assert "Range" not in plan_of(cut) and cut.count() == 5
    assert any(folder.rglob("part-*"))


def test_exposure_reads_positions_once_and_lineage_joins_once(spark):
    from compare import DATA

    from tidebook.workload import load

    queries, folder = load().QUERIES, f"{DATA}/sf0.001"
    exposure = plan_of(queries["exposure_by_asset_class"](spark, folder))
    # Five tables of the star, and sums that combine before they are shuffled.
    assert exposure.count("FileScan") == 5 and exposure.count("lineitem.parquet") == 1
    assert exposure.count("partial_count") >= 1
    lineage = plan_of(queries["lineage_resolve"](spark, folder))
    assert lineage.count("FileScan") <= 2 and lineage.count("Join") == 1


def test_silver_is_read_with_its_known_columns(spark, tmp_path, monkeypatch):
    from tidebook.sinks import tables

    path = str(tmp_path / "t")
    first = spark.sql("select date'2025-01-01' as as_of_date, 1 as id, 'a' as v")
    tables.upsert_partitions(first, path, ["as_of_date", "id"], None)
    more = spark.sql("select date'2025-01-02' as as_of_date, 2 as id, 'b' as v, 7 as extra")
    tables.upsert_partitions(more, path, ["as_of_date", "id"], None)
    monkeypatch.setattr(tables, "read_if_present", _only_with_schema(tables.read_if_present))
    back = tables.read_table(spark, path)
    assert {(r.id, r.v, r.extra) for r in back.collect()} == {(1, "a", None), (2, "b", 7)}
    assert tables.partition_days(spark, path) == ["2025-01-01", "2025-01-02"]


def _only_with_schema(read):
    def checked(spark, path, schema=None):
        assert schema is not None, "schemas of all files are merged"
        return read(spark, path, schema)

    return checked


def test_dependencies_read_every_document_once(spark):
    """Lookups inside the chunks and the chunks' summaries share one parse and one shuffle."""
    found = entry_point.queries()["collection_dependencies"](spark, f"{DATA}/sf0.001")
    assert found.count() > 0
    found.collect()
    ran = plan_of(found).split("== Initial Plan ==")[0]
    assert ran.count("parseJson(") <= 1 and "ReusedExchange" in ran


def test_positions_are_made_behind_the_last_shuffle(spark):
    """Lines travel as they are, with one shuffle for their order and one for their security."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for key in keys:
            spark.conf.set(key, "-1")
        found = entry_point.queries()["positions_enriched"](spark, f"{DATA}/sf0.001")
        plan = plan_of(found)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    above, below = plan.split("Exchange", 1)
    assert "concat_ws(|" in above and "concat_ws(|" not in below
    lines = [line for line in plan.splitlines() if "Exchange" in line]
    assert sum("security_id" in line or "l_orderkey" in line for line in lines) <= 4
