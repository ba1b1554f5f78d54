import random
from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from test_marts import account, position, security

from tidebook import schemas
from tidebook.operators.enrichment import enrich_positions
from tidebook.operators.staging import stage_accounts, stage_positions, stage_securities
from tidebook.operators.quality import QualityError
from tidebook.plans import positions as medallion
from tidebook.plans import report, synthetic
from tidebook.plans.run_recording import RunRecorder
from tidebook.operators import marts
from tidebook.sinks import bundles, commits, tables
from tidebook.sources import quoted, runs
from tidebook.sources import tables as feeds
from tidebook.streaming.landing import stream_landing, upsert_stream


def land(spark, root, positions, securities=None, accounts=None):
    data = {
        "positions_raw": positions,
        "securities": securities or [security("S"), security("C", "CASH")],
        "accounts": accounts or [account("A"), account("B")],
    }
    return {
        name: tables.reload_landing(
            spark.createDataFrame(rows, schemas.landing_schema(name)), f"{root}/bronze/{name}",
            name,
        )
        for name, rows in data.items()
    }


def test_medallion_build_is_incremental(spark, tmp_path, rows):
    layout = medallion.Layout(str(tmp_path))
    first = [position("2025-01-10", "A", "S", "10"), position("2025-01-10", "A", "S", "12"),
             position("2025-01-06", "A", "S", "5"), position("2025-01-07", "B", "C", "7")]
    assert land(spark, tmp_path, first)["positions_raw"] == 4
    stats = f"{tmp_path}/stats"
    recorder = RunRecorder(spark, stats, "run-1")
    written = medallion.build(spark, layout, recorder)
    # Two copies of one position: the higher value stays.
    assert written == {"positions_enriched": 3, "nav_by_account_daily": 3,
                       "exposure_by_asset_class": 3}

    def silver():
        return rows(tables.read_table(spark, layout.silver), "position_hash", "market_value")

    before = silver()
    medallion.build(spark, layout, recorder)
    assert silver() == before

    # Late rows: exactly three days back is taken, four days back is not.
    late = [position("2025-01-07", "B", "C", "70"), position("2025-01-07", "B", "S", "1"),
            position("2025-01-06", "A", "S", "50"), position("2025-01-11", "A", "S", "11")]
    land(spark, tmp_path, late)
    medallion.build(spark, layout, recorder)
    assert silver() == [
        ("2025-01-06|A|S", D("5.00")), ("2025-01-07|B|C", D("70.00")),
        ("2025-01-07|B|S", D("1.00")), ("2025-01-10|A|S", D("12.00")),
        ("2025-01-11|A|S", D("11.00")),
    ]
    found = runs.read_run_stats(spark, stats, "run-1")
    assert found.count() == 9 and rows(found.select("status").distinct()) == [("SUCCESS",)]
    assert found.where("elapsed_seconds IS NULL OR rows_processed IS NULL").isEmpty()

    checks = medallion.declared_checks(spark, layout)
    assert len(checks) == 25
    assert [name for name, bad in checks.items() if not bad.isEmpty()] == []


def test_smoke_run(spark, tmp_path):
    land(spark, tmp_path, [position("2025-01-10", "A", f"S{i}", "1") for i in range(5)],
         [security(f"S{i}") for i in range(5)])
    written = medallion.build(spark, medallion.Layout(str(tmp_path)), smoke_rows=2)
    assert written["positions_enriched"] == 2


def test_recorder_records_failures(spark, tmp_path):
    recorder = RunRecorder(spark, f"{tmp_path}/stats")
    with pytest.raises(ZeroDivisionError):
        recorder.run("bad", "table", lambda: 1 // 0)
    [row] = runs.read_run_stats(spark, f"{tmp_path}/stats").collect()
    assert (row.status, row.rows_processed) == ("ERROR", None)


def test_recorder_sums_the_stages_of_a_run(spark, tmp_path):
    data, stats = f"{tmp_path}/data", f"{tmp_path}/stats"
    spark.range(5000).selectExpr("id", "id % 7 AS k").write.parquet(data)
    recorder = RunRecorder(spark, stats)

    def write():
        df = spark.read.parquet(data).groupBy("k").count()
        return tables.rebuild(df, f"{tmp_path}/out")

    recorder.run("m", "table", write)
    recorder.run("nothing", "view", lambda: 0)
    spark.range(10).count()  # belongs to no run
    found = {r.model_name: r for r in runs.read_run_stats(spark, stats).collect()}
    row = found["m"]
    assert row.cpu_seconds > 0 and row.pga_peak_bytes > 0 and row.physical_reads_bytes > 0
    # 5000 rows read, and at least a row per key from the shuffle.
    assert 5000 + 7 <= row.logical_reads <= 5000 + 7 * 20
    assert row.redo_size_bytes > 0 and row.rows_processed == 7
    assert found["nothing"].cpu_seconds is None
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def test_recorder_takes_counters(spark, tmp_path):
    counters = spark.createDataFrame([(1, 7, 250), (1, 8, 99)],
                                     "sid int, statistic_id int, value long")
    names = spark.createDataFrame([(7, "CPU used by this session"), (8, "redo size")],
                                  "statistic_id int, name string")
    recorder = RunRecorder(spark, f"{tmp_path}/stats", counters=lambda: (counters, names))
    recorder.run("m", "view", lambda: 3)
    [row] = runs.read_run_stats(spark, f"{tmp_path}/stats").collect()
    assert (row.cpu_seconds, row.redo_size_bytes, row.pga_peak_bytes) == (D("2.500"), 99, None)


def test_reload_enforces_keys(spark, tmp_path):
    with pytest.raises(QualityError):
        land(spark, tmp_path, [], accounts=[account("A"), account("A")])


def test_upsert_rewrites_only_touched_partitions_and_appends_columns(spark, tmp_path, rows):
    path = f"{tmp_path}/t"

    def batch(data, more=""):
        df = spark.createDataFrame(data, "id string, as_of_date string, v int" + more)
        return df.withColumn("as_of_date", F.col("as_of_date").cast("date"))

    def upsert(df):
        return tables.upsert_partitions(df, path, ["id"], [F.col("v").desc()])

    upsert(batch([("a", "2025-01-01", 1), ("b", "2025-01-02", 2)]))
    before = tables.partition_places(spark, path)
    upsert(batch([("b", "2025-01-02", None, "n"), ("c", "2025-01-02", 3, "n"),
                  ("c", "2025-01-02", 9, "m")], ", w string"))
    after = tables.partition_places(spark, path)
    assert [day for day in after if after[day] != before[day]] == ["2025-01-02"]
    stored = tables.read_table(spark, path)
    assert rows(stored, "id", "v", "w") == [("a", 1, None), ("b", None, "n"), ("c", 9, "m")]


def dated(spark, *data):
    df = spark.createDataFrame(list(data), "id string, as_of_date string, v int")
    return df.withColumn("as_of_date", F.col("as_of_date").cast("date"))


def test_upsert_is_seen_whole_or_not_at_all(spark, tmp_path, rows, monkeypatch):
    """The write dies after all files are in place and before the commit record."""
    path = f"{tmp_path}/t"

    def upsert(*data):
        return tables.upsert_partitions(dated(spark, *data), path, ["id"], [F.col("v").desc()])

    assert tables.read_table(spark, path) is None
    first = [("a", "2025-01-01", 1), ("b", "2025-01-02", 2)]
    upsert(*first)
    changes = [("a", "2025-01-01", 10), ("c", "2025-01-02", 3), ("d", "2025-01-03", 4)]
    with monkeypatch.context() as broken:
        def dies(*_):
            raise KeyboardInterrupt

        broken.setattr(commits, "record", dies)
        with pytest.raises(KeyboardInterrupt):
            upsert(*changes)
    assert list((tmp_path / "t" / "_data" / "version=00000002").glob("*/*.parquet"))
    assert rows(tables.read_table(spark, path), "id", "v") == [("a", 1), ("b", 2)]
    assert tables.partition_days(spark, path) == ["2025-01-01", "2025-01-02"]

    # Other data than that of the dead run: nothing of its files may stay.
    upsert(("e", "2025-01-03", 5))
    assert rows(tables.read_table(spark, path), "id", "v") == [("a", 1), ("b", 2), ("e", 5)]
    upsert(*changes)
    whole = [("a", 10), ("b", 2), ("c", 3), ("d", 4), ("e", 5)]
    assert rows(tables.read_table(spark, path), "id", "v") == whole
    # Readers of an earlier version keep their files until these are removed.
    assert tables.remove_old_partitions(spark, path, keep=1) == [
        "_data/version=00000001/as_of_date=2025-01-01",
        "_data/version=00000001/as_of_date=2025-01-02",
        "_data/version=00000002/as_of_date=2025-01-03"]
    assert rows(tables.read_table(spark, path), "id", "v") == whole


def test_upsert_into_a_table_written_by_other_means(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    dated(spark, ("a", "2025-01-01", 1), ("b", "2025-01-02", 2)).write.partitionBy(
        "as_of_date").parquet(path)
    tables.upsert_partitions(
        dated(spark, ("b", "2025-01-02", 5), ("c", "2025-01-03", 6)), path, ["id"], None)
    found = tables.read_table(spark, path)
    assert rows(found, "id", "v") == [("a", 1), ("b", 5), ("c", 6)]
    assert rows(found.where("as_of_date = '2025-01-01'"), "id") == [("a",)]
    assert tables.partition_places(spark, path)["2025-01-01"] == "as_of_date=2025-01-01"


def test_marts_follow_the_changed_days_only(spark, tmp_path, rows):
    layout = medallion.Layout(str(tmp_path))
    days = [f"2025-01-{d:02d}" for d in (2, 3, 6, 7, 8)]
    first = [position(d, a, "S", str(10 + i)) for i, d in enumerate(days) for a in "AB"
             if (d, a) != ("2025-01-07", "B")]
    land(spark, tmp_path, first)
    medallion.build(spark, layout)
    nav, exposure = (layout.gold(m) for m in ("nav_by_account_daily", "exposure_by_asset_class"))

    def mart(path):
        return rows(tables.read_table(spark, path).drop("dbt_built_at"))

    def changed(path, before):
        places = tables.partition_places(spark, path)
        return sorted(d for d, p in places.items() if before.get(d) != p)

    before = {p: tables.partition_places(spark, p) for p in (nav, exposure)}
    # One new account on the sixth; the next day it has is not rolled up again but follows on it.
    late = [position("2025-01-06", "A", "C", "5"), position("2025-01-07", "B", "S", "3")]
    silver = tables.read_table(spark, layout.silver)
    tables.upsert_partitions(
        enrich_positions(
            stage_positions(spark.createDataFrame(late, schemas.landing_schema("positions_raw"))),
            stage_securities(spark.createDataFrame([security("S"), security("C", "CASH")],
                                                   schemas.landing_schema("securities"))),
            stage_accounts(spark.createDataFrame([account("A"), account("B")],
                                                 schemas.landing_schema("accounts")))),
        layout.silver, ["position_hash"], None)
    assert silver.count() == 9
    land(spark, tmp_path, first[:1])  # older than the look-back: silver stays as it is
    medallion.build(spark, layout)
    assert changed(nav, before[nav]) == ["2025-01-06", "2025-01-07", "2025-01-08"]
    assert changed(exposure, before[exposure]) == ["2025-01-06", "2025-01-07"]
    found = [mart(nav), mart(exposure)]
    medallion.build(spark, layout)  # nothing came: nothing is written
    assert [mart(nav), mart(exposure)] == found
    medallion.build(spark, layout, full_marts=True)
    assert [mart(nav), mart(exposure)] == found


def test_refresh_reads_only_the_changed_days(spark, tmp_path):
    from datetime import date as day

    path = f"{tmp_path}/silver"
    land(spark, tmp_path, [position(f"2025-01-{d:02d}", "A", "S", "1") for d in (2, 3, 6)])
    layout = medallion.Layout(str(tmp_path))
    medallion.build(spark, layout)
    assert path in layout.silver
    silver = tables.read_table(spark, layout.silver)
    rolled = marts.nav_rollup(silver.where(F.col("as_of_date").isin([day(2025, 1, 3)])))
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [as_of_date" in plan or "2025-01-03" in plan
    assert len(rolled.inputFiles()) == 3 and rolled.count() == 1


def test_one_account_or_security_is_found_without_reading_the_day(spark, tmp_path):
    path = f"{tmp_path}/silver"
    rows_of = spark.range(60_000).selectExpr(
        "date'2025-01-01' AS as_of_date", "format_string('A%05d', id * 7919 % 3000) AS account_id",
        "format_string('S%05d', id * 104729 % 20000 * 2) AS security_id", "id AS v")
    spark.conf.set("parquet.block.size", str(64 * 1024))
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    settings.set("parquet.block.size", str(64 * 1024))
    settings.set("parquet.page.row.count.limit", "500")
    try:
        tables.replace_partitions(rows_of, path, sort_by=["account_id", "security_id"])
    finally:
        spark.conf.unset("parquet.block.size")
        for key in ("parquet.block.size", "parquet.page.row.count.limit"):
            settings.unset(key)

    def scanned(condition):
        found = tables.read_table(spark, path).where(condition)
        # The filter above the scan is left out: what the reader lets through is counted.
        counted = found.groupBy().count()
        n = counted.collect()[0][0]
        plans, out = [counted._jdf.queryExecution().executedPlan()], 0
        while plans:
            plan = plans.pop()
            kind = plan.getClass().getSimpleName()
            if kind == "AdaptiveSparkPlanExec":
                plans.append(plan.executedPlan())
            elif kind.endswith("QueryStageExec"):
                plans.append(plan.plan())
            elif kind == "FileSourceScanExec":
                out += plan.metrics().apply("numOutputRows").value()
            else:
                plans += [plan.children().apply(i) for i in range(plan.children().size())]
        return n, out

    whole = scanned("v >= 0")
    assert whole == (60_000, 60_000)
    n, read = scanned("account_id = 'A01234'")
    assert n == 20 and read < 6_000
    # A value within the bounds of every row group that no group holds.
    n, read = scanned("security_id = 'S20001'")
    assert n == 0 and read < 6_000


def test_upsert_stream_matches_batches(spark, tmp_path, rows):
    path, landing = f"{tmp_path}/silver", f"{tmp_path}/landing"
    schema = schemas.landing_schema("positions_raw")
    reference = [spark.createDataFrame(data, schemas.landing_schema(name)) for name, data in (
        ("securities", [security("S")]), ("accounts", [account("A")]))]

    def arrive(*data):
        spark.createDataFrame(list(data), schema).write.mode("append").parquet(landing)

    def run():
        stream = stream_landing(spark, landing, "positions_raw", files_per_batch=1)
        upsert_stream(
            stream,
            lambda p: enrich_positions(
                stage_positions(p), stage_securities(reference[0]), stage_accounts(reference[1])
            ),
            path, f"{tmp_path}/checkpoint", ["position_hash"], [F.col("market_value").desc()],
        ).awaitTermination()

    arrive(position("2025-01-02", "A", "S", "1"), position("2025-01-03", "A", "S", "2"))
    run()
    arrive(position("2025-01-03", "A", "S", "3"))
    run()
    found = rows(tables.read_table(spark, path), "position_hash", "market_value")
    assert found == [("2025-01-02|A|S", D("1.00")), ("2025-01-03|A|S", D("3.00"))]


def test_bundle_is_visible_at_once_and_protects_columns(spark, tmp_path, rows):
    root = str(tmp_path)

    def sources(*data):
        return spark.createDataFrame(
            list(data), "source_id string, display_name string, kind string, ordinal int"
        )

    assert bundles.read_relation(spark, root, "api_sources") is None
    flows = spark.createDataFrame([("f", "F")], "flow_key string, flow_name string")
    assert bundles.commit_bundle(spark, root, {
        "api_sources": sources(("a", "Name", "k1", 1), ("a", "Late", "k2", 2)),
        "api_flows": flows,
    }) == 1
    first = bundles.read_relation(spark, root, "api_sources")
    assert rows(first) == [("a", "Late", "k2")]
    assert bundles.commit_bundle(spark, root, {
        "api_sources": sources(("a", "Other", "k3", 1), ("b", "B", None, 2)),
    }) == 2
    assert rows(bundles.read_relation(spark, root, "api_sources")) == [
        ("a", "Late", "k3"), ("b", "B", None),
    ]
    assert rows(bundles.read_relation(spark, root, "api_flows")) == [("f", "F")]
    assert rows(first) == [("a", "Late", "k2")]

    # A job that dies before its commit leaves nothing to see.
    sources(("z", "Z", "k", 1)).write.parquet(f"{root}/api_sources/version=00000003/_bucket=1")
    assert bundles.current_version(spark, root) == 2
    assert bundles.read_relation(spark, root, "api_sources").count() == 2
    assert bundles.commit_bundle(spark, root, {}) == 3
    assert bundles.read_relation(spark, root, "api_sources").count() == 2


def test_commit_rewrites_only_the_buckets_of_its_keys(spark, tmp_path, rows):
    root = str(tmp_path)

    def commit(*data):
        return bundles.commit_bundle(spark, root, {"api_sources": spark.createDataFrame(
            list(data), "source_id string, display_name string, kind string")}, buckets=8)

    def places():
        return {part: place for part, place in commits.newest(spark, root).locations.items()}

    commit(*[(f"s{i}", f"name {i}", "old") for i in range(60)])
    before = places()
    assert len(before) == 8
    commit(("s7", "another name", "new"), ("s7b", "brand new", "new"))
    after = places()
    changed = [part for part in after if after[part] != before[part]]
    assert 1 <= len(changed) <= 2
    found = {r[0]: tuple(r[1:]) for r in rows(bundles.read_relation(spark, root, "api_sources"))}
    expected = {f"s{i}": (f"name {i}", "old") for i in range(60)}
    assert found == expected | {"s7": ("name 7", "new"), "s7b": ("brand new", "new")}
    # Nothing but the buckets written twice can be removed.
    assert bundles.remove_old_versions(spark, root, keep=1) == sorted(before[p] for p in changed)
    assert bundles.read_relation(spark, root, "api_sources").count() == 61
    assert bundles.commit_bundle(spark, root, {"api_flows": spark.createDataFrame(
        [], "flow_key string, flow_name string")}) == 3
    assert bundles.read_relation(spark, root, "api_flows").columns == ["flow_key", "flow_name"]
    assert places() == after


def test_a_relation_written_whole_is_cut_into_buckets(spark, tmp_path, rows):
    root = str(tmp_path)
    flows = spark.createDataFrame([("f", "F"), ("g", "G")], "flow_key string, flow_name string")
    flows.write.parquet(f"{root}/version=00000001/api_flows")
    commits.record(spark, root, 1, {"api_flows": "version=00000001/api_flows"})
    assert rows(bundles.read_relation(spark, root, "api_flows")) == [("f", "F"), ("g", "G")]
    bundles.commit_bundle(spark, root, {"api_flows": spark.createDataFrame(
        [("g", "new")], "flow_key string, flow_name string")})
    assert rows(bundles.read_relation(spark, root, "api_flows")) == [("f", "F"), ("g", "new")]


HEADER = ",".join(schemas.FEED_COLUMNS["accounts"])


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_feed_round_trip(spark, tmp_path, rows, compression):
    df = spark.createDataFrame([account("A"), account("B")], schemas.landing_schema("accounts"))
    text = df.select([F.col(c).cast("string") for c in schemas.FEED_COLUMNS["accounts"]])
    text.write.csv(f"{tmp_path}/f", header=True, compression=compression)
    feed = feeds.read_feed(spark, f"{tmp_path}/f", "accounts", partitions=3)
    assert feed.rdd.getNumPartitions() == 3
    assert rows(feeds.typed_feed(feed, "accounts")) == rows(df)
    df.write.parquet(f"{tmp_path}/f.parquet")
    stored = feeds.read_feed(spark, f"{tmp_path}/f.parquet", "accounts")
    assert rows(feeds.typed_feed(stored, "accounts")) == rows(df)


def test_feed_header_must_match(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("account_name,account_id\nx,y\n")
    with pytest.raises(Exception, match="(?i)header"):
        feeds.read_feed(spark, f"{tmp_path}/bad.csv", "accounts").collect()
    spark.range(1).write.parquet(f"{tmp_path}/bad.parquet")
    with pytest.raises(ValueError, match="mismatch"):
        feeds.read_feed(spark, f"{tmp_path}/bad.parquet", "accounts")


def test_external_table_rules(spark, tmp_path, rows):
    columns = schemas.FEED_COLUMNS["positions_raw"]
    full = ["2025-01-02", "A", "S", "1", "1", "1", "1", "1", "0", "", "1", "SETTLED", "STAR", "h"]
    wide = [*full[:11], "MUCH TOO WIDE", *full[12:]]
    lines = [
        ",".join(columns), ",".join(full), "2025-01-03,B,S", "," * 13,
        ",".join([*full, "extra"]), ",".join(wide), '2025-01-04,"a ""b""\nc",S',
        ",".join([*full[:13], "", "more"]),
    ]
    (tmp_path / "p.csv").write_text("\n".join(lines) + "\n")
    good, rejects = feeds.read_external(spark, f"{tmp_path}/p.csv", "positions_raw")
    assert rows(good, "as_of_date", "account_id", "accrued_income", "position_hash") == [
        ("2025-01-02", "A", None, "h"), ("2025-01-03", "B", None, None),
        ("2025-01-04", 'a "b"\nc', None, None),
    ]
    assert rows(rejects, "reason") == [
        ("all fields empty",), ("too many fields",), ("too many fields",), ("value too wide",),
    ]


@pytest.fixture
def small_ranges(spark):
    """Files are cut into byte ranges of half a kilobyte."""
    settings = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "0"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.mark.parametrize("seed", range(3))
def test_quoted_records_across_ranges(spark, tmp_path, rows, small_ranges, seed):
    draw = random.Random(seed)
    cells = ["x", "", '"a,b"', '"line\nend"', '"say ""hi""\n\n, yes"', '""', '5" pipe', 'it"s "odd"',
             '"' + "long\n" * draw.choice([3, 300]) + '"', '"\n""\n"', "plain text"]
    for k in range(3):
        lines = [",".join([str(i), *draw.choices(cells, k=3)]) for i in range(200)]
        (tmp_path / f"f{k}.csv").write_text(
            "id,a,b,c\n" + "".join(f"{x}\n{chr(10) * (i % 50 == 0)}" for i, x in enumerate(lines)))
    schema = "id int, a string, b string, c string"
    records = quoted.quoted_records(spark, str(tmp_path))
    lines = quoted._lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 20
    assert lines.select("file", "start").distinct().count() > 20
    ours = records.select(F.from_csv("record", schema, {
        "quote": '"', "escape": '"', "multiLine": "true"}).alias("r")).select("r.*")
    plain = spark.read.schema(schema).options(
        header=True, quote='"', escape='"', multiLine=True).csv(str(tmp_path))
    assert ours.count() == 600
    assert rows(ours) == rows(plain)


def test_quoted_records_at_odd_ends(spark, tmp_path, rows, small_ranges):
    (tmp_path / "a.csv").write_text('h1,h2\r\n1,"x\r\ny"\r\n\r\n2,z')
    (tmp_path / "b.csv").write_text("h1,h2\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text('h1,h2\n3,"never closed\n' + "4,more\n" * 400)
    found = {r.record[:1]: r.record for r in quoted.quoted_records(spark, str(tmp_path)).collect()}
    assert sorted(found) == ["1", "2", "3"]
    assert (found["1"], found["2"]) == ('1,"x\r\ny"', "2,z")
    assert found["3"].count("4,more") == 400


def test_run_files(spark, tmp_path, rows):
    with pytest.raises(runs.NoRunFiles):
        (tmp_path / "none").mkdir()
        runs.read_run_files(spark, f"{tmp_path}/none")
    folder = tmp_path / "runs"
    folder.mkdir()
    (folder / "a.csv").write_text(
        'run_id,model_name,rows_processed,elapsed_seconds\nr1,"m,1",10,1.5\nr1,m2,,\n')
    (folder / "b.csv").write_text("model_name,run_id,pod_size,note\r\nm3,r2,small,hi\r\n")
    (folder / "empty.csv").write_text("")
    (folder / "c.txt").write_text("run_id\nno\n")
    found = runs.read_run_files(spark, str(folder))
    assert rows(found, "run_id", "model_name", "rows_processed", "elapsed_seconds", "pod_size") == [
        ("r1", "m,1", 10, D("1.500"), None), ("r1", "m2", None, None, None),
        ("r2", "m3", None, None, "small"),
    ]
    assert found.where("run_id = 'r2'").first().other_columns == {"note": "hi"}


@pytest.mark.parametrize("width", [65, 68, 500, 3000])
def test_run_files_of_any_width(spark, tmp_path, rows, width):
    names = ["run_id", "model_name", *[f"c{i}" for i in range(width - 3)], "rows_processed"]
    body = "," * (width - 4)
    (tmp_path / "wide.csv").write_text("\n".join([
        ",".join(names), f'r1,"a ""b"", \n c",x{body},7', f"r2,m,{body},8,", f"r3,m,{body},9,more",
        f'r4,"open,{body},1', "r5", "", f"r6, m , y{body}, 12 "]) + "\n")
    found = runs.read_run_files(spark, str(tmp_path))
    assert rows(found, "run_id", "model_name", "rows_processed") == [
        ("r1", 'a "b", \n c', 7), ("r2", "m", 8), ("r4", '"open', 1), ("r5", None, None),
        ("r6", "m", 12)]
    other = {r.run_id: r.other_columns for r in found.collect()}
    assert all(len(o) == width - 3 for o in other.values())
    assert (other["r1"]["c0"], other["r6"]["c0"]) == ("x", "y")
    files = spark.read.text(str(tmp_path), wholetext=True)
    assert [r.record[:2] for r in runs.run_file_rejects(files).collect()] == ["r3"]


def test_run_file_with_a_name_given_twice(spark, tmp_path, rows):
    (tmp_path / "twice.csv").write_text("run_id,note,model_name,note\nr,first,m,last\n")
    [row] = runs.read_run_files(spark, str(tmp_path)).collect()
    assert (row.run_id, row.model_name, row.other_columns) == ("r", "m", {"note": "last"})


def test_run_artifact_and_pod_metrics(spark, tmp_path, rows, caplog):
    pods = tmp_path / "pods"
    assert runs.read_pod_metrics(spark, str(pods)).count() == 0
    pods.mkdir()
    (pods / "m1.json").write_text('{"peak_cpu_cores": 1.5,\n "peak_mem_mib": 100}')
    tables.append_rows(spark.createDataFrame(
        [("r1", None, m, *[None] * 12) for m in ("m1", "m2")], schemas.RUN_STATS),
        f"{tmp_path}/stats")
    stats = runs.read_run_stats(spark, f"{tmp_path}/stats", "r1")
    metrics = runs.read_pod_metrics(spark, str(pods))
    assert tables.write_run_file(stats, metrics, "small", f"{tmp_path}/out/r1") == 2
    back = runs.read_run_files(spark, f"{tmp_path}/out")
    assert rows(back, "model_name", "pod_size", "pod_peak_cpu_cores", "pod_peak_mem_mib") == [
        ("m1", "small", 1.5, 100.0), ("m2", "small", None, None)]
    assert not caplog.records
    assert tables.write_run_file(stats.limit(0), metrics, "s", f"{tmp_path}/empty/r") == 0
    assert "no statistics" in caplog.text
    stats.createOrReplaceTempView("all_stats")
    assert runs.run_by_parameter(spark, "all_stats", "r1").count() == 2


def test_report(spark, rows, tmp_path):
    data = [
        ("small", 4, 4, "a", D(10), D(5), 2**20, 700_000), ("small", 4, 4, "b", None, None, None, None),
        ("large", 8, 4, "a", D(100), D(5), 2**21, 10_000_000),
        ("medium", 8, 4, "a", None, None, None, None), ("xl", 8, 8, "a", D(0), D(1), 1, 5),
        (None, 8, 8, "a", D(1), D(1), 1, 5),
    ]
    stats = spark.createDataFrame(
        data, "pod_size string, dbt_threads long, parallel_degree long, model_name string, "
        "elapsed_seconds decimal(18,3), cpu_seconds decimal(18,3), pga_peak_bytes long, "
        "rows_processed long",
    ).selectExpr("*", "'r' AS run_id", "'table' AS materialization",
                 "cast(null AS bigint) AS logical_reads",
                 "cast(null AS bigint) AS physical_reads_bytes")
    sheets = report.report(stats)
    assert rows(sheets["summary"], "pod_size", "total_elapsed_s", "total_rows",
                "throughput_rows_s", "peak_pga_mb", "models_run", "meets_sla") == [
        ("large", 100.0, 10_000_000, 100_000.0, 2.0, 1, "YES"),
        ("medium", 0.0, 0, None, None, 1, "NO"),
        ("small", 10.0, 700_000, 70_000.0, 1.0, 2, "YES"),
        ("xl", 0.0, 5, None, 1 / 2**20, 1, "NO"),
    ]
    assert rows(sheets["recommended"], "pod_size", "dbt_threads") == [("large", 8)]
    assert sheets["by_model"].where("elapsed_s IS NULL OR phys_mb IS NULL").isEmpty()
    strict = report.report(stats, min_rate=1e9)
    assert strict["recommended"].isEmpty()
    report.write_report(sheets, f"{tmp_path}/report")
    assert spark.read.parquet(f"{tmp_path}/report/summary").count() == 4


def test_catalog_tables(spark):
    tables.ensure_table(spark, "run_stats_t", schemas.RUN_STATS)
    tables.ensure_table(spark, "run_stats_t", schemas.RUN_STATS)
    tables.analyze(spark, "run_stats_t")
    assert spark.table("run_stats_t").schema.names == schemas.RUN_STATS.names
    spark.sql("DROP TABLE run_stats_t")


def test_exports(spark, tmp_path):
    df = spark.range(1500).withColumn("v", F.col("id") * 2)
    assert tables.export(df, f"{tmp_path}/p", files=2) == 1500
    assert tables.export(df, f"{tmp_path}/c", "csv.gz") == 1500
    assert spark.read.csv(f"{tmp_path}/c", header=True).count() == 1500
    tables.export_sample(df, f"{tmp_path}/s", ["id"])
    sample = spark.read.csv(f"{tmp_path}/s", header=True, inferSchema=True)
    assert sample.agg(F.count("id"), F.max("id")).first() == (1000, 999)
    with pytest.raises(ValueError):
        tables.export(df, f"{tmp_path}/x", "xlsx")


def test_synthetic_feed(spark, tmp_path):
    n = 20_000
    df = synthetic.positions(synthetic.ids(spark, n, 3), 500, 100)
    again = synthetic.positions(synthetic.ids(spark, n, 7), 500, 100)
    assert df.exceptAll(again).isEmpty()
    assert dict(df.dtypes) == {
        f.name: f.dataType.simpleString() for f in schemas.landing_schema("positions_raw").fields
    }
    r = df.agg(
        F.avg((F.col("settlement_status") == "SETTLED").cast("int")).alias("settled"),
        F.avg(F.col("accrued_income").isNull().cast("int")).alias("nulls"),
        F.avg(F.log("quantity")).alias("q_mean"), F.stddev(F.log("unit_cost")).alias("c_dev"),
        F.avg(F.col("unit_price") / F.col("unit_cost")).alias("drift"),
        F.min("fx_rate").alias("fx_min"), F.max("fx_rate").alias("fx_max"),
        F.count_distinct("as_of_date").alias("days"),
        F.count_distinct("account_id").alias("accounts"),
        F.min("unit_price").alias("low"),
    ).first()
    assert abs(r.settled - 0.95) < 0.01 and abs(r.nulls - 0.01) < 0.004
    assert abs(r.q_mean - 6) < 0.05 and abs(r.c_dev - 0.8) < 0.02
    assert abs(float(r.drift) - 1.05) < 0.01 and float(r.low) >= 0.01
    assert 0.8 <= r.fx_min and r.fx_max <= 1.5 and (r.days, r.accounts) == (64, 100)
    days = synthetic.business_days(spark)
    assert days.count() == 64 and days.where(F.weekday("day") > 4).isEmpty()
    assert date(2025, 1, 1) + timedelta(89) == days.agg(F.max("day")).first()[0]
