"""Ordered events: numbering, as-of lookups, counters and run statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog_views, runstats
from ..operators.sequences import latest_before, number_within
from ..plans.collections import flow_dependencies
from ..sources.runs import parse_run_files, run_file_rejects
from . import bindings as b
from . import sql as q
from .registry import query


@query("step_numbers", """
SELECT event_id, user_id,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step_order
FROM events""")
def step_numbers(t):
    events = t.events.select("event_id", "user_id", "ts")
    return number_within(
        events, ["user_id"], ["ts", "event_id"], F.date_trunc("minute", "ts"), "step_order"
    ).drop("ts")


_STEPS_SQL = """
steps AS (
  SELECT user_id, ts, event_id, CAST(floor(value) AS BIGINT) % 5 AS variable, event_type,
         CASE event_type
           WHEN 'signup' THEN 'POST https://api/' || json_extract_string(props, '$.k')
           ELSE 'GET https://api/' || json_extract_string(props, '$.k') END AS endpoint
  FROM events WHERE event_type IN ('signup', 'purchase')),
resolved AS (
  SELECT *, last_value(CASE WHEN event_type = 'signup' THEN endpoint END IGNORE NULLS)
    OVER (PARTITION BY user_id, variable ORDER BY ts, event_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS to_endpoint
  FROM steps)"""


def _steps(t):
    """Sign-ups set a variable, purchases use one."""
    k = F.get_json_object("props", "$.k")
    sets = F.col("event_type") == "signup"
    return t.events.where(F.col("event_type").isin("signup", "purchase")).select(
        "user_id", F.struct("ts", "event_id").alias("at"), "event_id", sets.alias("sets"),
        (F.floor("value").cast("bigint") % 5).alias("variable"),
        F.concat(F.when(sets, "POST https://api/").otherwise("GET https://api/"), k)
        .alias("endpoint"),
    )


@query("asof_latest_setter", q.with_tables(_STEPS_SQL, select="""
SELECT event_id, user_id, variable, endpoint, to_endpoint FROM resolved
WHERE event_type = 'purchase'"""))
def asof_latest_setter(t):
    steps = _steps(t).withColumn("to_endpoint", F.when(F.col("sets"), F.col("endpoint")))
    return latest_before(
        steps, ["user_id", "variable"], "at", "to_endpoint", F.date_trunc("minute", "at.ts")
    ).drop("at", "sets")


@query("flow_dependencies", q.with_tables(_STEPS_SQL, select="""
SELECT DISTINCT 'GET https://api/{{' || variable || '}}' AS from_endpoint, to_endpoint,
       'uses' AS dep_type
FROM resolved WHERE event_type = 'purchase' AND to_endpoint IS NOT NULL"""))
def event_flow_dependencies(t):
    """Edges of the same flows, every purchase using the variable in its address."""
    sets = F.col("sets")
    name = F.col("variable").cast("string")
    use = F.concat(F.lit("https://api/{{"), name, F.lit("}}"))
    steps = _steps(t).select(
        "user_id", "at",
        F.when(sets, F.col("endpoint")).otherwise(F.concat(F.lit("GET "), use))
        .alias("endpoint_key"),
        F.when(~sets, use).alias("address"),
        F.when(sets, name).alias("saved_variable"),
    )
    return flow_dependencies(steps, "user_id", "at", F.date_trunc("minute", "at.ts"))


_EDGES_SQL = """
edges AS (
  SELECT DISTINCT endpoint AS from_endpoint, to_endpoint FROM resolved
  WHERE event_type = 'purchase' AND to_endpoint IS NOT NULL)"""


def _edges(t):
    return asof_latest_setter(t).where(F.col("to_endpoint").isNotNull()).select(
        F.col("endpoint").alias("from_endpoint"), "to_endpoint",
        F.lit("uses").alias("dep_type"),
    )


@query("edge_endpoints", q.with_tables(_STEPS_SQL, _EDGES_SQL, select="""
SELECT side, endpoint, regexp_replace(endpoint, '^(GET|POST|PUT|DELETE)\\s', '') AS address,
       regexp_extract(endpoint, '^(GET|POST|PUT|DELETE)\\s', 1) AS method
FROM (SELECT 'from' AS side, from_endpoint AS endpoint FROM edges
      UNION SELECT 'to', to_endpoint FROM edges)"""))
def edge_endpoints(t):
    edges = catalog_views.distinct_edges(_edges(t))
    return catalog_views.endpoint_labels(catalog_views.edge_endpoints(edges))


@query("first_edge_attribute", q.with_tables(_STEPS_SQL, _EDGES_SQL, select="""
SELECT from_endpoint, min(to_endpoint) AS to_endpoint FROM edges GROUP BY from_endpoint"""))
def first_edge_attribute(t):
    return catalog_views.first_attribute(
        _edges(t), "from_endpoint", "to_endpoint", ["to_endpoint"]
    )


@query("counter_pivot", """
SELECT user_id AS sid, max(CASE WHEN event_type = 'view' THEN value END) AS view_max,
       max(CASE WHEN event_type = 'click' THEN value END) AS click_max,
       max(CASE WHEN event_type = 'error' THEN value END) AS error_max
FROM events WHERE event_type IN ('view', 'click', 'error') GROUP BY user_id""")
def counter_pivot(t):
    counters = t.events.select(F.col("user_id").alias("sid"), F.col("event_type").alias("name"),
                               "value")
    names = {"view": "view_max", "click": "click_max", "error": "error_max"}
    return runstats.pivot_counters(counters, ["sid"], names)


@query("session_counters", """
WITH ids AS (
  SELECT *, CASE event_type WHEN 'view' THEN 'CPU used by this session'
                            WHEN 'click' THEN 'session pga memory max'
                            WHEN 'error' THEN 'session uga memory max'
                            WHEN 'signup' THEN 'physical read bytes'
                            ELSE 'session logical reads' END AS name FROM events)
SELECT user_id AS sid,
       CAST(round(max(CASE WHEN name = 'CPU used by this session'
            THEN CAST(floor(value * 10) AS DECIMAL(18,0)) END) / 100.0, 3) AS DOUBLE)
         AS cpu_seconds,
       max(CASE WHEN name = 'session pga memory max' THEN CAST(floor(value * 10) AS BIGINT) END)
         AS pga_peak_bytes,
       max(CASE WHEN name = 'session uga memory max' THEN CAST(floor(value * 10) AS BIGINT) END)
         AS uga_peak_bytes,
       max(CASE WHEN name = 'physical read bytes' THEN CAST(floor(value * 10) AS BIGINT) END)
         AS physical_reads_bytes,
       max(CASE WHEN name = 'session logical reads' THEN CAST(floor(value * 10) AS BIGINT) END)
         AS logical_reads,
       CAST(NULL AS BIGINT) AS redo_size_bytes
FROM ids GROUP BY user_id""")
def session_counters(t):
    """Counter ids resolved through a name table, both taken from the events."""
    kind = F.col("event_type")
    counters = t.events.select(
        F.col("user_id").alias("sid"), kind.alias("statistic_id"),
        F.floor(F.col("value") * 10).cast("bigint").alias("value"),
    )
    name = (
        F.when(kind == "view", "CPU used by this session")
        .when(kind == "click", "session pga memory max")
        .when(kind == "error", "session uga memory max")
        .when(kind == "signup", "physical read bytes")
        .otherwise("session logical reads")
    )
    names = t.events.select(kind.alias("statistic_id"), name.alias("name")).distinct()
    return runstats.session_counters(counters, names)


def _stats_sql(select: str) -> str:
    return q.with_tables(q.RUN_STATS, select=select)


@query("run_stats_left_lookup", """
WITH stats AS (SELECT user_id AS run_id, event_type AS model_name, count(*) AS n
               FROM events GROUP BY ALL),
pods AS (SELECT event_type AS model_name, max(value) AS peak_cpu_cores,
                min(value) AS peak_mem_mib
         FROM events WHERE event_type IN ('view', 'click') GROUP BY event_type)
SELECT model_name, run_id, n, peak_cpu_cores AS pod_peak_cpu_cores,
       peak_mem_mib AS pod_peak_mem_mib FROM stats LEFT JOIN pods USING (model_name)""")
def run_stats_left_lookup(t):
    model = F.col("event_type").alias("model_name")
    stats = t.events.groupBy(F.col("user_id").alias("run_id"), model).agg(
        F.count(F.lit(1)).alias("n")
    )
    pods = t.events.where(F.col("event_type").isin("view", "click")).groupBy(model).agg(
        F.max("value").alias("peak_cpu_cores"), F.min("value").alias("peak_mem_mib")
    )
    return runstats.attach_pod_metrics(stats, pods)


_MATRIX_SQL = """
matrix AS (
  SELECT pod_size, dbt_threads, parallel_degree,
         coalesce(sum(elapsed_seconds), 0) AS total_elapsed_s,
         coalesce(sum(cpu_seconds), 0) AS total_cpu_s,
         max(pga_peak_bytes) / 1048576.0 AS peak_pga_mb,
         CAST(coalesce(sum(rows_processed), 0) AS BIGINT) AS total_rows,
         count(DISTINCT model_name) AS models_run
  FROM exact_stats WHERE pod_size IS NOT NULL AND dbt_threads IS NOT NULL
                     AND parallel_degree IS NOT NULL
  GROUP BY pod_size, dbt_threads, parallel_degree)"""
# Sums of doubles depend on the order of the rows, so the compared statistics are whole numbers.
_EXACT_SQL = """
exact_stats AS (SELECT * REPLACE (floor(elapsed_seconds) AS elapsed_seconds,
                                  floor(cpu_seconds) AS cpu_seconds) FROM stats)"""
_SLA_SQL = """
rated AS (
  SELECT *, total_rows / nullif(total_elapsed_s, 0) AS throughput_rows_s,
         total_cpu_s / nullif(total_elapsed_s, 0) AS cpu_efficiency,
         CASE WHEN total_rows / nullif(total_elapsed_s, 0) >= 2200
               AND total_elapsed_s <= 100000 THEN 'YES' ELSE 'NO' END AS meets_sla
  FROM matrix)"""
_MIN_RATE, _MAX_ELAPSED = 2200, 100000


def _exact_stats(t):
    whole = {c: F.floor(c).cast("double") for c in ("elapsed_seconds", "cpu_seconds")}
    return b.run_stats(t).withColumns(whole)


@query("sizing_matrix", q.with_tables(q.RUN_STATS, _EXACT_SQL, _MATRIX_SQL, _SLA_SQL, select="""
SELECT * EXCLUDE (meets_sla) FROM rated"""))
def sizing_matrix(t):
    return runstats.sizing_matrix(_exact_stats(t))


@query("sla_flag", q.with_tables(q.RUN_STATS, _EXACT_SQL, _MATRIX_SQL, _SLA_SQL, select="""
SELECT pod_size, dbt_threads, parallel_degree, meets_sla FROM rated"""))
def sla_flag(t):
    rated = runstats.with_sla(sizing_matrix(t), _MIN_RATE, _MAX_ELAPSED)
    return rated.select(*runstats.CONFIG_KEYS, "meets_sla")


@query("recommended_config", q.with_tables(
    q.RUN_STATS, _EXACT_SQL, _MATRIX_SQL, _SLA_SQL, select="""
SELECT pod_size, dbt_threads, parallel_degree FROM rated WHERE meets_sla = 'YES'
ORDER BY pod_size, dbt_threads, parallel_degree LIMIT 1"""))
def recommended_config(t):
    rated = runstats.with_sla(sizing_matrix(t), _MIN_RATE, _MAX_ELAPSED)
    return runstats.recommend(rated).select(*runstats.CONFIG_KEYS)


@query("by_model", _stats_sql("""
SELECT pod_size, dbt_threads, parallel_degree, model_name, materialization,
       coalesce(elapsed_seconds, 0) AS elapsed_s, coalesce(cpu_seconds, 0) AS cpu_s,
       coalesce(pga_peak_bytes / 1048576.0, 0) AS peak_pga_mb,
       coalesce(logical_reads, 0) AS logical_reads,
       coalesce(physical_reads_bytes / 1048576.0, 0) AS phys_mb FROM stats"""))
def by_model(t):
    return runstats.by_model(b.run_stats(t))


@query("run_summary", _stats_sql("""
SELECT count(*) AS total_rows, count(DISTINCT run_id) AS run_count FROM stats"""))
def run_summary(t):
    return runstats.run_summary(b.run_stats(t))


@query("union_by_name", _stats_sql("""
SELECT run_id, model_name, elapsed_seconds, NULL AS pod_size, logical_reads FROM stats
WHERE parallel_degree = 4
UNION ALL
SELECT run_id, model_name, NULL, pod_size, logical_reads FROM stats
WHERE parallel_degree <> 4"""))
def union_by_name(t):
    stats = b.run_stats(t)
    first = stats.where("parallel_degree = 4").select(
        "run_id", "model_name", "elapsed_seconds", "logical_reads"
    )
    second = stats.where("parallel_degree <> 4").select(
        "logical_reads", "pod_size", "run_id", "model_name"
    )
    return runstats.union_runs([first, second])


def _run_files(t):
    """Statistics written as one CSV text per run, in two column layouts.

    Names are quoted and hold a comma, a quote and a line end; in one layout the records whose
    number of rows is a multiple of five have a cell too many.
    """
    layouts = {
        True: ["run_id", "elapsed_seconds", "model_name", "pod_size", "rows_processed",
               "materialization"],
        False: ["model_name", "run_id", "dbt_threads", "materialization", "rows_processed",
                "pod_size"],
    }
    first = F.col("parallel_degree") == 4

    def cell(c: str):
        if c == "model_name":
            return F.concat(F.lit('"a, ""b""\n'), F.col(c), F.lit('"'))
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    lines = b.run_stats(t).select(
        "run_id", first.alias("first"),
        F.when(first, F.concat_ws(",", *map(cell, layouts[True])))
        .otherwise(F.concat(F.concat_ws(",", *map(cell, layouts[False])),
                            F.when(F.col("rows_processed") % 5 == 0, ",extra").otherwise(""))).alias("line"),
    )
    # A run has one line per model.
    files = lines.groupBy("run_id", "first").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    header = F.when(F.col("first"), ",".join(layouts[True])).otherwise(",".join(layouts[False]))
    return files.select(F.concat_ws("\n", header, "lines").alias("value"))


@query("run_files", _stats_sql("""
SELECT run_id, 'a, "b"' || chr(10) || model_name AS model_name, materialization, pod_size,
       rows_processed, CASE WHEN parallel_degree = 4 THEN elapsed_seconds END AS elapsed_seconds,
       CASE WHEN parallel_degree <> 4 THEN dbt_threads END AS dbt_threads FROM stats
WHERE parallel_degree = 4 OR coalesce(rows_processed % 5, 1) <> 0"""))
def run_files(t):
    return parse_run_files(_run_files(t)).select(
        "run_id", "model_name", "materialization", "pod_size", "rows_processed",
        "elapsed_seconds", "dbt_threads",
    )


_FILLED = (65, 68, 500)


def _wide_run_files(t):
    """One file per run with as many columns as its degree asks for; the last one is filled.

    Every record whose number of rows is a multiple of seven has one cell beyond the last.
    """
    width = F.get(F.array(*map(F.lit, _FILLED)), (F.col("parallel_degree") % 3).cast("int"))
    lines = b.run_stats(t).select(
        "run_id", width.alias("width"), F.concat(
            F.col("model_name"), F.lit(","), F.col("run_id"),
            F.repeat(F.lit(","), F.col("width") - 3), F.lit(",\"v,"),
            F.coalesce(F.col("rows_processed").cast("string"), F.lit("")), F.lit('"'),
            F.when(F.col("rows_processed") % 7 == 0, ",more").otherwise("")).alias("line"))
    names = F.concat_ws(",", F.lit("model_name"), F.lit("run_id"), F.transform(
        F.sequence(F.lit(3), F.col("width")), lambda i: F.concat(F.lit("x"), i.cast("string"))))
    files = lines.groupBy("run_id", "width").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    return files.select(F.concat_ws("\n", names, "lines").alias("value"))


_WIDTH_SQL = "CASE parallel_degree % 3 WHEN 0 THEN 65 WHEN 1 THEN 68 ELSE 500 END"


@query("run_files_wide", _stats_sql(f"""
SELECT run_id, model_name, {_WIDTH_SQL} - 2 AS n_other,
       'v,' || coalesce(CAST(rows_processed AS VARCHAR), '') AS last_other FROM stats
WHERE coalesce(rows_processed % 7, 1) <> 0"""))
def run_files_wide(t):
    other = F.col("other_columns")
    last = F.try_element_at(other, F.concat(F.lit("x"), (F.size(other) + 2).cast("string")))
    return parse_run_files(_wide_run_files(t)).select(
        "run_id", "model_name", F.size(other).alias("n_other"), last.alias("last_other"))


@query("run_file_rejects_wide", _stats_sql("""
SELECT run_id, count(*) AS n_records FROM stats WHERE rows_processed % 7 = 0 GROUP BY 1"""))
def run_file_rejects_wide(t):
    """Records of wide files with a cell too many, by run."""
    run = F.regexp_extract("record", r"^[^,]*,([^,]*),", 1).alias("run_id")
    return run_file_rejects(_wide_run_files(t)).groupBy(run).agg(
        F.count(F.lit(1)).alias("n_records"))


@query("run_file_rejects", _stats_sql("""
SELECT coalesce(pod_size, '') AS pod_size, count(*) AS n_records FROM stats
WHERE parallel_degree <> 4 AND rows_processed % 5 = 0 GROUP BY 1"""))
def run_file_rejects_(t):
    record = F.regexp_extract("record", r",([^,]*),extra$", 1).alias("pod_size")
    return run_file_rejects(_run_files(t)).groupBy(record).agg(
        F.count(F.lit(1)).alias("n_records"))


@query("flows_nested_steps", """
WITH steps AS (
  SELECT conv_id, turn, (turn) // 3 AS page,
         (turn + 1) || ':' || role || ':' || length(text) AS step FROM conversations)
SELECT 'conv-' || conv_id AS flow_key, page, string_agg(step, ',' ORDER BY turn) AS steps
FROM steps GROUP BY conv_id, page""")
def flows_nested_steps(t):
    """Conversations as flows of turns, three steps to a page."""
    key = F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("flow_key")
    steps = t.conversations.select(
        key, (F.col("turn") + 1).alias("step_order"), F.col("role").alias("label"),
        F.length("text").cast("string").alias("endpoint_key"),
        F.lit(None).cast("string").alias("variable_passed"),
    )
    flows = t.conversations.select(key).distinct()
    nested = catalog_views.nested_flows(flows, steps, page_size=3)
    shown = F.transform("steps", lambda s: F.concat_ws(
        ":", s.step_order.cast("string"), s.label, s.endpoint, s.variable_passed
    ))
    return nested.select("flow_key", "page", F.array_join(shown, ",").alias("steps"))
