"""Catalog jobs over documents, feeds as text, interfaces and the synthetic feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as x
from ..functions.projects import ProjectRules
from ..operators import catalog_views
from ..plans import collections, interfaces, manifests, specs, synthetic
from ..sources.scheduler import dump_rejects, dump_relation, task_instances
from ..sources.tables import parse_lines, typed_feed
from . import bindings as b
from . import corpora
from . import sql as q
from .registry import query

RULES = ProjectRules(
    models=(("^base_", "core"), ("^top_", "mart")),
    paths=(("/API-SPEC/", "external"),),
    systems=(("_1", "first"), ("_2", "second")),
    default="internal",
)

# --- specifications ---------------------------------------------------------------------


@query("spec_sources", """
SELECT CAST(doc_id AS VARCHAR) AS source_id, source AS display_name, 'external' AS project_id,
       source AS feature_group, CASE lang WHEN 'en' THEN 'OpenAPI' ELSE 'Swagger2' END AS kind,
       CAST(n_chars AS VARCHAR) AS release_version,
       '/API-SPEC/' || source || '/swagger-spec-' || doc_id || '.json' AS spec_path,
       2 AS endpoint_count
FROM documents""")
def spec_sources(t):
    return specs.spec_sources(corpora.spec_documents(t), RULES)


@query("spec_endpoints", """
SELECT doc_id || ':' || method || ' /docs/' || doc_id AS endpoint_key,
       CAST(doc_id AS VARCHAR) AS source_id, method, '/docs/' || doc_id AS path,
       CASE method WHEN 'GET' THEN 'read' ELSE 'write' END || doc_id AS operation_id,
       source AS summary,
       CASE lang WHEN 'en' THEN 'Handles one document.' ELSE '' END AS description,
       CAST(doc_id AS VARCHAR) AS function_point_id, server_url || '/docs/' || doc_id
         AS full_endpoint_url,
       CAST(n_chars AS VARCHAR) AS sei_version, server_url, 0 AS error_count,
       'Y' AS requires_auth, 'external' AS project_id, source AS feature_group
FROM (SELECT *, CASE lang WHEN 'en' THEN 'https://en.example.com'
                          ELSE lang || '.example.com' END AS server_url FROM documents)
CROSS JOIN (SELECT unnest(['GET', 'POST']) AS method)""")
def spec_endpoints(t):
    return specs.spec_endpoints(corpora.spec_documents(t), RULES)


@query("spec_fields", """
SELECT doc_id || ':POST /docs/' || doc_id AS endpoint_key, 'source' AS field_name,
       'string' AS data_type, 'Y' AS required, CAST(40 AS BIGINT) AS max_length,
       CAST(NULL AS VARCHAR) AS format, source AS example_value,
       CAST(NULL AS VARCHAR) AS description FROM documents
UNION ALL
SELECT doc_id || ':POST /docs/' || doc_id, 'length', 'integer', 'N', NULL, NULL, NULL,
       'characters' FROM documents
UNION ALL
SELECT doc_id || ':GET /docs/' || doc_id, f.name, f.type, f.required, NULL, NULL, NULL, NULL
FROM documents CROSS JOIN (
  SELECT unnest([{'name': 'id', 'type': 'integer', 'required': 'Y'},
                 {'name': '?', 'type': NULL, 'required': 'N'},
                 {'name': 'page', 'type': 'integer', 'required': 'N'},
                 {'name': 'size', 'type': 'integer', 'required': 'N'}]) AS f)""")
def spec_fields(t):
    return specs.spec_fields(corpora.spec_documents(t), RULES)


_LINES_SQL = """
lines AS (
  SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)"""


@query("spec_errors", q.with_tables(_LINES_SQL, select="""
SELECT doc_id || ':GET /docs/' || doc_id AS endpoint_key, '404' AS http_status,
       'HTTP_404' AS error_code, 1 AS sequence_no, 'no ' || source AS business_exception,
       'no ' || source AS error_details FROM documents
UNION ALL
SELECT doc_id || ':POST /docs/' || doc_id, '500', 'HTTP_500', 1, 'no ' || source,
       'no ' || source FROM documents
UNION ALL
SELECT doc_id || ':' || method || ' /docs/' || doc_id, '400', 'ERR-' || length(line), CAST(i + 1 AS INTEGER),
       'Line ' || i, lang
FROM lines CROSS JOIN (SELECT unnest(['GET', 'POST']) AS method)"""))
def spec_errors(t):
    return specs.spec_errors(corpora.spec_documents(t), RULES)


def _half(text):
    """A document that was cut off."""
    return F.substring(text, F.lit(1), F.floor(F.length(text) / 2).cast("int"))


@query("spec_rejects", """
SELECT '/API-SPEC/' || source || '/swagger-spec-' || doc_id || '.json' AS path FROM documents
WHERE lang <> 'en'""")
def spec_rejects(t):
    """The same corpus with the files of one format cut in half."""
    corpus = corpora.spec_documents(t)
    newer = F.get_json_object("content", "$.openapi").isNotNull()
    half = _half(F.col("content"))
    broken = corpus.withColumn("content", F.when(newer, F.col("content")).otherwise(half))
    return specs.spec_rejects(broken)


@query("markdown_rows", q.with_tables(_LINES_SQL, select="""
SELECT doc_id, CAST(i AS INTEGER) AS row_number, 'E' || length(line) AS error_code,
       lang AS business_exception, source AS error_details FROM lines"""))
def markdown_rows(t):
    """Error tables with one row per line of every text."""
    lines = F.transform(F.split("text", "\n"), lambda line, i: F.concat(
        F.lit("|"), i.cast("string"), F.lit("|"), F.col("lang"), F.lit("|E"),
        F.length(line).cast("string"), F.lit(" | "), F.col("source"), F.lit("| "),
    ))
    rows = t.documents.select(
        "doc_id", F.posexplode(x.markdown_errors(F.array_join(lines, "\n"))).alias("at", "row")
    )
    return rows.select("doc_id", (F.col("at") + 1).alias("row_number"), "row.*")


@query("project_counts", """
SELECT CASE WHEN lang = 'en' THEN 'english' WHEN source LIKE '%1' THEN 'ones' ELSE 'other' END
         AS project_id, count(*) AS object_count FROM documents GROUP BY 1""")
def project_counts(t):
    rules = ProjectRules(paths=(("^en/", "english"), ("1$", "ones")), default="other")
    path = F.concat_ws("/", "lang", "source")
    return catalog_views.project_counts(t.documents.select(rules.for_path(path).alias("project_id")))


@query("list_by_project", """
SELECT doc_id, lang AS project_id FROM documents WHERE lang = 'fr'""")
def list_by_project(t):
    listed = t.documents.select("doc_id", F.col("lang").alias("project_id"))
    return catalog_views.by_project(catalog_views.by_project(listed, "all"), "fr")


# --- collections ------------------------------------------------------------------------


@query("collection_flows", """
SELECT 'order-' || o_orderkey AS flow_key, 'order-' || o_orderkey AS flow_name,
       'internal' AS project_id, o_orderpriority AS description,
       CAST(7 AS BIGINT) AS step_count
FROM orders""")
def collection_flows(t):
    corpus = corpora.collection_documents(t)
    return collections.flows(corpus, collections.flow_requests(corpus), RULES)


@query("collection_rejects", """
SELECT '/POSTMAN/' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '.postman.json' AS path
FROM orders WHERE o_orderstatus <> 'O'""")
def collection_rejects(t):
    """The corpus with some documents cut in half, and a request given as text in others."""
    status = t.orders.select(
        F.format_string("/POSTMAN/%012d.postman.json", "o_orderkey").alias("path"),
        "o_orderstatus")
    corpus = corpora.collection_documents(t).join(status, "path")
    text = F.replace("content", F.lit('{"url": "https://api/self/{{loop}}"}'), F.lit('"GET x"'))
    broken = corpus.withColumn(
        "content",
        F.when(F.col("o_orderstatus") == "F", _half(F.col("content")))
        .when(F.col("o_orderstatus") == "P", text).otherwise(F.col("content")))
    return collections.collection_rejects(broken)


@query("collection_steps", """
SELECT 'order-' || o_orderkey AS flow_key, CAST(1 AS BIGINT) AS step_order,
       'login' AS label,
       'POST https://api/login/' || o_custkey AS endpoint_key, 'token' AS variable_passed
FROM orders
UNION ALL
SELECT 'order-' || o_orderkey, 2, 'read',
       'GET https://api/orders/' || o_orderkey || '?t={{token}}', 'order' FROM orders
UNION ALL
SELECT 'order-' || o_orderkey, 3, 'Step 3', 'GET https://api/{{order}}/{{token}}/{{none}}', NULL
FROM orders
UNION ALL
SELECT 'order-' || o_orderkey, 4, 'open', 'GET {{base}}/session/' || o_custkey, 'sid' FROM orders
UNION ALL
SELECT 'order-' || o_orderkey, 5, 'use', 'PUT {{base}}/use/{{sid}}', NULL FROM orders
UNION ALL
SELECT 'order-' || o_orderkey, 6, 'self', 'GET https://api/self/{{loop}}', 'loop' FROM orders
UNION ALL
SELECT 'order-' || o_orderkey, 7, 'again', 'GET https://api/self/{{loop}}', NULL FROM orders""")
def collection_steps(t):
    requests = collections.flow_requests(corpora.collection_documents(t))
    return collections.flow_steps(collections.request_steps(requests))


@query("collection_dependencies", """
SELECT 'GET https://api/orders/' || o_orderkey || '?t={{token}}' AS from_endpoint,
       'POST https://api/login/' || o_custkey AS to_endpoint, 'uses' AS dep_type FROM orders
UNION ALL
SELECT DISTINCT 'GET https://api/{{order}}/{{token}}/{{none}}',
       'POST https://api/login/' || o_custkey, 'uses' FROM orders
UNION ALL
SELECT 'GET https://api/{{order}}/{{token}}/{{none}}',
       'GET https://api/orders/' || o_orderkey || '?t={{token}}', 'uses' FROM orders
UNION ALL
SELECT DISTINCT 'PUT {{base}}/use/{{sid}}', 'GET {{base}}/session/' || o_custkey, 'uses'
FROM orders""")
def collection_dependencies(t):
    requests = collections.flow_requests(corpora.collection_documents(t))
    return collections.flow_dependencies(collections.request_steps(requests))


# --- manifests --------------------------------------------------------------------------

_FOLDER = """CASE p_size % 5 WHEN 0 THEN 'bronze' WHEN 1 THEN 'staging' WHEN 2 THEN 'marts'
                             WHEN 3 THEN 'misc' ELSE 'slv' END"""


@query("manifest_datasets", f"""
SELECT 'dbt' AS platform_id, p_brand AS schema_name, 'base_' || p_partkey AS object_name,
       'MODEL' AS object_type, 'direct' AS project_id,
       CASE {_FOLDER} WHEN 'bronze' THEN 'bronze' WHEN 'staging' THEN 'bronze'
            WHEN 'marts' THEN 'gold' WHEN 'slv' THEN 'silver' END AS layer,
       p_name AS tech_desc, p_type AS owner FROM part
UNION ALL
SELECT 'dbt', 'dbt', 'top_' || p_partkey, 'MODEL', 'mart', NULL, NULL, p_name FROM part""")
def manifest_datasets(t):
    return manifests.datasets(corpora.manifest_documents(t)[0], RULES)


@query("manifest_columns", """
SELECT 'dbt' AS platform_id, p_brand AS schema_name, 'base_' || p_partkey AS object_name,
       'name' AS column_name, 1 AS position_order, 'text' AS data_type,
       CAST(NULL AS VARCHAR) AS tech_desc FROM part
UNION ALL
SELECT 'dbt', p_brand, 'base_' || p_partkey, 'id', 2, 'bigint', 'key of ' || p_partkey
FROM part""")
def manifest_columns(t):
    return manifests.columns(*corpora.manifest_documents(t))


@query("manifest_transformations", """
SELECT 'dbt.' || p_brand || '.base_' || p_partkey AS target_key,
       'dbt_model' AS transform_type, 'base_' || p_partkey AS dbt_model,
       'direct' AS project_id, 'select ' || p_partkey AS compiled_sql, 'select 1' AS raw_sql
FROM part
UNION ALL
SELECT 'dbt.dbt.top_' || p_partkey, 'dbt_model', 'top_' || p_partkey, 'mart', 'select 2', 'raw'
FROM part""")
def manifest_transformations(t):
    return manifests.transformations(corpora.manifest_documents(t)[0], RULES)


@query("lineage_resolve", """
WITH edges AS (
  SELECT 'dbt.raw_' || p_brand || '.parts' AS from_key,
         'dbt.' || p_brand || '.base_' || p_partkey AS to_key, 'core' AS project_id FROM part
  UNION ALL
  SELECT 'dbt.' || p_brand || '.base_' || p_partkey, 'dbt.dbt.top_' || p_partkey, 'mart'
  FROM part
  UNION ALL
  SELECT 'dbt.raw_' || p_brand || '.parts', 'dbt.dbt.top_' || p_partkey, 'mart' FROM part)
SELECT from_key || '->' || to_key AS edge_id, from_key, to_key, 'dataset' AS from_type,
       'dataset' AS to_type, 'dbt' AS source, project_id FROM edges""")
def lineage_resolve(t):
    return manifests.lineage(corpora.manifest_documents(t)[0], RULES)


@query("manifest_rejects", """
SELECT 'part-' || p_partkey AS doc_id FROM part WHERE p_size % 2 = 0""")
def manifest_rejects(t):
    """The corpus with every other manifest cut in half."""
    corpus = corpora.manifest_documents(t)[0]
    sizes = t.part.select(
        F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("doc_id"), "p_size")
    cut_off = F.when(F.col("p_size") % 2 == 0, _half(F.col("content")))
    broken = corpus.join(sizes, "doc_id").withColumn("content", F.coalesce(cut_off, "content"))
    return manifests.manifest_rejects(broken)


# --- scheduler --------------------------------------------------------------------------


@query("dump_rejects", """
SELECT '/dumps/' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '.json' AS path
FROM orders WHERE o_orderkey % 3 = 0""")
def dump_rejects_(t):
    """The dumps with every third order's cut in half."""
    key = F.regexp_extract("path", r"(\d+)", 1).cast("bigint")
    broken = corpora.scheduler_dumps(t).withColumn(
        "content", F.when(key % 3 == 0, _half(F.col("content"))).otherwise(F.col("content")))
    return dump_rejects(broken)


@query("airflow_dag", """
SELECT 'dag_' || o_orderkey AS dag_id, o_orderstatus = 'F' AS is_paused,
       o_orderpriority AS owners FROM orders""")
def airflow_dag(t):
    return dump_relation(corpora.scheduler_dumps(t), "dag")


@query("airflow_dag_tag", """
SELECT 'dag_' || o_orderkey AS dag_id, o_orderpriority AS name FROM orders
UNION ALL SELECT 'dag_' || o_orderkey, 'all' FROM orders""")
def airflow_dag_tag(t):
    return dump_relation(corpora.scheduler_dumps(t), "dag_tag")


@query("airflow_task_instance", """
SELECT 'dag_' || o_orderkey AS dag_id, 'load' AS task_id, 'success' AS state,
       strftime(o_orderdate, '%Y-%m-%d') || ' 01:02:03' AS start_date,
       strftime(o_orderdate, '%Y-%m-%d') || ' 01:30:00' AS end_date FROM orders
UNION ALL SELECT 'dag_' || o_orderkey, 'wait', NULL, NULL, NULL FROM orders""")
def airflow_task_instance(t):
    tasks = task_instances(corpora.scheduler_dumps(t))
    return tasks.select("dag_id", "task_id", "state", F.col("start_date").cast("string"),
                        F.col("end_date").cast("string"))


@query("top_recent_tasks", """
SELECT 'dag_' || o_orderkey AS dag_id, 'load' AS task_id, 'success' AS state,
       strftime(o_orderdate, '%Y-%m-%d') || ' 01:02:03' AS start_date,
       strftime(o_orderdate, '%Y-%m-%d') || ' 01:30:00' AS end_date
FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 500""")
def top_recent_tasks(t):
    tasks = dump_relation(corpora.scheduler_dumps(t), "task_instance")
    return tasks.withColumns({c: F.col(c).cast("string") for c in ("start_date", "end_date")})


# --- interfaces -------------------------------------------------------------------------

_INTERFACES_SQL = """
interfaces AS (
  SELECT l_orderkey AS ordinal, sn.n_name AS source_system, o_orderpriority AS source_party,
         CASE WHEN o_orderstatus <> 'P' THEN cn.n_name ELSE '' END AS target_system,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS target_party
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON
       s_nationkey = sn.n_nationkey JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey)"""


def _interfaces(t):
    """An interface per order line, from the supplier's nation to the customer's."""
    names = t.nation.select("n_nationkey", "n_name")
    source = t.supplier.join(names, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("n_name").alias("source_system")
    )
    target = t.customer.join(names, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("n_name").alias("nation")
    )
    status = F.col("o_orderstatus")
    return (
        t.lineitem.select("l_orderkey", "l_suppkey")
        .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(source, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(target, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("l_orderkey").alias("ordinal"),
            "source_system",
            F.col("o_orderpriority").alias("source_party"),
            F.when(status != "P", F.col("nation")).otherwise("").alias("target_system"),
            F.when(status != "O", status).alias("target_party"),
        )
    )


@query("system_traffic", q.with_tables(_INTERFACES_SQL, select="""
SELECT system_name, arg_max_null(party, at_) AS party, CAST(sum(o) AS BIGINT) AS outbound_count,
       CAST(sum(i) AS BIGINT) AS inbound_count, count(*) AS total_count,
       CASE WHEN contains(system_name, '_1') THEN 'first'
            WHEN contains(system_name, '_2') THEN 'second' ELSE 'internal' END AS project_id
FROM (SELECT source_system AS system_name, source_party AS party, 1 AS o, 0 AS i,
             2 * ordinal AS at_ FROM interfaces
      UNION ALL
      SELECT target_system, target_party, 0, 1, 2 * ordinal + 1 FROM interfaces)
WHERE system_name <> '' GROUP BY system_name"""))
def system_traffic(t):
    return interfaces.system_traffic(_interfaces(t), RULES)


@query("interface_rows", """
SELECT CAST(p_partkey AS VARCHAR) AS interface_id, p_type AS domain, p_brand AS app_contact,
       p_name AS process_improvement, CAST(NULL AS VARCHAR) AS notes FROM part""")
def interface_rows(t):
    listed = t.part.select(
        F.col("p_partkey").cast("string").alias("interface_id"), F.col("p_type").alias("domain"),
        F.col("p_brand").alias("app_owner"), F.col("p_name").alias("improvement"),
    )
    return interfaces.interface_rows(listed).select(
        "interface_id", "domain", "app_contact", "process_improvement", "notes"
    )


@query("routing_hops", """
SELECT interface_id, CAST(hop_order AS INTEGER) AS hop_order, system_name, 'internal' AS project_id FROM (
  SELECT p_partkey AS interface_id, unnest(string_split(p_name, ' ')) AS system_name,
         generate_subscripts(string_split(p_name, ' '), 1) - 1 AS hop_order FROM part)""")
def routing_hops(t):
    listed = t.part.select(
        F.col("p_partkey").alias("interface_id"), F.split("p_name", " ").alias("routing_hops")
    )
    return interfaces.routing_hops(listed, RULES)


# --- feeds ------------------------------------------------------------------------------


def _feed_lines(t):
    """Positions as CSV records in file order; failed trades carry one field too many."""
    fields = [F.col(c).cast("string").alias(c) for c in schemas.FEED_COLUMNS["positions_raw"]]
    record = F.to_csv(F.struct(*fields))
    broken = F.col("settlement_status") == "FAILED"
    return b.positions_raw(t).select(
        F.when(broken, F.concat(record, F.lit(",extra"))).otherwise(record).alias("line")
    )


_POSITION_MEASURES = q.doubles(
    "quantity", "unit_cost", "unit_price", "cost_basis", "market_value", "unrealized_gl",
    "accrued_income", "fx_rate",
)


@query("feed_rows", q.with_tables(q.POSITIONS_RAW, select=f"""
SELECT position_hash, as_of_date, account_id, security_id, {_POSITION_MEASURES},
       settlement_status, source_system FROM positions WHERE settlement_status <> 'FAILED'"""))
def feed_rows(t):
    """Good records of the feed, back in landing types."""
    good, _ = parse_lines(_feed_lines(t), "line", "positions_raw")
    return typed_feed(good, "positions_raw")


@query("feed_rejects", q.with_tables(q.POSITIONS_RAW, select="""
SELECT split_part(position_hash, '|', 1) AS day, count(*) AS n_rows,
       'too many fields' AS reason
FROM positions WHERE settlement_status = 'FAILED' GROUP BY 1"""))
def feed_rejects(t):
    _, rejects = parse_lines(_feed_lines(t), "line", "positions_raw")
    return rejects.groupBy(F.substring("record", 1, 10).alias("day"), "reason").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query("synth_positions", """
SELECT true AS consistent, count(*) AS n_rows FROM lineitem""")
def synth_positions(t):
    """A synthetic position per order line; the rules between its drawn columns are checked."""
    ids = t.lineitem.select(F.xxhash64(*t.lineitem.columns).alias("id"))
    drawn = synthetic.positions(ids, n_securities=50_000, n_accounts=10_000)
    key = F.concat_ws("|", F.col("as_of_date").cast("string"), "account_id", "security_id")
    account = F.regexp_extract("account_id", r"^ACCT(\d{7})$", 1).try_cast("int")
    security = F.regexp_extract("security_id", r"^SEC(\d{8})$", 1).try_cast("int")
    near = F.lit(0.0101)
    consistent = (
        (F.col("position_hash") == key) & account.between(0, 9_999) & security.between(0, 49_999)
        & F.weekday("as_of_date").between(0, 4) & (F.col("quantity") >= 0)
        & (F.col("unit_price") >= F.lit(0.01).cast("decimal(4,2)"))
        & (F.abs(F.col("cost_basis") - F.col("quantity") * F.col("unit_cost")) <= near)
        & (F.abs(F.col("market_value") - F.col("quantity") * F.col("unit_price")) <= near)
        & (F.col("unrealized_gl") == F.col("market_value") - F.col("cost_basis"))
        & F.coalesce(F.col("accrued_income").between(
            0, F.col("market_value").cast("double") * 0.005 + 0.01), F.lit(True))
        & F.col("fx_rate").between(0.8, 1.5)
        & F.col("settlement_status").isin(*schemas.SETTLEMENT_STATUSES)
        & F.col("source_system").isNotNull()
    )
    return drawn.groupBy(consistent.alias("consistent")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("synth_securities", """
SELECT 'SEC' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS security_id,
       'Security ' || p_partkey || ' Holdings' AS security_name, true AS consistent FROM part""")
def synth_securities(t):
    """A synthetic security per part; the rules between its drawn columns are checked."""
    drawn = synthetic.securities(t.part.select(F.col("p_partkey").alias("id")))
    kind = F.col("asset_class")
    consistent = (
        ((kind == "FIXED_INCOME") == F.col("maturity_date").isNotNull())
        & ((kind == "EQUITY") == F.col("exchange").isNotNull())
        & (F.length("cusip") == 9) & (F.length("isin") == 12) & (F.length("ticker") == 4)
        & F.startswith("isin", "country") & kind.isin(*schemas.ASSET_CLASSES)
        & F.col("issue_date").between("2000-01-01", "2024-08-21")
    )
    return drawn.select("security_id", "security_name", consistent.alias("consistent"))


@query("synth_accounts", """
SELECT 'ACCT' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS account_id,
       'Client Account ' || c_custkey AS account_name,
       'CLT' || lpad(CAST(c_custkey // 10 AS VARCHAR), 6, '0') AS client_id,
       true AS consistent FROM customer""")
def synth_accounts(t):
    """A synthetic account per customer; the drawn columns are checked against their domains."""
    drawn = synthetic.accounts(t.customer.select(F.col("c_custkey").alias("id")))
    consistent = (
        F.col("account_type").isin(*synthetic.ACCOUNT_TYPES)
        & F.col("base_currency").isin(*synthetic.BASE_CURRENCIES)
        & F.col("domicile_country").isin(*synthetic.COUNTRIES)
        & F.col("inception_date").between("2010-01-01", "2023-09-09")
        & F.regexp_extract("portfolio_manager", r"^PM(\d{4})$", 1).cast("int").between(1, 200)
        & F.col("is_discretionary").isin("True", "False")
        & F.col("aum_tier").isin(*synthetic.AUM_TIERS)
    )
    return drawn.select("account_id", "account_name", "client_id",
                        consistent.alias("consistent"))
