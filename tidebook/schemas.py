"""Column contracts of the feeds, marts, run statistics and parsed documents."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------
# Names, order and types of the landing tables. ``varchar(n)`` keeps the
# first n characters, ``flag`` turns a boolean written as text into 0/1.
# ---------------------------------------------------------------------------------------

POSITIONS = {
    "position_hash": "string",
    "as_of_date": "date",
    "account_id": "varchar(20)",
    "security_id": "varchar(20)",
    "quantity": "decimal(18,4)",
    "unit_cost": "decimal(18,6)",
    "unit_price": "decimal(18,6)",
    "cost_basis": "decimal(20,2)",
    "market_value": "decimal(20,2)",
    "unrealized_gl": "decimal(20,2)",
    "accrued_income": "decimal(20,2)",
    "fx_rate": "decimal(10,6)",
    "settlement_status": "varchar(10)",
    "source_system": "varchar(20)",
}

SECURITIES = {
    "security_id": "varchar(20)",
    "cusip": "varchar(9)",
    "isin": "varchar(12)",
    "ticker": "varchar(10)",
    "security_name": "varchar(200)",
    "asset_class": "varchar(20)",
    "sub_asset_class": "varchar(30)",
    "currency": "varchar(3)",
    "country": "varchar(2)",
    "exchange": "varchar(10)",
    "issue_date": "date",
    "maturity_date": "date",
    "is_active": "flag",
}

ACCOUNTS = {
    "account_id": "varchar(20)",
    "account_name": "varchar(200)",
    "client_id": "varchar(20)",
    "account_type": "varchar(20)",
    "base_currency": "varchar(3)",
    "domicile_country": "varchar(2)",
    "inception_date": "date",
    "portfolio_manager": "varchar(20)",
    "is_discretionary": "flag",
    "aum_tier": "varchar(10)",
}

LANDING_TABLES = {"positions_raw": POSITIONS, "securities": SECURITIES, "accounts": ACCOUNTS}

#: Column order inside the feed files: the positions file carries its key last.
FEED_COLUMNS = {
    "positions_raw": [c for c in POSITIONS if c != "position_hash"] + ["position_hash"],
    "securities": list(SECURITIES),
    "accounts": list(ACCOUNTS),
}

SETTLEMENT_STATUSES = ("SETTLED", "PENDING", "FAILED")
ASSET_CLASSES = ("EQUITY", "FIXED_INCOME", "CASH", "ALTERNATIVE", "DERIVATIVE")


def text_schema(table: str) -> T.StructType:
    """All-string schema of a feed file, in file order."""
    return T.StructType([T.StructField(c, T.StringType()) for c in FEED_COLUMNS[table]])


def _type(kind: str) -> T.DataType:
    """Type of a contract entry. Needs no session, unlike parsing a schema string."""
    if kind.startswith("decimal("):
        precision, scale = kind[len("decimal("):-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    simple = {"date": T.DateType(), "timestamp": T.TimestampType(), "bigint": T.LongType(),
              "double": T.DoubleType()}
    return simple.get(kind, T.StringType())


def _struct(contract: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(c, _type(kind)) for c, kind in contract.items()])


def landing_schema(table: str) -> T.StructType:
    """Typed schema of a landing table; flags stay text until staging."""
    return _struct(LANDING_TABLES[table])


# ---------------------------------------------------------------------------------------
# Run statistics
# ---------------------------------------------------------------------------------------

RUN_STATS_COLUMNS = {
    "run_id": "string",
    "run_started_at": "timestamp",
    "model_name": "string",
    "materialization": "string",
    "dbt_threads": "bigint",
    "parallel_degree": "bigint",
    "elapsed_seconds": "decimal(18,3)",
    "cpu_seconds": "decimal(18,3)",
    "pga_peak_bytes": "bigint",
    "uga_peak_bytes": "bigint",
    "physical_reads_bytes": "bigint",
    "logical_reads": "bigint",
    "redo_size_bytes": "bigint",
    "rows_processed": "bigint",
    "status": "string",
}
RUN_STATS = _struct(RUN_STATS_COLUMNS)

#: A run file is a stats row plus what the pod measured.
RUN_FILE = _struct(RUN_STATS_COLUMNS | {
    "pod_size": "string", "pod_peak_cpu_cores": "double", "pod_peak_mem_mib": "double",
})
POD_METRICS = _struct({"peak_cpu_cores": "double", "peak_mem_mib": "double"})

#: Session counter name -> run statistics column.
COUNTER_COLUMNS = {
    "CPU used by this session": "cpu_seconds",
    "session pga memory max": "pga_peak_bytes",
    "session uga memory max": "uga_peak_bytes",
    "physical read bytes": "physical_reads_bytes",
    "session logical reads": "logical_reads",
    "redo size": "redo_size_bytes",
}

# ---------------------------------------------------------------------------------------
# Document shapes. Parts whose shape varies stay JSON text and are parsed one level later.
# ---------------------------------------------------------------------------------------

SPEC_DOC = """
    openapi string, host string,
    info struct<title: string, version: string, description: string>,
    servers array<struct<url: string>>,
    paths map<string, map<string, string>>
"""
_PROPERTY = (
    "struct<type: string, maxLength: string, format: string, example: string, "
    "description: string>"
)
SPEC_OPERATION = f"""
    operationId string, summary string, description string,
    requestBody struct<content: map<string, struct<schema: struct<
        properties: map<string, {_PROPERTY}>, required: array<string>>>>>,
    parameters array<struct<name: string, type: string, required: string, description: string,
        schema: struct<type: string, properties: map<string, {_PROPERTY}>>>>,
    responses map<string, struct<description: string>>
"""
COLLECTION_DOC = "info struct<name: string, description: string>, item array<string>"
MANIFEST_DOC = """
    nodes map<string, string>,
    sources map<string, struct<name: string, schema: string, source_name: string>>
"""
MANIFEST_NODE = """
    resource_type string, name string, schema string, path string, description string,
    config struct<meta: map<string, string>>, meta map<string, string>,
    columns map<string, struct<description: string>>,
    compiled_code string, compiled_sql string, raw_code string, raw_sql string,
    depends_on struct<nodes: array<string>>
"""
CATALOG_DOC = "nodes map<string, struct<columns: map<string, struct<type: string>>>>"
SCHEDULER_DOC = "map<string, array<array<string>>>"

# ---------------------------------------------------------------------------------------
# Catalog relations: business keys and the columns people maintain by hand
# ---------------------------------------------------------------------------------------

CATALOG_KEYS = {
    "datasets": ["platform_id", "schema_name", "object_name"],
    "columns": ["platform_id", "schema_name", "object_name", "column_name"],
    "transformations": ["target_key"],
    "transform_lineage": ["edge_id"],
    "api_sources": ["source_id"],
    "api_endpoints": ["endpoint_key"],
    "api_fields": ["endpoint_key", "field_name"],
    "api_endpoint_errors": ["endpoint_key", "http_status", "error_code", "sequence_no"],
    "api_flows": ["flow_key"],
    "api_flow_steps": ["flow_key", "step_order"],
    "api_dependencies": ["from_endpoint", "to_endpoint"],
    "interface360_interfaces": ["interface_id"],
    "interface360_routing_hops": ["interface_id", "hop_order"],
    "interface360_systems": ["system_name"],
}
CATALOG_PROTECTED = {
    "datasets": ["business_desc"],
    "columns": ["business_desc", "is_pii", "pii_category", "pii_attribute"],
    "api_sources": ["display_name"],
    "api_fields": ["is_pii", "pii_category", "pii_attribute"],
    "interface360_interfaces": ["carries_pii", "pii_categories"],
    "interface360_systems": ["carries_pii"],
}
