import json
from datetime import datetime

import pytest

from tidebook.functions.projects import ProjectRules
from tidebook.plans import catalog, collections, interfaces, manifests, specs
from tidebook.sources import documents, scheduler


def write(root, files):
    for name, content in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        text = content if isinstance(content, (str, bytes)) else json.dumps(content)
        path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(root)


YAML = """
swagger: '2.0'
host: pay.example.com
info: {title: Pay, version: 1.0, description: "Function Point Id is 12."}
paths:
  /pay:
    parameters: []
    Put:
      parameters:
        - {$ref: '#/p'}
        - {name: id, in: path, type: integer, required: true}
        - {name: body, schema: {properties: {amount: {type: number}, note: {type: string}}}}
        - {name: q, schema: {type: string}}
      responses:
        200: {description: ok}
        404: {description: gone}
        503:
        default: {description: any}
  /nothing: {}
"""
JSON_SPEC = {
    "openapi": "3.0.0",
    "info": {"description": "| 1 | Bad | ERR-7 | d |"},
    "servers": [{"url": "https://a"}, {"url": "https://b"}],
    "paths": {"/x": {"post": {
        "operationId": "op", "description": "| 1 | First | ERR-1 | d1 |",
        "requestBody": {"content": {"application/json": {"schema": {
            "required": ["a"],
            "properties": {"b": {"type": "string", "maxLength": 9, "example": "e" * 600},
                           "a": {"type": "integer", "example": 5, "format": "int64"}},
        }}}},
        "responses": {"500": {"description": "down"}, "201": {}},
    }, "trace": {}}},
}


@pytest.fixture
def spec_corpus(spark, tmp_path):
    root = write(tmp_path, {
        "Pay/swagger-spec-Pay.yaml": YAML,
        "Core/core.json": JSON_SPEC,
        "Core/broken.json": '{"info": ',
        "Core/broken.yml": "a: [1",
        "Core/readme.md": "no",
        "Core/my-POSTMAN.json": {"info": {}},
        "Core/latin.json": b'{"info": {"title": "caf\xe9"}}',
    })
    return documents.read_spec_corpus(spark, root)


def test_spec_sources(spec_corpus, rows):
    rules = ProjectRules(paths=(("/Pay/", "p"),), default="rest")
    found = rows(specs.spec_sources(spec_corpus, rules), "source_id", "display_name",
                 "project_id", "feature_group", "kind", "release_version", "endpoint_count")
    assert found == [
        ("Pay", "Pay", "p", "Pay", "Swagger2", "1.0", 1),
        ("core", "core", "rest", "Core", "OpenAPI", "", 1),
        ("latin", "caf�", "rest", "Core", "Swagger2", "", 0),
    ]
    rejected = [r[0].rsplit("/", 1)[1] for r in rows(specs.spec_rejects(spec_corpus))]
    assert rejected == ["broken.json", "broken.yml"]


def test_spec_endpoints(spec_corpus, rows):
    found = rows(specs.spec_endpoints(spec_corpus), "endpoint_key", "operation_id",
                 "function_point_id", "full_endpoint_url", "error_count", "requires_auth")
    assert found == [
        ("Pay:PUT /pay", None, "12", "pay.example.com/pay", 0, "Y"),
        ("core:POST /x", "op", None, "https://a/x", 0, "Y"),
    ]


def test_spec_fields(spec_corpus, rows):
    found = rows(specs.spec_fields(spec_corpus).orderBy("ordinal"), "endpoint_key",
                 "field_name", "data_type", "required", "max_length", "format")
    assert sorted(found, key=repr) == sorted([
        ("core:POST /x", "b", "string", "N", 9, None),
        ("core:POST /x", "a", "integer", "Y", None, "int64"),
        ("Pay:PUT /pay", "?", None, "N", None, None),
        ("Pay:PUT /pay", "id", "integer", "Y", None, None),
        ("Pay:PUT /pay", "amount", "number", "N", None, None),
        ("Pay:PUT /pay", "note", "string", "N", None, None),
        ("Pay:PUT /pay", "q", "string", "N", None, None),
    ], key=repr)
    examples = dict(rows(specs.spec_fields(spec_corpus).where("example_value IS NOT NULL"),
                         "field_name", "example_value"))
    assert examples == {"a": "5", "b": "e" * 512}


def test_spec_errors(spec_corpus, rows):
    found = rows(specs.spec_errors(spec_corpus), "endpoint_key", "sequence_no", "http_status",
                 "error_code", "business_exception")
    assert found == [
        ("Pay:PUT /pay", 1, "404", "HTTP_404", "gone"),
        ("Pay:PUT /pay", 2, "503", "HTTP_503", None),
        ("core:POST /x", 1, "500", "HTTP_500", "down"),
        ("core:POST /x", 2, "400", "ERR-1", "First"),
        ("core:POST /x", 3, "400", "ERR-7", "Bad"),
    ]


def request(name, url, saves=None, method="GET"):
    item = {"name": name, "request": {"method": method, "url": url}}
    if saves:
        item["event"] = [{"script": {}}, {"script": {"exec": ["x;", f"v.set('{saves}', 1)"]}}]
    return item


@pytest.fixture
def collection_corpus(spark, tmp_path):
    return documents.read_collection_corpus(spark, write(tmp_path, {
        "a.postman_collection.json": {
            "info": {"name": "flow", "description": "d" * 3000},
            "item": [
                request("early", "/early/{{tok}}"),
                {"name": "outer", "item": [
                    {"name": "empty", "item": []},
                    {"name": "inner", "item": [
                        request("first", {"raw": "/first"}, "tok", "POST"),
                        {"deep": 1, "item": [request("", "/u/{{tok}}/{{none}}")]},
                    ]},
                    request("second", "/second", "tok", "POST"),
                ]},
                {"name": "note"},
                request("late", "/l/{{tok}}"),
                request("self", "/self/{{tok}}", "tok"),
                request("self", "/self/{{tok}}", "tok"),
                {"request": {}},
            ],
        },
        "sub/b.postman.json": {"item": []},
        "_catalog.postman.json": {"info": {"name": "helper"}},
        "c.json": {"info": {"name": "other"}},
        "broken.postman.json": "{",
    }))


def test_flows_and_steps(collection_corpus, rows):
    requests = collections.flow_requests(collection_corpus)
    flows = collections.flows(collection_corpus, requests)
    found = [(r.flow_key, r.step_count, len(r.description)) for r in flows.collect()]
    assert sorted(found) == [("b.postman", 0, 0), ("flow", 8, 2000)]
    steps = collections.flow_steps(collections.request_steps(requests))
    assert rows(steps, "step_order", "label", "endpoint_key", "variable_passed") == [
        (1, "early", "GET /early/{{tok}}", None),
        (2, "first", "POST /first", "tok"),
        (3, "Step 3", "GET /u/{{tok}}/{{none}}", None),
        (4, "second", "POST /second", "tok"),
        (5, "late", "GET /l/{{tok}}", None),
        (6, "self", "GET /self/{{tok}}", "tok"),
        (7, "self", "GET /self/{{tok}}", "tok"),
        (8, "Step 8", "GET None", None),
    ]
    assert len(rows(collections.collection_rejects(collection_corpus))) == 1


def test_files_of_the_shorter_convention_win(spark, tmp_path):
    from tidebook.operators.merging import dedupe_latest

    corpus = documents.read_collection_corpus(spark, write(tmp_path, {
        "z.postman_collection.json": {"info": {"name": "f", "description": "long"}},
        "a.postman.json": {"info": {"name": "f", "description": "short"}},
    }))
    flows = collections.flows(corpus, collections.flow_requests(corpus))
    latest = dedupe_latest(flows, ["flow_key"], [flows.ordinal.desc()])
    assert latest.first().description == "short"


def test_nested_flows_are_paged(spark, rows):
    from tidebook.operators.catalog_views import nested_flows

    steps = spark.createDataFrame(
        [("long", i, f"s{i}", f"e{i}", None) for i in range(7, 0, -1)] + [("one", 1, "s", "e", "v")],
        "flow_key string, step_order long, label string, endpoint_key string, "
        "variable_passed string",
    )
    flows = spark.createDataFrame([("long",), ("one",), ("none",)], "flow_key string")
    nested = nested_flows(flows, steps, page_size=3)
    found = {(r.flow_key, r.page): [s.step_order for s in r.steps] for r in nested.collect()}
    assert found == {("long", 0): [1, 2, 3], ("long", 1): [4, 5, 6], ("long", 2): [7],
                     ("one", 0): [1], ("none", 0): []}


def test_dependencies_take_the_latest_setter_and_no_other(collection_corpus, rows):
    steps = collections.request_steps(collections.flow_requests(collection_corpus))
    # The second "self" step finds itself as the latest setter: no edge, no fall-back.
    assert rows(collections.flow_dependencies(steps)) == [
        ("GET /l/{{tok}}", "POST /second", "uses"),
        ("GET /self/{{tok}}", "POST /second", "uses"),
        ("GET /u/{{tok}}/{{none}}", "POST /first", "uses"),
    ]


MANIFEST = {
    "nodes": {
        "model.p.a_gold": {
            "resource_type": "model", "name": "a_gold", "schema": "s", "path": "marts/a.sql",
            "description": "desc", "config": {"meta": {}}, "meta": {"owner": "me"},
            "columns": {"id": {"description": "key"}}, "compiled_code": "", "compiled_sql": "c",
            "raw_code": "r", "depends_on": {"nodes": ["source.p.x", "model.p.b", "gone"]},
        },
        "model.p.b": {"resource_type": "model", "depends_on": {}},
        "test.p.t": {"resource_type": "test", "depends_on": {"nodes": ["model.p.b"]}},
    },
    "sources": {"source.p.x": {"source_name": "raw"}},
}
CATALOG = {"nodes": {
    "model.p.a_gold": {"columns": {"z": {"type": "int"}, "id": {"type": "text"}}},
    "model.p.missing": {"columns": {"q": {"type": "int"}}},
}}


@pytest.fixture
def manifest_corpora(spark, tmp_path):
    return documents.read_manifest_corpus(spark, write(tmp_path, {
        "one/manifest.json": MANIFEST, "one/catalog.json": CATALOG,
        "two/manifest.json": {"nodes": {"model.p.b": {"resource_type": "model", "schema": "t",
                                                      "name": "b"}}},
    }))


def test_manifest_relations(manifest_corpora, rows):
    models, catalogs = manifest_corpora
    rules = ProjectRules(models=(("^a_", "alpha"),), default="rest")
    assert rows(manifests.datasets(models, rules), "schema_name", "object_name", "project_id",
                "layer", "owner") == [
        ("dbt", "b", "rest", None, None),
        ("s", "a_gold", "alpha", "gold", "me"),
        ("t", "b", "rest", None, None),
    ]
    assert rows(manifests.columns(models, catalogs), "column_name", "position_order",
                "data_type", "tech_desc") == [("id", 2, "text", "key"), ("z", 1, "int", None)]
    assert rows(manifests.transformations(models).where("dbt_model = 'a_gold'"), "target_key",
                "compiled_sql", "raw_sql") == [("dbt.s.a_gold", "c", "r")]
    assert rows(manifests.lineage(models, rules), "edge_id", "project_id") == [
        ("dbt.dbt.b->dbt.s.a_gold", "alpha"), ("dbt.raw.x->dbt.s.a_gold", "alpha"),
    ]


def test_interfaces(spark, rows):
    listed = spark.createDataFrame(
        [
            (1, "i1", "A", "pa", "B", "pb", ["h1", "h2"], "own"),
            (2, "i2", "B", "pb2", "A", "pa2", [], "own"),
            (3, "i3", "A", "x", "A", None, None, "own"),
            (4, "i4", "", "y", "C", "pc", ["h1"], "own"),
        ],
        "ordinal int, interface_id string, source_system string, source_party string, "
        "target_system string, target_party string, routing_hops array<string>, "
        "app_owner string",
    )
    rules = ProjectRules(systems=(("^h", "hop"),), default="none")
    assert rows(interfaces.system_traffic(listed, rules), "system_name", "party",
                "outbound_count", "inbound_count", "total_count") == [
        ("A", None, 2, 2, 4), ("B", "pb2", 1, 1, 2), ("C", "pc", 0, 1, 1),
    ]
    assert rows(interfaces.routing_hops(listed, rules).drop("ordinal")) == [
        ("i1", 0, "h1", "hop"), ("i1", 1, "h2", "hop"), ("i4", 0, "h1", "hop"),
    ]
    first = interfaces.interface_rows(listed).drop("ordinal").orderBy("interface_id").first()
    assert first.app_contact == "own" and first.notes is None and len(first) == 27


DUMP = {
    "dag": [["d1", False, "me"], ["d2", True, None]],
    "dag_tag": [["d1", "t"]],
    "task_instance": [
        ["d1", "a", "ok", "2025-01-01T00:00:00+00:00", None],
        ["d1", "b", None, None, None],
        ["d1", "c", "ok", "2025-01-02T00:00:00", "2025-01-02T01:00:00"],
        ["d1", "d", "ok", "2025-01-02T00:00:00", "junk"],
    ],
}


def test_scheduler_dump(spark, tmp_path, rows):
    root = write(tmp_path, {"dump.json": DUMP})
    for dsn in (f"file://{root}/dump.json", f"{root}/dump.json"):
        fetch = scheduler.open_source(spark, dsn)
        assert rows(fetch("dag")) == [("d1", False, "me"), ("d2", True, None)]
        assert rows(fetch("dag_tag")) == [("d1", "t")]
        newest = fetch("task_instance").collect()
        assert [r.task_id for r in newest] == ["c", "d", "a", "b"]
        assert newest[0].end_date == datetime(2025, 1, 2, 1) and newest[1].end_date is None
        assert [r.task_id for r in fetch("task_instance", 2).collect()] == ["c", "d"]
        assert fetch("task_instance", 0).count() == 4


def test_scheduler_database_options():
    options = scheduler.jdbc_options("postgresql://u:p%40@db:5433/air", "task_instance", 0)
    assert options["url"] == "jdbc:postgresql://db:5433/air"
    assert (options["user"], options["password"]) == ("u", "p@")
    assert options["query"].endswith("ORDER BY start_date DESC NULLS LAST LIMIT 500")
    assert "LIMIT" not in scheduler.jdbc_options("postgres://db/air", "dag")["query"]


def test_scheduler_database_in_parts(monkeypatch):
    """What the reader is asked for; no database is started."""
    asked = []

    class Reader:
        def __getattr__(self, name):
            def call(*args, **kwargs):
                asked.append((name, args, kwargs))
                return self
            return call

    class Session:
        read = Reader()

    fetch = scheduler.open_source(Session(), "postgresql://u:p@db:5433/air", parts=4)
    fetch("dag_tag")
    (name, args, kwargs), select = asked
    assert (name, args) == ("jdbc", ("jdbc:postgresql://db:5433/air", "dag_tag"))
    assert kwargs["predicates"] == [f"abs(hashtext(dag_id) % 4) = {i}" for i in range(4)]
    assert kwargs["properties"] == {
        "driver": "org.postgresql.Driver", "user": "u", "password": "p"}
    assert select[:2] == ("select", ("dag_id", "name"))
    asked.clear()
    fetch("task_instance", 10)
    assert [a[0] for a in asked] == ["format", "options", "load"]
    assert asked[1][2]["query"].endswith("LIMIT 10")


def test_collections_are_walked_without_parsing_again(spark, tmp_path, rows):
    """Deep folders next to flat files, in one stage without any shuffle."""
    deep = request("bottom", "/deep")
    for level in range(12):
        deep = {"name": f"f{level}", "item": [request(f"r{level}", f"/{level}"), deep]}
    corpus = documents.read_collection_corpus(spark, write(tmp_path, {
        "deep.postman_collection.json": {"info": {"name": "deep"}, "item": [deep]},
        "flat.postman_collection.json": {"info": {"name": "flat"}, "item": [
            request("a [b", "/x]"), {"name": 7, "request": {"url": {"raw": "/y"}}},
            {"request": None}, None, "text", {"item": {}}]},
    }))
    requests = collections.flow_requests(corpus)
    plan = requests._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("parseJson(") == 1
    steps = collections.flow_steps(collections.request_steps(requests))
    found = rows(steps, "flow_key", "step_order", "label", "endpoint_key")
    found.sort(key=lambda f: f[:2])
    assert [f for f in found if f[0] == "flat"] == [
        ("flat", 1, "a [b", "GET /x]"), ("flat", 2, "7", "GET /y")]
    assert [f[2] for f in found if f[0] == "deep"] == [
        *[f"r{i}" for i in range(11, -1, -1)], "bottom"]


def test_bundles_name_known_relations(spec_corpus, collection_corpus, manifest_corpora):
    from tidebook.schemas import CATALOG_KEYS

    bundle = catalog.api_bundle(spec_corpus, collection_corpus) | catalog.manifest_bundle(
        *manifest_corpora
    )
    for name, df in bundle.items():
        assert set(CATALOG_KEYS[name]) <= set(df.columns)


def test_dependencies_across_chunks_and_repeated_paths(spark, monkeypatch, rows):
    """A use finds its setter chunks before, also one in another document of the same path."""
    def asked(url, saves=None):
        script = [{"script": {"exec": f"x.set('{saves}', 1)"}}] if saves else 5
        return {"request": {"url": url}, "event": script}

    def document(*items):
        return json.dumps({"info": {"name": "f"}, "item": list(items)})

    corpus = spark.createDataFrame([
        ("p", document(asked("set", "a"), *[asked("x")] * 8, asked("{{a}}{{b}}"))),
        ("p", document(asked("y"), asked("z", "b"))),
        ("q", document(asked("{{a}}"), {"request": 5}, {"request": None})),
    ], "path string, content string")
    monkeypatch.setattr(collections, "STEP_CHUNK", 2)
    steps = collections.request_steps(collections.flow_requests(corpus))
    assert rows(collections.flow_dependencies(steps)) == [
        ("GET {{a}}{{b}}", "GET set", "uses"), ("GET {{a}}{{b}}", "GET z", "uses")]
    unresolved = collections.resolve_uses(steps).where("to_endpoint is null")
    assert rows(unresolved, "path", "step_order", "variable") == [("q", 1, "a")]
    assert steps.where("path = 'q'").count() == 2


@pytest.mark.parametrize("numbered", [True, False])
def test_steps_without_a_place_or_flow(spark, rows, numbered):
    """Setters of no chunk come before all chunks; a step without a number has no part at all."""
    from pyspark.sql import functions as F

    steps = spark.createDataFrame([
        ("f", None, "url", "GET url", "a"), ("f", 3, "{{a}}", "GET {{a}}", None),
        ("f", None, "{{a}}", "GET lost", None), (None, 1, "url", "GET other", "a"),
        (None, 2, "{{a}}", "GET none", None),
    ], "path string, step_order int, address string, endpoint_key string, saved_variable string")
    if numbered:
        found = collections.resolve_uses(steps)
        assert rows(found, "from_endpoint", "to_endpoint") == [("GET {{a}}", None)]
        return
    placed = steps.withColumn("at", F.struct("step_order", "endpoint_key"))
    found = collections.resolve_uses(placed, order="at", chunk=F.col("at.step_order"))
    assert rows(found, "from_endpoint", "to_endpoint") == [("GET {{a}}", "GET url")]
