"""Documents written from the test tables: one document per row, so a corpus grows with its
table and no document gathers a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def spec_documents(t) -> DataFrame:
    """An API specification per text document, the whole text in its description.

    English documents are in the newer format with servers, the others in the older one with a
    host. Every document has a read and a write operation, and an error table with a row per
    line of the text.
    """
    newer = F.col("lang") == "en"
    lines = F.split("text", "\n")
    table = F.transform(lines, lambda line, i: F.concat(
        F.lit("| "), (i + 1).cast("string"), F.lit(" | Line "), (i + 1).cast("string"),
        F.lit(" | ERR-"), F.length(line).cast("string"), F.lit(" | "), F.col("lang"),
        F.lit(" |"),
    ))
    description = F.concat_ws(
        "\n",
        F.concat(F.lit("Function point Id is "), _text("doc_id"), F.lit(".")),
        F.col("text"),
        F.lit("| # | Exception | Error Code | Detail |"),
        F.lit("| 0 | Exception | Error Code | Detail |"),
        F.array_join(table, "\n"),
    )

    def prop(kind: str, **more: Column) -> Column:
        nothing = F.lit(None).cast("string")
        return F.struct(
            F.lit(kind).alias("type"), more.get("maxLength", nothing).alias("maxLength"),
            more.get("example", nothing).alias("example"),
            more.get("description", nothing).alias("description"),
        )

    body = F.struct(F.create_map(
        F.lit("application/json"),
        F.struct(F.struct(
            F.create_map(
                F.lit("source"), prop("string", maxLength=F.lit("40"), example=F.col("source")),
                F.lit("length"), prop("integer", description=F.lit("characters")),
            ).alias("properties"),
            F.array(F.lit("source")).alias("required"),
        ).alias("schema")),
    ).alias("content"))
    no_schema = F.lit(None).cast(
        "struct<type:string,properties:map<string,struct<type:string,maxLength:string,"
        "example:string,description:string>>>"
    )

    def parameter(name: Column, kind: Column, required: Column, schema: Column) -> Column:
        return F.struct(
            name.alias("name"), kind.alias("type"), required.alias("required"),
            schema.alias("schema"),
        )

    nested = F.struct(
        F.lit("object").alias("type"),
        F.create_map(F.lit("page"), prop("integer"), F.lit("size"), prop("integer"))
        .alias("properties"),
    )
    parameters = F.array(
        parameter(F.lit("id"), F.lit("integer"), F.lit(True), no_schema),
        parameter(F.lit(None).cast("string"), F.lit(None).cast("string"),
                  F.lit(None).cast("boolean"), no_schema),
        parameter(F.lit("body"), F.lit(None).cast("string"), F.lit(False), nested),
    )
    empty_parameters = F.lit(None).cast(
        "array<struct<name:string,type:string,required:boolean,schema:struct<type:string,"
        "properties:map<string,struct<type:string,maxLength:string,example:string,"
        "description:string>>>>>"
    )

    def operation(name: str, request: Column, params: Column, failure: str) -> Column:
        return F.struct(
            F.concat(F.lit(name), _text("doc_id")).alias("operationId"),
            F.col("source").alias("summary"),
            F.when(newer, F.lit("Handles one document.")).alias("description"),
            request.alias("requestBody"),
            params.alias("parameters"),
            F.create_map(
                F.lit("200"), F.struct(F.lit("fine").alias("description")),
                F.lit(failure), F.struct(F.concat(F.lit("no "), F.col("source"))
                                         .alias("description")),
                F.lit("default"), F.struct(F.lit("else").alias("description")),
            ).alias("responses"),
        )

    no_body = F.when(F.lit(False), body)
    paths = F.create_map(
        F.concat(F.lit("/docs/"), _text("doc_id")),
        F.create_map(
            F.lit("get"), operation("read", no_body, parameters, "404"),
            F.lit("POST"), operation("write", body, empty_parameters, "500"),
            F.lit("x-note"), operation("note", no_body, empty_parameters, "400"),
        ),
        F.lit("/empty"), F.create_map().cast(
            "map<string,struct<operationId:string,summary:string,description:string,"
            "requestBody:struct<content:map<string,struct<schema:struct<properties:map<string,"
            "struct<type:string,maxLength:string,example:string,description:string>>,"
            "required:array<string>>>>>,parameters:array<struct<name:string,type:string,"
            "required:boolean,schema:struct<type:string,properties:map<string,struct<"
            "type:string,maxLength:string,example:string,description:string>>>>>,"
            "responses:map<string,struct<description:string>>>>"
        ),
    )
    spec = F.struct(
        F.when(newer, F.lit("3.0.1")).alias("openapi"),
        F.when(~newer, F.concat(F.col("lang"), F.lit(".example.com"))).alias("host"),
        F.struct(
            F.col("source").alias("title"), _text("n_chars").alias("version"),
            description.alias("description"),
        ).alias("info"),
        F.when(newer, F.array(F.struct(F.lit("https://en.example.com").alias("url"))))
        .alias("servers"),
        paths.alias("paths"),
    )
    path = F.concat(
        F.lit("/API-SPEC/"), F.col("source"), F.lit("/swagger-spec-"), _text("doc_id"),
        F.lit(".json"),
    )
    return t.documents.select(path.alias("path"), F.to_json(spec).alias("content"))


def collection_documents(t) -> DataFrame:
    """A request collection per order: log in, read it in a folder, change it one level deeper.

    Then addresses that begin with a variable, one of which saves a value that the next uses, and
    a request made twice that uses what its own endpoint saved.
    """
    content = F.format_string(
        """{"info": {"name": "order-%d", "description": "%s"}, "item": [
        {"name": "login", "request": {"method": "POST",
         "url": {"raw": "https://api/login/%d"}},
         "event": [{"script": {"exec": ["let x;"]}},
                   {"script": {"exec": ["pm.variables", ".set('token', 1)"]}}]},
        {"name": "folder", "item": [
          {"name": "read", "request": {"method": "GET",
           "url": "https://api/orders/%d?t={{token}}"},
           "event": [{"script": {"exec": ["c.set(\\"order\\", 2)"]}}]},
          {"name": "inner", "item": [
            {"name": "", "request": {"url": {"raw": "https://api/{{order}}/{{token}}/{{none}}"}}}
          ]}]},
        {"name": "a note"},
        {"name": "open", "request": {"method": "GET", "url": "{{base}}/session/%d"},
         "event": [{"script": {"exec": ["c.set('sid', 3)"]}}]},
        {"name": "use", "request": {"method": "PUT", "url": "{{base}}/use/{{sid}}"}},
        {"name": "self", "request": {"url": "https://api/self/{{loop}}"},
         "event": [{"script": {"exec": ["c.set('loop', 4)"]}}]},
        {"name": "again", "request": {"url": "https://api/self/{{loop}}"}}]}""",
        "o_orderkey", "o_orderpriority", "o_custkey", "o_orderkey", "o_custkey",
    )
    path = F.format_string("/POSTMAN/%012d.postman.json", "o_orderkey")
    # The orders are one row group, but a corpus of files comes to all tasks.
    orders = t.orders.select("o_orderkey", "o_orderpriority", "o_custkey").repartition("o_orderkey")
    return orders.select(path.alias("path"), content.alias("content"))


LAYER_FOLDERS = ("bronze", "staging", "marts", "misc", "slv")


def manifest_documents(t) -> tuple[DataFrame, DataFrame]:
    """A manifest and a catalog per part: a source, two models, a test, and one missing input."""
    folder = F.element_at(
        F.array(*map(F.lit, LAYER_FOLDERS)), (F.col("p_size") % 5 + 1).cast("int")
    )
    key = F.concat(F.lit("part-"), _text("p_partkey"))
    manifest = F.format_string(
        """{"nodes": {
        "model.p.base_%1$d": {"resource_type": "model", "name": "base_%1$d",
          "schema": "%2$s", "path": "%3$s/base.sql", "description": "%4$s",
          "config": {"meta": {"owner": "%5$s", "project": "direct"}}, "meta": {"owner": "no"},
          "columns": {"id": {"description": "key of %1$d"}, "name": {}},
          "compiled_code": "select %1$d", "raw_sql": "select 1",
          "depends_on": {"nodes": ["source.p.parts", "model.p.gone"]}},
        "model.p.top_%1$d": {"resource_type": "model", "name": "top_%1$d", "schema": "",
          "path": "x/top.sql", "config": {"meta": {}}, "meta": {"owner": "%4$s"},
          "compiled_code": "", "compiled_sql": "select 2", "raw_code": "raw",
          "depends_on": {"nodes": ["model.p.base_%1$d", "source.p.parts"]}},
        "test.p.t": {"resource_type": "test", "name": "t",
          "depends_on": {"nodes": ["model.p.base_%1$d"]}}},
        "sources": {"source.p.parts": {"source_name": "raw_%2$s"}}}""",
        "p_partkey", "p_brand", folder, "p_name", "p_type",
    )
    catalog = F.format_string(
        """{"nodes": {"model.p.base_%1$d": {"columns": {"name": {"type": "text"},
        "id": {"type": "bigint"}}}, "model.p.other": {"columns": {"z": {"type": "int"}}}}}""",
        "p_partkey",
    )
    return (
        t.part.select(key.alias("doc_id"), manifest.alias("content")),
        t.part.select(key.alias("doc_id"), catalog.alias("content")),
    )


def scheduler_dumps(t) -> DataFrame:
    """A scheduler dump per order: one workflow, two tags, two task instances."""
    content = F.format_string(
        """{"dag": [["dag_%1$d", %2$s, "%3$s"]],
        "dag_tag": [["dag_%1$d", "%3$s"], ["dag_%1$d", "all"]],
        "task_instance": [
          ["dag_%1$d", "load", "success", "%4$sT01:02:03", "%4$sT01:30:00"],
          ["dag_%1$d", "wait", null, null, ""]]}""",
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "true").otherwise("false"),
        "o_orderpriority",
        F.date_format("o_orderdate", "yyyy-MM-dd"),
    )
    path = F.format_string("/dumps/%012d.json", "o_orderkey")
    return t.orders.select(path.alias("path"), content.alias("content"))
