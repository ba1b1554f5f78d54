"""API specifications to sources, endpoints, fields and errors.

All lists are built inside the document's row and exploded in place: numbering follows the
document's own order, and no step shuffles. Only the catalog upsert that follows does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as x
from ..functions.projects import ProjectRules
from ..functions.values import cut, first_filled, once, truthy, yes_no

MALFORMED = "_malformed"
REQUEST_EXAMPLE_LENGTH = 512


def _parsed(corpus: DataFrame, rules: ProjectRules) -> DataFrame:
    doc = F.from_json(
        "content", f"{schemas.SPEC_DOC}, {MALFORMED} string",
        {"columnNameOfCorruptRecord": MALFORMED},
    )
    path = F.col("path")
    return once(corpus.select("path", "content"), doc, "doc").select(
        "path",
        "doc",
        F.col("content").isNull().alias("unreadable"),
        F.replace(x.file_stem(path), F.lit("swagger-spec-"), F.lit("")).alias("source_id"),
        x.parent_folder(path).alias("feature_group"),
        rules.for_path(path).alias("project_id"),
    )


def spec_rejects(corpus: DataFrame) -> DataFrame:
    """Documents that cannot be read; they add no rows to any relation."""
    doc = _parsed(corpus, ProjectRules())
    return doc.where(F.col("unreadable") | F.col(f"doc.{MALFORMED}").isNotNull()).select("path")


def _specs(corpus: DataFrame, rules: ProjectRules) -> DataFrame:
    good = _parsed(corpus, rules).where(
        ~F.col("unreadable") & F.col(f"doc.{MALFORMED}").isNull()
    )
    has_servers = F.size("doc.servers") > 0
    return good.withColumns({
        "version": F.coalesce("doc.info.version", F.lit("")),
        "server_url": F.when(has_servers, F.get("doc.servers", F.lit(0)).url).otherwise(
            F.coalesce("doc.host", F.lit(""))
        ),
    })


def spec_sources(corpus: DataFrame, rules: ProjectRules = ProjectRules()) -> DataFrame:
    """One row per specification."""
    operations = F.flatten(
        F.transform(F.map_values("doc.paths"), lambda item: F.coalesce(
            F.filter(F.map_keys(item), x.is_http_method), F.array().cast("array<string>")
        ))
    )
    return _specs(corpus, rules).select(
        "source_id",
        F.coalesce("doc.info.title", "source_id").alias("display_name"),
        "project_id",
        "feature_group",
        yes_no(F.startswith(F.col("doc.openapi"), F.lit("3")), "OpenAPI", "Swagger2")
        .alias("kind"),
        F.col("version").alias("release_version"),
        F.col("path").alias("spec_path"),
        F.coalesce(F.when(F.col("doc.paths").isNotNull(), F.size(operations)), F.lit(0))
        .alias("endpoint_count"),
        _ordinal(),
    )


def _ordinal(*position: str) -> Column:
    """Place in the file walk and inside the document: later rows win an upsert."""
    return F.struct(x.path_parts(F.col("path")), *position).alias("ordinal")


def _operations(specs: DataFrame, *kept: str) -> DataFrame:
    """One row per path and method, the operation parsed only for known methods."""
    paths = specs.select(
        "*", F.posexplode(F.map_entries("doc.paths")).alias("path_position", "path_item")
    )
    methods = paths.select(
        "*",
        F.posexplode(F.map_entries("path_item.value")).alias("method_position", "method_item"),
    ).where(x.is_http_method(F.col("method_item.key")))
    method = F.upper("method_item.key")
    address = F.col("path_item.key")
    return methods.select(
        "path", "source_id", "project_id", "feature_group", "version", "server_url", *kept,
        F.col("doc.info.description").alias("spec_description"),
        method.alias("method"),
        address.alias("address"),
        F.concat("source_id", F.lit(":"), method, F.lit(" "), address).alias("endpoint_key"),
        F.struct("path_position", "method_position").alias("position"),
        F.from_json("method_item.value", schemas.SPEC_OPERATION).alias("op"),
    )


def spec_endpoints(corpus: DataFrame, rules: ProjectRules = ProjectRules()) -> DataFrame:
    """One row per path and method."""
    return _operations(_specs(corpus, rules)).select(
        "endpoint_key",
        "source_id",
        "method",
        F.col("address").alias("path"),
        F.col("op.operationId").alias("operation_id"),
        F.col("op.summary").alias("summary"),
        F.coalesce("op.description", F.lit("")).alias("description"),
        x.function_point_id(F.col("spec_description")).alias("function_point_id"),
        F.concat(F.coalesce("server_url", F.lit("")), "address").alias("full_endpoint_url"),
        F.col("version").alias("sei_version"),
        "server_url",
        F.lit(0).alias("error_count"),
        F.lit("Y").alias("requires_auth"),
        "project_id",
        "feature_group",
        _ordinal("position"),
    )


_FIELD = (
    "struct<field_name:string,data_type:string,required:string,max_length:string,"
    "format:string,example_value:string,description:string,absent:array<string>>"
)
#: Columns a parameter does not have: merging it leaves a body field's values alone.
BODY_ONLY = ("max_length", "format", "example_value")


def _field(name: Column, data_type: Column, required: Column, description: Column, **more):
    nothing = F.lit(None).cast("string")
    return F.struct(
        name.alias("field_name"), data_type.alias("data_type"), required.alias("required"),
        more.get("max_length", nothing).alias("max_length"),
        more.get("format", nothing).alias("format"),
        more.get("example_value", nothing).alias("example_value"),
        description.alias("description"),
        F.array(*[F.lit(c) for c in BODY_ONLY if not more]).cast("array<string>").alias("absent"),
    )


def _none_if_null(array: Column, of: str = _FIELD) -> Column:
    return F.coalesce(array, F.array().cast(f"array<{of}>"))


def _body_fields() -> Column:
    """Properties of every media type of the request body."""
    def of_schema(schema: Column) -> Column:
        return F.transform(
            F.map_entries(schema.properties),
            lambda p: _field(
                p.key,
                p.value.type,
                yes_no(F.array_contains(schema.required, p.key)),
                p.value.description,
                max_length=p.value.maxLength,
                format=p.value.format,
                example_value=cut(p.value.example, REQUEST_EXAMPLE_LENGTH),
            ),
        )

    media = F.map_values("op.requestBody.content")
    return F.flatten(F.transform(media, lambda m: _none_if_null(of_schema(m.schema))))


def _parameter_fields() -> Column:
    """Parameters; one whose schema has properties stands for those properties."""
    def of_parameter(p: Column) -> Column:
        properties = F.transform(
            F.map_entries(p.schema.properties),
            lambda e: _field(e.key, e.value.type, F.lit("N"), e.value.description),
        )
        plain = _field(
            F.coalesce(p.getField("name"), F.lit("?")),
            F.coalesce(first_filled(p.type), p.schema.type),
            yes_no(truthy(p.required)),
            p.description,
        )
        return F.when(F.size(p.schema.properties) > 0, properties).otherwise(F.array(plain))

    return F.flatten(F.transform("op.parameters", of_parameter))


def spec_fields(corpus: DataFrame, rules: ProjectRules = ProjectRules()) -> DataFrame:
    """Request body fields, then parameters, in document order.

    ``absent`` names the columns a row does not have, as opposed to those it has as NULL.
    """
    fields = F.concat(_none_if_null(_body_fields()), _none_if_null(_parameter_fields()))
    return (
        _operations(_specs(corpus, rules))
        .select("path", "position", "endpoint_key", F.posexplode(fields).alias("field_position",
                                                                              "field"))
        .select(
            "endpoint_key", "field.*", _ordinal("position", "field_position"),
        )
        .withColumn("max_length", F.col("max_length").try_cast("bigint"))
    )


_ERROR = (
    "struct<http_status:string,error_code:string,business_exception:string,"
    "error_details:string>"
)


def _table_errors(text: Column) -> Column:
    """Rows of the error tables in a description, reported as bad requests."""
    return F.transform(x.markdown_errors(F.coalesce(text, F.lit(""))), lambda e: F.struct(
        F.lit("400").alias("http_status"), e.error_code.alias("error_code"),
        e.business_exception.alias("business_exception"),
        e.error_details.alias("error_details"),
    ))


def spec_errors(corpus: DataFrame, rules: ProjectRules = ProjectRules()) -> DataFrame:
    """Error responses, then rows of error tables in the descriptions, numbered per endpoint."""
    responses = F.transform(
        F.filter(F.map_entries("op.responses"), lambda e: x.is_error_status(e.key)),
        lambda e: F.struct(
            e.key.alias("http_status"),
            F.concat(F.lit("HTTP_"), e.key).alias("error_code"),
            e.value.description.alias("business_exception"),
            e.value.description.alias("error_details"),
        ),
    )
    # The specification's own table belongs to every endpoint; it is read once per document.
    specs = once(
        _specs(corpus, rules), _table_errors(F.col("doc.info.description")), "shared_errors"
    )
    operations = once(
        _operations(specs, "shared_errors"), _table_errors(F.col("op.description")), "own_errors"
    )
    errors = F.concat(_none_if_null(responses, _ERROR), "own_errors", "shared_errors")
    return (
        operations
        .select("path", "position", "endpoint_key", F.posexplode(errors).alias("at", "error"))
        .select(
            "endpoint_key", "error.http_status", "error.error_code",
            (F.col("at") + 1).alias("sequence_no"),
            "error.business_exception", "error.error_details", _ordinal("position", "at"),
        )
    )
