"""Request collections to flows, ordered steps and endpoint dependencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as x
from ..functions.projects import ProjectRules
from ..functions.values import cut, first_filled, once
from ..operators.sequences import latest_before

NAME_LENGTH, ENDPOINT_LENGTH, DESCRIPTION_LENGTH = 256, 520, 2000
#: Steps of one flow that are looked at together when setters are searched.
STEP_CHUNK = 1024
MALFORMED = "_malformed"
#: A request given as text instead of an object, at any depth. Quotes inside JSON text are
#: escaped, so nothing but a key reads like this.
TEXT_REQUEST = r'"request"\s*:\s*"'


def _parsed(corpus: DataFrame) -> DataFrame:
    doc = F.from_json(
        "content", f"{schemas.COLLECTION_DOC}, {MALFORMED} string",
        {"columnNameOfCorruptRecord": MALFORMED},
    )
    return once(corpus.select("path", "content"), doc, "doc").withColumn(
        "bad",
        F.col("content").isNull() | F.col(f"doc.{MALFORMED}").isNotNull()
        | F.col("content").rlike(TEXT_REQUEST),
    )


def collection_rejects(corpus: DataFrame) -> DataFrame:
    """Collections that cannot be read, or hold a request that is no object.

    They add no rows to any relation.
    """
    return _parsed(corpus).where("bad").select("path")


def _documents(corpus: DataFrame) -> DataFrame:
    info = F.col("doc.info")
    return _parsed(corpus).where(~F.col("bad")).select(
        "path",
        cut(F.coalesce(info.getField("name"), x.file_stem(F.col("path"))), NAME_LENGTH)
        .alias("flow_key"),
        cut(F.coalesce(info.description, F.lit("")), DESCRIPTION_LENGTH).alias("description"),
        F.col("doc.item").alias("items"),
    )


#: What is left of JSON text without its strings and all but the brackets of its arrays.
NO_BRACKET = r'"(?:[^"\\]++|\\.)*+"|[^\[\]]++'


#: Documents with at most so many lists of entries are not looked into for how these are nested.
FEW_LISTS = 4


def _nesting(documents: DataFrame) -> int:
    """How deep lists of entries may be nested in any document.

    As deep as there are lists, or, where there are many, as deep as arrays of any kind are nested.
    """
    brackets = F.split(F.regexp_replace("content", NO_BRACKET, ""), "")
    depth = F.aggregate(
        F.filter(brackets, lambda c: c != ""),
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda d, c: F.struct(
            F.when(c == "[", d.now + 1).otherwise(d.now - 1).alias("now"),
            F.greatest(d.most, F.when(c == "[", d.now + 1).otherwise(d.now)).alias("most")),
        lambda d: d.most)
    lists = F.regexp_count("content", F.lit(r'"item"\s*:'))
    counted = once(documents.select("content"), lists, "lists")
    return counted.agg(F.max(F.when(F.col("lists") <= FEW_LISTS, F.col("lists")).otherwise(
        F.least(F.col("lists"), depth)))).first()[0] or 0


def _inside(node: Column) -> Column:
    """What a folder holds; NULL for anything else."""
    return F.try_variant_get(node, "$.item", "array<variant>")


#: What is taken out of an entry in one go; parts of another kind than these become NULL.
ENTRY = """struct<name:string, request:struct<method:string, url:variant>,
    event:array<struct<script:struct<exec:variant>>>>"""


def _request(entry: Column) -> Column:
    """The parts of a request that are used: its name, method, address and script texts.

    The JSON form of a URL has the address under ``raw``. A script is a list of lines, or one text.
    """
    def part(of: Column, kind: str = "string", path: str = "$") -> Column:
        return F.try_variant_get(of, path, kind)

    url = entry.request.url
    # An address may itself begin with a template variable; only an object has no other text.
    nothing = part(url).startswith("{") & part(url, "map<string,variant>").isNotNull()
    address = F.coalesce(part(url, path="$.raw"), F.when(~nothing, part(url)))

    def script(event: Column) -> Column:
        code = event.script.exec
        return F.coalesce(F.array_join(part(code, "array<string>"), ""), part(code))

    return F.struct(
        entry.getField("name").alias("name"), entry.request.method.alias("method"),
        address.alias("address"), F.transform(entry.event, script).alias("scripts"))


def flow_requests(corpus: DataFrame) -> DataFrame:
    """Requests of the readable collections, numbered depth first across nested folders.

    Every entry of a collection is parsed once, into a variant. A round replaces the folders of a
    document by what they hold, in their place, so requests end up in order and are numbered where
    the document is: nothing is parsed again, written, sorted or shuffled. There are as many rounds
    as lists of entries are nested in any document, which one pass over the text tells first.
    """
    nodes = once(_documents(corpus).select("path", "flow_key", "items"),
                 F.transform("items", lambda text: F.try_parse_json(text)), "nodes").drop("items")
    for _ in range(_nesting(corpus.where("content is not null")) - 1):
        opened = F.flatten(F.transform(
            "nodes", lambda node: F.coalesce(_inside(node), F.array(node))))
        nodes = once(nodes, opened, "opened").select("path", "flow_key", F.col("opened").alias("nodes"))

    def is_request(seen: Column) -> Column:
        asked = F.try_variant_get(seen.node, "$.request", "variant")
        given = seen.entry.request.isNotNull() | (asked.isNotNull() & ~F.is_variant_null(asked))
        return given & _inside(seen.node).isNull()

    seen = F.transform("nodes", lambda node: F.struct(
        node.alias("node"), F.try_variant_get(node, "$", ENTRY).alias("entry")))
    entries = F.transform(F.filter(seen, is_request), lambda seen: seen.entry)
    numbered = nodes.select("path", "flow_key", F.posexplode(entries).alias("position", "entry"))
    return numbered.select(
        "path", "flow_key", (F.col("position") + 1).cast("bigint").alias("step_order"),
        _request(F.col("entry")).alias("item"))


def _walk_order() -> Column:
    """Files of the shorter naming convention come after all others, then by path."""
    path = F.col("path")
    return F.struct(path.endswith(".postman.json"), x.path_parts(path)).alias("ordinal")


def flows(
    corpus: DataFrame, requests: DataFrame, rules: ProjectRules = ProjectRules()
) -> DataFrame:
    """One row per readable collection, also those without requests."""
    counts = requests.groupBy("path").agg(F.count(F.lit(1)).alias("step_count"))
    counted = _documents(corpus).drop("items").join(counts.hint("merge"), "path", "left")
    return counted.select(
        "flow_key",
        F.col("flow_key").alias("flow_name"),
        rules.for_path(F.col("path")).alias("project_id"),
        "description",
        F.coalesce("step_count", F.lit(0)).alias("step_count"),
        _walk_order(),
    )


def request_steps(requests: DataFrame) -> DataFrame:
    """One row per request with everything later stages need, not yet cut to catalog widths."""
    saved = F.filter(F.transform("item.scripts", x.saved_variable), lambda name: name.isNotNull())
    address = F.col("item.address")
    method = F.coalesce("item.method", F.lit("GET"))
    return requests.select(
        "path", "flow_key", "step_order",
        F.col("item.name").alias("name"),
        address.alias("address"),
        # A request without an address is labelled with the word the catalog always used.
        cut(F.concat(method, F.lit(" "), F.coalesce(address, F.lit("None"))), ENDPOINT_LENGTH)
        .alias("endpoint_key"),
        F.get(saved, F.lit(0)).alias("saved_variable"),
    )


def flow_steps(steps: DataFrame) -> DataFrame:
    """The catalog's view of ``request_steps``."""
    numbered = F.concat(F.lit("Step "), F.col("step_order").cast("string"))
    return steps.select(
        "flow_key", "step_order",
        cut(first_filled(F.col("name"), numbered), NAME_LENGTH).alias("label"),
        "endpoint_key",
        cut(F.col("saved_variable"), NAME_LENGTH).alias("variable_passed"),
        _walk_order(),
    )


def resolve_uses(
    steps: DataFrame, flow: str = "path", order: str = "step_order", chunk: Column | None = None
) -> DataFrame:
    """Every ``{{variable}}`` use with the endpoint that last set the variable before it.

    ``chunk`` cuts long flows (see ``latest_before``); the default suits numbered steps.
    """
    numbered = chunk is None
    if numbered:
        # Steps without a number neither use nor set.
        chunk = F.when(F.col(order).isNotNull(),
                       F.floor(F.greatest(F.col(order), F.lit(0)) / STEP_CHUNK))
    # Steps are made once and dealt out once, for the lookup inside the chunks and for the chunks'
    # summaries. Both take all their columns, and no filter of one can go below the shuffle:
    # otherwise each would have rows of its own, and every document be read for each.
    uses = F.coalesce(x.template_variables(F.col("address")), F.array().cast("array<string>"))
    told = once(steps.select(flow, order, chunk.alias("_part"), "address", "endpoint_key",
                             "saved_variable"),
                F.concat(F.array("saved_variable"), uses), "names")
    named = ((F.size("names") > 1) | F.col("names")[0].isNotNull()) & F.col(flow).isNotNull()
    placed = told.where(named & F.col("_part").isNotNull() if numbered else named).select(
        flow, order, "_part", "endpoint_key", "names").repartition(flow, "_part")
    events = placed.select(flow, order, "_part", "endpoint_key",
                           F.posexplode("names").alias("_at", "variable")).where(
        F.col("variable").isNotNull())
    # The place in the list is never negative, which only says that the condition needs it.
    opening = F.greatest("_part", F.least("_at", F.lit(0))) == 0 if numbered else F.lit(False)
    sets = F.col("_at") == 0
    rows = events.select(
        flow, "variable", order, "_part", opening.alias("_opening"),
        F.when(~sets, F.col("endpoint_key")).alias("from_endpoint"),
        F.when(sets, F.col("endpoint_key")).alias("to_endpoint"))
    found = latest_before(
        rows, [flow, "variable"], order, "to_endpoint", F.col("_part"),
        "_opening" if numbered else None)
    return found.select(flow, order, "variable", "from_endpoint", "to_endpoint")


def flow_dependencies(
    steps: DataFrame, flow: str = "path", order: str = "step_order", chunk: Column | None = None
) -> DataFrame:
    """Distinct edges from a step to the endpoint whose variable it uses.

    The latest setter is chosen first; when that is the step's own endpoint there is no edge,
    also if an older setter exists.
    """
    resolved = resolve_uses(steps, flow, order, chunk)
    return (
        resolved.where(F.col("to_endpoint") != F.col("from_endpoint"))
        .select("from_endpoint", "to_endpoint")
        .distinct()
        .withColumn("dep_type", F.lit("uses"))
    )
