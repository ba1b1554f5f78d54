from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidebook.functions import text as x
from tidebook.functions import values as v
from tidebook.functions.projects import ProjectRules


@pytest.fixture
def value(spark):
    """Evaluate one expression over one row of literals."""

    def evaluate(expression, **columns):
        df = spark.range(1).withColumns({k: F.lit(c) for k, c in columns.items()})
        return df.select(expression.alias("r")).first()[0]

    return evaluate


@pytest.mark.parametrize("given, expected", [
    ("True", 1), ("1", 1), ("y", 1), ("no", 0), ("", 0), (None, 0),
])
def test_flag_from_text(value, given, expected):
    assert value(v.flag_from_text(F.col("c").cast("string")), c=given) == expected


@pytest.mark.parametrize("maturity, expected", [
    (None, 0), ("2020-01-01", 1), ("2025-04-01", 0), ("2025-03-31", 1),
])
def test_matures_within_is_strict_and_has_no_lower_bound(value, maturity, expected):
    as_of = F.lit("2025-01-01").cast("date")
    assert value(v.matures_within(F.col("m").cast("date"), as_of, 90), m=maturity) == expected


@pytest.mark.parametrize("part, whole, expected", [
    ("1", "3", "33.33"), ("1", "0", None), ("1", "-2", None), ("1", None, None),
    ("0.005", "10", "0.10"), ("-1", "3", "-33.33"), ("2", "3", "66.67"),
])
def test_percent_of(value, part, whole, expected):
    money = [F.lit(c).cast("decimal(30,2)") for c in (part, whole)]
    found = value(v.percent_of(*money, 2))
    assert found == (None if expected is None else Decimal(expected))


def test_percent_is_rounded_once(value):
    # 0.000044999…: two roundings would end at 0.0001.
    ratio = v.percent_of(F.lit("44.99").cast("decimal(30,2)"),
                         F.lit("100000000").cast("decimal(30,2)"), 4)
    assert value(ratio) == Decimal("0.0000")


def test_rounding_modes(value):
    assert value(v.half_even(F.lit(2.5), 0)) == 2
    assert value(v.to_base_currency(F.lit("0.05").cast("decimal(20,2)"),
                                    F.lit("0.5").cast("decimal(10,6)"))) == Decimal("0.03")


def test_text_to_types(value):
    assert value(v.typed(F.lit("abcdef"), "varchar(3)")) == "abc"


def test_padded_id_keeps_wide_numbers(value):
    assert value(v.padded_id("A", F.lit(7), 3)) == "A007"
    assert value(v.padded_id("A", F.lit(12345), 3)) == "A12345"


def test_fallback_chains(value):
    assert value(v.first_filled(F.lit(""), F.lit("b"), F.lit("c"))) == "b"
    empty = F.create_map().cast("map<string,string>")
    assert value(v.first_filled_map(empty, F.create_map(F.lit("k"), F.lit("v")))) == {"k": "v"}


@pytest.mark.parametrize("text, expected", [
    ("The Function Point Id is 491.", "491"), ("functionpointidis7", "7"), ("none", None),
])
def test_function_point(value, text, expected):
    assert value(x.function_point_id(F.col("t")), t=text) == expected


def test_template_and_saved_variables(value):
    assert value(x.template_variables(F.lit("/a/{{x}}/{{y}}?{{x}}"))) == ["x", "y", "x"]
    assert value(x.saved_variable(F.lit("v.set('tok', 1); v.set(\"b\", 2)"))) == "tok"
    assert value(x.saved_variable(F.lit("v.get('tok')"))) is None


def test_markdown_errors(value):
    text = "\n".join([
        "intro | with a pipe",
        "| # | Exception | ERROR CODE | Detail |",
        "|---|---|---|---|",
        "| 1 | Invalid | ERR-1 | why |",
        "  |2|Two|ERR-2||  ",
        "| 3 | Header | Error Code | x |",
        "| 4 | Ruler | ---- | x |",
        "| x | Not a number | ERR-9 | x |",
        "| 5 | too | many | cells | here |",
        "| 6 || no exception | x |",
    ])
    found = [tuple(r) for r in value(x.markdown_errors(F.lit(text)))]
    assert found == [("ERR-1", "Invalid", "why"), ("ERR-2", "Two", "")]


@pytest.mark.parametrize("name, path, layer", [
    ("stg", "models/staging/x.sql", "bronze"), ("dim_gold", "silver/x", "silver"),
    ("Mart_x", None, "gold"), ("summary", "martial/x", "gold"), ("x", "y", None),
])
def test_layer_is_first_needle_in_list_order(value, name, path, layer):
    assert value(x.layer_of(F.lit(name), F.lit(path).cast("string"))) == layer


def test_paths_and_labels(value):
    path = F.lit("/API-SPEC/Billing/swagger-spec-Pay.v2.yaml")
    assert value(x.file_stem(path)) == "swagger-spec-Pay.v2"
    assert value(x.parent_folder(path)) == "Billing"
    assert value(x.last_dotted(F.lit("model.p.orders"))) == "orders"
    assert value(x.label_without_method(F.lit("POST /a"))) == "/a"
    assert value(x.label_without_method(F.lit("PATCH /a"))) == "PATCH /a"
    assert value(x.label_method(F.lit("GET /a"))) == "GET"


def test_project_rules(value):
    rules = ProjectRules(models=(("^a_", "alpha"), ("^a", "second")), default="rest")
    meta = F.create_map(F.lit("project"), F.lit("given"))
    assert value(rules.for_model(F.lit("a_x"), meta)) == "given"
    assert value(rules.for_model(F.lit("a_x"))) == "alpha"
    assert value(rules.for_model(F.lit("ax"))) == "second"
    assert value(rules.for_model(F.lit("b"))) == "rest"
