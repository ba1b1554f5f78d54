"""Patterns over API documents, scripts, paths and endpoint labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import blank_to_null, strip

# Patterns and word lists the results depend on.
FUNCTION_POINT = r"(?i)function\s*point\s*id\s*is\s*(\d+)"
TEMPLATE_VARIABLE = r"\{\{([^}]+)\}\}"
SAVED_VARIABLE = r"""\.set\(['"]([^'"]+)['"]"""
LABEL_METHOD = r"^(GET|POST|PUT|DELETE)\s"
HTTP_METHODS = ("get", "post", "put", "delete", "patch")
ERROR_TABLE_HEADERS = ("ERROR CODE", "----")
LAYER_NEEDLES = (
    ("bronze", "bronze"), ("brz", "bronze"), ("staging", "bronze"),
    ("silver", "silver"), ("slv", "silver"), ("intermediate", "silver"),
    ("gold", "gold"), ("gld", "gold"), ("mart", "gold"),
)


def function_point_id(text: Column) -> Column:
    """Digits after "function point id is", NULL without a match."""
    return blank_to_null(F.regexp_extract(text, FUNCTION_POINT, 1))


def template_variables(url: Column) -> Column:
    """Every ``{{name}}`` in the text, in order, repeats included."""
    return F.regexp_extract_all(url, F.lit(TEMPLATE_VARIABLE), F.lit(1))


def saved_variable(script: Column) -> Column:
    """Name in the first ``.set('name'`` call, NULL without one."""
    return blank_to_null(F.regexp_extract(script, SAVED_VARIABLE, 1))


def is_http_method(method: Column) -> Column:
    return F.lower(method).isin(*HTTP_METHODS)


def is_error_status(status: Column) -> Column:
    return F.substring(status, 1, 1).isin("4", "5")


def label_without_method(label: Column) -> Column:
    return F.regexp_replace(label, LABEL_METHOD, "")


def label_method(label: Column) -> Column:
    return blank_to_null(F.regexp_extract(label, LABEL_METHOD, 1))


def markdown_errors(text: Column) -> Column:
    """Rows of an error table written in Markdown, as an array in text order.

    A row is a line with exactly four cells between pipes, a number in the first; its next
    cells are exception, code and detail. Header and ruler lines are left out.
    """
    rows = F.transform(
        # Only lines with a pipe can be rows; the rest never reaches the cell split.
        F.filter(F.split(text, r"\R"), lambda line: F.contains(line, F.lit("|"))),
        lambda line: F.split(line, r"\|"),
    )

    def is_row(cells: Column) -> Column:
        edges_blank = (strip(cells[0]) == "") & (strip(F.get(cells, F.lit(5))) == "")
        numbered = strip(F.get(cells, F.lit(1))).rlike(r"^\d+$")
        # A cell may hold blanks only, but the exception and the code need a character.
        present = (F.length(F.get(cells, F.lit(2))) > 0) & (F.length(F.get(cells, F.lit(3))) > 0)
        code = F.upper(strip(F.get(cells, F.lit(3))))
        return (
            (F.size(cells) == 6) & edges_blank & numbered & present
            & ~code.isin(*ERROR_TABLE_HEADERS)
        )

    return F.transform(
        F.filter(rows, is_row),
        lambda cells: F.struct(
            strip(cells[3]).alias("error_code"),
            strip(cells[2]).alias("business_exception"),
            strip(cells[4]).alias("error_details"),
        ),
    )


def layer_of(name: Column, path: Column) -> Column:
    """Warehouse layer by the first needle, in list order, found in name or path."""
    text = F.lower(F.concat_ws(" ", name, path))
    return F.coalesce(*[F.when(F.contains(text, F.lit(n)), layer) for n, layer in LAYER_NEEDLES])


def path_parts(path: Column) -> Column:
    """Path split at slashes; arrays compare part by part, which gives the file-walk order."""
    return F.split(path, "/")


def file_name(path: Column) -> Column:
    return F.element_at(path_parts(path), -1)


def file_stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]+$", "")


def parent_folder(path: Column) -> Column:
    return F.coalesce(F.try_element_at(path_parts(path), F.lit(-2)), F.lit(""))


def last_dotted(name: Column) -> Column:
    return F.element_at(F.split(name, r"\."), -1)
