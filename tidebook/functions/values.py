"""Typing, null rules, money and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\r\n\f\x0b"


def cut(c: Column, length: int) -> Column:
    """First ``length`` characters: what a cast to a sized text column keeps."""
    return F.substring(c, 1, length)


def strip(c: Column) -> Column:
    """Trim every blank character, not only spaces."""
    return F.btrim(c, F.lit(BLANKS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_filled(*candidates: Column) -> Column:
    """First value that is neither NULL nor empty text."""
    return F.coalesce(*[blank_to_null(c) for c in candidates])


def first_filled_map(*candidates: Column) -> Column:
    """First map that has an entry."""
    return F.coalesce(*[F.when(F.size(c) > 0, c) for c in candidates])


def flag_from_text(c: Column) -> Column:
    """1 for TRUE, 1 or Y in any case, else 0; NULL counts as 0."""
    return F.when(F.upper(c).isin("TRUE", "1", "Y"), 1).otherwise(0)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def yes_no(condition: Column, yes: str = "Y", no: str = "N") -> Column:
    return F.when(condition, yes).otherwise(no)


def truthy(c: Column) -> Column:
    """Whether a JSON scalar read as text counts as set."""
    return F.coalesce(~F.lower(c).isin("", "false", "0", "null"), F.lit(False))


def to_base_currency(amount: Column, fx_rate: Column) -> Column:
    """Amount in the account currency, rounded half up to cents."""
    return F.round(amount * fx_rate, 2).cast("decimal(20,2)")


def percent_of(part: Column, whole: Column, scale: int) -> Column:
    """``part / whole * 100`` rounded half up; NULL unless the whole is positive.

    Both sides are brought to 24 digits first: wider decimals would leave the quotient so few
    fraction digits that it were rounded twice.
    """
    part, whole = part.cast("decimal(24,2)"), whole.cast("decimal(24,2)")
    return F.when(whole > 0, F.round(part / whole * 100, scale))


def mean_of(total: Column, count: Column, scale: int = 2) -> Column:
    """``total / count`` rounded half up once, from exact decimals."""
    return F.round(total.cast("decimal(24,2)") / count.cast("decimal(12,0)"), scale)


def matures_within(maturity: Column, as_of: Column, days: int) -> Column:
    """1 when the maturity is known and lies before ``as_of + days``, past dates included."""
    return flag(maturity.isNotNull() & (maturity < F.date_add(as_of, days)))


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """Prefix and zero-padded number; numbers wider than ``width`` keep all their digits."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), "0"))


def mebibytes(c: Column) -> Column:
    return c.cast("double") / F.lit(1048576.0)


def half_even(c: Column, scale: int) -> Column:
    """Rounding of the number libraries that statistics are compared with."""
    return F.bround(c, scale)


def typed(c: Column, kind: str) -> Column:
    """One contract entry (see ``schemas``) as an expression."""
    if kind == "string":
        return c.cast("string")
    if kind == "flag":
        return flag_from_text(c.cast("string"))
    if kind.startswith("varchar"):
        return cut(c.cast("string"), int(kind[len("varchar(") : -1]))
    return c.cast(kind)


def once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a column whose expression runs once per row, however often it is used.

    A parsed document that is only projected would be copied into every filter on its fields
    and parsed again there; the output of a generator is not.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
