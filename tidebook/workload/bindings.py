"""The shared test tables shaped as the inputs the operators expect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.values import padded_id, typed
from ..operators.enrichment import PositionParts, enrich_positions
from ..operators.staging import stage_accounts, stage_positions, stage_securities


def _account() -> Column:
    return padded_id("ACCT", F.col("o_custkey"), 7)


def _security() -> Column:
    return padded_id("SEC", F.col("l_partkey"), 8)


def _day() -> Column:
    return F.col("o_orderdate").cast("date")


def positions_raw(t) -> DataFrame:
    """One position per order line.

    Orders grow as the lines do, so this join is always a shuffle join; adaptive execution
    splits the lines of an order that has very many.
    """
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate").hint("merge")
    lines = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return _positions_of(lines.withColumns(
        {"as_of_date": _day(), "account_id": _account(), "security_id": _security()}))


def position_parts(t) -> PositionParts:
    """The same positions as headers, the orders, and lines."""
    def staged(name: str, raw: Column) -> dict[str, Column]:
        """The staged id, and what staging cuts off a very long one: the hash has all of it."""
        kept = typed(raw, schemas.POSITIONS[name])
        return {name: kept, f"{name}_rest": F.substring(raw, F.length(kept) + 1, F.length(raw))}

    headers = t.orders.withColumns(staged("account_id", _account()) | {"as_of_date": _day()})
    lines = _packed(t.lineitem.withColumns(staged("security_id", _security())))
    ids = {name: F.concat(name, f"{name}_rest") for name in ("account_id", "security_id")}
    return PositionParts(
        headers.select(F.col("o_orderkey").alias("l_orderkey"), "as_of_date", "account_id",
                       "account_id_rest"),
        lines, ("l_orderkey",),
        lambda whole, kept: stage_positions(
            _positions_of(_unpacked(whole).withColumns(ids), kept), kept=kept),
    )


#: How many parts of one a line's numbers are counted in, and the bits of that count in one packed
#: number. A line with a number that is missing, negative, wider or finer keeps all of them as
#: they are.
PACKED = {"l_extendedprice": (100, 31), "l_quantity": (100, 14), "l_discount": (100, 7),
          "l_tax": (100, 7), "l_linenumber": (1, 4)}


def _packed(lines: DataFrame) -> DataFrame:
    """Lines with their numbers in one: shuffles take that much less disk."""
    fits, whole = F.lit(True), F.lit(0).cast("bigint")
    for name, (scale, bits) in PACKED.items():
        number = F.col(name)
        # Guarded: a cast of what is no number, or too large, is an error.
        count = F.when((number >= 0) & (number < (2**bits - 1) / scale),
                       F.round(number * scale).cast("bigint"))
        fits = fits & F.coalesce(count / scale == number, F.lit(False))
        whole = F.shiftleft(whole, bits).bitwiseOR(count)
    return lines.withColumn("packed", F.when(fits, whole)).withColumns(
        {name: F.when(F.col("packed").isNull(), F.col(name)) for name in PACKED})


def _unpacked(lines: DataFrame) -> DataFrame:
    """The numbers as they were: a division rounds to the number that was written."""
    numbers, rest = {}, F.col("packed")
    for name, (scale, bits) in reversed(PACKED.items()):
        number = (rest.bitwiseAND(2**bits - 1) / scale).cast(lines.schema[name].dataType)
        numbers[name] = F.coalesce(number, F.col(name))
        rest = F.shiftright(rest, bits)
    return lines.withColumns(numbers).drop("packed")


def _positions_of(lines: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """Positions out of order lines with their day and ids, besides columns to keep."""
    amounts = lines.selectExpr(
        "*",
        "cast(l_extendedprice AS decimal(20,2)) AS market_value",
        "cast(l_quantity AS decimal(18,4)) AS quantity",
    ).selectExpr(
        "*",
        "cast(round(market_value * (1 - cast(l_discount AS decimal(4,2))), 2)"
        " AS decimal(20,2)) AS cost_basis",
        "cast(quantity AS decimal(10,0)) AS units",
    )
    return amounts.select(
        "as_of_date", "account_id", "security_id", *kept, "quantity", "market_value", "cost_basis",
        F.expr("cast(market_value - cost_basis AS decimal(20,2)) AS unrealized_gl"),
        F.expr("cast(cost_basis / units AS decimal(18,6)) AS unit_cost"),
        F.expr("cast(market_value / units AS decimal(18,6)) AS unit_price"),
        F.expr("""CASE WHEN l_linenumber % 7 <> 0 THEN cast(
                  round(market_value * cast(l_tax AS decimal(4,2)), 2) AS decimal(20,2)) END
                  AS accrued_income"""),
        F.expr("cast(1 + l_tax AS decimal(10,6)) AS fx_rate"),
        F.expr("""CASE l_returnflag WHEN 'N' THEN 'SETTLED' WHEN 'A' THEN 'PENDING'
                  WHEN 'R' THEN 'FAILED' END AS settlement_status"""),
        F.expr("""CASE l_linestatus WHEN 'F' THEN 'ADVANTAGE' WHEN 'O' THEN 'STAR' END
                  AS source_system"""),
    ).withColumn(
        "position_hash",
        F.expr("concat_ws('|', cast(as_of_date AS string), account_id, security_id)"),
    )


def securities_raw(t) -> DataFrame:
    """One security per part."""
    return t.part.select(
        padded_id("SEC", F.col("p_partkey"), 8).alias("security_id"),
        F.expr("concat('C', lpad(cast(p_partkey % 100000000 AS string), 8, '0')) AS cusip"),
        F.expr("concat('US', lpad(cast(p_partkey AS string), 10, '0')) AS isin"),
        F.expr("upper(substring(p_name, 1, 4)) AS ticker"),
        F.col("p_name").alias("security_name"),
        F.expr("""CASE p_type WHEN 'STANDARD' THEN 'EQUITY' WHEN 'ECONOMY' THEN 'FIXED_INCOME'
                  WHEN 'MEDIUM' THEN 'CASH' WHEN 'PROMO' THEN 'ALTERNATIVE'
                  WHEN 'SMALL' THEN 'DERIVATIVE' WHEN 'LARGE' THEN 'DERIVATIVE' END
                  AS asset_class"""),
        F.col("p_brand").alias("sub_asset_class"),
        F.expr("CASE p_partkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END"
               " AS currency"),
        F.expr("CASE p_partkey % 2 WHEN 0 THEN 'US' ELSE 'GB' END AS country"),
        F.expr("CASE WHEN p_type = 'STANDARD' THEN 'NYSE' END AS exchange"),
        F.expr("date_add(DATE '1990-01-01', p_size) AS issue_date"),
        F.expr("""CASE WHEN p_type = 'ECONOMY' THEN
                  date_add(DATE '1995-01-01', cast(p_partkey % 2500 AS int)) END
                  AS maturity_date"""),
        F.expr("CASE WHEN p_size < 45 THEN 'True' ELSE 'False' END AS is_active"),
    )


def accounts_raw(t) -> DataFrame:
    """One account per customer, with the nation as domicile."""
    nation = t.nation.select("n_nationkey", "n_name")
    return t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        padded_id("ACCT", F.col("c_custkey"), 7).alias("account_id"),
        F.col("c_name").alias("account_name"),
        padded_id("CLT", F.floor(F.col("c_custkey") / 10), 6).alias("client_id"),
        F.col("c_mktsegment").alias("account_type"),
        F.expr("CASE c_custkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END"
               " AS base_currency"),
        F.col("n_name").alias("domicile_country"),
        F.expr("date_add(DATE '2010-01-01', cast(c_custkey % 5000 AS int)) AS inception_date"),
        F.expr("concat('PM', lpad(cast(c_custkey % 200 AS string), 4, '0'))"
               " AS portfolio_manager"),
        F.expr("CASE WHEN c_custkey % 10 < 7 THEN 'y' ELSE 'no' END AS is_discretionary"),
        F.expr("""CASE WHEN c_acctbal < 0 THEN 'SMALL' WHEN c_acctbal < 3000 THEN 'MID'
                  WHEN c_acctbal < 7000 THEN 'LARGE' ELSE 'UHNW' END AS aum_tier"""),
    )


def staged_positions(t) -> DataFrame:
    return stage_positions(positions_raw(t))


def staged_securities(t) -> DataFrame:
    return stage_securities(securities_raw(t))


def staged_accounts(t) -> DataFrame:
    return stage_accounts(accounts_raw(t))


def enriched_positions(t) -> DataFrame:
    return enrich_positions(position_parts(t), staged_securities(t), staged_accounts(t))


def run_stats(t) -> DataFrame:
    """Run statistics: one row per user and event type, the user being the run."""
    k = "cast(get_json_object(props, '$.k') AS bigint)"
    return t.events.groupBy("user_id", "event_type").agg(
        F.expr("sum(cast(value AS decimal(20,2))) AS elapsed"),
        F.expr(f"sum({k}) AS k_sum"), F.expr(f"max({k}) AS k_max"), F.expr("count(*) AS n"),
    ).selectExpr(
        "concat('run-', cast(user_id AS string)) AS run_id",
        "event_type AS model_name",
        "CASE WHEN n % 2 = 0 THEN 'table' ELSE 'view' END AS materialization",
        """CASE user_id % 4 WHEN 0 THEN 'small' WHEN 1 THEN 'medium' WHEN 2 THEN 'large'
           ELSE 'xlarge' END AS pod_size""",
        "CASE WHEN user_id % 11 <> 0 THEN user_id % 3 + 2 END AS dbt_threads",
        "user_id % 2 * 4 + 4 AS parallel_degree",
        "CASE WHEN n % 5 <> 0 THEN cast(elapsed AS decimal(18,3)) END AS elapsed_seconds",
        "cast(cast(k_sum AS decimal(18,0)) / 100 AS decimal(18,3)) AS cpu_seconds",
        "k_max * 1048576 + n AS pga_peak_bytes",
        "k_sum * 4096 AS physical_reads_bytes",
        "CASE WHEN n % 3 <> 0 THEN k_sum END AS logical_reads",
        "n * 100000 AS rows_processed",
    )
