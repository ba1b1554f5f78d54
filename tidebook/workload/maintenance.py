"""Quality checks, look-back, upserts and duplicate removal."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merging, quality
from ..operators.enrichment import enrich_positions
from ..plans.interfaces import interface_rows
from ..schemas import ASSET_CLASSES
from ..sinks.bundles import merged_relation
from . import bindings as b
from . import sql as q
from .registry import query


#: Positions of accounts that end in 7 arrive late.
_LATE_SQL = "(SELECT *, right(account_id, 1) = '7' AS late FROM enriched) e"


@query("dq_unique", q.with_tables(q.POSITIONS_RAW, select="""
SELECT position_hash, count(*) AS n_rows FROM positions
GROUP BY position_hash HAVING count(*) > 1"""))
def dq_unique(t):
    return quality.check_unique(b.staged_positions(t), "position_hash")


@query("dq_not_null", q.with_tables(q.POSITIONS_RAW, select="""
SELECT position_hash, as_of_date, account_id, security_id,
       CAST(market_value AS DOUBLE) AS market_value
FROM positions WHERE accrued_income IS NULL"""))
def dq_not_null(t):
    return quality.check_not_null(b.staged_positions(t), "accrued_income").select(
        "position_hash", "as_of_date", "account_id", "security_id", "market_value"
    )


@query("dq_accepted_values", q.with_tables(q.SECURITIES, select="""
SELECT security_id, asset_class FROM securities
WHERE asset_class NOT IN ('EQUITY', 'FIXED_INCOME', 'CASH', 'ALTERNATIVE')"""))
def dq_accepted_values(t):
    found = quality.check_accepted(b.staged_securities(t), "asset_class", ASSET_CLASSES[:4])
    return found.select("security_id", "asset_class")


@query("dq_relationships", q.with_tables(q.POSITIONS_RAW, q.SECURITIES, select="""
SELECT security_id, count(*) AS n_rows FROM positions p
WHERE NOT EXISTS (SELECT 1 FROM securities s
                  WHERE s.security_id = p.security_id AND s.is_active = 1)
GROUP BY security_id"""))
def dq_relationships(t):
    """Positions in securities that are no longer active."""
    active = b.staged_securities(t).where("is_active = 1")
    return quality.check_relationship(
        b.staged_positions(t), "security_id", active, "security_id"
    )


@query("dq_unique_combination", q.with_tables(q.POSITIONS_RAW, select="""
SELECT as_of_date, account_id, count(*) AS n_rows FROM positions
GROUP BY as_of_date, account_id HAVING count(*) > 1"""))
def dq_unique_combination(t):
    return quality.check_unique_combination(
        b.staged_positions(t), ["as_of_date", "account_id"]
    )


@query("dq_null_counts", q.with_tables(q.SECURITIES, select="""
SELECT 'exchange' AS column_name, count(*) - count(exchange) AS null_rows FROM securities
UNION ALL
SELECT 'maturity_date', count(*) - count(maturity_date) FROM securities
UNION ALL
SELECT 'security_id', count(*) - count(security_id) FROM securities"""))
def dq_null_counts(t):
    return quality.null_counts(
        b.staged_securities(t), ["exchange", "maturity_date", "security_id"]
    )


@query("dq_report", q.with_tables(q.POSITIONS_RAW, q.SECURITIES, select="""
SELECT 'position_hash unique' AS check_name, count(*) AS violations
FROM (SELECT position_hash FROM positions GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'accrued_income not null', count(*) FROM positions
WHERE accrued_income IS NULL
UNION ALL SELECT 'security known', count(*) FROM (
  SELECT DISTINCT security_id FROM positions p WHERE security_id NOT IN (
    SELECT security_id FROM securities WHERE is_active = 1))"""))
def dq_report(t):
    positions = b.staged_positions(t)
    return quality.quality_report({
        "position_hash unique": quality.check_unique(positions, "position_hash"),
        "accrued_income not null": quality.check_not_null(positions, "accrued_income"),
        "security known": quality.check_relationship(
            positions, "security_id", b.staged_securities(t).where("is_active = 1"),
            "security_id",
        ),
    })


@query("incremental_lookback", q.with_tables(q.POSITIONS_RAW, select="""
SELECT position_hash, as_of_date, CAST(market_value AS DOUBLE) AS market_value FROM positions
WHERE as_of_date >= (SELECT coalesce(max(as_of_date), DATE '1900-01-01') - 3
                     FROM positions WHERE as_of_date < DATE '1997-07-01')"""))
def incremental_lookback(t):
    """What a run on the first of July 1997 has to process."""
    positions = b.staged_positions(t)
    loaded = positions.where(F.col("as_of_date") < "1997-07-01")
    return merging.lookback_filter(positions, loaded, "as_of_date").select(
        "position_hash", "as_of_date", "market_value"
    )


@query("silver_incremental", q.with_tables(*q.STAR, select="""
SELECT position_hash, as_of_date, CAST(max(market_value) AS DOUBLE) AS market_value,
       count(DISTINCT asset_class) AS asset_classes
FROM enriched
WHERE NOT late OR as_of_date >= (SELECT max(as_of_date) - 3 FROM enriched
                                 WHERE as_of_date < DATE '1997-07-01' AND NOT late)
   OR as_of_date >= DATE '1997-07-01'
GROUP BY position_hash, as_of_date""".replace("FROM enriched", f"FROM {_LATE_SQL}")))
def silver_incremental(t):
    """The silver table after loading up to mid 1997 and then everything since the look-back.

    The positions of accounts that end in 7 come late: those within the look-back are still taken, older
    ones are not.
    """
    securities, accounts = b.staged_securities(t), b.staged_accounts(t)
    highest = [F.col("market_value").desc()]

    def silver(positions):
        unique = merging.dedupe_latest(positions, ["position_hash"], highest)
        return enrich_positions(unique, securities, accounts)

    positions = b.staged_positions(t)
    late = F.right("account_id", F.lit(1)) == "7"
    first = positions.where((F.col("as_of_date") < "1997-07-01") & ~late)
    fresh = merging.lookback_filter(positions, first, "as_of_date")
    merged = merging.merge_rows(
        silver(first), silver(fresh), ["as_of_date", "position_hash"]
    )
    return merged.select(
        "position_hash", "as_of_date", "market_value",
        F.when(F.col("asset_class").isNull(), 0).otherwise(1).cast("bigint")
        .alias("asset_classes"),
    )


# One row per order of a customer; the status tells the two feeds of the upserts apart.
_ORDERS_SQL = """
feed AS (
  SELECT o_custkey AS account_id, CAST(o_orderdate AS DATE) AS as_of_date,
         o_orderkey AS order_id, o_orderstatus AS status, o_orderpriority AS priority,
         CAST(o_totalprice AS DOUBLE) AS total
  FROM orders),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY account_id, status = 'O'
                               ORDER BY as_of_date DESC, order_id DESC) AS rank_ FROM feed),
stored AS (SELECT * EXCLUDE (rank_) FROM ranked WHERE status <> 'O' AND rank_ = 1),
arrived AS (SELECT * EXCLUDE (rank_) FROM ranked WHERE status = 'O' AND rank_ = 1)"""


def order_feed(t):
    return t.orders.select(
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderdate").cast("date").alias("as_of_date"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("total"),
    )



def newest():
    return [F.col("as_of_date").desc(), F.col("order_id").desc()]


@query("dedupe_latest", q.with_tables(_ORDERS_SQL, select="""
SELECT account_id, as_of_date, order_id, status, priority, total FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id
                               ORDER BY as_of_date DESC, order_id DESC) AS r FROM feed)
WHERE r = 1"""))
def dedupe_latest(t):
    return merging.dedupe_latest(order_feed(t), ["account_id"], newest())


@query("upsert_merge", q.with_tables(_ORDERS_SQL, select="""
SELECT * FROM stored WHERE account_id NOT IN (SELECT account_id FROM arrived)
UNION ALL SELECT * FROM arrived"""))
def upsert_merge(t):
    """Closed and pending orders on record, open ones arriving: whole rows are replaced."""
    feed = order_feed(t)
    stored = merging.dedupe_latest(feed.where("status <> 'O'"), ["account_id"], newest())
    return merging.upsert(stored, feed.where("status = 'O'"), ["account_id"], newest())


@query("upsert_protected", q.with_tables(_ORDERS_SQL, select="""
SELECT coalesce(a.account_id, s.account_id) AS account_id,
       CASE WHEN a.account_id IS NOT NULL THEN a.order_id ELSE s.order_id END AS order_id,
       CASE WHEN s.account_id IS NOT NULL THEN s.priority ELSE a.priority END AS priority,
       s.status AS note, a.total AS total
FROM stored s FULL JOIN arrived a ON s.account_id = a.account_id"""))
def upsert_protected(t):
    """The priority is kept once stored, the note is the target's own, the total is new."""
    feed = order_feed(t)
    stored = merging.dedupe_latest(feed.where("status <> 'O'"), ["account_id"], newest()).select(
        "account_id", "order_id", "priority", F.col("status").alias("note")
    )
    arrived = merging.dedupe_latest(feed.where("status = 'O'"), ["account_id"], newest()).select(
        "account_id", "order_id", "priority", "total"
    )
    return merging.merge_rows(stored, arrived, ["account_id"], protect=["priority"])


@query("bundle_last_wins", """
SELECT 'i' || o_custkey AS interface_id, arg_max(o_orderpriority, o_orderkey) AS source_system,
       arg_max(o_orderstatus, o_orderkey) AS notes, max(o_orderkey) AS n_last
FROM orders GROUP BY o_custkey""")
def bundle_last_wins(t):
    """An interface per customer, listed once for each order: the newest order's row stays."""
    listed = t.orders.select(
        F.concat(F.lit("i"), F.col("o_custkey").cast("string")).alias("interface_id"),
        F.col("o_orderpriority").alias("source_system"),
        F.col("o_orderstatus").alias("notes"), F.col("o_orderkey").alias("ordinal"),
        F.col("o_orderkey").cast("string").alias("type_app_extract"),
    )
    rows = interface_rows(listed)
    merged = merged_relation(None, rows, "interface360_interfaces")
    return merged.select("interface_id", "source_system", "notes",
                         F.col("type_app_extract").cast("bigint").alias("n_last"))


@query("fields_merged", """
WITH body AS (
  SELECT o_custkey, max(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
stored AS (
  SELECT o_custkey, max(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
latest AS (
  SELECT o_custkey, max(o_orderkey) AS k FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
SELECT 'e' || o_custkey AS endpoint_key, 'f' AS field_name,
       't' || coalesce(latest.k, stored.k) AS data_type,
       coalesce(body.k, stored.k) AS max_length
FROM latest FULL JOIN stored USING (o_custkey) LEFT JOIN body USING (o_custkey)""")
def fields_merged(t):
    """A field per customer: open orders are body fields, finished ones parameters without a
    length, and pending ones are stored already."""
    rows = t.orders.select(
        F.concat(F.lit("e"), F.col("o_custkey").cast("string")).alias("endpoint_key"),
        F.lit("f").alias("field_name"),
        F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("data_type"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey")).alias("max_length"),
        F.when(F.col("o_orderstatus") == "F", F.array(F.lit("max_length")))
        .otherwise(F.array().cast("array<string>")).alias("absent"),
        F.col("o_orderkey").alias("ordinal"), "o_orderstatus",
    )
    pending = rows.where("o_orderstatus = 'P'").drop("o_orderstatus")
    stored = merged_relation(None, pending, "api_fields")
    arrived = rows.where("o_orderstatus <> 'P'").drop("o_orderstatus")
    return merged_relation(stored, arrived, "api_fields")
