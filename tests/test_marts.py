from datetime import date
from decimal import Decimal as D

import pytest

from tidebook.operators import marts
from tidebook.operators.enrichment import ENRICHED_COLUMNS, enrich_positions
from tidebook.operators.staging import stage_accounts, stage_positions, stage_securities
from tidebook.schemas import landing_schema


def position(day, account, security, value, fx="1", accrued="0", status="SETTLED", cost=None):
    as_of = date.fromisoformat(day)
    cost = D(value) if cost is None else D(cost)
    return (f"{day}|{account}|{security}", as_of, account, security, D(1), D(1), D(1), cost,
            D(value), D(value) - cost, None if accrued is None else D(accrued), D(fx), status,
            "STAR")


def security(key, kind="EQUITY", maturity=None, active="True"):
    return (key, "c", "i", "t", f"name {key}", kind, "sub", "USD", "US", None, None,
            maturity and date.fromisoformat(maturity), active)


def account(key):
    return (key, f"name {key}", "cl", "IRA", "EUR", "US", None, "PM1", "y", "MID")


@pytest.fixture
def enrich(spark):
    def build(positions, securities, accounts):
        return enrich_positions(
            stage_positions(spark.createDataFrame(positions, landing_schema("positions_raw"))),
            stage_securities(spark.createDataFrame(securities, landing_schema("securities"))),
            stage_accounts(spark.createDataFrame(accounts, landing_schema("accounts"))),
        )

    return build


def test_enrichment(enrich):
    df = enrich(
        [
            position("2025-01-02", "A", "S", "10.05", fx="1.5", accrued=None, status="FAILED"),
            position("2025-01-02", "A", "unknown", "1"),
            position("2025-01-02", "unknown", "S", "1"),
        ],
        [security("S", "CASH", "2025-04-01")], [account("A")],
    )
    assert df.columns == [*ENRICHED_COLUMNS, "dbt_updated_at"]
    [row] = df.collect()
    assert row.market_value_base == D("15.08")
    assert row.accrued_income == 0 and row.is_cash == 1 and row.is_failed == 1
    assert row.account_base_ccy == "EUR" and row.security_ccy == "USD"
    assert row.matures_within_90d == 1


def test_nav_uses_the_previous_existing_day(enrich):
    nav = marts.nav_by_account_daily(enrich(
        [
            position("2025-01-02", "A", "S", "100"),
            position("2025-01-09", "A", "S", "60"),
            position("2025-01-09", "A", "C", "50"),
            position("2025-01-09", "A", "C", "5"),
            position("2025-01-03", "B", "S", "7"),
        ],
        [security("S"), security("C", "CASH")], [account("A"), account("B")],
    ))
    found = {(r.account_id, r.as_of_date.day): r for r in nav.collect()}
    first, second = found["A", 2], found["A", 9]
    assert first.prior_day_nav_base is None and first.daily_return_pct is None
    assert second.prior_day_nav_base == 100 and second.daily_return_pct == D("15.0000")
    assert (second.position_count, second.distinct_securities) == (3, 2)
    assert second.distinct_asset_classes == 2 and second.cash_base == 55
    assert second.top_position_pct == D("52.17") and second.cash_pct_nav == D("47.83")
    assert found["B", 3].prior_day_nav_base is None


def test_nav_guards_against_worthless_accounts(enrich):
    nav = marts.nav_by_account_daily(enrich(
        [
            position("2025-01-02", "A", "S", "0"),
            position("2025-01-03", "A", "S", "-5"),
            position("2025-01-04", "A", "S", "5"),
        ],
        [security("S")], [account("A")],
    )).orderBy("as_of_date").collect()
    assert [r.top_position_pct for r in nav] == [None, None, D("100.00")]
    assert [r.daily_return_pct for r in nav] == [None, None, None]


def test_counts_of_an_account_that_holds_most_positions(enrich, spark):
    """Exact distinct counts for one hot account and day, whatever the classes are called."""
    kinds = ["EQUITY", "CASH", "OTHER", "MORE", None]
    positions = [position("2025-01-02", "A", f"S{i % 40}", "1") for i in range(400)]
    df = marts.nav_rollup(enrich(
        positions, [security(f"S{i}", kinds[i % 5]) for i in range(40)], [account("A")],
    ))
    [row] = df.collect()
    assert (row.position_count, row.distinct_securities, row.distinct_asset_classes) == (400, 40, 4)
    assert row.nav_base == 400


def test_exposure(enrich):
    [row] = marts.exposure_by_asset_class(enrich(
        [
            position("2025-01-02", "A", "S", "0.01", status="FAILED"),
            position("2025-01-02", "B", "S", "0.02"),
            position("2025-01-02", "B", "T", "0.02"),
            position("2025-01-02", "B", "T", "0.02"),
        ],
        [security("S"), security("T")], [account("A"), account("B")],
    )).collect()
    assert (row.position_count, row.distinct_accounts, row.distinct_securities) == (4, 2, 2)
    assert row.avg_position_base == D("0.02") and row.failed_count == 1
    assert row.largest_position_base == D("0.02")


def test_smoke_limit(spark):
    raw = spark.createDataFrame(
        [position("2025-01-02", "A", f"S{i}", "1") for i in range(9)],
        landing_schema("positions_raw"),
    )
    assert stage_positions(raw, limit=4).count() == 4


def test_positions_in_parts_equal_positions_joined_before(spark, rows):
    """Headers and lines give the rows of the flat table, for repeated, missing and long keys."""
    from types import SimpleNamespace

    from tidebook.workload import bindings
    from tidebook.workload.registry import SCHEMAS

    def table(name, data):
        columns = SCHEMAS[name].replace("timestamp_ntz", "string")
        df = spark.createDataFrame(data, columns)
        dates = [c for c in ("o_orderdate", "l_shipdate") if c in df.columns]
        return df.withColumns({c: df[c].cast("timestamp_ntz") for c in dates})

    long = 10**18 + 7
    orders = [(1, 5, "O", 1.0, "1997-06-01", "p"), (1, 6, "O", 1.0, "1997-06-02", "p"),
              (2, None, "O", 1.0, "1997-06-03", "p"), (None, 5, "O", 1.0, "1997-06-04", "p"),
              (3, long, "O", 1.0, None, "p"), (4, 99, "O", 1.0, "1997-06-05", "p")]
    line = ("N", "F", "1997-07-01")
    t = SimpleNamespace(
        orders=table("orders", orders),
        lineitem=table("lineitem", [
            (1, 7, 1, 1, 17.0, 84197.04, 0.06, 0.02, *line), (1, 7, 1, 7, 1.0, 0.01, 0.1, 0.0, *line),
            (1, 7, 1, 1, 17.0, 84197.04, 0.06, 0.02, *line), (2, 7, 1, 1, 2.0, 5.0, 0.0, 0.0, *line),
            (None, 7, 1, 1, 2.0, 5.0, 0.0, 0.0, *line), (4, 7, 1, 1, 2.0, 5.0, 0.0, 0.0, *line),
            (3, long, 1, 2, 1.125, 1234567.891, 0.333, 0.07, None, None, None),
            (3, 7, 1, 2, None, 3.0, None, 0.07, "R", "O", None),
            (3, 7, 1, None, 3.0, -3.0, 0.01, -0.07, "A", "x", None),
            (3, 7, 1, 1, 9e9, 9e13, 0.01, 0.07, "A", "x", None),
            (3, None, 1, 1, 2.0, 5.0, 0.0, 0.0, *line), (3, 8, 1, 1, 2.0, 5.0, 0.0, 0.0, *line)]),
        part=table("part", [(7, "red nut", "B", "CASH", 3, 1.0), (7, "red nut", "B", "ECONOMY", 3, 1.0),
                            (long, "bolt", "C", "ECONOMY", 3, 1.0)]),
        customer=table("customer", [(5, "c5", 1, 10.0, "s"), (6, "c6", 1, None, None),
                                    (6, "c6", 1, None, None), (long, "cl", 1, -1.0, "s"),
                                    (99, "c", 7, 1.0, "s")]),
        nation=table("nation", [(1, "FR", 1)]))
    columns = ENRICHED_COLUMNS
    flat = enrich_positions(bindings.staged_positions(t), bindings.staged_securities(t),
                            bindings.staged_accounts(t))
    found = rows(bindings.enriched_positions(t), *columns)
    assert found == rows(flat, *columns) and len(found) > 20
