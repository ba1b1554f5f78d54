"""Compare registered queries with their SQL twins on the shared test tables.

Run as a script to check chosen queries: ``python tests/compare.py sf0.01 nav_by_account_daily``.
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    """A value in the form both engines agree on."""
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    if hasattr(value, "asDict"):
        return plain(value.asDict())
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, [tuple(plain(r[n]) for n in names) for r in df.collect()]


def duck_rows(sf: str, sql: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{DATA}/{sf}/{table}.parquet'")
    con.execute("SET TimeZone='UTC'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = [names.index(n) for n in sorted(names)]
    return sorted(names), [tuple(plain(r[i]) for i in order) for r in result.fetchall()]


def differences(name, df, sql, sf: str) -> list[str]:
    """What differs, as text; empty when names and all values agree."""
    names, ours = spark_rows(df)
    other_names, theirs = duck_rows(sf, sql)
    if names != other_names:
        return [f"{name}: columns {names} != {other_names}"]
    ours, theirs = sorted(ours, key=repr), sorted(theirs, key=repr)
    if ours == theirs:
        return [] if ours else [f"{name}: both sides are empty"]
    out = [f"{name}: rows {len(ours)} vs {len(theirs)}; columns {names}"]
    only_ours = set(ours) - set(theirs)
    only_theirs = set(theirs) - set(ours)
    out.append(f"  only ours {len(only_ours)}, only theirs {len(only_theirs)}")
    for label, rows in (("ours", only_ours), ("theirs", only_theirs)):
        out.extend(f"  {label}: {r}" for r in sorted(rows, key=repr)[:3])
    return out


def main(sf: str, chosen: list[str]) -> int:
    import __spark_entry__ as e
    from tidebook.session import build_session

    spark = build_session("compare", "local[8]", 8, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracle = e.queries(), e.oracle_sql()
    failed = 0
    for name in chosen or queries:
        start = time.time()
        try:
            if name in oracle:
                df = queries[name](spark, f"{DATA}/{sf}")
                problems = differences(name, df, oracle[name], sf)
            else:
                print(f"rows only {queries[name](spark, f'{DATA}/{sf}').count():>8}", end=" ")
                problems = []
        except Exception as error:  # noqa: BLE001 - reported and counted
            problems = [f"{name}: {type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s", flush=True)
        print("\n".join(problems), end="\n" if problems else "")
    return failed


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1] if len(sys.argv) > 1 else "sf0.001", sys.argv[2:])))
