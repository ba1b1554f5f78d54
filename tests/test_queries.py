"""Every registered query against its SQL twin on the smallest shared tables."""

import __spark_entry__ as entry_point
import pytest
from compare import DATA, differences

from tidebook.workload import load

SF = "sf0.001"
#: Those of this library; the corpus operators have tests of their own.
QUERIES, ORACLE = load().QUERIES, load().ORACLE

#: Nothing that pairs all rows with all rows, and no Python in the registered queries.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython",
            "MapInPandas", "FlatMapGroups")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, f"{DATA}/{SF}")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [node for node in UNWANTED if node in plan] == []
    if name in ORACLE:
        assert differences(name, df, ORACLE[name], SF) == []
    else:
        assert not df.isEmpty()


def test_entry_is_the_flagship(spark):
    assert "daily_return_pct" in entry_point.entry(spark).columns


def test_every_twin_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_points_need_no_session():
    """The SQL twins are asked for by a process that has no Spark."""
    import subprocess
    import sys

    from conftest import ROOT

    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    registered = [str(len(entry_point.queries())), str(len(entry_point.oracle_sql()))]
    assert done.stdout.split() == registered, done.stderr
