"""Every named query against its DuckDB oracle on the sf0.001 tables, and the entry."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from logtally.plans.oracle import ORACLE
from logtally.plans.queries import QUERIES
from tests.conftest import SF_SMALL

TABLES = ["events"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(ORACLE) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(_norm(x) for x in r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    want = [tuple(_norm(x) for x in r) for r in res.fetchall()]
    assert df.columns == [d[0] for d in res.description]
    assert Counter(got) == Counter(want)
    _check_plan(name, df._jdf.queryExecution().executedPlan().toString())


# Operators no registered query may plan: pair-producing joins, and Python evaluated row
# by row. Python runs only as Arrow batches, and only to decode double-gzip files.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
ARROW_PYTHON = ("MapInArrow", "MapInPandas", "ArrowEvalPython")


def _check_plan(name, plan):
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans {op}"
    if name not in ("double_gzip_roundtrip", "double_gzip_members"):
        for op in ARROW_PYTHON:
            assert op not in plan, f"{name} runs Python ({op})"
    # A single-partition exchange only ever carries grouped rows, never raw lines.
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = "\n".join(lines[i + 1:])
            assert below.index("HashAggregate") < below.index("Scan"), f"{name}: raw rows in one task"


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["status", "bytes", "pct"]
    assert rows and abs(sum(r.pct for r in rows) - 100) < 1e-9
