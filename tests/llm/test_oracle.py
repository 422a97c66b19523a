"""The corpus queries that SQL can express against their DuckDB oracles."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from logtally.llm.queries import ORACLE
from tests.conftest import SF_ORACLE, SF_SMALL


def norm(v):
    return float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_ORACLE])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = E.queries()[name](spark, sf_dir)
    got = Counter(tuple(norm(x) for x in r) for r in df.collect())
    res = con.execute(E.oracle_sql()[name])
    columns = [c[0] for c in res.description]
    want = Counter(tuple(norm(x) for x in r) for r in res.fetchall())
    assert df.columns == columns
    assert got == want
