"""Hard negatives against every pair's score in Python integers."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from logtally.llm import negatives
from tests.conftest import SF_ORACLE


def brute(rows, asks, scale=256, n_positives=5, k=5, low=80, high=100):
    """``rows`` of (id, label, vector); every (anchor, positive, rank, negative, two scores)."""
    kept = []
    for i, label, x in rows:
        if i is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        kept.append((i, label, [math.floor(scale * float(c)) for c in x]))
    out = []
    for at, (i, label, v) in enumerate(kept):
        if not asks(i):
            continue
        scored = [
            (-sum(a * b for a, b in zip(v, w, strict=True)), j, other)
            for k_, (j, other, w) in enumerate(kept)
            if k_ != at and len(w) == len(v)
        ]
        for minus, positive, _ in sorted(s for s in scored if s[2] == label)[:n_positives]:
            p = -minus
            fits = sorted((s, j) for s, j, o in scored if o != label and low * p <= -100 * s <= high * p)[:k]
            out += [(i, positive, r, j, p, -s) for r, (s, j) in enumerate(fits, 1)]
    return out


def tuples(df):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_query(spark):
    table = pq.read_table(f"{SF_ORACLE}/embeddings.parquet").to_pylist()
    rows = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], r["embedding"]) for r in table]
    want = brute(rows, lambda i: i % 100 == 0)
    assert len(want) > 50
    assert tuples(E.queries()["op13_hard_negatives"](spark, SF_ORACLE)) == sorted(want)


SCHEMA = "vec_id long, label int, embedding array<double>, id string, row string, shard string, score string"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, *["clash"] * 4) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("block_rows", [2, 7, 2048])
def test_overlapping_windows(spark, block_rows, monkeypatch):
    """Many ties, equal positives, several blocks of anchors, wider windows."""
    rng = np.random.default_rng(3)
    rows = [(int(i), int(rng.integers(3)), [float(x) for x in rng.integers(0, 4, 3) / 256]) for i in range(120)]
    got = negatives.mine(table_of(spark, rows), F.expr("vec_id % 10 = 0"), 4, 3, low=50, high=90, block_rows=block_rows)
    want = brute(rows, lambda i: i % 10 == 0, n_positives=4, k=3, low=50, high=90)
    assert tuples(got) == sorted(want) and len(want) > 40


def test_edges(spark):
    """Nulls, non-finite and very large components, lengths, repeated rows, one label only."""
    rows = [
        (0, 1, [1.0, 2.0]), (0, 1, [1.0, 2.0]), (1, 1, [1.0, 2.0]), (2, 2, [1.0, 2.0]), (2, 2, [1.0, 2.0]),
        (3, 2, [1.0, 1.9]), (4, None, [1.0, 2.0]), (None, 2, [1.0, 2.0]), (5, 2, None), (6, 2, [None, 2.0]),
        (7, 2, [float("nan"), 2.0]), (8, 2, [float("inf"), 2.0]), (9, 2, [1.0, 2.0, 3.0]), (10, 1, [1.0, 2.0, 3.0]),
        (20, 1, [1.0, 2.0, 3.0]), (11, 2, []), (12, 1, []), (30, 1, []), (40, 3, [-1.0, 0.0]), (41, 3, [1.0, 0.0]),
        (50, 5, [2.0**22, 1.0]), (51, 5, [2.0**22, 2.0]), (52, 6, [2.0**22, 1.5]), (53, 6, [2.0**22 - 1, 7.0]),
    ]
    got = negatives.mine(table_of(spark, rows), F.expr("vec_id % 10 = 0"), block_rows=3)
    assert tuples(got) == sorted(brute(rows, lambda i: i % 10 == 0))
    assert negatives.mine(table_of(spark, rows).limit(0), F.expr("vec_id % 10 = 0")).collect() == []
    alone = table_of(spark, rows).where("label = 1")
    assert negatives.mine(alone, F.expr("vec_id = 0")).collect() == []
    huge = [(0, 1, [2.0**50, 3.0]), (1, 1, [2.0**50, 5.0]), (2, 2, [2.0**50, 4.0])]
    r = negatives.mine(table_of(spark, huge), F.expr("vec_id = 0")).collect()
    assert [(x.positive_id, x.negative_id, x.negative_score) for x in r] == [(1, 2, 2**63 - 1)]
    with pytest.raises(ValueError):
        negatives.mine(alone, F.expr("vec_id = 0"), low=0)


def test_products_are_exact():
    a = np.array([[2.0**30, 1.0], [3.0, 4.0], [2.0**40, -1.0]])
    b = np.array([[2.0**31, 1.0], [1.0, 2.0]])
    want = [[int(x[0]) * int(y[0]) + int(x[1]) * int(y[1]) for y in b] for x in a]
    assert [[int(x) for x in row] for row in negatives.products(a, b)] == want
