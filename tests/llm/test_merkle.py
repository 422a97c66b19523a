"""The Merkle manifest against a tree built in plain Python."""

import hashlib
import zlib
from collections import defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from logtally.llm import merkle
from tests.conftest import SF_ORACLE


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def levels(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def siblings(tree, at, fanout):
    """Per level: the run, with None in the node's own place."""
    out = []
    for nodes in tree[:-1]:
        a = at // fanout * fanout
        out.append([None if i == at else nodes[i] for i in range(a, min(a + fanout, len(nodes)))])
        at //= fanout
    return out


def key(lang):
    return (lang is not None, (lang or "").encode())


def brute(rows, fanout=2):
    """``rows`` of (order, group, leaf); yields (order, leaf, subroot, root, proof)."""
    groups = defaultdict(list)
    for o, g, x in rows:
        groups[g].append((o is not None, o or 0, x))
    order = sorted(groups, key=key)
    trees = {g: levels([x for *_, x in sorted(groups[g])], fanout) for g in order}
    top = levels([trees[g][-1][0] for g in order], fanout)
    for i, g in enumerate(order):
        for at, (has, o, x) in enumerate(sorted(groups[g])):
            proof = siblings(trees[g], at, fanout) + siblings(top, i, fanout)
            yield (o if has else None), x, trees[g][-1][0], top[-1][0], proof


def fold(node, proof):
    for run in proof:
        node = sha("".join(node if x is None else x for x in run))
    return node


def test_query(spark):
    docs = pq.read_table(f"{SF_ORACLE}/documents.parquet").to_pylist()
    fields = {d["doc_id"]: (d["doc_id"], d["source"], d["lang"], d["n_chars"], d["text"]) for d in docs}
    want = set()
    for doc_id, x, subroot, root, proof in brute([(d["doc_id"], d["lang"], leaf(*fields[d["doc_id"]])) for d in docs]):
        i, source, lang, n, text = fields[doc_id]
        hit = zlib.crc32(str(doc_id).encode()) % 7 == 0 and n is not None
        back = fold(leaf(i, source, lang, n + 1, text) if hit else x, proof)
        digest = sha("".join(x for run in proof for x in run if x is not None))
        want.add((doc_id, x, subroot, root, digest, back, back == root))
    got = E.queries()["op12_merkle_manifest"](spark, SF_ORACLE)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(docs) and set(got) == want
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize(("fanout", "block_levels", "swap_levels"), [(2, 1, 1), (2, 2, 2), (3, 1, 1), (2, 3, 2)])
def test_rounds_of_swaps(spark, fanout, block_levels, swap_levels):
    """Small partitions, so that several rounds and short last subtrees occur."""
    sizes = {"a": 1, "b": 2, "c": 7, "d": 53, "é": 16, "z": 33, None: 5, "": 3}
    rows = [(i, g, sha(f"{g}{i}")) for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, leaf string").repartition(5)
    got = merkle.manifest(df, fanout=fanout, block_levels=block_levels, swap_levels=swap_levels).withColumn(
        "folded", merkle.folded(F.col("leaf"), F.col("proof"))
    )
    got = sorted((r.leaf, r.doc_id, r.subroot, r.root, r.proof, r.folded) for r in got.collect())
    want = sorted(
        (x, o, subroot, root, [["" if e is None else e for e in run] for run in proof], root)
        for o, x, subroot, root, proof in brute(rows, fanout)
    )
    assert got == want


def test_edges(spark):
    """Nulls, ties, repeated rows, an empty table, other columns of the same names."""
    schema = "doc_id long, lang string, leaf string, g string, o string, at string, node string, proof string"
    rows = [(i, g, x) for i, g, x in [(1, None, "p"), (1, None, "p"), (None, None, "q"), (None, "en", "r"), (2, "en", "s"), (2, "en", "a")]]
    df = spark.createDataFrame([(*r, *["clash"] * 5) for r in rows], schema)
    got = merkle.manifest(df, block_levels=1, swap_levels=1)
    assert sorted((r.doc_id or -1, r.leaf, r.subroot, r.root) for r in got.collect()) == sorted(
        (o or -1, x, s, t) for o, x, s, t, _ in brute(rows)
    )
    assert merkle.manifest(df.limit(0)).collect() == []
    alone = merkle.manifest(df.limit(1)).collect()
    assert [(r.root, r.proof, r.position) for r in alone] == [("p", [], 0)]
    with pytest.raises(ValueError):
        merkle.manifest(df, fanout=1)


def test_leaf_of(spark):
    rows = [(1, "é", None), (None, "", 5)]
    df = spark.createDataFrame(rows, "a long, b string, c int")
    got = [r[0] for r in df.select(merkle.leaf_of(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == [leaf(*r) for r in rows]
