"""Merkle manifest of a dataset: a root, and for every row the proof that leads to it.

Rows are leaves. In each group the leaves, in order, are hashed in runs of ``fanout`` (the
last run may be shorter), level by level, until one node is left; the groups' nodes, in
order of the group, likewise give the root. A node is the sha256 (lowercase hex) of its
run's digests joined as text, so a run of one is hashed, too; a lone leaf is its own root.

The leaves of a group are numbered by ranges (no group is gathered in one task) and cut
into aligned partitions of ``fanout ** block_levels``, each of which hashes its own subtree.
Upper levels are a **butterfly exchange**: in round r, ``fanout ** swap_levels`` partitions
that stand at one place in neighbouring subtrees swap the subtrees' roots, and each hashes
the common ancestors for itself. So every partition climbs to the root and holds its
upper proof when it gets there; nothing is sent down again. Where the last subtree has
fewer partitions than the others, each of them stands in for the missing places.

A proof is one run per level, with ``''`` at the place of the node itself: the siblings are
the other entries, and :func:`folded` hashes a leaf up along it.

Defined results: rows without group (null) come before all groups, rows without order value
before the others of their group, and ties go by their leaf; repeated rows are leaves of
their own; an empty table gives no rows. Columns other than those named are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtally.llm.common import by_value, stored

BLOCK_LEVELS = 10
SWAP_LEVELS = 3
SALTS = 16
PROOF = "array<array<string>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_of(*fields: Column) -> Column:
    """The leaf of some fields: each ``-`` if null, else its UTF-8 byte count, ``:`` and it."""
    parts = []
    for f in fields:
        text = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(F.concat(*parts))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` leads to along ``proof``."""

    def up(node: Column, run: Column) -> Column:
        return digest(F.array_join(F.transform(run, lambda x: F.when(x == "", node).otherwise(x)), ""))

    return F.aggregate(proof, leaf, up)


def proof_digest(proof: Column) -> Column:
    """The hash of all siblings, level by level."""
    return digest(F.array_join(F.flatten(proof), ""))


def subtree(nodes: list[str], fanout: int, levels: int | None) -> tuple[list[str], list[list[list[str]]]]:
    """The nodes after ``levels`` levels (None: until one is left), and per level and node
    its run, with ``''`` in its own place."""
    runs_of = []
    while (len(nodes) > 1) if levels is None else (len(runs_of) < levels):
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        runs_of.append([[*run[:k], "", *run[k + 1 :]] for run in runs for k in range(len(run))])
        nodes = [hashlib.sha256("".join(run).encode()).hexdigest() for run in runs]
    return nodes, runs_of


def path(runs_of: list[list[list[str]]], at: int, fanout: int) -> list[list[str]]:
    """The proof of node ``at`` within a subtree."""
    out = []
    for runs in runs_of:
        out.append(runs[at])
        at //= fanout
    return out


def _blocks(leaves: DataFrame, fanout: int, block_levels: int) -> DataFrame:
    """``(g, n_blocks, block, leaves)`` from ``(g, o, leaf, kept)``: aligned runs of leaves,
    each an array of ``(at, leaf, kept)``."""
    size = fanout**block_levels
    dealt = leaves.repartitionByRange("g", "o", "leaf").withColumn("part", F.spark_partition_id())
    placed = stored(dealt, "merkle-leaves")
    # One row a group and range of rows.
    counts = placed.groupBy("g", "part").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("g")
    before = counts.select(
        F.col("g").alias("c_g"),
        F.col("part").alias("c_part"),
        (F.sum("n").over(whole.orderBy("part")) - F.col("n")).alias("before"),
        F.ceil(F.sum("n").over(whole) / size).cast("long").alias("n_blocks"),
    )
    inside = F.row_number().over(Window.partitionBy("g", "part").orderBy("o", "leaf")) - 1
    at = (F.col("before") + F.col("inside")).alias("at")
    same = (F.col("g") == F.col("c_g")) & (F.col("part") == F.col("c_part"))
    numbered = placed.withColumn("inside", inside).join(before, same).select("g", "n_blocks", at, "leaf", "kept")
    runs = numbered.groupBy("g", "n_blocks", F.floor(F.col("at") / size).cast("long").alias("block"))
    return stored(runs.agg(F.sort_array(F.collect_list(F.struct("at", "leaf", "kept"))).alias("leaves")), "merkle-blocks")


def _block_roots(blocks: DataFrame, fanout: int, block_levels: int) -> DataFrame:
    def run(batches):
        for b in batches:
            nodes = []
            for n, leaves in zip(b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
                nodes += subtree(leaves, fanout, None if n == 1 else block_levels)[0]
            cols = [*b.columns[:3], pa.array(nodes, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["g", "n_blocks", "block", "node"])

    rows = blocks.select("g", "n_blocks", "block", F.col("leaves.leaf"))
    return rows.mapInArrow(run, "g string, n_blocks long, block long, node string")


def _swap(state: DataFrame, fanout: int, swap_levels: int, reach: int) -> DataFrame:
    """One round: subtrees of ``reach`` partitions become subtrees of ``reach * members``."""
    members = fanout**swap_levels
    n_trees = F.ceil(F.col("n_blocks") / reach).cast("long")
    tree, place = F.floor(F.col("block") / reach).cast("long"), F.col("block") % reach
    held = F.col("n_blocks") - F.col("tree") * reach  # partitions of the subtree, if it is the last
    stand_in = (held < reach) & (F.col("tree") % members > 0)
    places = F.when(stand_in, F.sequence("place", F.lit(reach - 1), held)).otherwise(F.array("place"))
    sent = state.withColumns({"n_trees": n_trees, "tree": tree, "place": place})
    sent = sent.withColumn("to", F.explode(places)).withColumn("own", F.col("to") == F.col("place"))
    own = F.struct("tree", "node", "block", "own", F.when(F.col("own"), F.col("proof")).alias("proof"))
    groups = sent.groupBy("g", "n_blocks", "n_trees", F.floor(F.col("tree") / members).alias("up"), "to").agg(
        F.sort_array(F.collect_list(own)).alias("held")
    )

    def run(batches):
        for b in batches:
            out = []
            for g, n, n_trees, held in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                nodes, runs_of = subtree([m["node"] for m in held], fanout, None if n_trees <= members else swap_levels)
                for i, m in enumerate(held):
                    if m["own"]:
                        out.append((g, n, m["block"], nodes[0], m["proof"] + path(runs_of, i, fanout)))
            cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)] if out else []
            if cols:
                yield pa.RecordBatch.from_arrays(cols, names=names)

    names = ["g", "n_blocks", "block", "node", "proof"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.string()))]
    rows = groups.select("g", "n_blocks", "n_trees", "held")
    return rows.mapInArrow(run, f"g string, n_blocks long, block long, node string, proof {PROOF}")


def _climb(blocks: DataFrame, fanout: int, block_levels: int, swap_levels: int) -> DataFrame:
    """``(g, block, node, proof)``: each partition's group root, and its proof up to there."""
    most = blocks.agg(F.max("n_blocks")).first()[0] or 1
    state = _block_roots(blocks, fanout, block_levels).withColumn("proof", F.array().cast(PROOF))
    reach = 1
    while reach < most:
        state = _swap(state, fanout, swap_levels, reach)
        reach *= fanout**swap_levels
    return stored(state.select("g", "block", "node", "proof"), "merkle-upper")


def _proofs(blocks: DataFrame, upper: DataFrame, fanout: int, block_levels: int) -> DataFrame:
    """``(g, at, leaf, kept, subroot, root, proof)`` of every leaf; ``upper`` holds each
    partition's proof above its own subtree."""
    above = upper.select(F.col("g").alias("u_g"), F.col("block").alias("u_block"), "subroot", "root", F.col("proof").alias("above"))
    joined = blocks.join(above, (F.col("g") == F.col("u_g")) & (F.col("block") == F.col("u_block")))
    rows = joined.select("g", "n_blocks", "subroot", "root", "above", F.col("leaves.leaf").alias("nodes"), F.col("leaves.at").alias("at"), F.col("leaves.kept").alias("kept"))

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                g, n_blocks, subroot, root, above, nodes = (b.column(c)[i].as_py() for c in range(6))
                _, runs_of = subtree(nodes, fanout, None if n_blocks == 1 else block_levels)
                n = len(nodes)
                cols = [pa.array([x] * n, pa.string()) for x in (g, subroot, root)]
                proofs = pa.array([path(runs_of, k, fanout) + above for k in range(n)], pa.list_(pa.list_(pa.string())))
                cols += [b.column(6)[i].values, pa.array(nodes, pa.string()), b.column(7)[i].values, proofs]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    names = ["g", "subroot", "root", "at", "leaf", "kept", "proof"]
    kept = blocks.schema["leaves"].dataType.elementType["kept"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"g string, subroot string, root string, at long, leaf string, kept {kept}, proof {PROOF}"
    )


def manifest(
    rows: DataFrame,
    leaf_col: str = "leaf",
    group_col: str = "lang",
    order_col: str = "doc_id",
    keep: tuple[str, ...] = ("doc_id",),
    fanout: int = 2,
    block_levels: int = BLOCK_LEVELS,
    swap_levels: int = SWAP_LEVELS,
) -> DataFrame:
    """The ``keep`` columns and ``leaf``, ``position`` (in its group), ``subroot`` (of its
    group), ``root`` and ``proof`` of every row."""
    if fanout < 2 or block_levels < 1 or swap_levels < 1:
        raise ValueError("fanout is 2 at least, block_levels and swap_levels 1 at least")
    group = F.coalesce(F.concat(F.lit("="), rows[group_col].cast("string")), F.lit(""))  # null first
    leaves = rows.select(
        group.alias("g"),
        rows[order_col].alias("o"),
        rows[leaf_col].alias("leaf"),
        F.struct(*(rows[c] for c in keep)).alias("kept"),
    )
    # Written first: dealing out by ranges reads its rows twice, and leaves hash whole rows.
    blocks = _blocks(stored(leaves, "merkle-rows"), fanout, block_levels)
    upper = _climb(blocks, fanout, block_levels, swap_levels)
    # The groups' roots are the leaves of one more tree.
    tops = upper.where("block = 0").select(
        F.lit("").alias("g"), F.col("g").alias("o"), F.col("node").alias("leaf"), F.struct("g").alias("kept")
    )
    top_blocks = _blocks(tops, fanout, block_levels)
    top_upper = _climb(top_blocks, fanout, block_levels, swap_levels)
    top = _proofs(top_blocks, top_upper.withColumns({"subroot": F.col("node"), "root": F.col("node")}), fanout, block_levels)
    # A group of many partitions meets its one row in SALTS shares.
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    top = top.select(F.col("kept.g").alias("t_g"), salt.alias("t_salt"), "root", F.col("proof").alias("t_proof"))
    same = (F.col("g") == F.col("t_g")) & (F.col("block") % SALTS == F.col("t_salt"))
    upper = upper.join(top, same).select("g", "block", F.col("node").alias("subroot"), "root", F.concat("proof", "t_proof").alias("proof"))
    out = _proofs(blocks, stored(upper, "merkle-proofs"), fanout, block_levels)
    kept = [F.col("kept")[c].alias(c) for c in keep]
    return out.select(*kept, "leaf", F.col("at").alias("position"), "subroot", "root", "proof")


by_value(__name__)
