"""Hard negatives: for an anchor and each of its positives, the best rows of other labels
whose score lies in a window below the positive's score.

*Positives* of an anchor are its ``n_positives`` best other rows of the same label. A
positive of score p allows negatives of ``low * p <= 100 * score <= high * p`` (``low`` and
``high`` in percent).

*Slot-decomposed selection*: an anchor's windows overlap, so their upper limits, in
descending order, cut the scores into disjoint slots. Tasks keep the best ``k`` rows of each
slot only, and those are merged once; then, from the lowest slot up, the best ``k`` of a slot
and of all below it answer that slot's window (the lower limit only ends the list).

Anchors come in blocks of ``block_rows`` (fewer if vectors are long: at most ``BLOCK_BYTES``
of them are broadcast at once), each against all rows in two passes over the packed table:
positives, then slots. No row is copied per block or shuffled; what is shuffled are the
best rows of each task. The work is that of a stated set of queries against all rows.

Defined results: vectors that are null, hold null or non-finite components (also after
scaling), rows without id or label take no part. Labels must be integers. Components become
``floor(scale * x)``; scores are exact integers of any size for the order and the windows up to
38 digits, beyond which they count as the largest such number, and are returned as the
nearest long. Vectors of different lengths never meet. Repeated rows are rows of their own:
the copy of an anchor is one of its other rows. Ties go to the smaller id. Anchors without
positives, and windows without negatives (as below a negative score), give no rows; so does
an empty table. Other columns are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtally.llm.common import by_value
from logtally.session import scratch_path

SHARD_ROWS = 4096
BLOCK_ROWS = 2048
BLOCK_BYTES = 1 << 25
STRIP = 256  # anchors scored together
EXACT = float(1 << 53)  # integers below it are exact doubles
MOST = 10**38 - 1

SHARD = "shard string, dim int, peak double, ids binary, labels binary, asks binary, points binary"
FOUND = "a int, anchor_id long, slot int, score decimal(38,0), id long"


def pack(scale: float):
    """Arrow batches of ``(id, label, asks, x)`` to shards of one dimension each."""

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, SHARD_ROWS):
                part = b.slice(at, SHARD_ROWS)
                x = part.column(3)
                dims = np.diff(x.offsets.to_numpy())
                flat = x.flatten().to_numpy(zero_copy_only=False)  # null: not a number
                ends = np.cumsum(dims)
                ids, labels, asks = (part.column(i).to_numpy(zero_copy_only=False) for i in range(3))
                for dim in np.unique(dims):
                    of = np.flatnonzero(dims == dim)
                    with np.errstate(over="ignore", invalid="ignore"):
                        points = np.floor(scale * flat[(ends[of] - dim)[:, None] + np.arange(dim)].reshape(len(of), dim))
                    fine = np.isfinite(points).all(axis=1)
                    of, points = of[fine], points[fine]
                    if not len(of):
                        continue
                    peak = float(np.abs(points).max(initial=0.0))
                    kind = "<i2" if peak < 1 << 15 else "<f8"
                    cols = [uuid.uuid4().hex, int(dim), peak, ids[of].astype("<i8").tobytes(), labels[of].astype("<i8").tobytes()]
                    cols += [asks[of].astype(np.uint8).tobytes(), points.astype(kind).tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cols, types, strict=True)], names=names)

    names = ["shard", "dim", "peak", "ids", "labels", "asks", "points"]
    types = [pa.string(), pa.int32(), pa.float64(), *[pa.binary()] * 4]
    return run


def opened(shard: dict) -> dict:
    """A shard's arrays."""
    ids = np.frombuffer(shard["ids"], "<i8")
    kind = "<i2" if shard["peak"] < 1 << 15 else "<f8"
    points = np.frombuffer(shard["points"], kind).reshape(len(ids), shard["dim"]).astype(np.float64)
    labels, asks = np.frombuffer(shard["labels"], "<i8"), np.frombuffer(shard["asks"], np.uint8)
    return {**shard, "ids": ids, "labels": labels, "asks": asks.astype(bool), "points": points}


def anchors_of(batches):
    """The rows of shards that ask."""
    for b in batches:
        for shard in map(opened, b.to_pylist()):
            rows = np.flatnonzero(shard["asks"])
            if len(rows):
                cols = [
                    pa.array([shard["shard"]] * len(rows), pa.string()),
                    pa.array(rows, pa.int32()),
                    pa.array(shard["ids"][rows], pa.int64()),
                    pa.array(shard["labels"][rows], pa.int64()),
                    pa.array([shard["dim"]] * len(rows), pa.int32()),
                    pa.array([p.tobytes() for p in shard["points"][rows]], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=["shard", "row", "id", "label", "dim", "point"])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products: doubles where they cannot round, else Python's integers."""
    peaks = np.abs(a).max(axis=1, initial=0.0), np.abs(b).max(axis=1, initial=0.0)
    dim = max(1, a.shape[1])
    if not len(a) or not len(b) or peaks[0].max() * peaks[1].max() * dim < EXACT:
        return a @ b.T
    out = np.empty((len(a), len(b)), object)
    wide = [np.flatnonzero(p * p * dim >= EXACT) for p in peaks]
    rest = [np.setdiff1d(np.arange(len(p)), w) for p, w in zip(peaks, wide, strict=True)]
    if len(rest[0]) and len(rest[1]):
        plain = a[rest[0]] @ b[rest[1]].T
        out[np.ix_(*rest)] = np.array([[int(x) for x in row] for row in plain], object).reshape(plain.shape)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    clip = lambda m: np.clip(m, -MOST, MOST) if m.size else m
    a_all, b_all = whole(a), whole(b)
    if len(wide[0]):
        out[wide[0]] = clip(a_all[wide[0]] @ b_all.T)
    if len(wide[1]) and len(rest[0]):
        out[np.ix_(rest[0], wide[1])] = clip(a_all[rest[0]] @ b_all[wide[1]].T)
    return out


def best(found: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """Of ``(anchor, slot, score, id)`` the ``k`` best of every anchor and slot, in order."""
    a, slot, score, ids = found
    if score.dtype == object:  # order by place among the different scores
        places = {s: i for i, s in enumerate(sorted(set(score.tolist())))}
        rank = np.array([places[s] for s in score.tolist()], np.int64)
    else:
        rank = score
    order = np.lexsort((ids, -rank, slot, a))
    a, slot, score, ids = (c[order] for c in (a, slot, score, ids))
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (slot[1:] != slot[:-1])]) if len(a) else np.zeros(0, int)
    place = np.arange(len(a)) - np.repeat(first, np.diff(np.r_[first, len(a)]))
    return tuple(c[place < k] for c in (a, slot, score, ids))


NOTHING = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.float64, np.int64))


def joined(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def same_label(block: dict, shard: dict, strip: slice, k: int):
    """``(anchor, 0, score, id)``: candidates for the positives of some anchors."""
    out = []
    for label in np.unique(block["labels"][strip]):
        rows = np.flatnonzero(block["labels"][strip] == label) + strip.start
        cols = np.flatnonzero(shard["labels"] == label)
        if not len(cols):
            continue
        scores = products(block["points"][rows], shard["points"][cols])
        other = (block["shard"][rows] != shard["shard"])[:, None] | (block["row"][rows][:, None] != cols)
        if scores.dtype != object and len(cols) > k + 1:  # one may be the anchor itself
            kth = np.partition(scores, len(cols) - k - 1, axis=1)[:, len(cols) - k - 1]
            other &= scores >= kth[:, None]
        r, c = np.nonzero(other)
        out.append((rows[r], np.zeros(len(r), np.int64), scores[r, c], shard["ids"][cols[c]]))
    return joined(out) if out else NOTHING


def in_windows(block: dict, shard: dict, strip: slice, k: int):
    """``(anchor, slot, score, id)``: rows of other labels within an anchor's windows."""
    scores = products(block["points"][strip], shard["points"])
    high, low = block["high"][strip], block["low"][strip]
    kind = object if scores.dtype == object else np.float64
    wanted = (scores <= high[:, 0].astype(kind)[:, None]) & (scores >= low.astype(kind)[:, None])
    wanted = wanted.astype(bool) & (block["labels"][strip][:, None] != shard["labels"])
    r, c = np.nonzero(wanted)
    score = scores[r, c]
    slot = (high[r].astype(kind) >= score[:, None]).astype(bool).sum(axis=1) - 1
    return r + strip.start, slot, score, shard["ids"][c]


def sweep(shards: DataFrame, block: dict, look, k: int) -> DataFrame:
    """One pass of a block of anchors over all shards of its dimension: the best ``k`` of
    every anchor and slot, of each task and then of all."""
    held = shards.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        block, state = held.value, NOTHING
        for b in batches:
            for shard in map(opened, b.to_pylist()):
                parts = [state]
                for at in range(0, len(block["ids"]), STRIP):
                    strip = slice(at, min(at + STRIP, len(block["ids"])))
                    parts.append(best(look(block, shard, strip, k), k))
                state = best(joined(parts), k)
        a, slot, score, ids = state
        if len(a):
            exact = [max(-MOST, min(MOST, int(s))) for s in score.tolist()]
            cols = [pa.array(a, pa.int32()), pa.array(block["ids"][a], pa.int64()), pa.array(slot, pa.int32())]
            cols += [pa.array(exact, pa.decimal128(38, 0)), pa.array(ids, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["a", "anchor_id", "slot", "score", "id"])

    rows = shards.where(F.col("dim") == block["dim"]).mapInArrow(run, FOUND)
    order = Window.partitionBy("a", "slot").orderBy(F.desc("score"), F.asc("id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """The scores allowed by a positive's: the first and the last."""
    return -(-low * score // 100), high * score // 100


def answers(low: int, high: int, k: int):
    """Rows ``(anchor_id, positives, tops)`` to the result: suffix merges of the slots."""

    def run(batches):
        for b in batches:
            out = []
            for anchor, positives, tops in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                positives = sorted(positives or (), key=lambda p: p["rank"])
                slots = [[] for _ in positives]
                for t in tops or ():
                    slots[t["slot"]].append((-int(t["score"]), t["id"]))
                below = []
                for i in range(len(positives) - 1, -1, -1):
                    below = sorted(slots[i] + below)[:k]
                    p = positives[i]
                    least, _ = window_of(int(p["score"]), low, high)
                    for rank, (score, negative) in enumerate(below, 1):
                        if -score < least:
                            break
                        out.append((anchor, p["id"], rank, negative, int(p["score"]), -score, p["rank"]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.decimal128(38, 0), pa.decimal128(38, 0), pa.int32()]
    return run


def mine(
    table: DataFrame,
    anchors: Column,
    n_positives: int = 5,
    k: int = 5,
    low: int = 80,
    high: int = 100,
    scale: float = 256.0,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score,
    positive_rank)``; ``anchors`` is a predicate on the rows of ``table``."""
    if low <= 0 or high <= 0:
        raise ValueError("window limits are percentages above 0")
    spark = table.sparkSession
    path = scratch_path(spark, "negatives")
    rows = table.select(
        table[id_col].cast("long").alias("id"),
        table[label_col].cast("long").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("asks"),
        table[vector_col].cast("array<double>").alias("x"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
    rows.mapInArrow(pack(scale), SHARD).write.parquet(f"{path}/shards")
    shards = spark.read.schema(SHARD).parquet(f"{path}/shards")
    asking = "shard string, row int, id long, label long, dim int, point binary"
    shards.mapInArrow(anchors_of, asking).write.parquet(f"{path}/anchors")
    asked = spark.read.schema(asking).parquet(f"{path}/anchors")
    counts = asked.groupBy("dim").count().collect()  # one row per length of vectors
    blocks = {r["dim"]: -(-r["count"] // max(1, min(block_rows, BLOCK_BYTES // (8 * r["dim"] or 1)))) for r in counts}
    many = F.create_map(*(F.lit(x) for pair in blocks.items() for x in pair)) if blocks else F.lit(None)
    block = F.pmod(F.xxhash64("shard", "row"), many[F.col("dim")]).cast("int") if blocks else F.lit(0)
    dealt = asked.withColumn("block", block).repartition("dim", "block")
    dealt.write.partitionBy("dim", "block").parquet(f"{path}/blocks")
    for dim, n in blocks.items():
        for i in range(n):
            _mine_block(spark, shards, path, dim, i, n_positives, k, low, high)
    keys = ("dim", "block", "a", "anchor_id")
    kept = f"dim int, block int, {FOUND}, rank int"
    empty = spark.createDataFrame([], kept)
    found = {name: spark.read.schema(kept).parquet(f"{path}/{name}") if blocks else empty for name in ("positives", "tops")}
    listed = lambda name, *cols: F.collect_list(F.struct(*cols)).alias(name)
    positives = found["positives"].groupBy(*keys).agg(listed("positives", "rank", "score", "id"))
    tops = found["tops"].groupBy(*keys).agg(listed("tops", "slot", "score", "id"))
    both = positives.join(tops, list(keys)).select("anchor_id", "positives", "tops")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score decimal(38,0), "
    out = both.mapInArrow(answers(low, high, k), schema + "negative_score decimal(38,0), positive_rank int")
    fits = lambda c: F.greatest(F.least(c, F.lit(2**63 - 1)), F.lit(-(2**63))).cast("long").alias(c)
    return out.select(
        "anchor_id", "positive_id", "rank", "negative_id", fits("positive_score"), fits("negative_score"), "positive_rank"
    )


def _mine_block(spark, shards, path, dim, i, n_positives, k, low, high) -> None:
    """Both passes of one block of anchors; at most ``block_rows`` anchors on average, with
    ``n_positives`` scores each, come to the driver and go to the tasks."""
    dealt = spark.read.parquet(f"{path}/blocks").where((F.col("dim") == dim) & (F.col("block") == i))
    rows = dealt.orderBy("shard", "row").collect()
    if not rows:
        return
    block = {
        "dim": dim,
        "shard": np.array([r["shard"] for r in rows]),
        "row": np.array([r["row"] for r in rows]),
        "ids": np.array([r["id"] for r in rows], np.int64),
        "labels": np.array([r["label"] for r in rows], np.int64),
        "points": np.frombuffer(b"".join(bytes(r["point"]) for r in rows), np.float64).reshape(len(rows), dim),
    }
    at = f"dim={dim}/block={i}"
    sweep(shards, block, same_label, n_positives).write.parquet(f"{path}/positives/{at}")
    low_of, high_of = np.full(len(rows), None, object), np.full((len(rows), n_positives), -MOST - 1, object)
    kept = spark.read.parquet(f"{path}/positives/{at}").select("a", "rank", "score").collect()
    for a, rank, score in kept:
        least, most = window_of(int(score), low, high)
        high_of[a, rank - 1] = most
        low_of[a] = least if low_of[a] is None else min(low_of[a], least)
    asks = np.array([x is not None for x in low_of])
    block |= {"low": np.where(asks, low_of, MOST + 1), "high": high_of}
    sweep(shards, block, in_windows, k).write.parquet(f"{path}/tops/{at}")


by_value(__name__)
