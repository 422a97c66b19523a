"""Exact top-k inner-product search with one KD-tree per shard.

Vectors are dealt to shards of about ``shard_rows`` rows. A task builds its shard's tree
(median splits along the widest side, tight bounding boxes) and answers a block of
queries best-first: a box's bound is the largest inner product any of its points could
have, and the search of a query ends at the first box whose bound cannot beat its k-th
score. Each query first visits one shard; the k-th score found there is propagated to
its visits of all other shards, where it prunes from the start. A box with a bound equal
to the k-th score is skipped only if all its ids are larger, so ties go to smaller ids.

Queries go to the shards in blocks of at most ``block_rows`` on average: a stated query
set against all rows, whose work is the product of both.

Scores are exact: where products could pass 2**62 (also a box's bound, which sums the largest
product of every component), a task calculates with Python's integers.

Defined results: components become ``floor(1024 * x)``; vectors that are null or hold null or
non-finite components (also after scaling) take no part, nor do rows without id; vectors of
different lengths never meet; repeated rows are rows of their own, as queries and as
candidates, so the copy of a query is one of its candidates; a query with fewer than k
candidates returns all of them; an empty table gives no rows. Scores are compared up to 38
digits, beyond which they count as the largest such number, and returned as the nearest long.
"""

from __future__ import annotations

import heapq
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtally.llm.common import by_value, reliable

SCALE = 1024
LEAF = 256
FITS = float(1 << 62)
MOST = 10**38 - 1
SCORE = "decimal(38,0)"


def quantized(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", asks: Column | None = None) -> DataFrame:
    """``(row, id, x, dim, asks)`` of the vectors that take part: a number of the row, and the
    scaled components, which the tasks round down."""
    asks = F.lit(False) if asks is None else F.coalesce(asks, F.lit(False))
    x = table.select(table[id_col].alias("id"), table[vector_col].cast("array<double>").alias("x"), asks.alias("asks"))
    scaled = x.where("id IS NOT NULL AND x IS NOT NULL").withColumn("x", F.transform("x", lambda e: SCALE * e))
    fine = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return scaled.where(fine).withColumns({"row": F.monotonically_increasing_id(), "dim": F.size("x")})


def whole(rows: pd.Series) -> np.ndarray:
    """Scaled vectors as a matrix of integers: int64, or Python's where these may be too large."""
    x = np.floor(np.stack(rows.to_numpy()).astype(np.float64))
    return x.astype(np.int64) if np.abs(x).max(initial=0.0) < FITS else np.array([[int(e) for e in r] for r in x], object)


def comparable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices in a type in which their products and sums of products are exact."""
    peak = [max((abs(int(e)) for e in (m.min(initial=0), m.max(initial=0))), default=0) for m in (a, b)]
    if a.dtype != object and b.dtype != object and peak[0] * peak[1] * max(1, a.shape[1]) < FITS:
        return a, b
    return a.astype(object), b.astype(object)


def best_first(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The order by score, highest first, then id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])), np.int64)
    return np.lexsort((ids, -scores))


class KDTree:
    """Tight boxes over the rows of ``points``, which are reordered leaf by leaf."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF, rows: np.ndarray | None = None) -> None:
        self.order = np.arange(len(ids))
        self.points, self.leaf = points, leaf
        self.ids, self.rows = ids, ids if rows is None else rows
        self.nodes: list[tuple[int, int, int, int]] = []  # from, to, left, right (-1: a leaf)
        self.lo: list[np.ndarray] = []
        self.hi: list[np.ndarray] = []
        self.least: list[int] = []
        self._build()
        self.points, self.ids, self.rows = points[self.order], ids[self.order], self.rows[self.order]
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)

    def _add(self, a: int, b: int) -> int:
        own = self.points[self.order[a:b]]
        self.nodes.append((a, b, -1, -1))
        self.lo.append(own.min(axis=0))
        self.hi.append(own.max(axis=0))
        self.least.append(int(self.ids[self.order[a:b]].min()))
        return len(self.nodes) - 1

    def _build(self) -> None:
        todo = [self._add(0, len(self.ids))]
        while todo:
            k = todo.pop()
            a, b, _, _ = self.nodes[k]
            spread = self.hi[k] - self.lo[k]
            if b - a <= self.leaf or not spread.any():
                continue
            mid = (a + b) // 2
            side = self.points[self.order[a:b], int(spread.argmax())]
            split = np.argsort(side) if side.dtype == object else np.argpartition(side, mid - a)
            self.order[a:b] = self.order[a:b][split]
            left, right = self._add(a, mid), self._add(mid, b)
            self.nodes[k] = (a, b, left, right)
            todo += [left, right]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For every query and node, the largest inner product within the node's box."""
        return np.maximum(queries, 0) @ self.hi.T + np.minimum(queries, 0) @ self.lo.T

    def search(self, own: int, q: np.ndarray, bound: np.ndarray, k: int, kth: tuple[int, int] | None):
        """The best ``k`` (ids, scores) other than row ``own`` that also beat ``kth``, a (score,
        id) known before."""
        ids, scores = np.empty(0, np.int64), np.empty(0, self.points.dtype)
        heap = [(-int(bound[0]), self.least[0], 0)]
        while heap:
            best, least, node = heapq.heappop(heap)
            if kth is not None and (-best, -least) <= (kth[0], -kth[1]):
                break
            a, b, left, right = self.nodes[node]
            if left >= 0:
                for c in (left, right):
                    heapq.heappush(heap, (-int(bound[c]), self.least[c], c))
                continue
            got, found = self.points[a:b] @ q, self.ids[a:b]
            take = self.rows[a:b] != own
            if kth is not None:
                take &= ((got > kth[0]) | ((got == kth[0]) & (found < kth[1]))).astype(bool)
            if not take.any():
                continue
            ids, scores = np.concatenate([ids, found[take]]), np.concatenate([scores, got[take]])
            top = best_first(scores, ids)[:k]
            ids, scores = ids[top], scores[top]
            if len(ids) == k:
                kth = (int(scores[-1]), int(ids[-1]))
        return ids, scores


def _visit(k: int):
    """The search of one shard for one block of queries, for cogroup().applyInPandas."""

    def run(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(points) and len(queries):
            p, q = comparable(whole(points["x"]), whole(queries["x"]))
            tree = KDTree(points["id"].to_numpy(np.int64), p, rows=points["row"].to_numpy(np.int64))
            bounds = tree.bounds(q)
            known = zip(queries["row"], queries["id"], queries["kth_score"], queries["kth_id"], strict=True)
            for n, (row, qid, score, last) in enumerate(known):
                kth = None if pd.isna(score) else (int(score), int(last))
                ids, scores = tree.search(int(row), q[n], bounds[n], k, kth)
                exact = [Decimal(max(-MOST, min(MOST, int(s)))) for s in scores]
                out.append(pd.DataFrame({"row": int(row), "query_id": int(qid), "vec_id": ids, "score": pd.Series(exact, dtype=object)}))
        if not out:
            return pd.DataFrame({c: np.empty(0, np.int64) for c in ("row", "query_id", "vec_id")} | {"score": np.empty(0, object)})
        return pd.concat(out, ignore_index=True)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    table: DataFrame,
    queries: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = 8192,
    block_rows: int = 2048,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best other rows of every row of ``table``
    for which the predicate ``queries`` holds."""
    # Cut: the rows' numbers must not change when a task runs again.
    points = reliable(quantized(table, id_col, vector_col, queries))
    # New names for the columns, since the rows meet themselves.
    asked = points.where("asks").select(*(F.col(c).alias(c) for c in ("row", "id", "x", "dim")))
    shards, blocks = -(-points.count() // shard_rows) or 1, -(-asked.count() // block_rows) or 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # The rows' hashes deal rows to shards and blocks; seeds apart, so that a block's queries
    # do not share a shard.
    dealt = points.drop("asks").withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    dealt = dealt.withColumn("block", every(blocks))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("row", F.lit("block")), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("home", F.pmod(F.xxhash64("row", F.lit("home")), F.lit(shards)).cast("int"))
    key = ("dim", "shard", "block")
    schema = f"row long, query_id long, vec_id long, score {SCORE}"

    def visits(q: DataFrame) -> DataFrame:
        return dealt.groupBy(*key).cogroup(q.groupBy(*key)).applyInPandas(_visit(k), schema)

    none = {"kth_score": F.lit(None).cast(SCORE), "kth_id": F.lit(None).cast("long")}
    at_home = asked.withColumns({"shard": F.col("home"), **none})
    first = reliable(_best(visits(at_home), k))
    kth = first.where(F.col("rank") == k).select(
        F.col("row").alias("q"), F.col("score").alias("kth_score"), F.col("vec_id").alias("kth_id")
    )
    away = asked.join(kth, F.col("row") == F.col("q"), "left").withColumn("shard", every(shards))
    rest = visits(away.where("shard <> home"))
    score = F.greatest(F.least("score", F.lit(2**63 - 1)), F.lit(-(2**63))).cast("long")
    return _best(first.select("row", "query_id", "vec_id", "score").union(rest), k).select(
        "query_id", "rank", "vec_id", score.alias("score")
    )


by_value(__name__)
