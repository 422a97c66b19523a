"""Removal of passages that repeat an earlier document, by difference-cover anchors.

A window is 13 consecutive words. Anchors are 7-word windows at positions whose remainder
modulo 7 lies in a difference cover: whatever the two positions of a repeated window, the
two copies hold an anchor at the same offset inside them. So only three of seven positions
are hashed; a window can be a repeat only if an anchor inside it occurs in two documents.

1. Of equal texts only the smallest document is looked at: the others repeat it whole.
   ``mapInArrow`` emits each document's distinct anchors. What a task can tell by itself
   it settles at once: of equal anchors in one block, one row is dealt out by the hash,
   the others are known to be shared and dealt by document. So a passage that a third of
   all documents share meets as one row per block of about a million anchors.
2. Every document gets back its shared anchors and extends them: the full windows around
   them are hashed and dealt out the same way; a window whose smallest document is another
   one is a repeat.
3. Every document gets back its repeats and drops the words under them.

All three steps read the texts from one exchange by document id. Anchor hashes (48 bits)
only choose candidates; windows are compared by 63 bits, whole texts by 96 and length.

Defined results: null and empty texts have no words; documents without id lose nothing
and repeat nothing; repeated rows of one id do not repeat each other; a text shorter than
a window is kept; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtally.llm.common import by_value

BLOCK = 1 << 20  # hashes that a task compares among themselves
ANCHOR_MASK = (1 << 48) - 1
WINDOW_MASK = (1 << 63) - 1
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def difference_cover(period: int) -> tuple[int, ...]:
    """The first smallest set of remainders whose differences are all remainders."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    raise ValueError("a period is at least 1")


def word_hashes(text: str | None) -> np.ndarray:
    # bytes.split splits at space and U+0009..U+000D.
    w = (text or "").encode().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))


def window_hashes(h: np.ndarray, words: int) -> np.ndarray:
    """A hash of every run of ``words`` consecutive words."""
    n = len(h) - words + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for k in range(words):
        acc = acc * FACTOR + h[k : k + n]
        acc ^= acc >> np.uint64(29)
    acc *= FACTOR
    return acc ^ (acc >> np.uint64(32))


def anchor_hashes(h: np.ndarray, words: int, period: int, cover: tuple[int, ...]):
    """Positions in the cover and the hashes of the anchors there."""
    all_hashes = window_hashes(h, words)
    at = np.flatnonzero(np.isin(np.arange(period), cover)[np.arange(len(all_hashes)) % period])
    return at, (all_hashes[at] & np.uint64(ANCHOR_MASK)).astype(np.int64)


def settle(hashes: list[np.ndarray], ids: list[int], all_known: bool) -> pa.RecordBatch:
    """Rows ``(key, doc, hash)`` of one block: per hash one row dealt by it (for the smallest
    document), the others dealt by document and known, which a non-null ``hash`` marks.
    ``all_known``: the first row of several is known too (it only counts that they exist)."""
    h = np.concatenate(hashes)
    d = np.repeat(np.array(ids, np.int64), [len(x) for x in hashes])
    order = np.lexsort((d, h))
    h, d = h[order], d[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[fresh], d[fresh]
    first = np.ones(len(h), bool)
    first[1:] = h[1:] != h[:-1]
    known = ~first
    if all_known:
        known[:-1] |= ~first[1:]
    key = np.where(first, h, np.where(d < 0, d, ~d))  # hashes are not negative
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(d), pa.array(h, mask=~known)], names=["key", "doc", "hash"]
    )


def _blocks(found, all_known: bool):
    """Record batches of ``settle`` over pairs ``(id, hashes)``."""
    ids, hashes, n = [], [], 0
    for i, h in found:
        if len(h):
            ids.append(i)
            hashes.append(h)
            n += len(h)
        if n >= BLOCK:
            yield settle(hashes, ids, all_known)
            ids, hashes, n = [], [], 0
    if n:
        yield settle(hashes, ids, all_known)


def _lists(rows: DataFrame, name: str) -> DataFrame:
    value = F.coalesce("hash", "key")
    return rows.groupBy(F.col("doc").alias("of")).agg(F.collect_list(value).alias(name))


def remove_repeats(
    docs: DataFrame, window: int = 13, period: int = 7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed`` and ``kept`` (words joined by a
    space). Ids must be integers."""
    size = window - period + 1
    if size < 1:
        raise ValueError("the period is at most the window")
    cover = difference_cover(period)
    # The names differ from those of the table, so that all uses plan one and the same exchange.
    body = F.coalesce(docs[text_col], F.lit("")).alias("body")
    texts = docs.select(docs[id_col].cast("long").alias("of_doc"), body)
    named = texts.where(F.col("of_doc").isNotNull())
    same = (F.xxhash64("body").alias("a"), F.hash("body").alias("b"), F.octet_length("body").alias("c"))
    smallest = named.select("of_doc", *same).groupBy("a", "b", "c").agg(F.min("of_doc").alias("of"))
    smallest = smallest.select("of").distinct()

    def emit_anchors(batches):
        def found():
            for b in batches:
                for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    yield i, np.unique(anchor_hashes(word_hashes(t), size, period, cover)[1])

        yield from _blocks(found(), True)

    def emit_windows(batches):
        def found():
            for b in batches:
                columns = b.column(0).to_pylist(), b.column(1).to_pylist()
                for k, (i, t) in enumerate(zip(*columns, strict=True)):
                    h = word_hashes(t)
                    at, own = anchor_hashes(h, size, period, cover)
                    hit = at[np.isin(own, b.column(2)[k].values.to_numpy())]
                    all_windows = (window_hashes(h, window) & np.uint64(WINDOW_MASK)).astype(np.int64)
                    # An anchor at p lies in the windows that start at p - period + 1 .. p.
                    starts = np.unique((hit[:, None] - np.arange(period)[None, :]).ravel())
                    starts = starts[(starts >= 0) & (starts < len(all_windows))]
                    yield i, np.unique(all_windows[starts])

        yield from _blocks(found(), False)

    def drop_words(batches):
        for b in batches:
            n_words, n_removed, kept = [], [], []
            copies = b.column(3).to_pylist()
            for k, t in enumerate(b.column(1).to_pylist()):
                w, repeats = t.encode().split(), b.column(2)[k]
                gone = np.full(len(w), copies[k] and len(w) >= window)
                if repeats.is_valid and len(w) >= window:
                    hashes = (window_hashes(word_hashes(t), window) & np.uint64(WINDOW_MASK)).astype(np.int64)
                    step = np.zeros(len(w) + 1, np.int64)
                    at = np.flatnonzero(np.isin(hashes, repeats.values.to_numpy()))
                    step[at] += 1
                    step[at + window] -= 1
                    gone |= np.cumsum(step[:-1]) > 0
                n_words.append(len(w))
                n_removed.append(int(gone.sum()))
                kept.append(b" ".join(x for x, g in zip(w, gone.tolist(), strict=True) if not g).decode())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                names=["id", "n_words", "n_removed", "kept"],
            )

    dealt, met = "key long, doc long, hash long", Window.partitionBy("key")
    here = F.col("of_doc") == F.col("of")
    looked_at = named.join(smallest, here).select("of_doc", "body")
    anchors = looked_at.mapInArrow(emit_anchors, dealt).withColumn("n", F.count(F.lit(1)).over(met))
    shared = _lists(anchors.where(F.col("hash").isNotNull() | (F.col("n") > 1)), "shared")
    extended = named.join(shared, here).select("of_doc", "body", "shared")
    windows = extended.mapInArrow(emit_windows, dealt).withColumn("least", F.min("doc").over(met))
    repeats = _lists(windows.where(F.col("hash").isNotNull() | (F.col("least") < F.col("doc"))), "repeats")
    marked = (
        named.join(repeats, here, "left")
        .drop("of")
        .join(smallest, here, "left")
        .select("of_doc", "body", "repeats", F.col("of").isNull().alias("copy"))
    )
    nameless = texts.where(F.col("of_doc").isNull()).select(
        "of_doc", "body", F.lit(None).cast("array<long>").alias("repeats"), F.lit(False).alias("copy")
    )
    out = marked.unionByName(nameless).mapInArrow(drop_words, "id long, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("id", id_col)


by_value(__name__)
