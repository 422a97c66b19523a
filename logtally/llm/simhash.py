"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments, so many that two fingerprints at most d bits apart differ
in at most one bit of some segment. There is one table per segment: every fingerprint lies
in the bucket of its segment's value, and is sought in the buckets of the values in a
small Hamming ball around it (the value, and each with one more bit set; of two values a
bit apart one finds the other). What meets in a bucket is verified on all 64 bits.

All near copies of a text meet in one bucket, where pairs would grow with the square. A
bucket of more than ``HOT`` fingerprints is split exactly, by whole neighbours: two
fingerprints at most d bits apart have a common neighbour at most d // 2 bits from one and
d - d // 2 bits from the other. Each is listed under its neighbours of the larger radius
(65 for d = 1 and 2, 2,081 for 3 and 4), and those that meet under one are linked to the
smallest within the smaller radius. At most as many meet there as there are neighbours, all
links are at most d bits long, and no connection is lost though pairs are not listed.

Documents are first reduced to distinct fingerprints; a group of copies is one of them.
Components are found by contraction (see ``components``).

Defined results: null and empty texts have fingerprint zero, linked like any other; a
null id never becomes a component id unless its whole component has none; repeated rows
get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtally.llm.common import by_value, reliable
from logtally.llm.components import components

SEED = 42
BLOCK = 1 << 15  # shingles whose bits are counted at once
HOT = 128  # rows of a bucket that are compared pair by pair


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, as a signed integer."""
    # bytes.lower changes A-Z only, bytes.split splits at space and U+0009..U+000D.
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    joined, ends = b" ".join(w), np.cumsum([len(x) + 1 for x in w]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends[words - 1 :].tolist() if len(w) >= words else [len(joined)]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(stops), BLOCK):
        spans = zip(starts[at : at + BLOCK], stops[at : at + BLOCK], strict=False)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    over = np.packbits(2 * counts > len(stops), bitorder="little")
    return int(over.view("<i8")[0])


def fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text_hash, fp)`` for every row; ``fp`` is the fingerprint as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            fps = [fingerprint(t, words) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(fps, pa.int64())], names=["id", "text_hash", "fp"]
            )

    rows = docs.select(docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("text_hash"), docs[text_col])
    return rows.mapInArrow(run, f"id {kind}, text_hash long, fp long")


def ball(fp: Column, radius: int) -> Column:
    """The fingerprint itself and all that differ from it in at most ``radius`` bits, once each."""
    flip = lambda v, j: v.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), j))
    # Bits are flipped in ascending order; ``free`` is the first one that may be next.
    step = lambda e: F.transform(
        F.sequence(e["free"], F.lit(63)), lambda j: F.struct(flip(e["v"], j).alias("v"), (j + 1).alias("free"))
    )
    ring, rings = F.array(F.struct(fp.alias("v"), F.lit(0).alias("free"))), [F.array(fp)]
    for _ in range(radius):
        ring = F.flatten(F.transform(F.filter(ring, lambda e: e["free"] < 64), step))
        rings.append(F.transform(ring, lambda e: e["v"]))
    return F.concat(*rings)


def _places(fp: Column, segment: int, a: int, b: int, seek: bool) -> Column:
    """Where a fingerprint lies and, with ``seek``, is sought in the table of bits ``a`` to ``b``."""
    entry = lambda v, own: F.struct(F.lit(segment).alias("segment"), v.alias("value"), F.lit(own).alias("own"))
    bit = lambda j: F.call_function("shiftleft", F.lit(1).cast("long"), j)
    value = F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
    own = F.array(entry(value, True))
    if not seek:
        return own
    clear = F.filter(F.sequence(F.lit(0), F.lit(b - a - 1)), lambda j: value.bitwiseAND(bit(j)) == 0)
    return F.concat(own, F.transform(clear, lambda j: entry(value.bitwiseOR(bit(j)), False)))


def tables(fp: Column, max_bits: int) -> Column:
    """Where a fingerprint lies (``own``) and is sought: ``(segment, value, own)`` of every table."""
    number = max(2, -(-(max_bits + 1) // 2))
    edges = [64 * k // number for k in range(number + 1)]
    pairs = zip(edges, edges[1:], strict=False)
    return F.concat(*(_places(fp, k, a, b, max_bits >= number) for k, (a, b) in enumerate(pairs)))


def links(distinct: DataFrame, max_bits: int, hot: int = HOT) -> DataFrame:
    """Links ``(a, b)`` between fingerprints (column ``fp``) at most ``max_bits`` apart:
    the same components as all such pairs."""
    if max_bits < 0:
        raise ValueError("fingerprints link at 0 or more bits")
    if max_bits == 0:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    rows = distinct.select("fp", F.explode(tables(F.col("fp"), max_bits)).alias("t")).select("fp", "t.*")
    sizes = rows.groupBy(F.col("segment").alias("of_segment"), F.col("value").alias("of_value")).agg(
        F.count(F.lit(1)).alias("n"), F.max("own").alias("held")
    )
    here = (F.col("segment") == F.col("of_segment")) & (F.col("value") == F.col("of_value"))
    met = reliable(rows.join(sizes.where("n > 1 AND held"), here).select("segment", "value", "fp", "own", "n"))
    few = met.where(F.col("n") <= hot)
    mine = few.where("own").select(F.col("segment").alias("of_segment"), F.col("value").alias("of_value"), F.col("fp").alias("a"))
    pairs = few.withColumnRenamed("fp", "b").join(mine, here)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = pairs.where(near & ((F.col("a") < F.col("b")) | ~F.col("own"))).select("a", "b")
    many = met.where(F.col("n") > hot)
    return pairs.union(neighbour_links(many, max_bits, ("segment", "value")))


def neighbour_links(rows: DataFrame, max_bits: int, within: tuple[str, ...]) -> DataFrame:
    """Links between fingerprints of one bucket (columns ``within``) by their common neighbours."""
    inner = max_bits // 2
    index = rows.select(*within, "fp", F.explode(ball(F.col("fp"), max_bits - inner)).alias("key"))
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("key"))) <= inner
    centre = F.min(F.when(close, F.col("fp"))).over(Window.partitionBy(*within, "key"))
    return index.withColumn("centre", centre).where("fp <> centre").select(F.col("centre").alias("a"), F.col("fp").alias("b"))


def grouped(docs: DataFrame, words: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, text_hash, fp, root, component_id)`` for every row of ``docs``; ``root`` names
    the component."""
    rows = reliable(fingerprints(docs, words, id_col, text_col))
    distinct = reliable(rows.groupBy("fp").agg(F.min("id").alias("first")))
    joined = components(links(distinct, max_bits))
    linked = distinct.join(joined, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root")
    )
    smallest = linked.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("component_id"))
    by_fp = linked.join(smallest, F.col("r") == F.col("root")).select(F.col("fp").alias("f"), "root", "component_id")
    return rows.join(by_fp, F.col("fp") == F.col("f")).drop("f")


def near_duplicates(
    docs: DataFrame, words: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits) and ``component_id``, the
    smallest id reachable over links of at most ``max_bits`` bits."""
    return grouped(docs, words, max_bits, id_col, text_col).select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def deduped_documents(
    docs: DataFrame, words: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of ``docs`` per component, columns unchanged: that of the smallest id (then
    of the smallest text hash); of repeated rows one stays."""
    groups = grouped(docs, words, max_bits, id_col, text_col)
    order = F.struct(F.col("id").isNull().alias("last"), "id", "text_hash")
    keep = groups.groupBy("root").agg(F.min(order).alias("m")).select(
        F.col("m.text_hash").alias("text_hash"), F.xxhash64("m.id", "m.text_hash").alias("row_hash")
    )
    text_hash = F.xxhash64(docs[text_col])
    rows = docs.select(
        F.struct("*").alias("row"),
        text_hash.alias("text_hash"),
        F.xxhash64(docs[id_col], text_hash).alias("row_hash"),
    )
    kept = rows.join(keep, ["text_hash", "row_hash"]).dropDuplicates(["text_hash", "row_hash"])
    return kept.select("row.*")


by_value(__name__)
