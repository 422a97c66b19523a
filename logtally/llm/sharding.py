"""Consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into ``cells`` equal arcs. Each shard owns ``vnodes`` places on it; a
document belongs to the arc of its id's hash and so to the next place clockwise. Every
shard has a capacity; the documents of a full shard continue clockwise to the next place
whose shard has room. With ``load=1`` the capacities add up to the number of documents,
so row counts differ by at most one (law ``rows``).

Spark counts documents by (cell, salt), a table whose size is fixed by the parameters.
Placing whole counts instead of single documents gives the split points (rank ranges
inside a cell); a window inside each (cell, salt) ranks the documents, and a broadcast
join with the placed ranges, again of fixed size, yields shard and slot. The salt comes
from the row's place in the input, so a key that holds a third of all rows still spreads
over ``salts`` tasks.

Defined results: null text counts 16 bytes and CRC of the empty text; null ids hash like
any other value; repeated rows are placed one by one; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtally.llm.common import reliable

ROW_OVERHEAD = 16


def ring(n_shards: int, vnodes: int, cells: int) -> list[tuple[int, int]]:
    """Sorted ``(cell, shard)`` places; two places never share a cell."""
    if n_shards * vnodes > cells:
        raise ValueError("the ring needs at least one cell per virtual node")
    taken: dict[int, int] = {}
    for shard in range(n_shards):
        for v in range(vnodes):
            digest = hashlib.blake2b(f"{shard}:{v}".encode(), digest_size=8).digest()
            cell = int.from_bytes(digest, "big") % cells
            while cell in taken:
                cell = (cell + 1) % cells
            taken[cell] = shard
    return sorted(taken.items())


def capacities(n_rows: int, n_shards: int, load: float = 1.0) -> list[int]:
    """Rows each shard may take: floor or ceil of the mean, or ``load`` times the mean."""
    if load < 1:
        raise ValueError("load must be at least 1")
    if load == 1:
        return [n_rows // n_shards + (s < n_rows % n_shards) for s in range(n_shards)]
    return [-int(-load * n_rows // n_shards)] * n_shards


def place(
    counts: list[tuple[int, int, int]], places: list[tuple[int, int]], room: list[int]
) -> list[tuple[int, int, int, int, int, int]]:
    """Rank ranges ``(cell, salt, from, to, shard, first slot)`` for ``(cell, salt, n)``.

    Round by round, every range still waiting is offered to the shard of its place; the
    shard takes what fits, and the rest moves to the next place with room, clockwise.
    """
    cells = [c for c, _ in places]
    room, filled = list(room), [0] * len(room)
    waiting = [(c, s, 0, n, bisect_left(cells, c) % len(cells)) for c, s, n in sorted(counts)]
    out = []
    while waiting:
        moved = []
        for cell, salt, lo, hi, at in waiting:
            shard = places[at][1]
            take = min(room[shard], hi - lo)
            if take:
                out.append((cell, salt, lo, lo + take, shard, filled[shard]))
                room[shard] -= take
                filled[shard] += take
            if lo + take < hi:
                at = (at + 1) % len(places)
                while not room[places[at][1]]:
                    at = (at + 1) % len(places)
                moved.append((cell, salt, lo + take, hi, at))
        waiting = moved
    return out


def shard_documents(
    docs: DataFrame,
    n_shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    vnodes: int = 16,
    cells: int = 4096,
    salts: int = 8,
    load: float = 1.0,
) -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``shard`` and ``slot``."""
    if cells < 2 or cells & (cells - 1):
        raise ValueError("cells must be a power of two")
    text: Column = F.coalesce(docs[text_col], F.lit(""))
    rows = reliable(
        docs.select(
            docs[id_col].alias("id"),
            (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
            F.xxhash64(docs[id_col]).alias("pos"),
        )
        .withColumn("cell", F.shiftrightunsigned("pos", 65 - cells.bit_length()).cast("int"))
        .withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    )
    counts = [tuple(r) for r in rows.groupBy("cell", "salt").count().collect()]  # <= cells * salts
    room = capacities(sum(n for _, _, n in counts), n_shards, load)
    ranges = docs.sparkSession.createDataFrame(
        place(counts, ring(n_shards, vnodes, cells), room),
        "cell int, salt int, lo long, hi long, shard int, first long",
    )
    order = Window.partitionBy("cell", "salt").orderBy("pos", "id", "crc", "size")
    ranked = rows.withColumn("rank", F.row_number().over(order) - 1)
    inside = (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    return (
        ranked.join(F.broadcast(ranges), ["cell", "salt"])
        .where(inside)
        .select(
            F.col("id").alias(id_col),
            "size",
            F.col("crc").alias("text_crc32"),
            "shard",
            (F.col("first") + F.col("rank") - F.col("lo")).alias("slot"),
        )
    )
