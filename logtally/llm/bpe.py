"""Byte-level BPE: the tables of a tokenizer file, pre-tokenisation, and the two
operators built on them.

*Encoding* cuts every pre-token at forced boundaries: a pair of neighbouring bytes that
occurs inside no vocabulary token can never be merged over, so the fragments between such
pairs are encoded independently and their ids concatenated. *Counting* emits no ids: each
pre-token is a linked list of symbols and a heap of adjacent pairs; the lowest-rank pair
is popped and merged until none is left, and the count is symbols minus merges. Both take
``O(n log n)`` in a pre-token's length, so a text without any space is no special case.

Texts stream through ``mapInArrow`` in Arrow batches, of which a worker holds ``SLICE`` texts or
``SLICE_BYTES`` at once (or one longer text); encoding and decoding in one step keeps one
Python worker a task. The tokenizer file (of fixed size) is broadcast, its tables are built once per Python worker, and short pre-tokens are kept
in a memo of at most twice ``MEMO`` entries, the least lately used half going first.

Defined results: a null text is encoded like an empty one (no ids); repeated rows are
encoded one by one; an empty table gives no rows; special strings inside a text become
their special id, as in the tokenizers library.
"""

from __future__ import annotations

import heapq
import json
import sys
import types
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.llm.common import by_value

# Fixed value: the published pre-token pattern of byte-level BPE, with the Unicode
# white-space property written out.
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
MEMO = 1 << 17
MEMO_CHARS = 48
SLICE = 512
SLICE_BYTES = 1 << 22
ID_BITS = 20
NEVER = 1 << 62  # the rank of a pair that does not merge


class Memo:
    """A dictionary of at most twice ``MEMO`` entries: when the newer half is full, it
    becomes the older one, whose entries stay as long as they are asked for again."""

    def __init__(self, build: Callable[[str], object]) -> None:
        self.build, self.newer, self.older = build, {}, {}

    def __call__(self, piece: str) -> object:
        value = self.older.get(piece)
        if value is None:
            value = self.build(piece)
        if len(piece) <= MEMO_CHARS:
            if len(self.newer) >= MEMO:
                self.older, self.newer = self.newer, {}
            self.newer[piece] = value
        return value


def byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable
    bytes stand for themselves, the others for the characters from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


class ByteBPE:
    """Tables of one tokenizer file (its JSON text)."""

    def __init__(self, spec: str) -> None:
        tok = json.loads(spec)
        model = tok["model"]
        if model["type"] != "BPE" or tok["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE tokenizer file is needed")
        for t in tok["added_tokens"]:
            if t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError("added tokens that look at their surroundings are not supported")
        if tok["pre_tokenizer"]["add_prefix_space"] or tok["normalizer"] or model.get("ignore_merges"):
            raise ValueError("prefix spaces, normalizers and ignore_merges are not supported")
        chars = byte_chars()
        byte_of = {c: b for b, c in enumerate(chars)}
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in tok["added_tokens"]}
        self.token_bytes: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        self.joined = bytearray(1 << 16)  # 1 where two bytes are neighbours inside a token
        for t, i in vocab.items():
            raw = self.token_bytes[i] = bytes(byte_of[c] for c in t)
            for a, b in zip(raw, raw[1:], strict=False):
                self.joined[a << 8 | b] = 1
        for t, i in self.special.items():
            self.token_bytes[i] = t.encode()
        self.byte_id = [vocab[c] for c in chars]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # Both ids of a pair in one integer, and its rank and merged id in another.
        self.rank = {
            vocab[a] << ID_BITS | vocab[b]: r << ID_BITS | vocab[a + b] for r, (a, b) in enumerate(pairs)
        }
        self.split = regex.compile(PRE_TOKEN).findall
        found = sorted(self.special, key=len, reverse=True)
        self.special_at = regex.compile("|".join(map(regex.escape, found))) if found else None
        self.ids_memo, self.count_memo = Memo(self.piece_ids), Memo(self.piece_count)

    def parts(self, text: str) -> Iterator[tuple[str, int | None]]:
        """The text between special strings (id None), and those strings with their ids."""
        at = 0
        for m in self.special_at.finditer(text) if self.special_at else ():
            yield text[at : m.start()], None
            yield m[0], self.special[m[0]]
            at = m.end()
        yield text[at:], None

    # Encoding: forced boundaries.

    def fragments(self, raw: bytes) -> list[bytes]:
        """``raw`` cut wherever two neighbouring bytes occur together in no token."""
        joined = self.joined
        cuts = [i for i, (a, b) in enumerate(zip(raw, raw[1:], strict=False), 1) if not joined[a << 8 | b]]
        return [raw[a:b] for a, b in zip([0, *cuts], [*cuts, len(raw)], strict=True)] if cuts else [raw]

    def merged(self, raw: bytes) -> list[int]:
        """Ids of one fragment."""
        ids = [self.byte_id[b] for b in raw]
        if len(ids) > 48:
            return [i for i in self._merge(ids) if i >= 0]
        rank = self.rank.get
        ranks = [rank(a << ID_BITS | b, NEVER) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            i = ranks.index(best)  # the leftmost pair of the lowest rank
            ids[i] = new = best & (1 << ID_BITS) - 1
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank(new << ID_BITS | ids[i + 1], NEVER)
            if i:
                ranks[i - 1] = rank(ids[i - 1] << ID_BITS | new, NEVER)
        return ids

    def piece_ids(self, piece: str) -> bytes:
        """Ids of one pre-token as little-endian 32-bit integers."""
        out = array("I")
        for part in self.fragments(piece.encode()):
            out.extend(self.merged(part))
        return little(out)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        memo, out = self.ids_memo, []
        for part, special in self.parts(text):
            if special is not None:
                out.append(little(array("I", [special])))
                continue
            for piece in self.split(part):
                out.append(memo.newer.get(piece) or memo(piece))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        listed = array("I", ids)
        if sys.byteorder == "big":
            listed.byteswap()
        return b"".join(map(self.token_bytes.__getitem__, listed)).decode("utf-8", "replace")

    # Counting: heap and linked list.

    def _merge(self, ids: list[int]) -> list[int]:
        """Merge in place, lowest rank first and leftmost among equals; a symbol merged
        into its left neighbour becomes -1."""
        n, rank = len(ids), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if (r := rank(ids[i] << ID_BITS | ids[i + 1])) is not None:
                heap.append((r, i))
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or rank(ids[i] << ID_BITS | ids[j]) != r:
                continue  # one of the two has been merged meanwhile
            new = r & (1 << ID_BITS) - 1
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(new << ID_BITS | ids[k])) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := rank(ids[h] << ID_BITS | new)) is not None:
                heapq.heappush(heap, (r, h))
        return ids

    def piece_count(self, piece: str) -> int:
        """Tokens of one pre-token: symbols less merges."""
        ids = self._merge([self.byte_id[b] for b in piece.encode()])
        return len(ids) - ids.count(-1)

    def count(self, text: str) -> int:
        memo, total = self.count_memo, 0
        for part, special in self.parts(text):
            if special is not None:
                total += 1
                continue
            for piece in self.split(part):
                total += memo.newer.get(piece) or memo(piece)
        return total


def little(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids.byteswap()
    return ids.tobytes()


def slices(
    batches: Iterator[pa.RecordBatch], text: int = -1, most: int = SLICE, most_bytes: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``most`` rows and ``most_bytes`` of column ``text`` (or
    one row), so few texts are Python objects at once."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(text)), 0).to_pylist()
        at = held = 0
        for i, size in enumerate(sizes):
            if i > at and (i - at >= most or held + size > most_bytes):
                yield b.slice(at, i - at)
                at, held = i, 0
            held += size
        if at < len(sizes):
            yield b.slice(at)


def worker_state(key: str, build: Callable[[], object]) -> object:
    """What ``build`` made, once per Python worker process and key."""
    name = "_corpus_worker_state"
    held = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if key not in held:
        held[key] = build()
    return held[key]


def _load(docs: DataFrame, path: str):
    """A function that gives the tables on an executor; the file is read on the driver."""
    with open(path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    return lambda: worker_state(f"bpe:{path}", lambda: ByteBPE(spec.value))


def encode_documents(
    docs: DataFrame, tokenizer: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The ``keep`` columns, ``n_tokens`` and ``ids`` (binary, little-endian 32-bit)."""
    load = _load(docs, tokenizer)

    def run(batches):
        model = load()
        for b in slices(batches):
            ids = [model.encode(t or "") for t in b.column(b.num_columns - 1).to_pylist()]
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            cols += [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    rows = docs.select(*(docs[c] for c in keep), docs[text_col].alias("bpe_text"))
    names = [*keep, "n_tokens", "ids"]
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join([*kept, "n_tokens long", "ids binary"]))


def decode_documents(
    encoded: DataFrame, tokenizer: str, keep: tuple[str, ...] = ("doc_id", "n_tokens", "ids")
) -> DataFrame:
    """The ``keep`` columns of ``encoded`` and ``decoded``, the text of its ``ids``."""
    load = _load(encoded, tokenizer)

    def run(batches):
        model = load()
        for b in slices(batches):
            texts = [model.decode(x or b"") for x in b.column(b.num_columns - 1).to_pylist()]
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(texts, pa.string())], names=names)

    rows = encoded.select(*keep, encoded["ids"].alias("bpe_ids"))
    names = [*keep, "decoded"]
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join([*kept, "decoded string"]))


def roundtrip_documents(
    docs: DataFrame, tokenizer: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The ``keep`` columns, ``n_tokens``, ``ids`` and ``decoded``, the text of the ids: encoding
    and decoding in one step."""
    load = _load(docs, tokenizer)

    def run(batches):
        model = load()
        for b in slices(batches):
            ids = [model.encode(t or "") for t in b.column(b.num_columns - 1).to_pylist()]
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            cols += [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            cols.append(pa.array([model.decode(x) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    rows = docs.select(*(docs[c] for c in keep), docs[text_col].alias("bpe_text"))
    names = [*keep, "n_tokens", "ids", "decoded"]
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join([*kept, "n_tokens long", "ids binary", "decoded string"]))


def count_tokens(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512
) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    load = _load(docs, tokenizer)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        model = load()
        for b in slices(batches, 1):
            counts = [model.count(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(counts, pa.int64())], names=["id", "n_bytes", "n_tokens"]
            )

    size = F.octet_length(F.coalesce(docs[text_col], F.lit(""))).cast("long")
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("t"), size.alias("n_bytes"))
    counted = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


by_value(__name__)
