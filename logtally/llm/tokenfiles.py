"""Token-id files: binary, block-packed, readable from any id on.

``write_token_files`` encodes texts with the tokenizers library, ends every document with
one id, and writes the ids in ascending order of document id, as files of at most about
``FILE_IDS`` ids that hold whole documents. The files are written by Python tasks through
pyarrow's file systems (local, HDFS, object stores) under names of their own attempt; the
rows of the manifest that Spark commits name the files that count, so what a lost or
speculative attempt leaves behind is never read.

A file is a run of blocks of ``BLOCK`` ids in patched frame-of-reference form: the block's
minimum is subtracted, the differences are packed at the width that ``PERCENT`` of a
hundred fit in, and of the others the bits above that width stand in a list of exceptions
(position, high bits)::

    magic | block .. block | document ids, document starts, block offsets | trailer
    block: minimum u32, ids u16, width u8, 0, exceptions u16 | packed bits
           | positions u16 .. | high bits u32 ..
    trailer: documents, documents without id, ids, blocks, offset of the index (u64 each), magic

All numbers are little-endian. Block offsets let ``read_ids`` decode only the blocks of the
ids it was asked for.

Order: documents are dealt to tasks by ranges of (id, hash of the text) and sorted within
them, so documents without id come first, and documents of one id by their texts' hash.
Repeated rows are written one by one; a null text is an empty one, which has the end id
only; an empty table gives no files and no rows. Document ids must be integers. Other
columns are not read.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import struct
import sys
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logtally.llm.bpe import byte_chars, little, slices, worker_state
from logtally.llm.common import GAP_CHARS, by_value

BLOCK = 4096
PERCENT = 95
FILE_IDS = 1 << 25
FILE_DOCS = 1 << 20
BATCH_IDS = 1 << 18
READ_BYTES = 1 << 25  # bytes of files that one reading task takes, on average

MAGIC = b"TOKPFOR1"
HEAD, HEAD_SIZE = "<IHBxH", struct.calcsize("<IHBxH")
TRAILER, TRAILER_SIZE = "<5Q8s", struct.calcsize("<5Q8s")

# Pieces that no pre-token spans the end of: white space and a word of Latin letters and
# digits up to white space or ASCII punctuation, else white space and all that follows it
# up to the next. (U+001C..U+001F are white space to Python, not to the tokenizers.)
SPACE, SOLID, PUNCT = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]", r"!-/:-@\[-`{-~"
PIECE = rf"{SPACE}*+[0-9A-Za-zÀ-ÖØ-öø-ÿ]++(?![^\s{PUNCT}]|[\x1c-\x1f])|{SPACE}*{SOLID}+|{SPACE}+"
# Bytes by kind: 1 white space, 2 punctuation, 3 letters and digits, 4 parts of characters
# beyond ASCII, 0 others.
KINDS = np.zeros(256, np.uint8)
KINDS[[0x20, *range(0x09, 0x0E)]] = 1
KINDS[[b for b in range(0x21, 0x7F)]] = 2
KINDS[[b for b in range(0x21, 0x7F) if chr(b).isalnum()]] = 3
KINDS[0x80:] = 4
MEMO = 1 << 19
SLICE_BYTES = 1 << 22  # of texts encoded together
MEMO_CHARS = 48


def cuts(raw: np.ndarray) -> np.ndarray:
    """Where in the bytes of texts a piece may begin: at white space behind a character that
    is none, and at ASCII punctuation behind a letter or digit. No pre-token of the pattern
    spans such a place, and none looks past it."""
    kind = KINDS[raw]
    before, here = kind[:-1], kind[1:]
    first = np.zeros(len(raw), bool)
    first[1:] = ((here == 1) & (before > 1)) | ((here == 2) & (before == 3))
    # Behind the last byte of another character: not if this may be white space of two or
    # three bytes.
    wide = np.flatnonzero((here == 1) & (before == 4)) + 1
    if len(wide):
        last = raw[np.maximum(wide - 2, 0)]
        first[wide] = ~((last == 0xC2) | (last == 0x9A) | (last == 0x80) | (last == 0x81))
    return first


# Blocks.


def pack_block(ids: np.ndarray) -> bytes:
    """One block of at most 65,535 ids (uint32)."""
    base = ids.min()
    rest = ids - base
    at = max(0, -(-len(ids) * PERCENT // 100) - 1)
    width = int(np.partition(rest, at)[at]).bit_length()
    over = np.flatnonzero(rest >> np.uint32(width) if width < 32 else rest[:0]).astype("<u2")
    # Bits of 16-bit numbers where the width allows it.
    small, size = ("<u2", 2) if width <= 16 else ("<u4", 4)
    whole = np.unpackbits(rest.astype(small).view(np.uint8).reshape(-1, size), axis=1, bitorder="little")
    packed = np.packbits(whole[:, :width], bitorder="little")
    high = (rest[over] >> np.uint32(width)).astype("<u4") if len(over) else np.zeros(0, "<u4")
    return b"".join(
        (struct.pack(HEAD, int(base), len(ids), width, len(over)), packed.tobytes(), over.tobytes(), high.tobytes())
    )


def unpack_block(raw: bytes | memoryview, at: int = 0) -> np.ndarray:
    """The ids of the block that starts at ``at``."""
    base, n, width, n_over = struct.unpack_from(HEAD, raw, at)
    at += HEAD_SIZE
    size = (n * width + 7) // 8
    # Value i starts at bit i * width: the bytes it touches, joined, shifted and masked.
    bits = np.arange(n, dtype=np.int64) * width
    from_byte, touched = bits >> 3, (width + 14) // 8
    held = np.zeros(size + touched, np.uint64)
    held[:size] = np.frombuffer(raw, np.uint8, size, at)
    whole = held[from_byte] if touched else np.zeros(n, np.uint64)
    for k in range(1, touched):
        whole |= held[from_byte + k] << np.uint64(8 * k)
    ids = (whole >> (bits & 7).astype(np.uint64) & np.uint64((1 << width) - 1)).astype(np.uint32)
    if n_over:
        over = np.frombuffer(raw, "<u2", n_over, at + size)
        high = np.frombuffer(raw, "<u4", n_over, at + size + 2 * n_over)
        ids[over] |= high << np.uint32(width)
    return ids + np.uint32(base)


# Files.


def file_system(path: str):
    """pyarrow's file system for a path or URI, and the path in it."""
    from pyarrow import fs

    if "://" not in path:
        path = re.sub("^file:/+", "/", path)
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class TokenFile:
    """Writes one file; ``add`` takes documents in order."""

    def __init__(self, path: str) -> None:
        self.path = path
        fs, inner = file_system(path)
        self.out = fs.open_output_stream(inner)
        self.out.write(MAGIC)
        self.at, self.offsets = len(MAGIC), []
        self.docs, self.starts, self.nulls, self.n_ids = [], [], 0, 0
        self.waiting, self.n_waiting = [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.nulls += doc_id is None
        self.docs.append(0 if doc_id is None else doc_id)
        self.starts.append(self.n_ids)
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= 16 * BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate([*self.waiting, np.zeros(0, np.uint32)]).astype(np.uint32)
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        blocks = [pack_block(ids[a : min(a + BLOCK, whole)]) for a in range(0, whole, BLOCK)]
        for b in blocks:
            self.offsets.append(self.at)
            self.at += len(b)
        self.out.write(b"".join(blocks))
        self.waiting, self.n_waiting = [ids[whole:]], len(ids) - whole

    def close(self) -> int:
        """The file's size in bytes."""
        self._flush(True)
        index = [np.array(self.docs, "<i8"), np.array(self.starts, "<u8"), np.array(self.offsets, "<u8")]
        tail = b"".join(x.tobytes() for x in index)
        tail += struct.pack(TRAILER, len(self.docs), self.nulls, self.n_ids, len(self.offsets), self.at, MAGIC)
        self.out.write(tail)
        self.out.close()
        return self.at + len(tail)


class OpenTokenFile:
    """Reads one file: its index, and the ids of any span."""

    def __init__(self, path: str) -> None:
        fs, inner = file_system(path)
        self.raw = fs.open_input_file(inner)
        size = self.raw.size()
        n_docs, nulls, self.n_ids, n_blocks, at, magic = struct.unpack(
            TRAILER, self.raw.read_at(TRAILER_SIZE, size - TRAILER_SIZE)
        )
        if magic != MAGIC:
            raise ValueError(f"{path} is not a token file")
        index = self.raw.read_at(size - TRAILER_SIZE - at, at)
        self.docs = np.frombuffer(index, "<i8", n_docs)
        self.nulls = nulls  # documents without id come first
        self.starts = np.append(np.frombuffer(index, "<u8", n_docs, 8 * n_docs), [self.n_ids]).astype(np.int64)
        self.offsets = np.append(np.frombuffer(index, "<u8", n_blocks, 16 * n_docs), [at]).astype(np.int64)

    def ids(self, first: int, n: int) -> np.ndarray:
        """``n`` ids from the file's id number ``first`` on; only their blocks are read."""
        if n <= 0:
            return np.zeros(0, np.uint32)
        a, b = first // BLOCK, -(-(first + n) // BLOCK)
        at = self.offsets[a]
        raw = self.raw.read_at(int(self.offsets[b] - at), int(at))
        found = np.concatenate([unpack_block(raw, int(o - at)) for o in self.offsets[a:b]])
        return found[first - a * BLOCK :][:n]

    def spans(self, most: int = BATCH_IDS) -> Iterator[tuple[int, int, np.ndarray]]:
        """``(from, to, ids)`` of runs of documents of about ``most`` ids."""
        a = 0
        while a < len(self.docs):
            b = max(a + 1, int(np.searchsorted(self.starts, self.starts[a] + most, "right")) - 1)
            yield a, b, self.ids(int(self.starts[a]), int(self.starts[b] - self.starts[a]))
            a = b

    def __enter__(self) -> OpenTokenFile:
        return self

    def __exit__(self, *_) -> None:
        self.raw.close()


def read_ids(path: str, first: int, n: int) -> np.ndarray:
    """Random access: ``n`` ids of one file, from its id number ``first`` on."""
    with OpenTokenFile(path) as f:
        return f.ids(first, n)


# Encoding.


def separable(spec: str) -> tuple[bool, list[str]]:
    """Whether no rule of a tokenizer file looks past a piece's end, and its special strings."""
    tok = json.loads(spec)
    pre, added = tok["pre_tokenizer"] or {}, tok["added_tokens"]
    plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    alone = all(
        not (t["single_word"] or t["lstrip"] or t["rstrip"]) and re.fullmatch(r"<\|\w+\|>", t["content"]) for t in added
    )
    whole = tok["normalizer"] is None and not tok["model"].get("ignore_merges")
    return bool(plain and alone and whole), sorted((t["content"] for t in added), key=len, reverse=True)


class PieceEncoder:
    """Texts to ids (little-endian 32-bit) by the tokenizers library, which is asked once
    for each different piece while the memo holds it: at most twice ``MEMO`` short pieces,
    the half that was not asked for lately going first. A word of letters behind a space is
    one pre-token, so the library's model takes it as it is. Tokenizers whose rules could
    see past a piece's end are given whole texts."""

    def __init__(self, spec: str, exact: bool, specials: list[str]) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.model, self.exact = self.library.model, exact
        # The library cuts special strings out before anything else.
        self.special = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None
        self.find = re.compile(PIECE).findall
        self.shown = dict(enumerate(byte_chars()))
        self.newer, self.older = {}, {}

    def cut(self, text: str) -> list[str]:
        if not self.exact:
            return [text]
        if self.special is None or "<|" not in text:
            return self.find(text)
        parts = self.special.split(text)  # special strings at odd places
        return [p for i, part in enumerate(parts) for p in ([part] if i % 2 else self.find(part))]

    def tokens(self, shown: str) -> bytes:
        """The ids of one pre-token, its bytes as the vocabulary shows them."""
        return little(array("I", [t.id for t in self.model.tokenize(shown)]))

    def word(self, piece: str) -> bytes | None:
        """The ids of a piece of one ASCII white space, or none, and letters; None for others. A
        space is part of the word's pre-token, other white space is one of its own."""
        gap, letters = piece[0], piece[1:]
        if not (self.exact and letters.isalpha()):
            return None
        ascii = piece.isascii()
        if gap == " ":
            shown = letters if ascii else letters.encode().decode("latin-1").translate(self.shown)
            return self.tokens(self.shown[32] + shown)
        if ascii and gap in GAP_CHARS:
            return self.tokens(self.shown[ord(gap)]) + self.tokens(letters)
        return self.tokens(piece) if ascii and gap.isalpha() else None

    def learn(self, piece: str) -> bytes:
        """The ids of a piece."""
        return self.word(piece) or little(array("I", self.library.encode(piece, add_special_tokens=False).ids))

    def whole(self, piece: str) -> bytes:
        """The ids of a text between two cuts, by its pieces."""
        parts = self.cut(piece)
        if len(parts) == 1:
            return self.learn(piece)
        newer, older, out = self.newer, self.older, []
        for p in parts:
            ids = newer.get(p)
            if ids is None:
                ids = older.get(p) or self.learn(p)
                if len(p) <= MEMO_CHARS:
                    newer[p] = ids
            out.append(ids)
        return b"".join(out)

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty), one behind the other, and where each text's
        begin, with their end: the texts are cut as bytes, and of equal pieces one is asked for."""
        flat = pc.fill_null(texts.cast(pa.large_string()), "")
        _, ends, held = flat.buffers()
        ends = np.frombuffer(ends, "<i8", len(flat) + 1, 8 * flat.offset)
        raw = np.frombuffer(held, np.uint8)[ends[0] : ends[-1]] if held else np.zeros(0, np.uint8)
        ends = ends - ends[0]
        if not len(raw):
            return np.zeros(0, "<u4"), np.zeros(len(ends), np.int64)
        first = cuts(raw) if self.exact else np.zeros(len(raw), bool)
        if self.exact and self.special is not None:
            # Special strings may hold places like cuts; their texts are cut by characters.
            for i in np.flatnonzero(pc.match_substring(flat, "<|").to_numpy(zero_copy_only=False)):
                first[ends[i] : ends[i + 1]] = False
        first[ends[:-1][ends[:-1] < len(raw)]] = True
        at = np.append(np.flatnonzero(first), len(raw))
        of_text = np.searchsorted(at, ends)  # the number of each text's first piece
        buffers = [None, pa.py_buffer(at.astype("<i4")), pa.py_buffer(raw)]
        pieces = pa.Array.from_buffers(pa.string(), len(at) - 1, buffers).dictionary_encode()
        which = pieces.indices.to_numpy()
        if len(self.newer) >= MEMO:
            self.older, self.newer = self.newer, {}
        newer, older = self.newer, self.older
        found = pieces.dictionary.to_pylist()
        known = list(map(newer.get, found))
        for i, ids in enumerate(known):
            if ids is None:
                p = found[i]
                known[i] = ids = older.get(p) or self.word(p) or self.whole(p)
                if len(p) <= MEMO_CHARS:
                    newer[p] = ids
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        from_id, sizes = np.cumsum(size) - size, size[which]
        to = np.append(0, np.cumsum(sizes))
        place = np.repeat(from_id[which] - to[:-1], sizes)
        place += np.arange(to[-1])
        return np.frombuffer(b"".join(known), "<u4")[place], to[of_text]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        ids, at = self.encode_column(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in itertools.pairwise(at.tolist())]


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write the files and their manifest under the new folder ``path``; returns the manifest
    ``(file, part, seq, n_docs, n_ids, n_bytes, start)``, where ``start`` counts the ids of
    all earlier files."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        text = f.read()
    spec, rules = spark.sparkContext.broadcast(text), separable(text)
    # The tie-break is a column of the sort, not of the rows that go to Python.
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    keyed = rows.withColumn("tie", F.xxhash64("text"))
    dealt = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")

    def write(batches):
        encoder = worker_state(f"pieces:{tokenizer}", lambda: PieceEncoder(spec.value, *rules))
        part, seq, out, end = TaskContext.get().partitionId(), 0, None, np.array([end_id], "<u4")

        def closed():
            size = out.close()
            held = [os.path.basename(out.path), part, seq, len(out.docs), out.n_ids, size]
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in held], names=names)

        for b in (part for b in batches for part in slices(iter([b]), 1, len(b), SLICE_BYTES)):
            held, at = encoder.encode_column(b.column(1))
            for i, doc in enumerate(b.column(0).to_pylist()):
                ids = np.concatenate((held[at[i] : at[i + 1]], end))
                if out is not None and (out.n_ids + len(ids) > FILE_IDS or len(out.docs) >= FILE_DOCS):
                    yield closed()
                    out, seq = None, seq + 1
                if out is None:
                    out = TokenFile(f"{path}/tokens-{uuid.uuid4().hex}.bin")
                out.add(doc, ids)
        if out is not None:
            yield closed()

    names = ["file", "part", "seq", "n_docs", "n_ids", "n_bytes"]
    schema = "file string, part long, seq long, n_docs long, n_ids long, n_bytes long"
    dealt.mapInArrow(write, schema).write.parquet(f"{path}/written")
    files = spark.read.schema(schema).parquet(f"{path}/written")
    # Tasks have ranges in ascending order: sums over one row a task, then within a task.
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("held"))
    before = parts.select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    started = files.withColumn("inside", inside).join(before, "part")
    started.select(*names, (F.col("before") + F.col("inside")).alias("start")).write.parquet(f"{path}/manifest")
    return spark.read.schema(schema + ", start long").parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document in the files under ``path``;
    ``ids`` is binary (little-endian 32-bit), ``start`` counts the ids of all documents
    before it. Tasks take about ``READ_BYTES`` of files each."""
    manifest = spark.read.parquet(f"{path}/manifest")
    size = manifest.agg(F.sum("n_bytes")).first()[0] or 0
    tasks = max(1, -(-size // READ_BYTES), min(manifest.count(), spark.sparkContext.defaultParallelism))

    def read(batches):
        # A worker that wrote files before need not hold its tokenizer any longer.
        worker_state("pieces", dict)
        for key in [k for k in sys.modules["_corpus_worker_state"].__dict__ if k.startswith("pieces:")]:
            del sys.modules["_corpus_worker_state"].__dict__[key]
        for b in batches:
            for file, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with OpenTokenFile(f"{path}/{file}") as f:
                    for first, to, ids in f.spans():
                        at = f.starts[first : to + 1]
                        null = np.arange(first, to) < f.nulls
                        # The documents' ids lie one behind the other, as a binary column's do.
                        held = [None, pa.py_buffer((4 * (at - at[0])).astype("<i4")), pa.py_buffer(ids.astype("<u4"))]
                        cols = [
                            pa.array(f.docs[first:to].astype(np.int64), pa.int64(), mask=null),
                            pa.array(start + at[:-1], pa.int64()),
                            pa.array(np.diff(at), pa.int64()),
                            pa.Array.from_buffers(pa.binary(), to - first, held),
                        ]
                        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "ids"])

    listed = manifest.select("file", "start").repartition(tasks)
    return listed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


by_value(__name__)
