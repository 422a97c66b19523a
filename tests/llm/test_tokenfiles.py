"""Token-id files: blocks, files, manifest, and the query against the tokenizers library."""

import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
from logtally.llm import tokenfiles
from logtally.session import scratch_path
from tests.conftest import SF_ORACLE

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRICKY = ["ab", "A1", "!", "\n", "\t", " ", "  ", " ", "\x1c", "\x1f", "'s", "'sx", "<|endoftext|>", "<|", "é", "λ", "²", "½x", "漢", " ", "…", ".", "…."]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as f:
        spec = f.read()
    return tokenfiles.PieceEncoder(spec, *tokenfiles.separable(spec))


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(TRICKY), max_size=12).map("".join) | st.text(max_size=30), max_size=4))
def test_pieces_encode_like_whole_texts(texts):
    enc, lib = _held()
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    assert [ids_of(x) for x in enc.encode_all(texts)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


_HELD = []


def _held():
    if not _HELD:
        with open(PATH, encoding="utf-8") as f:
            spec = f.read()
        _HELD.extend([tokenfiles.PieceEncoder(spec, *tokenfiles.separable(spec)), Tokenizer.from_file(PATH)])
    return _HELD


def test_memo_turns_over(encoder, library, monkeypatch):
    monkeypatch.setattr(tokenfiles, "MEMO", 4)
    text = "one two three four five, six seven one two eight"
    for _ in range(4):
        assert ids_of(encoder.encode_all([text])[0]) == library.encode(text, add_special_tokens=False).ids
    assert len(encoder.newer) <= 4 + 20


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 60_000) | st.integers(7, 9), min_size=1, max_size=300))
def test_blocks(values):
    ids = np.array(values, np.uint32)
    raw = b"x" + tokenfiles.pack_block(ids) + b"rest"
    assert tokenfiles.unpack_block(raw, 1).tolist() == values


def test_exceptions_keep_a_block_narrow():
    ids = np.full(1000, 40_000, np.uint32) + np.arange(1000, dtype=np.uint32) % 16
    ids[[3, 500]] = [2**32 - 1, 49_999]
    assert len(tokenfiles.pack_block(ids)) < 1000 * 4 / 8 + 40
    assert (tokenfiles.unpack_block(tokenfiles.pack_block(ids)) == ids).all()


def test_file_and_random_access(tmp_path):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50_000, n).astype(np.uint32) for n in (0, 1, 5000, 3, 20_000, 0, 4096)]
    path = str(tmp_path / "a#b?.bin")
    out = tokenfiles.TokenFile(path)
    for i, d in enumerate(docs):
        out.add(None if i < 2 else i, d)
    assert out.close() == os.path.getsize(path)
    every = np.concatenate(docs)
    with tokenfiles.OpenTokenFile(path) as f:
        assert (f.nulls, f.docs.tolist()[2:]) == (2, [2, 3, 4, 5, 6])
        for most in (1, 4000, 10**9):
            got = [x for a, b, ids in f.spans(most) for x in np.split(ids, (f.starts[a + 1 : b] - f.starts[a]))]
            assert [g.tolist() for g in got] == [d.tolist() for d in docs]
    for first, n in ((0, 1), (4095, 2), (4096, 8192), (29_000, 99), (7, 0)):
        assert (tokenfiles.read_ids(path, first, n) == every[first : first + n]).all()
    with pytest.raises(ValueError):
        (tmp_path / "no").write_bytes(b"0" * 100)
        tokenfiles.OpenTokenFile(str(tmp_path / "no"))


def test_query(spark, library):
    want, at = [], 0
    for d in sorted(pq.read_table(f"{SF_ORACLE}/documents.parquet").to_pylist(), key=lambda d: d["doc_id"]):
        ids = [*library.encode(d["text"] or "", add_special_tokens=False).ids, 0]
        want.append((d["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = E.queries()["op11_token_files"](spark, SF_ORACLE)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == want


def test_edges(spark, library, monkeypatch):
    """Nulls, empty and very long texts, repeated rows and ids, small files, clashing columns."""
    long = " ".join(f"w{i * 7919 % 10007}" for i in range(60_000))
    texts = [(3, "b"), (3, "a"), (1, None), (None, "no id"), (2, ""), (2, ""), (5, long), (4, "x" * 50_000), (None, None), (3, "b")]
    schema = "doc_id long, text string, ids string, tie string, part string, start string, file string"
    docs = spark.createDataFrame([(*t, *["clash"] * 5) for t in texts], schema).repartition(4)
    monkeypatch.setattr(tokenfiles, "FILE_DOCS", 2)
    path = scratch_path(spark, "token-files-test")
    manifest = tokenfiles.write_token_files(docs, path, PATH)
    assert manifest.agg(F.sum("n_docs")).first()[0] == len(texts)
    assert manifest.agg(F.max("n_docs")).first()[0] <= 2
    rows = sorted(tokenfiles.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((t[0] for t in texts), key=lambda i: (i is not None, i))
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (at, len(r.ids) // 4)
        at += r.n_tokens
    want = sorted((i or -1, [*library.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in texts)
    assert sorted((r.doc_id or -1, ids_of(r.ids)) for r in rows) == want
    # What another attempt left behind is not read.
    with open(f"{path.removeprefix('file:')}/tokens-left-behind.bin", "wb") as f:
        f.write(b"half a file")
    assert tokenfiles.read_token_files(spark, path).count() == len(texts)
    empty = scratch_path(spark, "token-files-test")
    tokenfiles.write_token_files(docs.limit(0), empty, PATH)
    assert tokenfiles.read_token_files(spark, empty).collect() == []


GAPS = [" ", "  ", "   ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", " ", " ", " ", " ", "　", " \n ", "\n\n"]
PARTS = ["a", "Word", "word", "it's", "x'", "'s", "12", "a1", "é", "р", "с", "ß", "中", "́", "👍", ".", ",.", "-", "<|", "<|endoftext|>", "_", "\x00"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(GAPS + PARTS), max_size=14).map("".join) | st.none(), max_size=5))
def test_columns_encode_like_whole_texts(texts):
    """Texts of one column, sliced out of a larger one: cut as bytes, equal pieces once."""
    enc, lib = _held()
    column = pa.array(["before", *texts, "after"], pa.string()).slice(1, len(texts))
    ids, at = enc.encode_column(column)
    want = [lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == want


def test_equal_pieces_are_looked_up_once(library, monkeypatch):
    """A column's pieces are cut and counted as bytes: characters are only searched in what
    is new, and words behind a line's end are no texts to the library."""
    with open(PATH, encoding="utf-8") as f:
        spec = f.read()
    fresh, asked = tokenfiles.PieceEncoder(spec, *tokenfiles.separable(spec)), []

    class Counted:
        def encode(self, text, **rest):
            asked.append(text)
            return library.encode(text, **rest)

    fresh.library = Counted()
    find, cut = fresh.find, []
    monkeypatch.setattr(fresh, "find", lambda text: cut.append(text) or find(text))
    word = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    text = "".join(f"{gap}{word(i)}" for _ in range(3) for i in range(500) for gap in (" ", ".\n"))
    assert ids_of(fresh.encode_all([text])[0]) == library.encode(text, add_special_tokens=False).ids
    assert len(asked) < 5 and sum(map(len, cut)) < 20
