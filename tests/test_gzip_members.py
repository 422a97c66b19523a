"""Double-gzip files of several members, dealt to tasks."""

import gzip
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from logtally.session import scratch_path
from logtally.sources.double_gzip import member_starts, read_double_gzip, write_double_gzip


def twice(data: bytes) -> bytes:
    return gzip.compress(gzip.compress(data))


@pytest.fixture(scope="module")
def folder(spark):
    """Members cut at any byte; one file with one inner stream over three outer members; an
    empty member; a member without any line end; zero padding; no line end at the end."""
    rnd = random.Random(4)
    path = scratch_path(spark, "t-members").removeprefix("file:")
    os.makedirs(path)
    text = "\n".join(f"line {i} é\U0001f600 {rnd.random()}" for i in range(4000)).encode() + b"\r\nlast\rtwo"
    cuts = [0, *sorted(rnd.randrange(len(text)) for _ in range(7)), len(text)]
    parts = [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    parts[3:3] = [b"", b"no line end at all here", b"\n"]
    with open(f"{path}/eight.gz.gz", "wb") as f:
        f.write(b"".join(twice(p) for p in parts) + b"\0" * 300)
    inner = gzip.compress(text)
    third = len(inner) // 3
    with open(f"{path}/one-stream.gz.gz", "wb") as f:
        f.write(b"".join(gzip.compress(inner[a : a + third]) for a in range(0, len(inner), third)))
    with open(f"{path}/single#1.gz.gz", "wb") as f:
        f.write(twice(b"a\nb"))
    with open(f"{path}/none.gz.gz", "wb") as f:
        f.write(twice(b""))
    return path


def test_members_give_the_same_lines(spark, folder):
    rows = lambda df: sorted((r.path.rsplit("/", 1)[1], r.line) for r in df.collect())
    whole = rows(read_double_gzip(spark, folder))
    assert len(whole) > 8000
    assert rows(read_double_gzip(spark, folder, split_members=True, batch_lines=7)) == whole


def test_member_starts(folder):
    with open(f"{folder}/eight.gz.gz", "rb") as f:
        found = list(member_starts(f))
    with open(f"{folder}/eight.gz.gz", "rb") as f:
        data = f.read()
    assert len(found) == 11 and all(whole for _, whole in found) and all(data[a : a + 2] == b"\x1f\x8b" for a, _ in found)
    with open(f"{folder}/one-stream.gz.gz", "rb") as f:
        assert [whole for _, whole in member_starts(f)][:3] == [True, False, False]
    with pytest.raises(EOFError):
        list(member_starts(io.BytesIO(data[:50])))


def test_one_file_is_read_by_many_tasks(spark, lines_df):
    out = scratch_path(spark, "t-members-tasks")
    lines = [f"line {i}" for i in range(8000)]
    assert write_double_gzip(lines_df(lines), out, files=1, member_bytes=12_000) == 8000
    read = read_double_gzip(spark, out, split_members=True)
    files = read.where("line LIKE 'line%'").select(F.input_file_name().alias("f")).distinct()
    assert files.count() >= 7  # each task wrote its members' lines
    assert sorted(r.line for r in read.collect()) == sorted(lines)
    assert sorted(r.line for r in read_double_gzip(spark, out).collect()) == sorted(lines)
