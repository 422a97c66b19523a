"""Sources, sinks, store and tables: round trips and pruned plans."""

import gzip
import io
import os

import pytest

from logtally.operators import reports as R
from logtally.operators import sinks, store
from logtally.operators.parse import parse
from logtally.operators.select import where_ip
from logtally.plans.sql import status_share_sql
from logtally.session import scratch_path
from logtally.sources import tables
from logtally.sources.double_gzip import iter_lines, read_double_gzip, write_double_gzip
from logtally.sources.text import read_lines

LINES = [
    '1.1.1.1 - - [x] "G /a" 200 10 "-" "a"',
    '2.2.2.2 - - [x] "G /b" 404 5 "-" "a"',
    '1.1.1.1 - - [x] "G /c" 304 - "-" "a"',
    'h - u [x] "G /d" 200 7',
    "junk é",
    "",
]


def test_iter_lines_terminators():
    data = b"a\nb\r\nc\rd\n\ne"
    got = [x for chunk in iter_lines(io.BytesIO(data), chunk_bytes=3) for x in chunk]
    assert got == ["a", "b", "c", "d", "", "e"]
    crlf_split = [x for chunk in iter_lines(io.BytesIO(b"x\r\ny\r\n"), chunk_bytes=2) for x in chunk]
    assert crlf_split == ["x", "y"]


def test_double_gzip_roundtrip(spark, lines_df):
    out = scratch_path(spark, "t-gz2")
    assert write_double_gzip(lines_df(LINES), out, files=2) == len(LINES)
    local = out.replace("file:", "")
    files = sorted(f for f in os.listdir(local) if f.endswith(".gz.gz"))
    assert len(files) == 2
    with open(os.path.join(local, files[0]), "rb") as fh:  # really two gzip layers
        inner = gzip.decompress(gzip.decompress(fh.read()))
    assert inner.decode("utf-8").splitlines()[0] in LINES
    streamed = sorted(r.line for r in read_double_gzip(spark, out, batch_lines=2).collect())
    in_memory = sorted(r.line for r in read_double_gzip(spark, out, from_content=True).collect())
    assert streamed == in_memory == sorted(LINES)


def test_text_roundtrip_gzip(spark, lines_df):
    out = scratch_path(spark, "t-text")
    sinks.write_text(lines_df(LINES).repartition(2), out, compression="gzip")
    assert sorted(r.line for r in read_lines(spark, out).collect()) == sorted(LINES)
    with_path = read_lines(spark, out, with_path=True).first()
    assert with_path.path.endswith(".gz")


def test_format_line_roundtrip(spark, lines_df):
    parsed = parse(lines_df(LINES), "regexserde")
    formatted = sorted(r.line for r in sinks.format_lines(parsed).collect())
    assert formatted == sorted(LINES[:4])


@pytest.fixture
def store_path(spark, lines_df):
    path = scratch_path(spark, "t-store")
    store.append(parse(lines_df(LINES)), path)
    return path


def test_store_roundtrip_and_append(spark, lines_df, store_path):
    first = sorted(tuple(r) for r in store.read_store(spark, store_path).collect())
    assert first == sorted(tuple(r) for r in parse(lines_df(LINES)).collect())
    store.append(parse(lines_df(LINES)), store_path)
    assert store.read_store(spark, store_path).count() == 2 * len(first)
    segments = store.read_store(spark, store_path, with_segment=True).select("segment").distinct().count()
    assert segments == 2


def test_store_same_segment_is_idempotent(spark, lines_df):
    path = scratch_path(spark, "t-store-seg")
    store.append(parse(lines_df(LINES)), path, segment="b000000000001")
    store.append(parse(lines_df(LINES)), path, segment="b000000000001")
    assert store.read_store(spark, path).count() == 2


def test_store_replaces_a_segment_whatever_its_rows(spark, lines_df):
    path = scratch_path(spark, "t-store-replace")
    store.append(parse(lines_df(LINES[:1])), path, segment="a")
    store.append(parse(lines_df(LINES[1:2])), path, segment="b")
    store.append(parse(lines_df(['7.7.7.7 - - [x] "G" 500 1 "-" "a"'])), path, segment="a")
    assert sorted((r.ip, r.status) for r in store.read_store(spark, path).collect()) == [("2.2.2.2", 404), ("7.7.7.7", 500)]
    store.compact(spark, path)
    store.append(parse(lines_df(["junk"])), path, segment="a")  # an empty one replaces too
    assert [r.ip for r in store.read_store(spark, path).collect()] == ["2.2.2.2"]
    assert store.read_store(spark, path, ip="7.7.7.7").count() == 0
    store.compact(spark, path)
    store.vacuum(spark, path)
    assert [r.ip for r in store.read_store(spark, path).collect()] == ["2.2.2.2"]


def test_store_compact(spark, lines_df, store_path):
    store.append(parse(lines_df(LINES)), store_path)
    before = sorted(map(tuple, store.read_store(spark, store_path, with_segment=True).collect()))
    target = scratch_path(spark, "t-compact")
    store.compact(spark, store_path, target)
    assert sorted(map(tuple, store.read_store(spark, target, with_segment=True).collect())) == before
    with pytest.raises(ValueError):
        store.compact(spark, store_path, target)
    store.compact(spark, store_path)
    assert sorted(map(tuple, store.read_store(spark, store_path, with_segment=True).collect())) == before
    store.append(parse(lines_df(LINES)), store_path)  # a reader sees later appends too
    assert store.read_store(spark, store_path).count() == 6
    assert len(store.vacuum(spark, store_path)) == 2
    assert store.read_store(spark, store_path).count() == 6
    assert store.vacuum(spark, store_path) == []


def test_empty_store_reads_as_no_rows(spark):
    assert store.read_store(spark, scratch_path(spark, "t-nothing")).collect() == []


def test_store_files_and_lookups_do_not_grow_with_statuses_and_ips(spark, lines_df):
    """Five appends of spread IPs and eight statuses: one file per input task; after the
    compaction a lookup reads one bucket folder."""
    path = scratch_path(spark, "t-store-spread")
    for k in range(5):
        lines = [
            f'{(i * 37 + k) % 223 + 1}.{i % 250}.{k}.{i % 13} - - [x] "G /{i}" {200 + i % 8} {i} "-" "a"' for i in range(2000)
        ]
        store.ingest_lines(lines_df(lines).coalesce(3), path)
    files = spark.read.parquet(path).inputFiles()
    assert len(files) == 5 * 3
    ip = store.read_store(spark, path).first().ip
    want = sorted(map(tuple, where_ip(store.read_store(spark, path), ip).collect()))
    assert want and sorted(map(tuple, store.read_store(spark, path, ip=ip).collect())) == want
    store.compact(spark, path, buckets=16)
    lookup = store.read_store(spark, path, ip=ip)
    read = {f.rsplit("/", 2)[1] for f in lookup.inputFiles()}
    assert read == {f"ip_bucket={store.ip_bucket_of(ip, 16)}"}
    assert sorted(map(tuple, lookup.collect())) == want
    plan = lookup._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(ip,{ip})" in plan


def test_store_lookup_plan_is_pruned(spark, store_path):
    records = where_ip(store.read_store(spark, store_path), "1.1.1.1").where("status = 200")
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(ip,1.1.1.1)" in plan and "EqualTo(status,200)" in plan
    report = R.status_breakdown(where_ip(store.read_store(spark, store_path), "1.1.1.1"))
    report_plan = report._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ip:string,status:int,bytes:bigint>" in report_plan  # column pruning


def test_store_cross_path_agreement(spark, lines_df, store_path):
    scan = R.status_breakdown(parse(lines_df(LINES))).collect()
    from_store = R.status_breakdown(store.read_store(spark, store_path)).collect()
    assert scan == from_store


def test_tables_load_overwrite_and_sql(spark, lines_df):
    location = scratch_path(spark, "t-table")
    name = tables.create_log_table(spark, "logtally_t_table", location=location)
    tables.load_lines(spark, name, lines_df(LINES))
    tables.load_lines(spark, name, lines_df(LINES))
    tables.parsed_view(spark, name, "logtally_t_view")
    twice = {r.status: r.bytes for r in status_share_sql(spark, "logtally_t_view").collect()}
    assert twice == {"200": 34.0, "404": 10.0, "304": None, None: None}
    tables.load_lines(spark, name, lines_df(LINES), overwrite=True)
    once = {r.status: (r.bytes, r.pct) for r in status_share_sql(spark, "logtally_t_view").collect()}
    assert once["200"] == (17.0, pytest.approx(100 * 17 / 22))
    tables.drop_table(spark, name)
    assert os.path.isdir(location.replace("file:", ""))  # external: files survive the drop


def test_table_location_with_a_quote(spark, lines_df):
    location = scratch_path(spark, "t-it's a table")
    name = tables.create_log_table(spark, "logtally_t_quote", location=location)
    tables.load_lines(spark, name, lines_df(LINES))
    assert sorted(r.line for r in spark.table(name).collect()) == sorted(LINES)
    tables.drop_table(spark, name)
    assert read_lines(spark, location).count() == len(LINES)


def test_store_takes_serde_records(spark, lines_df):
    """SerDe records (strings, ``-`` allowed) are typed on the way in; the store reads back."""
    lines = [
        '1.1.1.1 - - [x] "G" - 5 "-" "a"',
        '2.2.2.2 - - [x] "G" 200 - "-" "a"',
        '3.3.3.3 - - [x] "G" 404 7',
    ]
    path = scratch_path(spark, "t-serde-store")
    store.ingest_lines(lines_df(lines), path, dialect="regexserde", on_bad_bytes="null")
    got = sorted((r.ip, r.status, r.bytes, r.agent) for r in store.read_store(spark, path).collect())
    assert got == [("1.1.1.1", None, 5, '"a"'), ("2.2.2.2", 200, None, '"a"'), ("3.3.3.3", 404, 7, None)]


def test_ip_bucket_same_in_python_and_spark(spark):
    values = ["10.2.7.128", "1.2.3.4", "1", "", None, "host.example", "\u00e9\u00e8x", "\U0001f600ab", "~"]
    df = spark.createDataFrame([(v,) for v in values], "ip string")
    got = [r.k for r in df.select(store.ip_bucket(df["ip"], 64).alias("k")).collect()]
    assert got == [store.ip_bucket_of(v, 64) for v in values]


@pytest.mark.parametrize("dialect", ["combined", "regexserde"])
def test_ingest_lines_equals_append_of_parsed(spark, lines_df, dialect):
    """Raw lines store the same records as parsed ones."""
    from tests.test_parse import _generated_lines

    lines = lines_df(_generated_lines(n=600, seed=11) + LINES)
    a, b = scratch_path(spark, "t-ingest-a"), scratch_path(spark, "t-ingest-b")
    store.ingest_lines(lines, a, dialect=dialect, on_bad_bytes="null", partitions=3)
    store.append(parse(lines, dialect, "null"), b, partitions=3)
    got, want = (sorted(map(tuple, store.read_store(spark, p).collect()), key=repr) for p in (a, b))
    assert len(got) > 100 and got == want


def test_ip_lookup_with_any_text_as_ip(spark, lines_df):
    """SerDe hosts can hold any non-space text; lookups find them before and after a
    compaction."""
    hosts = ["a/b", "=%x", "é:1", "1.2.3.4"]
    lines = [f'{h} - - [x] "G" 200 {i + 1}' for i, h in enumerate(hosts)]
    path = scratch_path(spark, "t-key-chars")
    store.ingest_lines(lines_df(lines), path, dialect="regexserde", on_bad_bytes="null")
    for _ in range(2):
        for i, host in enumerate(hosts):
            got = [(r.ip, r.bytes) for r in store.read_store(spark, path, ip=host).collect()]
            assert got == [(host, i + 1)], host
        store.compact(spark, path)


@pytest.mark.parametrize("path_kind", ["append", "ingest_lines"])
def test_equal_lines_spread_over_files(spark, lines_df, path_kind):
    """Half of the input being one identical line is no key of anything: it is written by
    the tasks that read it, or dealt out evenly with ``partitions``."""
    lines = [f'10.0.{i % 50}.{i % 7} - - [x] "G /{i}" 200 {i}' + ' "-" "a"' for i in range(3000)]
    lines += ['9.9.9.9 - - [x] "G /same" 200 7 "-" "a"'] * 3000
    df = lines_df(lines)
    path = scratch_path(spark, "t-hot")
    if path_kind == "append":
        store.append(parse(df), path, partitions=6)
    else:
        store.ingest_lines(df, path, partitions=6)
    records = spark.read.parquet(path).where("ip = '9.9.9.9'").selectExpr("_metadata.file_path AS f")
    per_file = sorted(r["count"] for r in records.groupBy("f").count().collect())
    assert len(per_file) == 6 and per_file[-1] < 2 * per_file[0]
    assert store.read_store(spark, path, ip="9.9.9.9").count() == 3000


def test_ingest_reads_each_double_gzip_file_once(spark, lines_df):
    out, path = scratch_path(spark, "t-gz2-once"), scratch_path(spark, "t-gz2-store")
    write_double_gzip(lines_df(LINES * 50), out, files=3)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    lines = read_double_gzip(spark, out).mapInArrow(counted, "line string, path string")
    store.ingest_lines(lines.select("line"), path)
    assert reads.value == len(LINES) * 50
    assert store.read_store(spark, path).count() == 100


def test_double_gzip_file_names_with_url_characters(spark, lines_df):
    out = scratch_path(spark, "t-gz2-names")
    write_double_gzip(lines_df(LINES), out, files=1)
    local = out.replace("file:", "")
    (part,) = [f for f in os.listdir(local) if f.endswith(".gz.gz")]
    os.rename(os.path.join(local, part), os.path.join(local, "a#1?x.log.gz.gz"))
    assert sorted(r.line for r in read_double_gzip(spark, out).collect()) == sorted(LINES)


def test_key_value_lines_keep_their_tab(spark):
    out = scratch_path(spark, "t-kv")
    df = spark.createDataFrame([(None, "v"), ("k", None), ("a", "b")], "k string, v string")
    sinks.write_key_value(df, "k", "v", out)
    assert sorted(r.line for r in read_lines(spark, out).collect()) == ["\tv", "a\tb", "k\t"]


def test_managed_table_is_dropped_with_its_files(spark, lines_df):
    name = tables.create_log_table(spark, "logtally_t_managed")
    tables.load_lines(spark, name, lines_df(LINES))
    (kind,) = [r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name == "Type"]
    assert kind == "MANAGED" and spark.table(name).count() == len(LINES)
    tables.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)
