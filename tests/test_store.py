"""The store: generations, tiers, key lists, terms, rejects."""

import os
import random

import pytest
from pyspark.sql import functions as F

from logtally.operators import reports as R
from logtally.operators import store
from logtally.operators.parse import parse, rejects
from logtally.session import scratch_path
from logtally.sources import hadoop_fs

ALL = [
    '1.1.1.1 - - [x] "G /a" 200 10 "-" "a"',
    '2.2.2.2 - - [x] "G /b" 404 5 "-" "a"',
    '1.1.1.1 - - [x] "G /c" 304 - "-" "a"',
    'h - u [x] "G /d" 200 7',
    "junk é",
    "",
]


def line(ip, status=200, size=1, path="/"):
    return f'{ip} - - [x] "G {path}" {status} {size} "-" "a"'


def ips(df):
    return sorted(r.ip for r in df.collect())


def failing(spark, good):
    """Rows of which the last task raises."""
    return good.unionByName(
        spark.range(1).selectExpr("raise_error('the job fails') AS line")
    )


@pytest.mark.parametrize("merged", [False, True])
def test_failed_rewrite_keeps_the_old_rows(spark, lines_df, merged):
    path = scratch_path(spark, "t-gen")
    store.ingest_lines(lines_df([line("1.1.1.1")] * 3), path, segment="a")
    if merged:
        store.compact(spark, path)
    before = store.read_store(spark, path)
    with pytest.raises(Exception, match="the job fails"):
        store.ingest_lines(failing(spark, lines_df([line("2.2.2.2")])), path, segment="a")
    assert ips(store.read_store(spark, path)) == ["1.1.1.1"] * 3
    store.ingest_lines(lines_df([line("3.3.3.3")]), path, segment="a")
    assert ips(before) == ["1.1.1.1"] * 3  # a reader open meanwhile goes on
    assert ips(store.read_store(spark, path)) == ["3.3.3.3"]
    assert len(store.sweep(spark, path)) == 1  # the failed append's folder
    store.vacuum(spark, path)
    assert ips(store.read_store(spark, path)) == ["3.3.3.3"]


def test_rewrites_across_compactions_and_vacuum(spark, lines_df):
    """A segment written again before and after its folders are merged and forgotten."""
    path = scratch_path(spark, "t-rewrite")
    write = lambda ip, segment: store.ingest_lines(lines_df([line(ip)]), path, segment=segment)
    store.ingest_lines(lines_df([line("9.9.9.9")] * 200), path, segment="big")
    write("1.0.0.1", "a")
    store.compact(spark, path)
    store.vacuum(spark, path)
    write("1.0.0.2", "a")  # merged and vacuumed: known by its name file only
    assert ips(store.read_store(spark, path))[:2] == ["1.0.0.2", "9.9.9.9"]
    store.compact(spark, path, full=False)
    write("1.0.0.3", "a")
    write("2.0.0.1", "b")
    assert ips(store.read_store(spark, path))[:3] == ["1.0.0.3", "2.0.0.1", "9.9.9.9"]
    store.compact(spark, path)
    store.vacuum(spark, path)
    assert ips(store.read_store(spark, path))[:3] == ["1.0.0.3", "2.0.0.1", "9.9.9.9"]
    store.compact(spark, path, full=True)
    store.vacuum(spark, path)
    assert ips(store.read_store(spark, path))[:3] == ["1.0.0.3", "2.0.0.1", "9.9.9.9"]
    assert len(hadoop_fs.child_names(spark, f"{path}/_live")) == 0
    assert len(hadoop_fs.child_names(spark, f"{path}/_current")) == 1


def test_a_rewrite_during_a_compaction_wins(spark, lines_df, monkeypatch):
    path = scratch_path(spark, "t-race")
    store.ingest_lines(lines_df([line("1.1.1.1")]), path, segment="a")
    store.ingest_lines(lines_df([line("5.5.5.5")]), path, segment="b")
    publish = store._publish

    def late(*args):
        monkeypatch.setattr(store, "_publish", publish)
        store.ingest_lines(lines_df([line("2.2.2.2")]), path, segment="a")
        publish(*args)

    monkeypatch.setattr(store, "_publish", late)
    store.compact(spark, path)
    assert ips(store.read_store(spark, path)) == ["2.2.2.2", "5.5.5.5"]
    store.compact(spark, path, full=True)
    assert ips(store.read_store(spark, path)) == ["2.2.2.2", "5.5.5.5"]


def test_two_compactions_at_once(spark, lines_df, monkeypatch):
    path = scratch_path(spark, "t-two")
    store.ingest_lines(lines_df([line("1.1.1.1")]), path)
    publish = store._publish

    def late(*args):
        monkeypatch.setattr(store, "_publish", publish)
        store.compact(spark, path)
        publish(*args)

    monkeypatch.setattr(store, "_publish", late)
    with pytest.raises(Exception, match="(?i)exist"):
        store.compact(spark, path)
    assert ips(store.read_store(spark, path)) == ["1.1.1.1"]


def test_small_appends_do_not_rewrite_the_large_run(spark, lines_df, monkeypatch):
    """One large and many small appends, each compacted: bytes written by compactions."""
    path = scratch_path(spark, "t-tiers")
    rnd = random.Random(5)
    some = lambda n: [line(f"10.{rnd.randrange(256)}.{rnd.randrange(256)}.{rnd.randrange(256)}", 200, i, f"/{rnd.random()}") for i in range(n)]
    large, small, k = 20_000, 150, 8
    store.ingest_lines(lines_df(some(large)).coalesce(1), path)
    written = {}
    size_of = hadoop_fs.size_of
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    monkeypatch.setattr(store, "IP_BUCKETS", 1)
    first = store.compact(spark, path)
    sizes = [size_of(spark, f"{path}/run={first}")]
    for _ in range(k):
        store.ingest_lines(lines_df(some(small)).coalesce(1), path)
        name = store.compact(spark, path)
        written[name] = size_of(spark, f"{path}/run={name}")
    runs = store._pointer(spark, path)["runs"]
    assert any(r["id"] == first for r in runs) and len(runs) <= 5
    one = min(written.values())
    # Every append is written again at most about log(k) to the base 1.5 times.
    assert sum(written.values()) < one * k * 5 and sum(written.values()) < sizes[0] * 2
    assert store.read_store(spark, path).count() == large + k * small
    store.compact(spark, path, full=True)
    assert len(store._pointer(spark, path)["runs"]) == 1
    store.vacuum(spark, path)
    assert store.read_store(spark, path).count() == large + k * small
    assert [n for n in hadoop_fs.child_names(spark, path) if n.startswith(("run=", "segment="))] == [
        f"run={store._pointer(spark, path)['runs'][0]['id']}"
    ]


@pytest.fixture
def spread(spark, lines_df):
    path = scratch_path(spark, "t-list")
    lines = [line(f"10.0.{i % 40}.{i % 7}", 200 + i % 3, i) for i in range(2000)]
    store.ingest_lines(lines_df(lines), path)
    store.compact(spark, path)
    return path


def test_a_key_list_opens_its_buckets_only(spark, spread):
    wanted = ["10.0.3.3", "10.0.8.1", "10.0.21.0", "no such ip"]
    found = store.read_store(spark, spread, ips=wanted)
    buckets = {f.rsplit("/", 2)[1] for f in found.inputFiles()}
    assert 1 <= len(buckets) <= 4
    want = sorted(map(tuple, store.read_store(spark, spread).where(F.col("ip").isin(wanted)).collect()))
    assert want and sorted(map(tuple, found.collect())) == want
    assert "In(ip, [" in found._jdf.queryExecution().executedPlan().toString()
    assert store.read_store(spark, spread, ips=[]).collect() == []


def test_a_key_table_prunes_buckets_at_run_time(spark, spread):
    rows = [("10.0.3.3",), ("10.0.8.1",), ("no such ip",), (None,), ("10.0.3.3",)]
    keys = spark.createDataFrame(rows, "ip string").where("ip LIKE '10.%'")
    found = store.read_store(spark, spread, ips=keys)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "ip_bucket" in plan
    want = sorted(map(tuple, store.read_store(spark, spread, ips=["10.0.3.3", "10.0.8.1"]).collect()))
    assert want and sorted(map(tuple, found.collect())) == want


def test_terms_equal_the_records(spark, lines_df):
    """Every report from terms equals the same from records: after appends, a compaction, a
    replacement of a merged segment, and its compaction."""
    path = scratch_path(spark, "t-terms")
    lines = [line(f"10.0.{i % 9}.1", 200 + i % 4, 2**62 if i % 50 == 0 else i) for i in range(400)]
    store.ingest_lines(lines_df([*lines, *ALL]), path, segment="a", on_bad_bytes="null")
    store.ingest_lines(lines_df(lines[:90]), path, segment="b")
    store.append(parse(lines_df(['5.5.5.5 - - [x] "G" 1999 7', '5.5.5.5 - - [x] "G" - 7', "junk"]), "regexserde", "null"), path)

    def check():
        records, terms = store.read_store(spark, path), store.read_terms(spark, path)
        for report in (
            R.status_bytes, R.status_breakdown, R.ip_bytes, R.ip_hits, R.top_ip, R.total_bytes,
            lambda d: R.status_breakdown(d, "10.0.3.1", denominator="global"),
            lambda d: R.status_range(d, 200, 2000), lambda d: R.ip_total(d, "10.0.3.1"), lambda d: R.ip_total(d, "nobody"),
            lambda d: R.top_ips(d, 3), lambda d: R.distinct_values(d, "ip"), lambda d: R.distinct_values(d, "status"),
            lambda d: R.ip_list_breakdown(d, ["10.0.1.1", "5.5.5.5"]), lambda d: R.top_ips_breakdown(d, 2),
            lambda d: R.breakdown_of_ips_with_status(d, 404), lambda d: R.status_map(d, F.col("ip")),
        ):
            want, got = (sorted(map(str, report(d).collect())) for d in (records, terms))
            assert got == want
        return terms

    for act in (
        lambda: None,
        lambda: store.compact(spark, path),
        lambda: store.ingest_lines(lines_df(lines[5:60]), path, segment="a"),
        lambda: store.compact(spark, path, full=True),
    ):
        act()
        terms = check()
    files = R.top_ip(terms).inputFiles()
    assert files and all("/_terms/" in f for f in files)  # no record file is read
    assert store.read_terms(spark, scratch_path(spark, "t-none")).collect() == []


def test_top_ips_read_few_entries(spark, lines_df):
    """The exact top IPs of three dictionaries, with ties; most entries are never candidates."""
    path = scratch_path(spark, "t-top")
    rnd = random.Random(8)
    for k in range(3):
        some = [line(f"10.{i % 250}.{i // 250}.1", 200, rnd.randrange(50)) for i in range(3000)]
        some += [line(f"20.0.0.{i}", 404, 100_000 * (1 + i % 4), f"/{k}") for i in range(12)]
        some += [line("30.0.0.1", 200, 2**62), line("30.0.0.1", 200, 2**62), line("30.0.0.2", 200, 0)]
        store.ingest_lines(lines_df([*some, 'h - u [x] "G /d" 200 7']), path, segment=f"s{k}")
        if k == 1:
            store.compact(spark, path)
    want = {n: R.top_ips(store.read_store(spark, path), n).collect() for n in (1, 3, 7, 5000)}
    assert want[1][0].bytes == 6 * 2**62
    for n, rows in want.items():
        entries = store.top_entries(spark, path, n)
        assert R.top_ips(entries, n).collect() == rows
        assert n > 12 or entries.count() <= 13 * 3  # of some 6,000
    assert R.top_ip(store.top_entries(spark, path, 1)).collect() == R.top_ip(store.read_store(spark, path)).collect()
    store.ingest_lines(lines_df([line("1.1.1.1", 200, -5), line("2.2.2.2", 200, 3)]), path, segment="s0")  # replaced in a run
    for n in (1, 3, 7):
        assert R.top_ips(store.top_entries(spark, path, n), n).collect() == R.top_ips(store.read_store(spark, path), n).collect()
    assert R.top_ips(store.top_entries(spark, scratch_path(spark, "t-none"), 3), 3).collect() == []


def test_share_of_many_statuses_gathers_no_groups(spark, lines_df):
    path = scratch_path(spark, "t-open")
    store.append(spark.range(20_000).selectExpr(
        "'1.1.1.1' AS ip", "'' AS client", "'' AS user", "'' AS date_time", "'' AS request", "CAST(id AS INT) AS status",
        "id AS bytes", "'' AS referer", "'' AS agent"), path)
    shares = R.status_breakdown(store.read_store(spark, path), order=None)
    plan = shares._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Subquery" in plan
    rows = shares.collect()
    assert len(rows) == 20_000 and sum(r.pct for r in rows) == pytest.approx(100)
    closed = scratch_path(spark, "t-closed")
    store.ingest_lines(lines_df(ALL), closed)
    assert R.status_breakdown(store.read_store(spark, closed)).count() == 2


@pytest.mark.parametrize(("dialect", "policy"), [("combined", "drop"), ("combined", "zero"), ("regexserde", "zero"), ("regexserde", "drop"), ("regexserde", None)])
def test_rejects_are_kept_by_the_ingest(spark, lines_df, dialect, policy):
    path = scratch_path(spark, "t-rejects")
    lines = lines_df([*ALL, None])
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    store.ingest_lines(lines.mapInArrow(counted, "line string"), path, dialect, policy)
    assert reads.value == len(ALL) + 1  # one pass
    want = [tuple(r) for r in rejects(lines, dialect).collect()]
    if policy != "drop":
        want = [r for r in want if r[1] == "no_match"]
    records = parse(lines, dialect, policy).where("request IS NOT NULL").count()
    for _ in range(2):
        got = [tuple(r)[:2] for r in store.read_rejects(spark, path).collect()]
        assert sorted(got, key=str) == sorted(want, key=str) and ("junk é", "no_match") in got
        assert store.read_store(spark, path).count() == records > 0
        store.compact(spark, path)
    assert store.read_store(spark, path).where("bytes IS NULL AND ip IS NULL").count() == 0


def test_fail_policy_still_fails(spark, lines_df):
    path = scratch_path(spark, "t-fail")
    with pytest.raises(Exception, match="unparsable byte count"):
        store.ingest_lines(lines_df(ALL), path, on_bad_bytes="fail")
    assert store.read_store(spark, path).collect() == [] and store.read_rejects(spark, path).collect() == []


def test_files_of_an_append_follow_its_tasks(spark, lines_df):
    """Records and rejects of each task, and nothing else, in a segment's folder."""
    path = scratch_path(spark, "t-files")
    store.ingest_lines(lines_df(ALL * 20).repartition(3), path)
    (segment,) = [n for n in os.listdir(path.removeprefix("file:")) if n.startswith("segment=")]
    found = [f for _, _, names in os.walk(f"{path.removeprefix('file:')}/{segment}") for f in names if f.endswith(".parquet")]
    assert len(found) <= 6


def test_a_compaction_deals_a_hot_ip_to_many_tasks(spark, lines_df, monkeypatch):
    """Half of the rows are one line, which shrinks to nothing in a shuffle: no task of the
    compaction gets many more rows than its share of the bytes in memory."""
    monkeypatch.setattr(store, "TASK_BYTES", 1 << 17)
    monkeypatch.setattr(store, "LEAST_TASK_BYTES", 1 << 16)
    path = scratch_path(spark, "t-hot-run")
    same = [line("9.9.9.9", 200, 7)] * 6000
    lines = [line(f"10.{i % 3}.{i % 40}.{i % 7}", 200 + i % 3, i) for i in range(5900)]
    store.ingest_lines(lines_df(same + lines + ["no record"] * 100).coalesce(1), path)
    want = sorted(map(tuple, store.read_store(spark, path).collect()))
    run = store.compact(spark, path)
    found = spark.read.parquet(f"{path}/run={run}").selectExpr("_metadata.file_path AS f", "ip")
    tasks = found.groupBy(F.regexp_extract("f", r"part-(\d+)", 1)).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("ip") == "9.9.9.9", 1)).alias("hot")
    )
    rows = tasks.collect()
    assert sum(r["n"] for r in rows) == 12000 and max(r["n"] for r in rows) < 1500
    assert sum(r["hot"] > 0 for r in rows) > 4
    assert sorted(map(tuple, store.read_store(spark, path).collect())) == want
    assert store.read_rejects(spark, path).count() == 100
