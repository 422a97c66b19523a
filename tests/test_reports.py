"""Reports: golden values published with the original results (FIXTURES.md §3) and the
semantics of every report."""

import pytest
from pyspark.sql import functions as F

from logtally.operators import reports as R
from logtally.operators import sinks
from logtally.operators.parse import parse

# Published global sums per status, in report order (bytes descending).
GLOBAL = [
    (200, 20815630950), (206, 2644272701), (404, 78956562), (302, 11593895), (304, 9225377),
    (301, 3507503), (303, 1211448), (403, 83109), (400, 57272), (500, 53103), (406, 27861),
    (501, 14066), (405, 13580), (408, 1028), (401, 325),
]
GLOBAL_TOTAL = 23564648780
PUBLISHED_PCT = {200: 88.334, 206: 11.221, 404: 0.335, 302: 0.049, 304: 0.039, 301: 0.015, 303: 0.005}

ONE_IP = "178.154.179.250"
ONE_IP_ROWS = [(200, 2704091077), (301, 101791), (302, 187891), (304, 384519), (404, 644171),
               (408, 0), (500, 940)]


def _line(ip, status, size):
    return f'{ip} - - [21/Jul/2009:02:48:13 -0700] "GET /x HTTP/1.1" {status} {size} "-" "agent"'


@pytest.fixture
def golden(spark, lines_df):
    lines = [_line("10.0.0.1", s, b) for s, b in GLOBAL]
    return parse(lines_df(lines))


def test_global_breakdown_golden(golden):
    rows = R.status_breakdown(golden).collect()
    assert [(r.status, r.bytes) for r in rows] == GLOBAL
    assert sum(r.bytes for r in rows) == GLOBAL_TOTAL
    for r in rows:
        assert r.pct == pytest.approx(100 * int(r.bytes) / GLOBAL_TOTAL, rel=1e-12)
        if r.status in PUBLISHED_PCT:
            assert r.pct == pytest.approx(PUBLISHED_PCT[r.status], abs=5e-4)


def test_one_ip_breakdown_keeps_zero_status(spark, lines_df):
    lines = [_line(ONE_IP, s, b) for s, b in ONE_IP_ROWS] + [_line("1.1.1.1", 200, 5)]
    rows = R.status_breakdown(parse(lines_df(lines)), ONE_IP, order="status").collect()
    assert [(r.status, r.bytes) for r in rows] == ONE_IP_ROWS
    assert sum(r.bytes for r in rows) == 2705410389
    assert [r for r in rows if r.status == 408][0].pct == 0.0


def test_global_denominator(spark, lines_df):
    lines = [_line("1.1.1.1", 200, 30), _line("1.1.1.1", 404, 10), _line("2.2.2.2", 200, 60)]
    parsed = parse(lines_df(lines))
    rows = R.status_breakdown(parsed, "1.1.1.1", denominator="global", order="status").collect()
    assert [(r.status, r.bytes, r.pct) for r in rows] == [(200, 30, 30.0), (404, 10, 10.0)]
    own = R.status_breakdown(parsed, "1.1.1.1", order="status").collect()
    assert [(r.status, r.pct) for r in own] == [(200, 75.0), (404, 25.0)]


def test_bytes_order_breaks_ties_by_status_desc(spark, lines_df):
    parsed = parse(lines_df([_line("1.1.1.1", s, 5) for s in (200, 404, 301)]))
    assert [r.status for r in R.status_breakdown(parsed).collect()] == [404, 301, 200]


@pytest.fixture
def small(spark, lines_df):
    lines = [
        _line("1.1.1.1", 200, 10), _line("1.1.1.1", 404, 5), _line("2.2.2.2", 200, 15),
        _line("3.3.3.3", 304, 0), 'host.example - - [x] "G" 200 7 "-" "a"',
    ]
    return parse(lines_df(lines))


def test_totals(small):
    assert R.total_bytes(small).first().total_bytes == 37
    assert R.status_total(small, 200).first().asDict() == {"status": 200, "bytes": 32}
    assert R.status_total(small, 500).first().asDict() == {"status": 500, "bytes": 0}
    assert [tuple(r) for r in R.status_range(small, 300, 499).collect()] == [(304, 0), (404, 5)]
    assert R.ip_total(small, "1.1.1.1").first().asDict() == {"ip": "1.1.1.1", "bytes": 15, "hits": 2}
    assert R.ip_total(small, "9.9.9.9").first().asDict() == {"ip": "9.9.9.9", "bytes": 0, "hits": 0}


def test_ip_reports(small):
    assert {r.ip: (r.bytes, r.hits) for r in R.ip_bytes(small).collect()} == {
        "1.1.1.1": (15, 2), "2.2.2.2": (15, 1), "3.3.3.3": (0, 1), "": (7, 1)}
    assert {r.ip: r.hits for r in R.ip_hits(small).collect()}["1.1.1.1"] == 2
    # tie on 15 bytes: the smaller IP string wins; the empty IP never does
    assert R.top_ip(small).first().asDict() == {"ip": "1.1.1.1", "bytes": 15}
    assert [r.ip for r in R.top_ips(small, 3).collect()] == ["1.1.1.1", "2.2.2.2", "3.3.3.3"]
    assert [r.ip for r in R.distinct_values(small, "ip").collect()] == ["", "1.1.1.1", "2.2.2.2", "3.3.3.3"]


def test_top_ip_default_when_nothing_positive(spark, lines_df):
    parsed = parse(lines_df([_line("1.1.1.1", 200, 0), 'h - - [x] "G" 200 9 "-" "a"']))
    assert R.top_ip(parsed).first().asDict() == {"ip": "", "bytes": 0}


def test_ip_list_breakdown_list_and_frame(small):
    from_list = sorted(tuple(r) for r in R.ip_list_breakdown(small, ["1.1.1.1", "3.3.3.3"]).collect())
    assert from_list == [("1.1.1.1", 200, 10), ("1.1.1.1", 404, 5), ("3.3.3.3", 304, 0)]
    keys = R.top_ips(small, 1).select("ip")
    assert sorted(tuple(r) for r in R.ip_list_breakdown(small, keys).collect()) == from_list[:2]


def test_status_map_and_text(small):
    row = sinks.status_map_text(R.status_map(small)).first()
    assert row.selection == "all" and row.total == 37
    assert row.text == "200=32\n304=0\n404=5 from a total of 37"


def test_merge_status_maps(small):
    maps = R.line_status_maps(small, F.col("ip"))
    merged = {r.selection: (r.total, dict(r.statuses)) for r in R.merge_status_maps(maps).collect()}
    assert merged["1.1.1.1"] == (15, {"200": 10, "404": 5})
    # merging already merged maps again changes nothing
    again = {r.selection: (r.total, dict(r.statuses)) for r in R.merge_status_maps(
        R.merge_status_maps(maps).select("selection", "statuses")).collect()}
    assert again == merged


def test_sum_identical_and_ctrl_a(spark, lines_df):
    line = 'h - - [x] "G" 200 - "-" "a"'
    parsed = parse(lines_df([_line("1.1.1.1", 200, 3), _line("1.1.1.1", 200, 4), line]), "combined", "zero")
    summed = R.sum_identical(parsed)
    assert sorted(r.bytes for r in summed.collect()) == [0, 7]
    rendered = sorted(r.line for r in sinks.ctrl_a_lines(summed).collect())
    assert rendered[0].split("\u0001")[0] == "1.1.1.1" and rendered[0].endswith("\u00017")
    assert rendered[1].split("\u0001")[0] == "null" and len(rendered[1].split("\u0001")) == 9


def test_breakdown_of_ips_with_status_equals_key_list_path(small):
    """The one-scan window form gives the rows of the semi join with a derived key set."""
    keys = R.distinct_values(small.where("status = 404"), "ip")
    want = sorted(tuple(r) for r in R.ip_list_breakdown(small, keys).collect())
    got = sorted(tuple(r) for r in R.breakdown_of_ips_with_status(small, 404).collect())
    assert want and got == want


def test_top_ips_breakdown_of_all_ips(spark):
    rows = [(f"10.0.{i % 50}.1", str(200 + i % 3), i) for i in range(300)] + [("", "200", 9), (None, "200", 9)]
    parsed = spark.createDataFrame(rows, "ip string, status string, bytes long")
    every = R.top_ips_breakdown(parsed, None)
    large = R.top_ips_breakdown(parsed, 10_000_000)  # more places than there are IPs
    assert sorted(map(tuple, every.collect())) == sorted(map(tuple, large.collect()))
    assert every.select("ip").distinct().count() == 50
    plan = every._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Limit" not in plan and "SinglePartition" not in plan


def test_top_ips_breakdown_leaves_out_missing_ips(spark, lines_df):
    lines = ['2.2.2.2 - - [x] "G" 200 5', '1.1.1.1 - - [x] "G" 200 4', "junk"]
    parsed = parse(lines_df(lines), "regexserde", "null")
    assert [tuple(r) for r in R.top_ips_breakdown(parsed, 1).collect()] == [("2.2.2.2", "200", 5)]
    df = R.top_ips_breakdown(parsed, 10)
    assert sorted(r.ip for r in df.collect()) == ["1.1.1.1", "2.2.2.2"]
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_beyond_64_bits(spark, lines_df, ansi):
    big = 9_000_000_000_000_000_000
    lines = [_line("1.1.1.1", 200, big)] * 3 + [_line("1.1.1.1", 404, -5)]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        parsed = parse(lines_df(lines))
        rows = R.status_breakdown(parsed).collect()
        assert [(r.status, int(r.bytes)) for r in rows] == [(200, 3 * big), (404, -5)]
        assert int(R.total_bytes(parsed).first().total_bytes) == 3 * big - 5
        assert int(R.top_ip(parsed).first().bytes) == 3 * big - 5
        assert int(R.status_map(parsed).first().total) == 3 * big - 5
        assert int(R.merge_status_maps(R.line_status_maps(parsed)).first().total) == 3 * big - 5
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_serde_statuses_through_the_reports(spark, lines_df):
    lines = ['1.1.1.1 - - [x] "G" - 5', '1.1.1.1 - - [x] "G"  6', '1.1.1.1 - - [x] "G" 200 7', "junk"]
    parsed = parse(lines_df(lines), "regexserde", "null")
    assert R.status_total(parsed, 200).first().bytes == 7
    assert [r.status for r in R.status_range(parsed, 0, 999).collect()] == ["200"]
    assert set(R.status_map(parsed).first().statuses) == {"-", "", "200", "null"}
    assert set(R.merge_status_maps(R.line_status_maps(parsed)).first().statuses) == {"-", "", "200", "null"}
    plan = R.status_breakdown(parsed)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert len(R.status_breakdown(parsed).collect()) == 4
