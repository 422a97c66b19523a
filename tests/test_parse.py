"""Edge lines for both dialects, byte policies, rejects and counters (FIXTURES.md §2)."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from logtally.functions.parse import raw_fields
from logtally.functions.patterns import COMBINED
from logtally.operators.parse import clean_lines, observe_counts, parse, parse_counts, rejects
from logtally.operators.select import prefilter_lines, where_ip

COMBINED_EDGES = [
    # line, ip, client, user, request, status, bytes (None = not an integer)
    ('1.2.3.4 - - [x] "GET / HTTP/1.1" 200 10 "-" "a"', "1.2.3.4", "-", "-", "GET / HTTP/1.1", 200, 10),
    ('1234.5.6.7 - - [x] "G" 200 10 "-" "a"', "234.5.6.7", "-", "-", "G", 200, 10),
    ('h - - [x] "G" 200 - "-" "a"', "", "-", "-", "G", 200, None),
    ('1.2.3.45 - - [x] "G" 200 1 "-" "a"', "1.2.3.45", "-", "-", "G", 200, 1),
    ('1.2.3.4 - bob smith [x] "G" 200 1 "-" "a"', "", "bob", "smith", "G", 200, 1),
    ('1.2.3.4 - - [x] "G \\" q" 200 1 "-" "a"', "1.2.3.4", "-", "-", 'G \\" q', 200, 1),
]


def _rows(df, cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_combined_edge_lines(spark, lines_df):
    df = parse(lines_df([e[0] for e in COMBINED_EDGES]), "combined", "null")
    got = _rows(df, ["ip", "client", "user", "request", "status", "bytes"])
    assert got == [e[1:] for e in COMBINED_EDGES]


def test_combined_keeps_brackets_strips_quotes(spark, lines_df):
    row = parse(lines_df(['9.9.9.9 a b [d t] "r q" 404 7 "ref" "ag ent"'])).first()
    assert row.asDict() == {
        "ip": "9.9.9.9", "client": "a", "user": "b", "date_time": "[d t]", "request": "r q",
        "status": 404, "bytes": 7, "referer": "ref", "agent": "ag ent",
    }


def test_combined_needs_referer_and_agent(spark, lines_df):
    assert parse(lines_df(['1.2.3.4 - - [x] "G /" 200 10'])).count() == 0


def test_regexserde_edge_lines(spark, lines_df):
    df = parse(
        lines_df([
            '1.2.3.4 - - [x] "G /" 200 10 "-" "a"',
            '1.2.3.4 - - [x] "G /" 304 -',
            "garbage",
            'x 1.2.3.4 - - [x] "G /" 200 10 "-" "a"',
        ]),
        "regexserde",
    )
    assert [tuple(r) for r in df.collect()] == [
        ("1.2.3.4", "-", "-", "[x]", '"G /"', "200", "10", '"-"', '"a"'),
        ("1.2.3.4", "-", "-", "[x]", '"G /"', "304", "-", None, None),
        (None,) * 9,
        (None,) * 9,
    ]


@pytest.mark.parametrize("dialect", ["combined", "regexserde"])
def test_separator_characters_take_the_exact_path(spark, lines_df, dialect):
    """Lines containing the packing separators give the same fields as per-field
    extraction."""
    weird = [
        '1.2.3.4 - u\u0001x [x] "G\u0002 /" 200 5 "r\u0001" "a"',
        '\u00021.2.3.4 - - [x] "G /" 200 5 "-" "a"',
        '1.2.3.4 - - [x] "G /" 200 5 "-" "a\u0001\u0002"',
        '\u0001 garbage',
    ]
    df = lines_df(weird)
    fast = parse(df, dialect, "null" if dialect == "combined" else None)
    if dialect == "combined":
        slow = df.where(F.col("line").rlike(COMBINED))
        slow = slow.select(*raw_fields(F.col("line"), dialect)).withColumn(
            "status", F.col("status").cast("int")).withColumn("bytes", F.col("bytes").try_cast("bigint"))
    else:
        slow = df.select(*raw_fields(F.col("line"), dialect))
    assert [tuple(r) for r in fast.collect()] == [tuple(r) for r in slow.collect()]


POLICY_LINES = [
    '1.1.1.1 - - [x] "G" 200 10 "-" "a"',
    '1.1.1.1 - - [x] "G" 304 - "-" "a"',
    '2.2.2.2 - - [x] "G" 304 5 "-" "a"',
    '3.3.3.3 - - [x] "G" 404 - "-" "a"',
    "junk",
]


def _sums(df):
    return {r.status: r.bytes for r in df.groupBy("status").agg(F.sum("bytes").alias("bytes")).collect()}


def test_policy_drop(spark, lines_df):
    assert _sums(parse(lines_df(POLICY_LINES), "combined", "drop")) == {200: 10, 304: 5}


def test_policy_zero(spark, lines_df):
    assert _sums(parse(lines_df(POLICY_LINES), "combined", "zero")) == {200: 10, 304: 5, 404: 0}


def test_policy_null_keeps_status_group(spark, lines_df):
    assert _sums(parse(lines_df(POLICY_LINES), "combined", "null")) == {200: 10, 304: 5, 404: None}


def test_policy_fail_raises(spark, lines_df):
    with pytest.raises(PySparkException, match="unparsable byte count"):
        parse(lines_df(POLICY_LINES), "combined", "fail").collect()


def test_policy_fail_on_clean_lines(spark, lines_df):
    clean = clean_lines(lines_df(POLICY_LINES))
    assert _sums(parse(clean, "combined", "fail")) == {200: 10, 304: 5}


def test_rejects_and_counts(spark, lines_df):
    df = lines_df(POLICY_LINES)
    assert sorted(tuple(r) for r in rejects(df).collect()) == sorted([
        ('1.1.1.1 - - [x] "G" 304 - "-" "a"', "bad_bytes"),
        ('3.3.3.3 - - [x] "G" 404 - "-" "a"', "bad_bytes"),
        ("junk", "no_match"),
    ])
    assert parse_counts(df).first().asDict() == {"lines": 5, "matched": 4, "bad_bytes": 2, "usable": 2}


def test_observe_counts_rides_along(spark, lines_df):
    observed, obs = observe_counts(lines_df(POLICY_LINES))
    observed.where("_matched").count()
    assert obs.get == {"lines": 5, "matched": 4, "bad_bytes": 2, "usable": 2}


def test_prefix_has_no_boundary_exact_does(spark, lines_df):
    df = lines_df([e[0] for e in COMBINED_EDGES])
    prefix = parse(prefilter_lines(df, "1.2.3.4", "prefix"), "combined", "zero")
    exact = where_ip(parse(prefilter_lines(df, "1.2.3.4", "exact"), "combined", "zero"), "1.2.3.4")
    assert prefix.count() == 4  # includes 1.2.3.45 and the "bob smith" line (ip '')
    assert exact.count() == 2


def test_value_column_of_text_source(spark):
    df = spark.createDataFrame([('1.2.3.4 - - [x] "G" 200 3 "-" "a"',)], "value string")
    assert parse(df).first().bytes == 3


def test_unknown_options(spark, lines_df):
    with pytest.raises(ValueError):
        parse(lines_df(["x"]), "apache")
    with pytest.raises(ValueError):
        parse(lines_df(["x"]), "combined", "ignore").collect()


def _generated_lines(n=3000, seed=7):
    """Log-like lines from random pieces: valid, near-valid and broken fields, the
    packing separators, doubled spaces, text before and after."""
    import random

    rnd = random.Random(seed)
    pieces = [
        ["1.2.3.4", "1234.5.6.7", "host.example", "", "10.0.0.1", "1.2.3", "1.2.3.4\u0001"],
        ["-", "u1", "bob smith", "", "x\u0002y"],
        ["-", "u2", "", "a b"],
        ["[01/Jan/2024:00:00:00 +0000]", "[x]", "-", "[a]b]", "[]", "[x"],
        ['"GET / HTTP/1.1"', '"G \\" q"', '"', '""', "GET", '"a"b"', '"x y z"'],
        ["200", "404", "-", "20", "2000", ""],
        ["10", "-", "", "1e3", "99999999999999999999", "0", "12a"],
        [' "-" "a"', "", ' "r" "a b"', ' "-"', " - -", ' "x\u0002" "y"', ' "-" "a" extra'],
    ]
    lines = []
    for _ in range(n):
        # each piece keeps its well-formed first value 3 times in 4
        pick = [p[0] if rnd.random() < 0.75 else rnd.choice(p) for p in pieces]
        line = rnd.choice([" ", " ", " ", "  "]).join(pick[:7]) + pick[7]
        lines.append(rnd.choice(["", "", "", "junk ", "\u0002"]) + line)
    return lines


@pytest.mark.parametrize("dialect", ["combined", "regexserde"])
def test_packed_parse_equals_per_field_extraction(spark, dialect):
    """The one-pass parse (packed groups, split once) gives exactly the fields of one
    regexp_extract per field, on thousands of generated near-valid lines."""
    lines = _generated_lines()
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    line = F.col("line")
    if dialect == "combined":
        fast = parse(df, dialect, "null", keep=("i",))
        slow = df.where(line.rlike(COMBINED)).select("i", *raw_fields(line, dialect))
        slow = slow.withColumn("status", F.col("status").cast("int")).withColumn(
            "bytes", F.col("bytes").try_cast("bigint"))
    else:
        fast = parse(df, dialect, keep=("i",))
        slow = df.select("i", *raw_fields(line, dialect))
    got = sorted(tuple(r) for r in fast.collect())
    want = sorted(tuple(r) for r in slow.collect())
    assert len(want) > 100 and got == want


@pytest.mark.parametrize(
    "dialect,policy",
    [("combined", "drop"), ("combined", "null"), ("combined", "zero"), ("regexserde", None),
     ("regexserde", "null")],
)
@pytest.mark.parametrize(
    "fields", [("ip", "status", "bytes"), ("status",), ("agent", "ip"), ("referer",), ("bytes",)]
)
def test_parse_field_subsets_equal_full_parse(spark, dialect, policy, fields):
    """Packing only some groups gives the same rows as the full parse, projected."""
    df = spark.createDataFrame(list(enumerate(_generated_lines(n=800, seed=5))), "i int, line string")
    full = parse(df, dialect, policy, keep=("i",))
    part = parse(df, dialect, policy, keep=("i",), fields=fields)
    ordered = [n for n in ("ip", "client", "user", "date_time", "request", "status", "bytes",
                           "referer", "agent") if n in fields]
    assert part.columns == ["i", *ordered]
    got = sorted(tuple(r) for r in part.collect())
    want = sorted(tuple(r) for r in full.select("i", *ordered).collect())
    assert got == want


def test_null_line_is_no_match(spark):
    df = spark.createDataFrame([(None,), ("junk",)], "line string")
    assert [r.reason for r in rejects(df).collect()] == ["no_match", "no_match"]


def test_queries_pack_only_the_groups_they_use(spark):
    from logtally.plans.queries import QUERIES
    from tests.conftest import SF_SMALL

    for name, groups in {"bytes_zero": "$6\u0001$7\u0001", "hive_style_breakdown": "$6\u0001$7\u0001"}.items():
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert groups in plan and "$1\u0001" not in plan, name
