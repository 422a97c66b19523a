"""The data source for raw logs against the parser of built-in functions."""

import gzip
import io
import os

import pytest

from logtally.operators.parse import parse
from logtally.session import scratch_path
from logtally.sources import accesslog
from logtally.sources.double_gzip import write_double_gzip
from tests.test_parse import _generated_lines

LINES = [
    '1.1.1.1 - - [x] "G /a" 200 10 "-" "a"',
    '2.2.2.2 - - [x] "G /b" 404 +5 "-" "a"',
    '1.1.1.1 - - [x] "G /c" 304 - "-" "a"',
    'h - u [x] "G /d" 200 7',
    'x 3.3.3.3 - - [ ] "a\u0085b" 200 99999999999999999999 "-" ""',
    " - - [d] \"\" 200 \x017 \"\" \"\"",
    "junk é",
    "",
]


@pytest.fixture(scope="module")
def folder(spark):
    accesslog.register(spark)
    path = scratch_path(spark, "t-accesslog").removeprefix("file:")
    os.makedirs(f"{path}/more")
    lines = [x for x in _generated_lines(n=500, seed=3) + LINES if "\n" not in x and "\r" not in x]
    text = [x.encode("utf-8", "replace") for x in lines]
    with open(f"{path}/a#1.log", "wb") as f:
        f.write(b"\n".join(text[:300]))
    with open(f"{path}/more/b.log", "wb") as f:
        f.write(b"\n".join(text[300:400]) + b"\n")
    with gzip.open(f"{path}/c.log.gz", "wb") as f:
        f.write(b"\n".join(text[400:]) + b"\n")
    for hidden in ("_hidden.log", ".x.log"):
        with open(f"{path}/{hidden}", "wb") as f:
            f.write(text[0])
    return path, [x.decode() for x in text]


def read(spark, files, **options):
    return spark.read.format("accesslog").options(files=files, **options).load()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("dialect", "policy"), [("combined", "drop"), ("combined", "null"), ("combined", "zero"), ("regexserde", None), ("regexserde", "null")])
def test_same_rows_as_the_parser(spark, lines_df, folder, dialect, policy):
    path, lines = folder
    options = {"dialect": dialect} | ({"onBadBytes": policy} if policy else {})
    got = read(spark, path, splitBytes="700", **options)
    want = parse(lines_df(lines), dialect, policy)
    assert [f.simpleString() for f in got.schema] == [f.simpleString() for f in want.schema]
    assert rows(got) == rows(want)


def test_ranges_give_every_line_once(folder):
    path, _ = folder
    with open(f"{path}/a#1.log", "rb") as f:
        data = f.read()
    want = data.split(b"\n")
    for size in (1, 2, 7, 100, 333, 5000, len(data) + 1):
        got = []
        for at in range(0, len(data), size):
            stream, part = accesslog.RangeStream(io.BytesIO(data), at, min(at + size, len(data))), b""
            while block := stream.read(64):
                part += block
            got += (part[:-1] if part.endswith(b"\n") else part).split(b"\n") if part else []
        assert got == want, size


def test_filters_are_pushed_and_exact(spark, lines_df, folder):
    path, lines = folder
    name = accesslog.create_log_view(spark, "logtally_t_raw", path)
    parse(lines_df(lines)).createOrReplaceTempView("logtally_t_parsed")
    some = spark.sql("SELECT ip FROM logtally_t_parsed WHERE ip <> '' GROUP BY ip ORDER BY count(*) DESC, ip LIMIT 1").first().ip
    for where, pushed in [
        (f"ip = '{some}'", "EqualTo(ip"),
        (f"ip IN ('{some}', '1.1.1.1') AND status >= 200", "In(ip"),
        ("ip LIKE '1%' AND status < 300", "StringStartsWith(ip"),
        ("status IN (404, 200, 500)", "In(status"),
        ("status > 200 AND bytes > 5 AND agent LIKE '%a%'", "GreaterThan(status"),
        ("ip = ''", "EqualTo(ip"),
    ]:
        got = spark.sql(f"SELECT * FROM {name} WHERE {where}")
        plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
        assert pushed in plan.split("PushedFilters: ", 1)[1].splitlines()[0]
        assert rows(got) == rows(spark.sql(f"SELECT * FROM logtally_t_parsed WHERE {where}")), where
    other = spark.newSession()
    accesslog.register(other)
    assert other.sql(f"SELECT count(*) FROM {name}").first()[0] == spark.table("logtally_t_parsed").count()
    accesslog.drop_log_view(spark, name)
    assert not spark.catalog.tableExists(name) and os.path.exists(f"{path}/c.log.gz")


def test_globs_double_gzip_and_quotes(spark, lines_df, folder):
    path, lines = folder
    assert rows(read(spark, f"{path}/*.log", onBadBytes="null")) == rows(parse(lines_df(lines[:300]), "combined", "null"))
    quoted = scratch_path(spark, "t-it's").removeprefix("file:")
    write_double_gzip(lines_df(lines), quoted, files=2)
    name = accesslog.create_log_view(spark, "logtally_t_quoted", quoted, on_bad_bytes="zero")
    assert rows(spark.table(name)) == rows(parse(lines_df(lines), "combined", "zero"))
    accesslog.drop_log_view(spark, name)


def test_errors(spark, folder):
    path, _ = folder
    with pytest.raises(Exception, match="unparsable byte count"):
        read(spark, path, onBadBytes="fail").collect()
    with pytest.raises(Exception, match="unknown dialect"):
        read(spark, path, dialect="other").collect()
    with pytest.raises(Exception, match="nothing-here"):
        read(spark, f"{path}/nothing-here").collect()
    empty = scratch_path(spark, "t-empty").removeprefix("file:")
    os.makedirs(empty)
    assert read(spark, empty).collect() == []
