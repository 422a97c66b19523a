"""Line dedup: how lines are cut and what of it is computed how often."""

import pytest
from pyspark.sql import functions as F

from logtally.llm import lines

TEXTS = [None, "", " ", "a", "a b\nc", "a  b", " a \n  b", "a\tb\x0bc\x0cd\re", "a\n\n\nb ", "\ta", "a \x0b\x0c b c\nd", "a\x1cb\x85c d"]


def test_gaps_are_the_pattern(spark):
    """Texts that are not searched have no gap to replace."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string")
    whole = F.split(F.regexp_replace(F.coalesce("text", F.lit("")), lines.INNER_GAP, " "), "\n")
    rows = df.select(lines._plain(df["text"]).alias("a"), whole.alias("b"), F.rlike("text", F.lit(lines.INNER_GAP)).alias("c")).collect()
    assert all(r["a"] == r["b"] for r in rows) and {r["c"] for r in rows} == {None, False, True}


@pytest.mark.parametrize("texts", [TEXTS, ["x y z u v w\nx y z u v w"]])
def test_words_of_a_line_are_counted_once(spark, monkeypatch, texts):
    """The generated code of the first step counts a line's words in one place, not for every
    half of it; texts without such gaps are not searched by the pattern."""
    monkeypatch.setattr(lines, "stored", lambda df, name: df)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    parsed = lines.parsed_documents(df, "doc_id", "text")
    assert parsed.where("h IS NULL AND (p1 IS NOT NULL OR s2 IS NOT NULL OR check IS NOT NULL)").count() == 0
    code = spark._jvm.PythonSQLUtils.explainString(parsed._jdf.queryExecution(), "codegen")
    assert 1 <= code.count("StringReplace.exec") <= 2
    assert "CASE WHEN" in parsed._jdf.queryExecution().optimizedPlan().toString()
