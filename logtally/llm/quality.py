"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Four measures of every document (symbols, repeated lines and repeated words per thousand,
mean word length) are summarised per language and source in a sketch: counts of values by
logarithmic bucket with 16 steps per doubling, so every quantile is off by at most 1/16.
Sketches merge by adding counts: the same rows give the sketch of a language and of the
whole corpus, which stand in for a source with fewer than ``MIN_DOCS`` documents. A
document fails a rule beyond the quartile fence of its group, ``Q3 + 3 * (Q3 - Q1)`` plus
the measure's slack (below ``Q1 - 3 * (Q3 - Q1)`` less the slack for word length too).
All values are integers, so results do not depend on the order of rows.

Documents with too few words or too many repeated ones fail the base rules and take no
part in the sketches. Verdicts join on language and source, null-safe and salted.

Defined results: null text has no words and fails; null language or source is a value of
its own; repeated rows are judged one by one; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtally.llm.common import GAP_CHARS, let, reliable, without, words

SYMBOLS = ("#", "*", "$", "%", "&", "|", "<", ">")
WINDOW = 5
MIN_WORDS = 10
MIN_DOCS = 100
SALTS = 16
# Measure: the least distance from the quartile at which a document can fail.
SLACK = {"symbols": 100, "dup_lines": 500, "repeats": 180, "word_length": 300}
TWO_SIDED = ("word_length",)
MEASURES = tuple(SLACK)


def repeated_words(hashes: Column) -> Column:
    """Words in ``WINDOW``-word windows that occur twice or more in the text."""

    def covered(wins: Column) -> Column:
        def positions(s: Column) -> Column:
            same = lambda e, k: (F.get(s, k - 1)["x"] == e["x"]) | (F.get(s, k + 1)["x"] == e["x"])
            return F.sort_array(F.transform(F.filter(s, lambda e, k: F.coalesce(same(e, k), F.lit(False))), lambda e: e["i"]))

        def total(p: Column) -> Column:
            step = lambda v, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - v, F.lit(WINDOW)))
            return F.aggregate(F.transform(p, step), F.lit(0), lambda a, x: a + x)

        tagged = F.transform(wins, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
        return let(let(F.sort_array(tagged), positions), total)

    def count(wins: Column) -> Column:
        return F.when(F.size(F.array_distinct(wins)) == F.size(wins), 0).otherwise(covered(wins))

    wins = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - WINDOW),
        lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(WINDOW))),
    )
    return F.when(F.size(hashes) < WINDOW, 0).otherwise(let(wins, count)).cast("long")


def _coalesced(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def base_measures(docs: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """``keep`` plus n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    t = _coalesced(text)
    by_word = let(
        F.transform(words(text), lambda w: F.xxhash64(w)),
        lambda h: F.struct(F.size(h).cast("long").alias("n"), repeated_words(h).alias("r")),
    )
    by_line = let(
        F.filter(F.split(t, "\n"), lambda x: without(x, GAP_CHARS) != ""),
        lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")),
    )
    return docs.select(
        *keep,
        by_word.alias("bw"),
        by_line.alias("bl"),
        F.char_length(without(t, GAP_CHARS)).cast("long").alias("word_chars"),
        (F.octet_length(t) - F.octet_length(without(t, SYMBOLS))).cast("long").alias("n_symbols"),
    ).withColumns(
        {
            "n_words": F.col("bw.n"),
            "n_repeat_words": F.col("bw.r"),
            "n_lines": F.col("bl.n").cast("long"),
            "n_dup_lines": (F.col("bl.n") - F.col("bl.d")).cast("long"),
        }
    ).drop("bw", "bl").withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    )


def _values() -> dict[str, Column]:
    per = lambda a, b, k: F.expr(f"CASE WHEN {b} > 0 THEN {k} * {a} div {b} ELSE 0L END")
    return {
        "symbols": per("n_symbols", "n_words", 1000),
        "dup_lines": per("n_dup_lines", "n_lines", 1000),
        "repeats": per("n_repeat_words", "n_words", 1000),
        "word_length": per("word_chars", "n_words", 100),
    }


def bucket(v: Column) -> Column:
    """Values under 32 are their own bucket; above, 16 buckets per doubling."""
    top = F.length(F.bin(v)) - 5  # the value shifted by this keeps its five leading bits
    shifted = F.call_function("shiftright", v, top)
    return F.when(v < 32, v.cast("int")).otherwise((top * 16 + shifted).cast("int"))


def bucket_end(b: Column) -> Column:
    """The largest value of a bucket."""
    top = F.expr("0") + F.floor((b - 16) / 16).cast("int")
    low = (b - top * 16).cast("long")
    end = F.call_function("shiftleft", low + 1, top) - 1
    return F.when(b < 32, b.cast("long")).otherwise(end)


def sketches(measured: DataFrame) -> DataFrame:
    """``(level, lang, source, measure, bucket, n)``: level 2 is a source in a language,
    level 1 a language, level 0 the corpus; the lower levels are merged from level 2."""
    items = F.array(*(F.struct(F.lit(m).alias("measure"), bucket(v).alias("bucket")) for m, v in _values().items()))
    leaf = (
        measured.where(~F.col("base_failed"))
        .select("lang", "source", F.explode(items).alias("x"))
        .groupBy("lang", "source", "x.measure", "x.bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    leaf = reliable(leaf)
    none = F.lit(None).cast("string")
    return (
        leaf.withColumn("level", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
        .withColumn("source", F.when(F.col("level") == 2, F.col("source")).otherwise(none))
        .withColumn("lang", F.when(F.col("level") >= 1, F.col("lang")).otherwise(none))
        .groupBy("level", "lang", "source", "measure", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def fences(sketch: DataFrame) -> DataFrame:
    """One row per level and group: ``docs`` and a ``lo``/``hi`` pair for every measure."""
    group = ("level", "lang", "source", "measure")
    upto = F.sum("n").over(Window.partitionBy(*group).orderBy("bucket"))
    total = F.sum("n").over(Window.partitionBy(*group))
    ranked = sketch.withColumns({"upto": upto, "total": total})
    at = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("bucket")))
    quart = ranked.groupBy(*group).agg(
        F.max("total").alias("docs"), bucket_end(at(1)).alias("q1"), bucket_end(at(3)).alias("q3")
    )
    slack = F.create_map(*(F.lit(x) for kv in SLACK.items() for x in kv))[F.col("measure")]
    reach = 3 * (F.col("q3") - F.col("q1")) + slack
    low = F.when(F.col("measure").isin(*TWO_SIDED), F.col("q1") - reach).otherwise(F.lit(-1))
    quart = quart.select(*group, "docs", low.alias("lo"), (F.col("q3") + reach).alias("hi"))
    pick = lambda m, c: F.max(F.when(F.col("measure") == m, F.col(c))).alias(f"{c}_{m}")
    return quart.groupBy("level", "lang", "source").agg(
        F.max("docs").alias("docs"), *(pick(m, c) for m in MEASURES for c in ("lo", "hi"))
    )


def thresholds(measured: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(lang, source, lo_*, hi_*)`` for every group: its own fences, or those of its
    language, or of the corpus, where a sketch has fewer than ``min_docs`` documents."""
    limits = [f"{c}_{m}" for m in MEASURES for c in ("lo", "hi")]
    all_fences = reliable(fences(sketches(measured)))
    # Groups whose documents all fail the base rules have no sketch; they need no fence.
    own = all_fences.where("level = 2").select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "docs")
    lang = all_fences.where("level = 1").select(F.col("lang").alias("l_lang"), F.col("docs").alias("l_docs"))
    level = F.when(F.col("docs") >= min_docs, 2).when(F.col("l_docs") >= min_docs, 1).otherwise(0)
    groups = own.join(lang, F.col("g_lang").eqNullSafe(F.col("l_lang"))).select(
        "g_lang", "g_source", level.alias("g_level")
    )
    same = (
        (F.col("g_level") == F.col("level"))
        & F.when(F.col("g_level") >= 1, F.col("g_lang")).eqNullSafe(F.col("lang"))
        & F.when(F.col("g_level") == 2, F.col("g_source")).eqNullSafe(F.col("source"))
    )
    return groups.join(all_fences, same).select("g_lang", "g_source", *limits)


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """``measured`` plus ``kept``; every group's limits are there once per salt."""
    lines = limits.withColumn("g_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("id", "n_words", "word_chars"), F.lit(SALTS)).cast("int")
    joined = measured.withColumn("salt", salt).join(
        lines,
        F.col("lang").eqNullSafe(F.col("g_lang"))
        & F.col("source").eqNullSafe(F.col("g_source"))
        & (F.col("salt") == F.col("g_salt")),
        "left",
    )
    good = F.lit(True)
    for m, v in _values().items():
        good = good & (v >= F.col(f"lo_{m}")) & (v <= F.col(f"hi_{m}"))
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(good, F.lit(True)))


def _measured(docs, id_col, text_col, lang_col, source_col, *more):
    keys = (docs[id_col].alias("id"), docs[lang_col].alias("lang"), docs[source_col].alias("source"))
    return base_measures(docs, docs[text_col], *keys, *more)


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """One row per document: id, the base measures, ``base_failed`` and ``kept``."""
    measured = reliable(_measured(docs, id_col, text_col, lang_col, source_col))
    return judge(measured, thresholds(measured, min_docs)).select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def quality_filter(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged."""
    limits = reliable(thresholds(reliable(_measured(docs, id_col, text_col, lang_col, source_col)), min_docs))
    whole = _measured(docs, id_col, text_col, lang_col, source_col, F.struct("*").alias("row"))
    return judge(whole, limits).where("kept").select("row.*")
