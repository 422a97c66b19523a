"""Mixing sources to target weights by hash-threshold histograms.

Every source gets a target in words. A target of r whole passes and a remainder means:
take every document r times, and those below a hash threshold once more, where the
threshold makes the sizes below it add up to the remainder. The threshold is found
without sorting: sizes are summed by (source, leading hash digits), a running sum finds
the bucket in which the budget runs out, and only that bucket is split by the next
digits, level by level, until single hash values remain. A larger budget always takes a
superset of a smaller one (nested thresholds).

Defined results: null texts have size 0; the null source is a source, last in order;
rows with the same id and size share a hash and go together; an empty table gives no
rows. Hash and sums are integers, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtally.llm.common import reliable, words

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
LEVELS = 4  # hash digits of 12 bits each
DIGIT = 4096
SALTS = 32


def mix_hash(id_col: Column, size: Column) -> Column:
    """48 bits of the MD5 of id and size, as a long."""
    key = F.concat_ws("|", F.coalesce(id_col.cast("string"), F.lit("")), size.cast("string"))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_REPEAT) -> DataFrame:
    """``(source, source_size)`` plus ``target``: the share of all words by weight, at most
    ``most`` times the source's words, the excess reshared by weight.

    Sources in the order of most-words-per-weight fill up first; source k is at its limit
    if what is left after the limits before it, shared by weight, would exceed its own.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    w = sizes.withColumn("w", weight.cast("double"))
    w = w.withColumn("most", F.col("source_size").cast("double") * most)
    by_ratio = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything).cast("double")
    left = total - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    w = w.withColumn("per_weight", left / F.sum("w").over(after))
    # The rate of the first source below its limit holds for all sources after it.
    below = F.col("per_weight") * F.col("w") <= F.col("most")
    rate = F.max(F.when(below, F.col("per_weight"))).over(everything)
    return w.select(
        "source", "source_size", F.least(F.col("most"), F.col("w") * F.coalesce(rate, F.lit(0.0))).alias("target")
    )


def _digit(h: Column, level: int) -> Column:
    return F.shiftright(h, 12 * (LEVELS - 1 - level)).bitwiseAND(DIGIT - 1).cast("int")


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``(source, below)``: documents with a hash under ``below`` fill the source's budget.

    ``rows`` has source, salt, h, size; ``budgets`` source, budget (of one partial pass).
    """
    found = budgets.select("source", "budget", F.lit(0).cast("long").alias("prefix"))
    for level in range(LEVELS):
        inner = rows
        if level:
            cut = _salted(found.select(F.col("source").alias("s"), "prefix")).withColumnRenamed("salt", "t")
            at = F.shiftright("h", 12 * (LEVELS - level)) == F.col("prefix")
            inner = rows.join(
                cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("salt") == F.col("t")) & at
            )
        sums = inner.groupBy("source", _digit(F.col("h"), level).alias("digit")).agg(F.sum("size").alias("n"))
        upto = Window.partitionBy("source").orderBy("digit")
        sums = sums.withColumn("upto", F.sum("n").over(upto)).select(
            F.col("source").alias("s"), "digit", "n", "upto"
        )
        # The first bucket whose running sum exceeds the budget; none: all of them fit.
        over = (
            found.join(sums, F.col("s").eqNullSafe(F.col("source")), "left")
            .groupBy("source", "budget", "prefix")
            .agg(
                F.min(F.when(F.col("upto") > F.col("budget"), F.col("digit"))).alias("digit"),
                F.max(F.when(F.col("upto") <= F.col("budget"), F.col("upto"))).alias("below"),
                F.min(F.when(F.col("upto") > F.col("budget"), F.col("upto"))).alias("upto"),
            )
        )
        fits = F.coalesce(F.col("below"), F.lit(0))
        if level == LEVELS - 1:
            # The document at the cut goes in if that comes nearer to the budget.
            nearer = (F.col("upto") - F.col("budget")) < (F.col("budget") - fits)
            digit = F.col("digit") + F.when(nearer, 1).otherwise(0)
        else:
            digit = F.col("digit")
        found = reliable(
            over.select(
                "source",
                (F.col("budget") - fits).alias("budget"),
                (F.col("prefix") * DIGIT + F.coalesce(digit, F.lit(DIGIT))).alias("prefix"),
            )
        )
    return found.select("source", F.col("prefix").alias("below"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    rows = docs.select(
        docs[id_col].alias("id"),
        docs[source_col].alias("source"),
        F.size(words(docs[text_col])).cast("long").alias("size"),
        *more,
    ).withColumn("h", mix_hash(F.col("id"), F.col("size")))
    return rows.withColumn("salt", F.pmod("h", F.lit(SALTS)).cast("int"))


def _plan(rows: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``(source, source_size, target, whole, below)``, one row per source."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = reliable(targets(sources, weights, most))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("whole", F.least(passes, F.lit(most)).cast("long"))
    budgets = plan.select("source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget"))
    cuts = _thresholds(rows, budgets).withColumnRenamed("source", "s")
    return plan.join(cuts, F.col("source").eqNullSafe(F.col("s"))).drop("s")


def _times(rows: DataFrame, plan: DataFrame, most: int) -> DataFrame:
    """``rows`` plus ``source_size``, ``target`` and ``times``. Each source's line of the plan
    is there once per salt, so a source with a third of all rows meets it in many tasks."""
    lines = _salted(plan).withColumnsRenamed({"source": "s", "salt": "t"})
    joined = rows.join(lines, F.col("source").eqNullSafe(F.col("s")) & (F.col("salt") == F.col("t")))
    times = F.least(F.col("whole") + F.when(F.col("h") < F.col("below"), 1).otherwise(0), F.lit(most))
    return joined.withColumn("times", times.cast("int"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MAX_REPEAT,
) -> DataFrame:
    """One row per document: id, source, ``size``, ``source_size``, ``target``, ``times``."""
    rows = reliable(_sized(docs, id_col, text_col, source_col))
    return _times(rows, _plan(rows, weights, most), most).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "times"
    )


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MAX_REPEAT,
) -> DataFrame:
    """The mix itself: each row of ``docs`` as many times as the mix takes it, columns kept."""
    plan = reliable(_plan(reliable(_sized(docs, id_col, text_col, source_col)), weights, most))
    whole = _sized(docs, id_col, text_col, source_col, F.struct("*").alias("row"))
    taken = _times(whole, plan, most).where("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
