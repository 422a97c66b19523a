"""Helpers shared by the corpus operators: word rule, let-binding, reliable cuts, shipping."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtally.session import checkpoint_root, scratch_path

# A word is a run of characters other than space and U+0009..U+000D.
GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def words(text: Column) -> Column:
    """The words of a text as an array (null text: no words)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def without(text: Column, chars: tuple[str, ...]) -> Column:
    """``text`` less every occurrence of the given characters."""
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A lambda variable holds the value, so the optimizer cannot copy its expression into
    every place (and every array element) where the body uses it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def reliable(df: DataFrame) -> DataFrame:
    """``df`` materialised once in the shared folder of ``spark.checkpoint.dir``."""
    checkpoint_root(df.sparkSession)  # in local mode without the setting: makes a folder
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the same shared folder and read back: for
    wider tables, smaller than a checkpoint and read by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def by_value(module: str) -> None:
    """Pickle the module's functions into the tasks, so executors need not import it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
