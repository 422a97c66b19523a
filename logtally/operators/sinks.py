"""Exports: text lines, delimited rows, status-map text, formatted log lines.

Each function either returns the rendered column(s) as a DataFrame, or writes it with the
DataFrame writer (one file per task, committed by Spark's output committer).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import FIELDS
from .reports import IDENTITY_COLUMNS

CTRL_A = "\u0001"


def write_text(lines: DataFrame, path: str, compression: str | None = None, mode: str = "error") -> None:
    """Write a single string column as text lines (``compression='gzip'`` for .gz)."""
    writer = lines.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)


def write_key_value(df: DataFrame, key: str, value: str, path: str, mode: str = "error") -> None:
    """``key<TAB>value`` lines, the layout of a MapReduce text output. A NULL key or value
    is written as an empty one, so the tab stays."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key, value)]
    write_text(df.select(F.concat_ws("\t", *text)), path, mode=mode)


def map_text(statuses: Column, total: Column) -> Column:
    """``k=v`` entries sorted by key, one per line, then ``' from a total of '`` and the
    total."""
    entries = F.transform(
        F.array_sort(F.map_entries(statuses)),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return F.concat(F.array_join(entries, "\n"), F.lit(" from a total of "), total.cast("string"))


def status_map_text(maps: DataFrame) -> DataFrame:
    """``(selection, total, text)`` from ``(selection, total, statuses)`` rows."""
    return maps.select(
        "selection", "total", map_text(F.col("statuses"), F.col("total")).alias("text")
    )


def ctrl_a_lines(summed: DataFrame) -> DataFrame:
    """``\\u0001``-separated rows of :func:`reports.sum_identical` output, bytes last.

    An absent IP is written as the text ``null``; every field is rendered, so a column
    never shifts.
    """
    ip = F.coalesce(F.nullif(F.col("ip"), F.lit("")), F.lit("null"))
    fields = [ip] + [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in IDENTITY_COLUMNS[1:]]
    fields.append(F.coalesce(F.col("bytes").cast("string"), F.lit("")))
    return summed.select(F.concat_ws(CTRL_A, *fields).alias("line"))


def write_ctrl_a(summed: DataFrame, path: str, mode: str = "error") -> None:
    """Write :func:`ctrl_a_lines` as text files, the layout a Hive text table loads."""
    write_text(ctrl_a_lines(summed), path, mode=mode)


def format_lines(records: DataFrame) -> DataFrame:
    """Render SerDe records back to log lines: the nine fields joined by spaces.

    NULL fields are skipped, so a short line (no referer/agent) comes back as it was.
    Rows that are NULL in every field (unmatched lines) give no output line.
    """
    line = F.concat_ws(" ", *[F.col(c) for c in FIELDS])
    return records.where(F.col("ip").isNotNull()).select(line.alias("line"))
