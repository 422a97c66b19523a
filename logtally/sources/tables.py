"""Catalog tables of raw log lines, read through the parser (schema on read).

A log table stores the raw lines as a one-column ``text`` table; a temporary view applies
the parser on every scan, like a Hive table with a regex SerDe. Tables created with a
``LOCATION`` are external: dropping them keeps the files, so raw logs can be mapped
without ever being deleted by a ``DROP TABLE``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.parse import parse


def _quote(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def create_log_table(
    spark: SparkSession, name: str, location: str | None = None, replace: bool = True
) -> str:
    """``CREATE TABLE name (line STRING) USING text [LOCATION ..]``; with ``replace``,
    ``DROP TABLE IF EXISTS`` first."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {_quote(name)}")
    where = ""
    if location:
        # The location must exist; an empty text write creates it and leaves data alone.
        spark.createDataFrame([], "line string").write.mode("ignore").text(location)
        escaped = location.replace("\\", "\\\\").replace("'", "\\'")
        where = f" LOCATION '{escaped}'"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quote(name)} (line STRING) USING text{where}")
    return name


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quote(name)}")


def load_lines(spark: SparkSession, table: str, lines: DataFrame, overwrite: bool = False,
               line_col: str = "line") -> None:
    """Load lines into a log table: append, or replace its contents with ``overwrite``.

    ``insertInto`` is positional, so the single line column is selected explicitly.
    """
    lines.select(line_col).write.insertInto(table, overwrite=overwrite)


def parsed_view(
    spark: SparkSession,
    table: str,
    view: str,
    dialect: str = "regexserde",
    on_bad_bytes: str | None = None,
    fields: tuple[str, ...] | None = None,
) -> DataFrame:
    """Register ``view`` as the parsed form of ``table`` and return it. With ``fields``,
    the view has only those columns and only their regex groups are evaluated."""
    parsed = parse(
        spark.table(table), dialect=dialect, on_bad_bytes=on_bad_bytes, line_col="line", fields=fields
    )
    parsed.createOrReplaceTempView(view)
    return parsed


def register_lines(lines: DataFrame, view: str, dialect: str = "regexserde",
                   on_bad_bytes: str | None = None, fields: tuple[str, ...] | None = None) -> DataFrame:
    """Register a parsed temporary view over a DataFrame of lines (no catalog table)."""
    parsed = parse(lines, dialect=dialect, on_bad_bytes=on_bad_bytes, fields=fields)
    parsed.createOrReplaceTempView(view)
    return parsed
