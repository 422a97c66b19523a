"""Selecting lines or records: by IP, by line prefix, by status range.

The cheap string tests run on the raw line *before* the regex: the substring test comes
first in the combined filter and short-circuits it, so most lines never reach the
pattern. On a parsed Parquet store the same selections become
pushed filters (``PushedFilters: EqualTo(ip, ...)``) and partition filters on ``status``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .parse import _line

MATCH_MODES = ("exact", "prefix")


def prefilter_lines(
    lines: DataFrame, ip: str | None, match: str = "exact", line_col: str | None = None
) -> DataFrame:
    """Keep lines that can belong to ``ip``. ``None`` keeps everything.

    ``exact``: the line contains ``ip`` (necessary for an exact IP match; confirm with
    :func:`where_ip` after parsing). ``prefix``: the line starts with ``ip`` - this is the
    selection itself and has no boundary, so ``1.2.3.4`` also selects ``1.2.3.45``.
    """
    if ip is None:
        return lines
    line = _line(lines, line_col)
    if match == "exact":
        return lines.where(line.contains(ip))
    if match == "prefix":
        return lines.where(line.startswith(ip))
    raise ValueError(f"unknown match mode {match!r}; expected one of {MATCH_MODES}")


def ip_predicate(ip: str | None) -> Column:
    """Exact IP equality on a parsed ``ip`` column (``None`` = every row)."""
    return F.lit(True) if ip is None else (F.col("ip") == F.lit(ip))


def where_ip(parsed: DataFrame, ip: str | None) -> DataFrame:
    return parsed if ip is None else parsed.where(ip_predicate(ip))


def non_empty_ip(parsed: DataFrame) -> DataFrame:
    """Rows with an IP (host-name lines parse with ``ip = ''``)."""
    return parsed.where(F.col("ip") != "")


def status_between(parsed: DataFrame, low: int, high: int) -> DataFrame:
    """Statuses in ``[low, high]``, both ends inclusive (a point when equal). A status that
    is no number (``-`` or NULL in SerDe records) is in no range."""
    status = F.col("status")
    if parsed.schema["status"].dataType.typeName() == "string":
        status = status.try_cast("int")
    return parsed.where(status.between(low, high))
