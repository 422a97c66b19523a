"""Bandwidth reports over parsed records (columns ``ip``, ``status``, ``bytes``).

Every report is a grouped aggregate: Spark computes a partial aggregate in each task
(the map-side combine), shuffles one row per group and task, and merges. A hot IP or a
dominant status (one status often carries most of the traffic) therefore never sends its
raw rows through one task.

Shares divide by a window sum over the *grouped* status rows where statuses are numbers of
three digits (at most 1000 rows whatever the input), and by a scalar subquery over the same
grouped rows where they have no bound. The raw records are scanned once either way.

The reports that group by IP or status take a store's terms (``store.read_terms``: sums and
hits by IP and status) in place of records, with the same results.

Sums are exact beyond 2^63: a byte count is summed in three parts of 21 bits, each a
``bigint`` sum that holds for 2^42 rows per group, and the parts are joined on the grouped
rows as ``decimal(38,0)``. So results do not depend on ``spark.sql.ansi.enabled`` either.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .select import ip_predicate, non_empty_ip, status_between, where_ip

PART_BITS = 21
SUM_TYPE = "decimal(38,0)"


_MASK = (1 << PART_BITS) - 1
# The parts of a byte count, by the name of the sum they go into.
_PARTS = {
    "p0": f"({{value}}) & {_MASK}L",
    "p1": f"shiftright({{value}}, {PART_BITS}) & {_MASK}L",
    "p2": f"shiftright({{value}}, {2 * PART_BITS})",
}
_VALUE = "CAST(bytes AS BIGINT)"
TERM_SUMS = [f"sum({part.format(value=_VALUE)}) AS bytes_{name}" for name, part in _PARTS.items()]
# Metadata of a ``status`` column whose numbers may have more than three digits.
OPEN_STATUSES = "logtally.open_statuses"


def _is_terms(df: DataFrame) -> bool:
    """Whether the rows are a store's terms (sums by IP and status) instead of records."""
    return "bytes_p0" in df.columns


def _sum_parts(df: DataFrame, name: str, condition: str | None = None) -> list[Column]:
    """Three partial sums of the byte counts of ``df`` (where ``condition`` holds)."""
    out = []
    for part, value in _PARTS.items():
        value = f"bytes_{part}" if _is_terms(df) else value.format(value=_VALUE)
        out.append(F.expr(f"sum({f'CASE WHEN {condition} THEN {value} END' if condition else value}) AS {name}_{part}"))
    return out


def exact_bytes(name: str) -> str:
    """SQL for the sum whose parts are named after ``name``; NULL if no value was summed."""
    part = lambda k: f"CAST({name}_p{k} AS DECIMAL(19,0))"
    whole = f"{part(2)} * {1 << 2 * PART_BITS}BD + {part(1)} * {1 << PART_BITS}BD + {part(0)}"
    return f"CAST({whole} AS {SUM_TYPE})"


def _joined(name: str, alias: str) -> str:
    return f"{exact_bytes(name)} AS {alias}"


def _hits(df: DataFrame) -> Column:
    return F.expr("coalesce(sum(hits), 0L) AS hits" if _is_terms(df) else "count(1) AS hits")


def _sum_by(df: DataFrame, keys: list, hits: bool = False) -> DataFrame:
    """``keys`` and the exact sum ``bytes`` of each group, plus its row count ``hits``."""
    grouped = df.groupBy(*keys).agg(*_sum_parts(df, "bytes"), *([_hits(df)] if hits else []))
    names = [f"`{c}`" for c in grouped.columns[: len(keys)]]
    return grouped.selectExpr(*names, _joined("bytes", "bytes"), *(["hits"] if hits else []))


ORDERS = ("bytes", "status", None)

# The parsed columns the status and IP reports read; ``parse(lines, fields=REPORT_FIELDS)``
# packs only their regex groups.
REPORT_FIELDS = ("ip", "status", "bytes")


def _order(df: DataFrame, order: str | None, key: str = "status") -> DataFrame:
    if order is None:
        return df
    if order == "bytes":
        return df.orderBy(F.desc("bytes"), F.desc(key))
    if order == key:
        return df.orderBy(F.asc(key))
    raise ValueError(f"unknown order {order!r}; expected one of {ORDERS}")


def status_bytes(parsed: DataFrame) -> DataFrame:
    """``(status, bytes)``: bytes summed per status."""
    return _sum_by(parsed, ["status"])


# ``100 * (part / whole)`` as double; NULL when ``whole`` is 0 or NULL.
_PERCENT = "100D * try_divide(CAST({part} AS DOUBLE), CAST({whole} AS DOUBLE)) AS pct"

# The total as a scalar subquery over the same grouped rows, which share one exchange.
_SHARE = f"""
WITH grouped AS (SELECT * FROM {{rows}})
SELECT status, {{part}} AS bytes, {_PERCENT.format(part="{part}", whole="(SELECT sum({all}) FROM grouped)")}
FROM grouped WHERE {{keep}}
"""


def _with_share(rows: DataFrame, part: str, whole: str, keep: str) -> DataFrame:
    """``(status, bytes, pct)``: ``part`` and its share of the sum of ``whole`` over all rows.

    Parsed numeric statuses have three digits, so a window over the grouped rows sees at most
    1000 of them and saves a second job; statuses that are text (SerDe), and those of a store
    that took any, have no such bound and take the subquery.
    """
    status = rows.schema["status"]
    if status.dataType.typeName() != "string" and not status.metadata.get(OPEN_STATUSES):
        share = _PERCENT.format(part=part, whole="_total")
        totals = rows.selectExpr("*", f"sum({whole}) OVER () AS _total").where(keep)
        return totals.selectExpr("status", f"{part} AS bytes", share)
    text = _SHARE.replace("{part}", part).replace("{all}", whole).replace("{keep}", keep)
    return rows.sparkSession.sql(text, rows=rows)


def status_breakdown(
    parsed: DataFrame,
    selection: Column | str | None = None,
    denominator: str = "selection",
    order: str | None = "bytes",
) -> DataFrame:
    """``(status, bytes, pct)``: bytes per status and their share of a total.

    ``selection`` restricts the rows (a Column predicate, or an IP string for exact
    matching). ``denominator='selection'`` divides by the selection's own total;
    ``'global'`` divides by the total of all rows, computed in the same single pass with
    a conditional sum, and keeps only statuses that occur in the selection.
    ``order='bytes'`` sorts by bytes then status, both descending; ``'status'`` sorts by
    status ascending; ``None`` leaves the order open.
    """
    if isinstance(selection, str):
        selection = ip_predicate(selection)
    if denominator not in ("selection", "global"):
        raise ValueError(f"unknown denominator {denominator!r}")
    if selection is None or denominator == "selection":
        source = parsed if selection is None else parsed.where(selection)
        out = _with_share(status_bytes(source), "bytes", "bytes", "true")
    else:
        grouped = parsed.withColumn("_in", selection).groupBy("status").agg(
            *_sum_parts(parsed, "sel", "_in"),
            *_sum_parts(parsed, "whole"),
            F.expr("count_if(_in) AS _hits"),
        )
        rows = grouped.selectExpr("status", _joined("sel", "sel"), _joined("whole", "whole"), "_hits")
        out = _with_share(rows, "sel", "whole", "_hits > 0")
    return _order(out, order)


def status_total(parsed: DataFrame, status: int) -> DataFrame:
    """One row ``(status, bytes)``; bytes is 0 when the status never occurs."""
    return status_range_total(parsed, status, status).select(
        F.lit(status).alias("status"), "bytes"
    )


def status_range_total(parsed: DataFrame, low: int, high: int) -> DataFrame:
    """One row ``(bytes)``: bytes of all statuses in ``[low, high]``, 0 if none."""
    return _sum_by(status_between(parsed, low, high), []).select(_or_zero("bytes"))


def _or_zero(column: str) -> Column:
    return F.coalesce(column, F.lit(0).cast(SUM_TYPE)).alias(column)


def status_range(parsed: DataFrame, low: int, high: int, order: str | None = "status") -> DataFrame:
    """``(status, bytes)`` for the statuses in ``[low, high]``."""
    return _order(status_bytes(status_between(parsed, low, high)), order)


def ip_total(parsed: DataFrame, ip: str) -> DataFrame:
    """One row ``(ip, bytes, hits)``; 0 bytes and 0 hits when the IP never occurs."""
    total = _sum_by(where_ip(parsed, ip), [], hits=True)
    return total.select(F.lit(ip).alias("ip"), _or_zero("bytes"), "hits")


def ip_bytes(parsed: DataFrame) -> DataFrame:
    """``(ip, bytes, hits)`` for every IP value, the empty one included."""
    return _sum_by(parsed, ["ip"], hits=True)


def ip_hits(parsed: DataFrame) -> DataFrame:
    """``(ip, hits)``: number of records per IP."""
    return parsed.groupBy("ip").agg(_hits(parsed))


def top_ips(parsed: DataFrame, n: int) -> DataFrame:
    """The ``n`` non-empty IPs with the most bytes; ties go to the smaller IP string.

    ``orderBy(..).limit(n)`` plans as ``TakeOrderedAndProject``: every task keeps its own
    top ``n`` and only those are merged, so nothing is sorted globally.
    """
    return (
        ip_bytes(non_empty_ip(parsed))
        .orderBy(F.desc("bytes"), F.asc("ip"))
        .limit(n)
    )


def top_ip(parsed: DataFrame) -> DataFrame:
    """One row ``(ip, bytes)``: the IP with the most bytes.

    An IP only wins with more than 0 bytes; when none has any, the row is ``('', 0)``.
    """
    candidates = (
        ip_bytes(non_empty_ip(parsed))
        .where(F.col("bytes") > 0)
        .select("ip", "bytes", F.lit(0).alias("_default"))
    )
    default = parsed.sparkSession.range(1).select(
        F.lit("").alias("ip"), F.lit(0).cast(SUM_TYPE).alias("bytes"), F.lit(1).alias("_default")
    )
    return (
        candidates.unionByName(default)
        .orderBy(F.asc("_default"), F.desc("bytes"), F.asc("ip"))
        .limit(1)
        .select("ip", "bytes")
    )


def total_bytes(parsed: DataFrame) -> DataFrame:
    """One row ``(total_bytes)``. Empty input gives NULL."""
    return _sum_by(parsed, []).withColumnRenamed("bytes", "total_bytes")


def distinct_values(parsed: DataFrame, column: str) -> DataFrame:
    """The distinct values of one column, ascending (the term dictionary of a field)."""
    return parsed.select(column).distinct().orderBy(column)


def ip_list_breakdown(
    parsed: DataFrame, ips: DataFrame | Iterable[str], order: str | None = None
) -> DataFrame:
    """``(ip, status, bytes)`` for the IPs of a key list: one pass, not one search per key.

    A Python list becomes an ``IN`` filter, which a Parquet store receives as a pushed
    filter. A DataFrame of keys is a left-semi join that Catalyst applies to the records
    before aggregating; the join strategy is left to Catalyst's size estimate and AQE,
    which broadcast the keys only when their measured size is under the broadcast
    threshold and otherwise shuffle both sides.
    """
    if not isinstance(ips, DataFrame):
        rows = parsed.where(F.col("ip").isin(sorted(set(ips))))
    else:
        rows = parsed.join(ips.select("ip"), on="ip", how="left_semi")
    out = _sum_by(rows, ["ip", "status"])
    if order == "status":
        out = out.orderBy("ip", "status")
    return out


def status_bytes_by_ip(parsed: DataFrame) -> DataFrame:
    """``(ip, status, bytes)`` of every IP."""
    return _sum_by(parsed, ["ip", "status"])


def breakdown_of_ips_with_status(parsed: DataFrame, status: int) -> DataFrame:
    """``(ip, status, bytes)`` for every IP that has at least one record of ``status``.

    One scan: the ``(ip, status)`` aggregate is flagged per IP with a window over the
    grouped rows (one row per status of the IP, however many records it has), instead of joining the records to a key set computed from a
    second scan.
    """
    grouped = _sum_by(parsed, ["ip", "status"])
    return (
        grouped.selectExpr("*", f"max(status = {int(status)}) OVER (PARTITION BY ip) AS _has")
        .where("_has")
        .select("ip", "status", "bytes")
    )


def top_ips_breakdown(parsed: DataFrame, n: int | None) -> DataFrame:
    """``(ip, status, bytes)`` for the ``n`` IPs with the most bytes, from one scan; for
    all IPs, without a ranking, if ``n`` is None. A missing IP is never among them.

    The ranking and the breakdown read the same ``(ip, status)`` aggregate, so its
    shuffle is computed once and reused. The top-N keys (at most ``n`` distinct rows)
    are inner-joined to the aggregate, by the strategy Catalyst and AQE choose; a semi
    join would be pushed below the aggregate by the optimizer and scan the input a
    second time.
    """
    if n is None:
        return _sum_by(parsed.where(F.col("ip") != ""), ["ip", "status"])
    grouped = _sum_by(parsed, ["ip", "status"])
    # A missing IP ('' or NULL) sorts last and is removed after the limit: a filter before
    # the aggregate would be pushed into it and the two aggregates would no longer match.
    top = (
        grouped.groupBy("ip")
        .agg(F.sum("bytes").alias("_total"))
        .orderBy((F.coalesce("ip", F.lit("")) == "").asc(), F.desc("_total"), F.asc("ip"))
        .limit(n)
        .where(F.col("ip") != "")
        .select("ip")
    )
    # Null-safe equality: a plain equi-join would infer ``ip IS NOT NULL`` and push it
    # into the left aggregate, which then differs from the shared one as well.
    top = top.select(F.col("ip").alias("_top_ip"))
    joined = grouped.join(top, grouped["ip"].eqNullSafe(top["_top_ip"]), "inner")
    return joined.select("ip", "status", "bytes")


def _status_key() -> Column:
    """A status as a map key: its text, or ``null`` for a record without one."""
    return F.coalesce(F.col("status").cast("string"), F.lit("null"))


def line_status_maps(parsed: DataFrame, selection: Column | str = "all") -> DataFrame:
    """``(selection, statuses map<string,decimal(38,0)>)``: a one-entry map per record."""
    label = F.lit(selection) if isinstance(selection, str) else selection
    return parsed.select(
        label.alias("selection"),
        F.create_map(_status_key(), F.col("bytes").cast(SUM_TYPE)).alias("statuses"),
    )


def _maps_from_rows(rows: DataFrame) -> DataFrame:
    """``(selection, total, statuses)`` from ``(selection, status string, bytes)`` rows
    that are already unique per (selection, status).

    The second aggregation collects one entry per status into each map, which is what a
    map holds: at most 1000 for the combined dialect (three digits).
    """
    return rows.groupBy("selection").agg(
        F.sum("bytes").cast(SUM_TYPE).alias("total"),
        F.map_from_entries(
            F.sort_array(F.collect_list(F.struct(F.col("status"), F.col("bytes"))))
        ).alias("statuses"),
    )


def status_map(parsed: DataFrame, selection: Column | str = "all") -> DataFrame:
    """``(selection, total, statuses)``: bytes per status as a map, plus the total.

    ``selection`` is a label (``'all'``, an IP) or a column to group by (e.g. ``ip``).
    """
    label = F.lit(selection) if isinstance(selection, str) else selection
    return _maps_from_rows(_sum_by(parsed, [label.alias("selection"), _status_key().alias("status")]))


def merge_status_maps(maps: DataFrame) -> DataFrame:
    """Merge ``(selection, statuses map)`` rows into one map and total per selection.

    Maps are exploded into entries and summed per (selection, status) with a partial
    aggregate, so any number of partial maps per selection merge without a large group.
    """
    entries = maps.select("selection", F.explode("statuses").alias("status", "bytes"))
    rows = entries.groupBy("selection", "status").agg(F.sum("bytes").cast(SUM_TYPE).alias("bytes"))
    return _maps_from_rows(rows)


IDENTITY_COLUMNS = ("ip", "client", "user", "date_time", "request", "status", "referer", "agent")


def sum_identical(parsed: DataFrame) -> DataFrame:
    """Bytes summed over records identical in the eight non-byte fields.

    The key columns are grouped as they are; joining them into one delimited key string
    is left to the export (:func:`logtally.operators.sinks.ctrl_a_lines`).
    """
    return _sum_by(parsed, list(IDENTITY_COLUMNS))


__all__ = [
    "status_bytes", "status_breakdown", "status_total", "status_range_total", "status_range",
    "ip_total", "ip_bytes", "ip_hits", "top_ips", "top_ip", "total_bytes", "distinct_values",
    "ip_list_breakdown", "breakdown_of_ips_with_status", "status_bytes_by_ip", "top_ips_breakdown", "line_status_maps", "status_map", "merge_status_maps", "sum_identical",
    "IDENTITY_COLUMNS", "REPORT_FIELDS",
]
