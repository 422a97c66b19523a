"""Parsing raw lines into typed records, with the lines that were rejected kept visible.

Two dialects:

* ``combined`` - the searched combined-log pattern. Lines without a match are dropped;
  ``status`` is ``int``, ``bytes`` is ``bigint`` under a policy for malformed byte
  counts (``drop`` / ``zero`` / ``null`` / ``fail``).
* ``regexserde`` - the Hive RegexSerDe view: every line gives a row, nine strings, all
  NULL when the line does not match as a whole. Passing a policy types ``bytes``.

Parsing is a narrow, per-partition step (no shuffle). The pattern is evaluated once per
line: the packed groups (see :mod:`logtally.functions.parse`) are produced by a one-row
``inline`` generator, which Catalyst cannot merge into the filters and projections
above it, so the match test and all nine fields read the same evaluated array instead
of each re-running the regex or the split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import parse as PF
from ..functions import patterns as P

LINE = "line"


def _line_name(lines: DataFrame, line_col: str | None) -> str:
    if line_col:
        return line_col
    columns = lines.columns
    if LINE in columns:
        return LINE
    if "value" in columns:  # spark.read.text
        return "value"
    raise ValueError(f"no line column in {columns}")


def _line(lines: DataFrame, line_col: str | None) -> Column:
    return F.col(_line_name(lines, line_col))


def _evaluate(
    lines: DataFrame,
    dialect: str,
    line_col: str | None,
    keep: tuple[str, ...],
    names: tuple[str, ...] = P.FIELDS,
) -> tuple[DataFrame, str, dict[str, str]]:
    """``(*keep, _line, _plain, _parts)`` with the pattern evaluated once per line, plus
    the SQL of the match test and of the string fields ``names`` over those columns.

    The generator materialises the three values, so the match test, a byte-count filter
    pushed below the projection, and every field only read them; nothing is recomputed
    per reference. Only the regex groups of ``names`` are packed into ``_parts``."""
    if dialect not in P.DIALECTS:
        raise ValueError(f"unknown dialect {dialect!r}; expected one of {P.DIALECTS}")
    unknown = set(names) - set(P.FIELDS)
    if unknown:
        raise ValueError(f"unknown fields {sorted(unknown)}; expected some of {P.FIELDS}")
    line = _line_name(lines, line_col)
    groups = PF.packed_groups(dialect, names)
    evaluated = lines.selectExpr(
        *[f"`{c}`" for c in keep],
        f"inline(array(struct(`{line}` AS _line, {PF.plain_sql(f'`{line}`')} AS _plain, "
        f"{PF.parts_sql(f'`{line}`', dialect, groups)} AS _parts)))",
    )
    matched, fields = PF.unpack_sql("_line", "_plain", "_parts", dialect, groups)
    return evaluated, matched, fields


def split_fields(
    lines: DataFrame,
    dialect: str = "combined",
    line_col: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(*keep, _line, _matched, ip .. agent)``: all nine fields as strings, one row per
    line, the pattern evaluated once per line."""
    evaluated, matched, fields = _evaluate(lines, dialect, line_col, keep)
    return evaluated.selectExpr(
        *[f"`{c}`" for c in keep],
        "_line",
        f"{matched} AS _matched",
        *[f"{fields[name]} AS `{name}`" for name in P.FIELDS],
    )


def parse(
    lines: DataFrame,
    dialect: str = "combined",
    on_bad_bytes: str | None = None,
    line_col: str | None = None,
    keep: tuple[str, ...] = (),
    fields: tuple[str, ...] | list[str] | None = None,
) -> DataFrame:
    """Parse ``lines`` (a ``line`` or ``value`` string column) into the nine fields.

    ``on_bad_bytes`` defaults to ``drop`` for ``combined`` and to raw strings for
    ``regexserde``. ``keep`` names input columns to carry along. ``fields`` limits the
    output to some of the nine fields (in their usual order): only their regex groups
    are packed per line, which saves work when a report reads two or three of them
    (e.g. ``("ip", "status", "bytes")``). Rows are the same as for all fields; ``bytes``
    is still evaluated when the policy filters or checks it.

    The whole parse is three DataFrame steps (evaluate, match filter, typed projection)
    built from SQL text, so constructing it costs a handful of calls into the JVM.
    """
    policy = on_bad_bytes or ("drop" if dialect == "combined" else None)
    wanted = tuple(P.FIELDS) if fields is None else tuple(n for n in P.FIELDS if n in set(fields))
    needed = wanted + (("bytes",) if policy in ("drop", "fail") and "bytes" not in wanted else ())
    evaluated, matched, values = _evaluate(lines, dialect, line_col, keep, needed)
    exprs = {name: f"{values[name]} AS `{name}`" for name in needed}
    if dialect == "combined":
        evaluated = evaluated.where(matched)
        if "status" in exprs:
            exprs["status"] = f"CAST({values['status']} AS INT) AS status"
    if policy and "bytes" in exprs:
        exprs["bytes"] = f"{PF.typed_bytes_sql(values['bytes'], policy)} AS bytes"
    out = evaluated.selectExpr(*[f"`{c}`" for c in keep], *[exprs[n] for n in P.FIELDS if n in exprs])
    if policy == "drop":
        out = out.where("bytes IS NOT NULL")
    if policy == "fail" and "bytes" not in wanted:
        # the check must run even though the value is not returned: keep it in a filter
        out = out.where("bytes IS NOT NULL")
    if needed != wanted:
        out = out.select(*keep, *wanted)
    return out


def parse_outcomes(
    lines: DataFrame,
    dialect: str = "combined",
    on_bad_bytes: str | None = None,
    line_col: str | None = None,
) -> DataFrame:
    """``(nine fields, line, reason, outcome)``, one row per line, the pattern evaluated once.

    ``outcome`` is ``records`` (typed fields, ``line`` and ``reason`` NULL) or ``rejects`` (the
    line and its reason, fields NULL). A line is rejected if it does not match, and under
    the ``drop`` policy if its byte count is no integer. A status that is no number is NULL.
    """
    policy = on_bad_bytes or ("drop" if dialect == "combined" else "null")
    evaluated, matched, values = _evaluate(lines, dialect, line_col, ())
    bad = f"WHEN TRY_CAST({values['bytes']} AS BIGINT) IS NULL THEN 'bad_bytes' " if policy == "drop" else ""
    typed = {
        "status": f"TRY_CAST({values['status']} AS INT)",
        "bytes": PF.typed_bytes_sql(values["bytes"], policy),
    }
    judged = evaluated.selectExpr(
        "*", f"CASE WHEN NOT coalesce({matched}, false) THEN 'no_match' {bad}END AS reason"
    )
    kept = [f"CASE WHEN reason IS NULL THEN {typed.get(n, values[n])} END AS `{n}`" for n in P.FIELDS]
    return judged.selectExpr(
        *kept,
        "CASE WHEN reason IS NOT NULL THEN _line END AS line",
        "reason",
        "CASE WHEN reason IS NULL THEN 'records' ELSE 'rejects' END AS outcome",
    )


def _checked(lines: DataFrame, dialect: str, line_col: str | None) -> DataFrame:
    """``(_line, _matched, bytes)``: what the reject rules read, packing one group only."""
    evaluated, matched, values = _evaluate(lines, dialect, line_col, (), ("bytes",))
    return evaluated.selectExpr("_line", f"{matched} AS _matched", f"{values['bytes']} AS bytes")


def _reason() -> Column:
    return F.when(~F.coalesce("_matched", F.lit(False)), F.lit("no_match")).when(
        F.col("bytes").try_cast("bigint").isNull(), F.lit("bad_bytes")
    )


def rejects(
    lines: DataFrame, dialect: str = "combined", line_col: str | None = None
) -> DataFrame:
    """``(line, reason)`` for every line a ``drop`` parse would not use.

    ``reason`` is ``no_match`` (the pattern does not match, or the line is NULL) or ``bad_bytes`` (it matches
    but the byte count is not an integer).
    """
    return (
        _checked(lines, dialect, line_col)
        .select(F.col("_line").alias("line"), _reason().alias("reason"))
        .where(F.col("reason").isNotNull())
    )


def clean_lines(
    lines: DataFrame, dialect: str = "combined", line_col: str | None = None
) -> DataFrame:
    """The lines :func:`rejects` does not return: they all parse under any policy."""
    return (
        _checked(lines, dialect, line_col)
        .where(_reason().isNull())
        .select(F.col("_line").alias("line"))
    )


def _count_exprs() -> list[Column]:
    reason = _reason()
    return [
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("_matched")).alias("matched"),
        F.count_if(reason == "bad_bytes").alias("bad_bytes"),
        F.count_if(reason.isNull()).alias("usable"),
    ]


def parse_counts(
    lines: DataFrame, dialect: str = "combined", line_col: str | None = None
) -> DataFrame:
    """One row ``(lines, matched, bad_bytes, usable)``: a global aggregate, partial per
    task and merged from one small row per task."""
    return _checked(lines, dialect, line_col).agg(*_count_exprs())


def observe_counts(
    lines: DataFrame, dialect: str = "combined", line_col: str | None = None
) -> tuple[DataFrame, Observation]:
    """Parse with the counters of :func:`parse_counts` attached as an ``Observation``.

    Returns the split lines (see :func:`split_fields`) and the observation; the counters
    are filled by whatever action later runs on them, so the input is read once for
    both the report and the counts.
    """
    observation = Observation("logtally_parse")
    observed = split_fields(lines, dialect, line_col).observe(observation, *_count_exprs())
    return observed, observation
