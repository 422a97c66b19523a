"""Column expressions for parsing one log line.

Everything here is built from built-in functions, so parsing stays in the JVM inside
whole-stage codegen.

Two ways to get the fields of a line:

* ``combined_group`` / ``serde_group``: one ``regexp_extract`` per field. Exact, simple,
  but every field (and the match test) runs the pattern again.
* ``packed``: one ``regexp_replace`` that rewrites a matching line into
  ``MARK f1 SEP f2 SEP ...`` - the pattern runs once per line, and one ``split`` turns
  that into the array of groups (``parts_sql``); an unmatched line gives a one-element
  array. The match test and the fields then only read that array (``unpack_sql``).
  These are built as SQL text, one expression string per field, so building a query
  costs few calls into the JVM. A line that itself contains ``SEP`` or ``MARK`` would
  be ambiguous, so such lines fall back to the per-field form (``plain_sql`` tells them
  apart); results are identical either way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

SEP = "\u0001"
MARK = "\u0002"


def combined_group(line: Column, group: int) -> Column:
    """Group ``group`` (1-9) of the first combined match; '' when the group is absent.

    Only meaningful on lines in which the pattern occurs.
    """
    return F.regexp_extract(line, P.COMBINED, group)


def serde_group(line: Column, group: int) -> Column:
    """Group ``group`` of the whole-line SerDe match, NULL like the SerDe does.

    A line that does not match gives NULL in every group; groups 8 and 9 are also NULL
    when the optional referer/agent pair is missing.
    """
    gate = P.SERDE9 if group >= 8 else P.SERDE
    return F.when(line.rlike(gate), F.regexp_extract(line, P.SERDE, group))


def raw_fields(line: Column, dialect: str = "combined") -> list[Column]:
    """The nine fields as strings (per-field form), named as in :data:`patterns.FIELDS`."""
    if dialect == "combined":
        extract = combined_group
    elif dialect == "regexserde":
        extract = serde_group
    else:
        raise ValueError(f"unknown dialect {dialect!r}; expected one of {P.DIALECTS}")
    return [extract(line, i + 1).alias(name) for i, name in enumerate(P.FIELDS)]


def sql_literal(text: str) -> str:
    """``text`` as a raw Spark SQL string literal (no escape processing)."""
    if "'" in text:
        raise ValueError("raw literal cannot contain a single quote")
    return f"r'{text}'"


def plain_sql(line: str) -> str:
    """SQL that is true when the line has neither separator character (packing is exact)."""
    return f"(NOT contains({line}, {sql_literal(SEP)}) AND NOT contains({line}, {sql_literal(MARK)}))"


def _packed_pattern(dialect: str) -> tuple[str, range]:
    if dialect == "combined":
        return P.COMBINED + "(?s:.*)", range(1, 10)
    if dialect == "regexserde":
        return P.SERDE_TAIL, range(1, 11)
    raise ValueError(f"unknown dialect {dialect!r}; expected one of {P.DIALECTS}")


def packed_groups(dialect: str, names=P.FIELDS) -> tuple[int, ...]:
    """The regex groups that carry the fields ``names``, ascending.

    ``regexserde`` referer and agent also need group 8, which tells whether the optional
    pair is present. At least one group is packed, so a match is always recognisable.
    """
    _, available = _packed_pattern(dialect)
    groups: set[int] = set()
    for name in names:
        i = P.FIELDS.index(name)
        groups |= {i + 1} if dialect == "combined" or i < 7 else {8, i + 2}
    return tuple(sorted(groups)) or (available[0],)


def packed_sql(line: str, dialect: str = "combined", groups: tuple[int, ...] | None = None) -> str:
    """SQL for the line rewritten as ``MARK`` + the groups, each followed by ``SEP``, if
    it matches, else the line unchanged. One pattern evaluation.

    ``combined``: the first match is extended to the end of the line, so text before
    the match stays in front of ``MARK`` and nothing follows the fields.
    ``regexserde``: the whole line is replaced; group 8 is the optional tail.
    """
    pattern, available = _packed_pattern(dialect)
    replacement = MARK + "".join(f"${g}{SEP}" for g in (groups or available))
    return f"regexp_replace({line}, {sql_literal(pattern)}, {sql_literal(replacement)})"


def parts_sql(line: str, dialect: str = "combined", groups: tuple[int, ...] | None = None) -> str:
    """SQL for the packed groups of the first match as an array of strings, plus an
    empty last element; a line without a match gives a one-element array. Exact for
    plain lines only."""
    mark, sep = sql_literal(MARK), sql_literal(SEP)
    return f"split(substring_index({packed_sql(line, dialect, groups)}, {mark}, -1), {sep})"


def unpack_sql(
    line: str, plain: str, parts: str, dialect: str = "combined",
    groups: tuple[int, ...] | None = None,
) -> tuple[str, dict[str, str]]:
    """SQL ``(matched, {field: string value})`` from a line, its plain flag and its parts
    array (built with the same ``groups``); one entry per field those groups carry.

    Plain lines read the parts array; other lines recompute with the per-field form.
    For ``regexserde`` every field is NULL on a mismatch and referer/agent are NULL when
    the optional pair is absent.
    """
    groups = groups or _packed_pattern(dialect)[1]
    hit = f"size({parts}) = {len(groups) + 1}"

    def part(group: int) -> str:
        return f"get({parts}, {list(groups).index(group)})"  # NULL past the end, also under ANSI

    fields: dict[str, str] = {}
    if dialect == "combined":
        pattern = sql_literal(P.COMBINED)
        matched = f"CASE WHEN {plain} THEN {hit} ELSE {line} RLIKE {pattern} END"
        for i, name in enumerate(P.FIELDS):
            if i + 1 in groups:
                fields[name] = (
                    f"CASE WHEN {plain} THEN {part(i + 1)} "
                    f"ELSE regexp_extract({line}, {pattern}, {i + 1}) END"
                )
        return matched, fields
    serde, serde9 = sql_literal(P.SERDE), sql_literal(P.SERDE9)
    matched = f"CASE WHEN {plain} THEN {hit} ELSE {line} RLIKE {serde} END"
    for i, name in enumerate(P.FIELDS):
        if i < 7 and i + 1 in groups:
            fast = part(i + 1)
        elif i >= 7 and {8, i + 2} <= set(groups):
            fast = f"CASE WHEN {part(8)} <> '' THEN {part(i + 2)} END"
        else:
            continue
        gate = serde9 if i >= 7 else serde
        slow = f"CASE WHEN {line} RLIKE {gate} THEN regexp_extract({line}, {serde}, {i + 1}) END"
        fields[name] = f"CASE WHEN {plain} THEN (CASE WHEN {hit} THEN {fast} END) ELSE {slow} END"
    return matched, fields


def typed_bytes_sql(raw: str, policy: str = "drop") -> str:
    """SQL for a byte count as ``bigint`` under a malformed-value policy.

    ``drop`` and ``null`` give NULL for a value that is not an integer (``drop`` callers
    then filter the row out), ``zero`` gives 0, ``fail`` raises an error naming the value.
    ``fail`` does not depend on ``spark.sql.ansi.enabled``.
    """
    value = f"TRY_CAST({raw} AS BIGINT)"
    if policy in ("drop", "null"):
        return value
    if policy == "zero":
        return f"COALESCE({value}, 0L)"
    if policy == "fail":
        message = f"concat('unparsable byte count: ', coalesce({raw}, 'NULL'))"
        return f"CASE WHEN {value} IS NULL THEN raise_error({message}) ELSE {value} END"
    raise ValueError(f"unknown byte policy {policy!r}; expected one of {P.BYTE_POLICIES}")
