"""DuckDB SQL equal in result to each named query (the correctness oracle).

Every statement starts from the same ``log_lines`` rule over the ``events`` view and
parses with the same patterns (DuckDB's regex engine agrees with Java's on them).
Sums are DECIMAL(38,0), as in Spark.
"""

from __future__ import annotations

from ..functions.patterns import COMBINED, SERDE, SERDE9
from ..sources.fixtures import HARD_LINES_SQL, LOG_LINES_SQL
from . import queries as Q

P, H, H9 = COMBINED, SERDE, SERDE9


def _fields_combined(src: str = "m") -> str:
    cols = [
        f"regexp_extract(line, '{P}', 1) AS ip",
        f"regexp_extract(line, '{P}', 2) AS client",
        f"regexp_extract(line, '{P}', 3) AS \"user\"",
        f"regexp_extract(line, '{P}', 4) AS date_time",
        f"regexp_extract(line, '{P}', 5) AS request",
        f"CAST(regexp_extract(line, '{P}', 6) AS INTEGER) AS status",
        f"TRY_CAST(regexp_extract(line, '{P}', 7) AS BIGINT) AS bytes",
        f"regexp_extract(line, '{P}', 8) AS referer",
        f"regexp_extract(line, '{P}', 9) AS agent",
    ]
    return "SELECT " + ", ".join(cols) + f" FROM {src}"


def _fields_serde(src: str = "log_lines") -> str:
    names = ["ip", "client", '"user"', "date_time", "request", "status", "bytes", "referer", "agent"]
    cols = []
    for i, name in enumerate(names, start=1):
        gate = H9 if i >= 8 else H
        cols.append(
            f"CASE WHEN regexp_matches(line, '{gate}') THEN regexp_extract(line, '{H}', {i}) END AS {name}"
        )
    return "SELECT " + ", ".join(cols) + f" FROM {src}"


BASE = f"""WITH log_lines AS ({LOG_LINES_SQL}),
m AS (SELECT line FROM log_lines WHERE regexp_matches(line, '{P}')),
parsed AS ({_fields_combined()}),
usable AS (SELECT * FROM parsed WHERE bytes IS NOT NULL),
serde AS ({_fields_serde()})
"""

HARD = f"""WITH log_lines AS ({HARD_LINES_SQL}),
m AS (SELECT line FROM log_lines WHERE regexp_matches(line, '{P}')),
parsed AS ({_fields_combined()}),
usable AS (SELECT * FROM parsed WHERE bytes IS NOT NULL),
raw_serde AS ({_fields_serde()}),
serde AS (SELECT * REPLACE (TRY_CAST(bytes AS BIGINT) AS bytes) FROM raw_serde)
"""

FIELDS_SQL = 'ip, client, "user", date_time, request, status, bytes, referer, agent'


def _q(body: str) -> str:
    return BASE + body


def _pct(part: str, whole: str) -> str:
    return f"100 * (CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE))"


def _breakdown(src: str, order: str) -> str:
    return (
        f", g AS (SELECT status, CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes FROM {src} GROUP BY status)\n"
        f"SELECT status, bytes, {_pct('bytes', '(SELECT sum(bytes) FROM g)')} AS pct FROM g "
        f"ORDER BY {order}"
    )


BY_BYTES = "bytes DESC, status DESC"
IP_ROWS = f"(SELECT * FROM usable WHERE ip = '{Q.IP}')"
PREFIX_ROWS = (
    f"(SELECT p.* FROM ({_fields_combined(f'(SELECT line FROM m WHERE starts_with(line, {Q.PREFIX!r}))')}) p "
    "WHERE p.bytes IS NOT NULL)"
)

_REASON = (
    f"CASE WHEN NOT regexp_matches(line, '{P}') THEN 'no_match' "
    f"WHEN TRY_CAST(regexp_extract(line, '{P}', 7) AS BIGINT) IS NULL THEN 'bad_bytes' END"
)

_HIVE = (
    ", g AS (SELECT status, sum(TRY_CAST(bytes AS DOUBLE)) AS bytes FROM {src} GROUP BY status)\n"
    "SELECT status, bytes, 100 * (bytes / (SELECT sum(bytes) FROM g)) AS pct FROM g"
)

_MAP_TEXT = (
    "SELECT selection, CAST(sum(bytes) AS DECIMAL(38,0)) AS total, "
    "string_agg(status || '=' || CAST(bytes AS VARCHAR), chr(10) ORDER BY status) "
    "|| ' from a total of ' || CAST(sum(bytes) AS VARCHAR) AS text FROM g GROUP BY selection"
)

_IDENTITY = 'ip, client, "user", date_time, request, status, referer, agent'
_SUMMED = (
    f", summed AS (SELECT {_IDENTITY}, CAST(sum(coalesce(bytes, 0)) AS DECIMAL(38,0)) AS bytes "
    f"FROM parsed GROUP BY {_IDENTITY})\n"
)

_TOP = (
    "SELECT ip, CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes, count(*) AS hits FROM usable "
    "WHERE ip <> '' GROUP BY ip ORDER BY bytes DESC, ip ASC"
)

_PCT_TEXT = "printf('%.6f', pct)"

ORACLE: dict[str, str] = {
    "parse_combined": _q(f"SELECT {FIELDS_SQL} FROM usable"),
    "parse_regexserde": _q(f"SELECT {FIELDS_SQL} FROM serde"),
    "rejects": _q(
        f"SELECT line, reason FROM (SELECT line, {_REASON} AS reason FROM log_lines) r "
        "WHERE reason IS NOT NULL"
    ),
    "parse_counts": _q(
        "SELECT count(*) AS lines, "
        f"count(*) FILTER (WHERE regexp_matches(line, '{P}')) AS matched, "
        f"count(*) FILTER (WHERE {_REASON} = 'bad_bytes') AS bad_bytes, "
        f"count(*) FILTER (WHERE {_REASON} IS NULL) AS usable FROM log_lines"
    ),
    "bytes_drop": _q("SELECT status, CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes FROM usable GROUP BY status"),
    "bytes_zero": _q(
        "SELECT status, CAST(sum(coalesce(bytes, 0)) AS DECIMAL(38,0)) AS bytes FROM parsed GROUP BY status"
    ),
    "bytes_null": _q("SELECT status, CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes FROM parsed GROUP BY status"),
    "bytes_fail": _q("SELECT status, CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes FROM usable GROUP BY status"),
    "status_breakdown_global": _q(_breakdown("usable", BY_BYTES)),
    "status_breakdown_ip": _q(_breakdown(IP_ROWS, "status")),
    "status_breakdown_ip_of_global": _q(
        f", g AS (SELECT status, CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes FROM {IP_ROWS} GROUP BY status)\n"
        f"SELECT status, bytes, {_pct('bytes', '(SELECT sum(bytes) FROM usable)')} AS pct FROM g "
        "ORDER BY status"
    ),
    "status_breakdown_prefix": _q(_breakdown(PREFIX_ROWS, "status")),
    "hive_style_breakdown": _q(_HIVE.format(src="serde")),
    "percent_text": _q(
        f", g AS (SELECT status, CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes FROM usable GROUP BY status),\n"
        f"b AS (SELECT status, bytes, {_pct('bytes', '(SELECT sum(bytes) FROM g)')} AS pct FROM g)\n"
        f"SELECT status, bytes, {_PCT_TEXT} AS pct_text, "
        f"'Status ' || CAST(status AS VARCHAR) || ' ' || {_PCT_TEXT} || '% ' || CAST(bytes AS VARCHAR) "
        "AS report FROM b ORDER BY bytes DESC, status DESC"
    ),
    "total_bytes": _q("SELECT CAST(sum(bytes) AS DECIMAL(38,0)) AS total_bytes FROM usable"),
    "status_total": _q(
        f"SELECT {Q.STATUS} AS status, CAST(coalesce(sum(bytes), 0) AS DECIMAL(38,0)) AS bytes FROM usable "
        f"WHERE status BETWEEN {Q.STATUS} AND {Q.STATUS}"
    ),
    "status_range": _q(
        "SELECT status, CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes FROM usable "
        f"WHERE status BETWEEN {Q.STATUS_RANGE[0]} AND {Q.STATUS_RANGE[1]} GROUP BY status ORDER BY status"
    ),
    "ip_total": _q(
        f"SELECT '{Q.IP}' AS ip, CAST(coalesce(sum(bytes), 0) AS DECIMAL(38,0)) AS bytes, count(*) AS hits "
        f"FROM usable WHERE ip = '{Q.IP}'"
    ),
    "ip_hits": _q("SELECT ip, count(*) AS hits FROM usable GROUP BY ip"),
    "ip_bytes": _q(
        "SELECT ip, CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes, count(*) AS hits FROM usable GROUP BY ip"
    ),
    "top_ip": _q(
        "SELECT coalesce(t.ip, '') AS ip, CAST(coalesce(t.bytes, 0) AS DECIMAL(38,0)) AS bytes "
        "FROM (SELECT 1 AS k) d LEFT JOIN ("
        "SELECT ip, CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes FROM usable WHERE ip <> '' GROUP BY ip "
        "HAVING sum(bytes) > 0 ORDER BY bytes DESC, ip ASC LIMIT 1) t ON true"
    ),
    "top_ips_10": _q(f"{_TOP} LIMIT {Q.TOP_N}"),
    "distinct_ips": _q("SELECT DISTINCT ip FROM usable ORDER BY ip"),
    "distinct_statuses": _q("SELECT DISTINCT status FROM usable ORDER BY status"),
    "top_ips_breakdown": _q(
        f", top AS ({_TOP} LIMIT {Q.TOP_N})\n"
        "SELECT ip, status, CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes FROM usable "
        "WHERE ip IN (SELECT ip FROM top) GROUP BY ip, status"
    ),
    "status_map_text": _q(
        ", g AS (SELECT 'all' AS selection, CAST(status AS VARCHAR) AS status, "
        "CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes FROM usable GROUP BY status)\n" + _MAP_TEXT
    ),
    "status_map_merge": _q(
        ", g AS (SELECT ip AS selection, CAST(status AS VARCHAR) AS status, "
        "CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes FROM usable GROUP BY ip, status)\n" + _MAP_TEXT
    ),
    "ip_set_breakdown": _q(
        "SELECT ip, status, CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes FROM usable "
        f"WHERE ip IN (SELECT ip FROM usable WHERE status = {Q.STATUS}) GROUP BY ip, status"
    ),
    "status_map_export": _q(
        f", g AS (SELECT {Q.PREFIX!r} AS selection, CAST(status AS VARCHAR) AS status, "
        f"CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes FROM {PREFIX_ROWS} GROUP BY status),\n"
        f"maps AS ({_MAP_TEXT})\n"
        "SELECT unnest(string_split(selection || chr(9) || text, chr(10))) AS line FROM maps"
    ),
    "sum_identical_records": _q(_SUMMED + f"SELECT {_IDENTITY}, bytes FROM summed"),
    "ctrl_a_rows": _q(
        _SUMMED
        + "SELECT concat_ws(chr(1), coalesce(nullif(ip, ''), 'null'), client, \"user\", date_time, "
        "request, CAST(status AS VARCHAR), referer, agent, CAST(bytes AS VARCHAR)) AS line FROM summed"
    ),
    "format_line": _q(f"SELECT line FROM log_lines WHERE regexp_matches(line, '{H}')"),
    "store_roundtrip": _q(f"SELECT {FIELDS_SQL} FROM usable"),
    "store_compact": _q(
        f"SELECT {FIELDS_SQL} FROM usable UNION ALL SELECT {FIELDS_SQL} FROM usable"
    ),
    "store_breakdown_ip": _q(_breakdown(IP_ROWS, "status")),
    "store_breakdown_global": _q(_breakdown("usable", BY_BYTES)),
    "double_gzip_roundtrip": _q("SELECT line FROM log_lines"),
    "text_source_roundtrip": _q("SELECT line FROM log_lines"),
    "table_load": _q(
        f", twice AS (SELECT line FROM log_lines UNION ALL SELECT line FROM log_lines),\n"
        f"serde2 AS ({_fields_serde('twice')})\n" + _HIVE.format(src="serde2")
    ),
    "table_overwrite": _q(_HIVE.format(src="serde")),
    "streaming_ingest": _q(f"SELECT {FIELDS_SQL} FROM usable"),
}

# The store answers the same reports as the scan (cross-path agreement).
ORACLE.update({
    "store_status_total": ORACLE["status_total"],
    "store_ip_total": ORACLE["ip_total"],
    "store_top_ip": ORACLE["top_ip"],
    "store_distinct_statuses": ORACLE["distinct_statuses"],
})

_IP_STATUS = "SELECT ip, status, CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes FROM {src} WHERE {where} GROUP BY ip, status"
_LIST = _q(_IP_STATUS.format(src="usable", where="ip IN (" + ", ".join(f"'{x}'" for x in Q.IP_LIST) + ")"))
_FRAME = _q(_IP_STATUS.format(src="usable", where="ip LIKE '10.2.%'"))
_SERDE_TOP = (
    ", top AS (SELECT ip FROM serde WHERE ip <> '' GROUP BY ip "
    "ORDER BY CAST(sum(bytes) AS DECIMAL(38,0)) DESC NULLS LAST, ip ASC LIMIT {n})\n"
    + _IP_STATUS.format(src="serde", where="ip IN (SELECT ip FROM top)")
)
_REPLACED = _q(f"SELECT {FIELDS_SQL} FROM usable WHERE status >= 400 OR status = 200")

ORACLE.update({
    "ip_list_breakdown": _LIST,
    "store_ip_list_breakdown": _LIST,
    "ip_frame_breakdown": _FRAME,
    "store_ip_frame_breakdown": _FRAME,
    "rejects_hard": HARD + (
        f"SELECT line, reason FROM (SELECT line, CASE WHEN NOT coalesce(regexp_matches(line, '{P}'), false) "
        f"THEN 'no_match' WHEN TRY_CAST(regexp_extract(line, '{P}', 7) AS BIGINT) IS NULL THEN 'bad_bytes' END "
        "AS reason FROM log_lines) r WHERE reason IS NOT NULL"
    ),
    "big_sum_breakdown": HARD + _breakdown("usable", BY_BYTES),
    "big_sum_ips": HARD + (
        "SELECT ip, CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes, count(*) AS hits FROM usable GROUP BY ip"
    ),
    "status_breakdown_serde": HARD + _breakdown("serde", "bytes DESC NULLS LAST, status DESC NULLS LAST"),
    "status_range_serde": HARD + (
        "SELECT status, CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes FROM serde "
        "WHERE TRY_CAST(status AS INTEGER) BETWEEN 200 AND 1999 GROUP BY status ORDER BY status"
    ),
    "status_total_serde": HARD + (
        "SELECT 200 AS status, CAST(coalesce(sum(bytes), 0) AS DECIMAL(38,0)) AS bytes FROM serde "
        "WHERE TRY_CAST(status AS INTEGER) = 200"
    ),
    "status_map_serde": HARD + (
        ", g AS (SELECT 'all' AS selection, coalesce(status, 'null') AS status, "
        "CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes FROM serde GROUP BY 2)\n" + _MAP_TEXT
    ),
    "top_ips_breakdown_serde": HARD + _SERDE_TOP.format(n=3),
    "top_ips_breakdown_serde_all": HARD + _SERDE_TOP.format(n=10_000_000),
    "store_compact_in_place": ORACLE["store_compact"],
    "store_compacted_ip": ORACLE["store_breakdown_ip"],
    "store_replace_segment": _REPLACED,
    "store_replace_compacted": _REPLACED,
    "double_gzip_to_store": ORACLE["store_roundtrip"],
    "managed_table": ORACLE["hive_style_breakdown"],
})
ORACLE["store_spread_ips"] = ORACLE["big_sum_ips"]

ORACLE.update({
    "store_failed_rewrite": _q(f"SELECT {FIELDS_SQL} FROM usable WHERE status < 400"),
    "store_tiers": ORACLE["store_roundtrip"],
    "store_compacted_ip_list": _LIST,
    "store_compacted_ip_frame": _FRAME,
    "store_terms_breakdown": ORACLE["status_breakdown_global"],
    "store_terms_top_ip": ORACLE["top_ip"],
    "store_terms_ips": ORACLE["ip_bytes"],
    "store_terms_distinct_ips": ORACLE["distinct_ips"],
    "store_top_ips_pruned": ORACLE["top_ips_10"],
    "store_top_ip_pruned": ORACLE["top_ip"],
    "store_breakdown_serde": HARD + _breakdown(
        "(SELECT TRY_CAST(status AS INTEGER) AS status, bytes FROM serde WHERE request IS NOT NULL)",
        "bytes DESC NULLS LAST, status DESC NULLS LAST",
    ),
    "ingest_rejects": ORACLE["rejects_hard"],
    "ingest_rejects_serde": HARD + (
        f"SELECT line, reason FROM (SELECT line, CASE WHEN NOT coalesce(regexp_matches(line, '{H}'), false) "
        f"THEN 'no_match' WHEN TRY_CAST(regexp_extract(line, '{H}', 7) AS BIGINT) IS NULL THEN 'bad_bytes' END "
        "AS reason FROM log_lines) r WHERE reason IS NOT NULL"
    ),
    "accesslog_view": _q(_IP_STATUS.format(src="usable", where="status >= 300 AND ip LIKE '10.%'")),
    "accesslog_serde": HARD + f"SELECT {FIELDS_SQL} FROM (SELECT s.* FROM ({_fields_serde('(SELECT line FROM log_lines WHERE line IS NOT NULL)')}) s) "
    .replace("FROM (SELECT s.*", "FROM (SELECT s.* REPLACE (TRY_CAST(bytes AS BIGINT) AS bytes)"),
    "double_gzip_members": ORACLE["double_gzip_roundtrip"],
})
