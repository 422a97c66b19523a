"""Named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

All of them run on ``log_lines`` (or ``hard_lines``) generated from the whole ``events``
table of ``sf_dir``. The parameters (one IP, one prefix, one status, a status range, top-N) play
the role of the IP or status a user asks about.

Queries whose subject is a file format, a store or a table first write the data under a
fresh folder of the session's shared scratch location, then read it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import reports as R
from ..operators import sinks, store
from ..operators.parse import clean_lines, parse, parse_counts, rejects
from ..operators.select import prefilter_lines
from ..session import scratch_path
from ..sources import accesslog, tables
from ..sources.double_gzip import read_double_gzip, write_double_gzip
from ..sources.fixtures import hard_lines, log_lines
from ..sources.text import read_lines
from .sql import status_share_sql

# Report parameters (the "given IP" etc. of the reports).
IP = "10.2.7.128"
PREFIX = "10.4.2.4"
STATUS = 404
STATUS_RANGE = (300, 399)
TOP_N = 10
IP_LIST = ("10.2.7.128", "10.1.1.78", "10.5.1.89", "10.0.0.1", "no such ip")
# Columns of the status reports over parsed views.
STATUS_FIELDS = ("status", "bytes")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_lines(spark, sf_dir).select("line")


def _usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(_lines(spark, sf_dir), "combined", "drop")


def _report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable records with the columns the reports read (same rows as ``_usable``)."""
    return parse(_lines(spark, sf_dir), "combined", "drop", fields=R.REPORT_FIELDS)


# --- parsing -------------------------------------------------------------------------

def parse_combined(spark, sf_dir):
    return _usable(spark, sf_dir)


def parse_regexserde(spark, sf_dir):
    return parse(_lines(spark, sf_dir), "regexserde")


def rejects_q(spark, sf_dir):
    return rejects(_lines(spark, sf_dir))


def parse_counts_q(spark, sf_dir):
    return parse_counts(_lines(spark, sf_dir))


def _bytes_by_policy(policy: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        return R.status_bytes(parse(_lines(spark, sf_dir), "combined", policy, fields=STATUS_FIELDS))

    run.__name__ = f"bytes_{policy}"
    return run


def bytes_fail(spark, sf_dir):
    """The strict policy on quarantined input: rejected lines are split off first, the
    remaining lines must all parse (an unparsable byte count would stop the job)."""
    return R.status_bytes(
        parse(clean_lines(_lines(spark, sf_dir)), "combined", "fail", fields=STATUS_FIELDS)
    )


# --- status breakdowns ---------------------------------------------------------------

def status_breakdown_global(spark, sf_dir):
    return R.status_breakdown(_report_rows(spark, sf_dir))


def status_breakdown_ip(spark, sf_dir):
    lines = prefilter_lines(_lines(spark, sf_dir), IP, "exact")
    return R.status_breakdown(parse(lines, fields=R.REPORT_FIELDS), IP, order="status")


def status_breakdown_ip_of_global(spark, sf_dir):
    return R.status_breakdown(_report_rows(spark, sf_dir), IP, denominator="global", order="status")


def status_breakdown_prefix(spark, sf_dir):
    lines = prefilter_lines(_lines(spark, sf_dir), PREFIX, "prefix")
    return R.status_breakdown(parse(lines, fields=R.REPORT_FIELDS), order="status")


def hive_style_breakdown(spark, sf_dir):
    tables.register_lines(_lines(spark, sf_dir), "logtally_serde_lines", fields=STATUS_FIELDS)
    return status_share_sql(spark, "logtally_serde_lines")


def percent_text(spark, sf_dir):
    rows = R.status_breakdown(_report_rows(spark, sf_dir))
    pct_text = F.format_string("%.6f", F.col("pct"))
    return rows.select(
        "status",
        "bytes",
        pct_text.alias("pct_text"),
        F.concat(
            F.lit("Status "), F.col("status").cast("string"), F.lit(" "), pct_text,
            F.lit("% "), F.col("bytes").cast("string"),
        ).alias("report"),
    )


# --- totals, IPs ----------------------------------------------------------------------

def total_bytes(spark, sf_dir):
    return R.total_bytes(_report_rows(spark, sf_dir))


def status_total(spark, sf_dir):
    return R.status_total(_report_rows(spark, sf_dir), STATUS)


def status_range(spark, sf_dir):
    return R.status_range(_report_rows(spark, sf_dir), *STATUS_RANGE)


def ip_total(spark, sf_dir):
    lines = prefilter_lines(_lines(spark, sf_dir), IP, "exact")
    return R.ip_total(parse(lines, fields=R.REPORT_FIELDS), IP)


def ip_hits(spark, sf_dir):
    return R.ip_hits(_report_rows(spark, sf_dir))


def ip_bytes(spark, sf_dir):
    return R.ip_bytes(_report_rows(spark, sf_dir))


def top_ip(spark, sf_dir):
    return R.top_ip(_report_rows(spark, sf_dir))


def top_ips_10(spark, sf_dir):
    return R.top_ips(_report_rows(spark, sf_dir), TOP_N)


def distinct_ips(spark, sf_dir):
    return R.distinct_values(_report_rows(spark, sf_dir), "ip")


def distinct_statuses(spark, sf_dir):
    return R.distinct_values(_report_rows(spark, sf_dir), "status")


def top_ips_breakdown(spark, sf_dir):
    """Status breakdown of each of the top IPs: the key list is a top-N result (at most
    N rows) joined to the (ip, status) aggregate of the same scan."""
    return R.top_ips_breakdown(_report_rows(spark, sf_dir), TOP_N)


def _ip_frame(spark, sf_dir) -> DataFrame:
    """The key list as a table of its own: the dotted IPs that start with ``10.2.``."""
    ips = _report_rows(spark, sf_dir).where("ip LIKE '10.2.%'").select("ip").distinct()
    return ips.union(spark.createDataFrame([("no such ip",)], "ip string"))


def ip_list_breakdown(spark, sf_dir):
    """Status breakdown of an explicit list of IPs: an ``IN`` filter on the lines' records."""
    return R.ip_list_breakdown(_report_rows(spark, sf_dir), IP_LIST)


def ip_frame_breakdown(spark, sf_dir):
    """Status breakdown of the IPs of a key table: a semi join."""
    return R.ip_list_breakdown(_report_rows(spark, sf_dir), _ip_frame(spark, sf_dir))


def store_ip_list_breakdown(spark, sf_dir):
    """The explicit list against the store: a pushed ``In`` filter."""
    return R.ip_list_breakdown(store.read_store(spark, _store_of(spark, sf_dir)), IP_LIST)


def store_ip_frame_breakdown(spark, sf_dir):
    """The key table against the store."""
    return R.ip_list_breakdown(store.read_store(spark, _store_of(spark, sf_dir)), _ip_frame(spark, sf_dir))


def ip_set_breakdown(spark, sf_dir):
    """Status breakdown of every IP in a key set derived from the data (IPs that got a
    404), from one scan: the (ip, status) aggregate flagged per IP by a window. (A key
    table goes through a semi join instead: ``ip_frame_breakdown``.)"""
    return R.breakdown_of_ips_with_status(_report_rows(spark, sf_dir), STATUS)


# --- status maps, identical records, exports ----------------------------------------

def status_map_text(spark, sf_dir):
    return sinks.status_map_text(R.status_map(_report_rows(spark, sf_dir), "all"))


def status_map_merge(spark, sf_dir):
    """One-entry maps per record, merged per IP."""
    maps = R.line_status_maps(_report_rows(spark, sf_dir), F.col("ip"))
    return sinks.status_map_text(R.merge_status_maps(maps))


def status_map_export(spark, sf_dir):
    """The counting job's text output: the selection (an IP prefix) as key, a tab, then
    the status map text, written as text files and read back line by line (the map text
    spans several lines)."""
    lines = prefilter_lines(_lines(spark, sf_dir), PREFIX, "prefix")
    maps = sinks.status_map_text(R.status_map(parse(lines, fields=R.REPORT_FIELDS), PREFIX))
    out = scratch_path(spark, "status-map-tsv")
    sinks.write_key_value(maps, "selection", "text", out)
    return read_lines(spark, out)


def sum_identical_records(spark, sf_dir):
    return R.sum_identical(parse(_lines(spark, sf_dir), "combined", "zero"))


def ctrl_a_rows(spark, sf_dir):
    summed = R.sum_identical(parse(_lines(spark, sf_dir), "combined", "zero"))
    out = scratch_path(spark, "ctrl-a")
    sinks.write_text(sinks.ctrl_a_lines(summed), out)
    return read_lines(spark, out)


def format_line(spark, sf_dir):
    return sinks.format_lines(parse(_lines(spark, sf_dir), "regexserde"))


# --- hard lines: SerDe records through every report, large counts, repeated lines ------

def _hard(spark, sf_dir) -> DataFrame:
    return hard_lines(spark, sf_dir).select("line")


def _serde(spark, sf_dir) -> DataFrame:
    return parse(_hard(spark, sf_dir), "regexserde", "null", fields=R.REPORT_FIELDS)


def rejects_hard(spark, sf_dir):
    return rejects(_hard(spark, sf_dir))


def big_sum_breakdown(spark, sf_dir):
    """Byte counts near 2^62: sums of a few lines pass 2^63."""
    return R.status_breakdown(parse(_hard(spark, sf_dir), fields=R.REPORT_FIELDS))


def big_sum_ips(spark, sf_dir):
    return R.ip_bytes(parse(_hard(spark, sf_dir), fields=R.REPORT_FIELDS))


def status_breakdown_serde(spark, sf_dir):
    return R.status_breakdown(_serde(spark, sf_dir))


def status_range_serde(spark, sf_dir):
    return R.status_range(_serde(spark, sf_dir), 200, 1999)


def status_total_serde(spark, sf_dir):
    return R.status_total(_serde(spark, sf_dir), 200)


def status_map_serde(spark, sf_dir):
    return sinks.status_map_text(R.status_map(_serde(spark, sf_dir)))


def top_ips_breakdown_serde(spark, sf_dir):
    return R.top_ips_breakdown(_serde(spark, sf_dir), 3)


def top_ips_breakdown_serde_all(spark, sf_dir):
    """Every IP, and none that is missing."""
    return R.top_ips_breakdown(_serde(spark, sf_dir), None)


# --- store, files, tables, streaming ------------------------------------------------

def _store_of(spark, sf_dir) -> str:
    path = scratch_path(spark, "store")
    store.ingest_lines(_lines(spark, sf_dir), path)
    return path


def store_roundtrip(spark, sf_dir):
    return store.read_store(spark, _store_of(spark, sf_dir))


def store_compact(spark, sf_dir):
    """Two appends of the same input (re-ingesting duplicates rows), merged into one
    compacted segment."""
    path = _store_of(spark, sf_dir)
    store.append(_usable(spark, sf_dir), path)
    target = scratch_path(spark, "store-compact")
    store.compact(spark, path, target)
    return store.read_store(spark, target)


def store_compact_in_place(spark, sf_dir):
    """An append, a compaction in place, another append of the same lines: both are read."""
    path = _store_of(spark, sf_dir)
    store.compact(spark, path)
    store.ingest_lines(_lines(spark, sf_dir), path)
    return store.read_store(spark, path)


def store_compacted_ip(spark, sf_dir):
    """One IP from a compacted store: one bucket folder is read."""
    path = _store_of(spark, sf_dir)
    store.compact(spark, path)
    store.vacuum(spark, path)
    return R.status_breakdown(store.read_store(spark, path, ip=IP), order="status")


def store_replace_segment(spark, sf_dir):
    """A named segment written again with other rows: only the second rows remain."""
    path, rows = scratch_path(spark, "store"), _usable(spark, sf_dir)
    store.append(rows.where("status < 400"), path, segment="a")
    store.append(rows.where("status = 200"), path, segment="b")
    store.append(rows.where("status >= 400"), path, segment="a")
    return store.read_store(spark, path)


def store_replace_compacted(spark, sf_dir):
    """The same after a compaction has merged the first version."""
    path, rows = scratch_path(spark, "store"), _usable(spark, sf_dir)
    store.append(rows.where("status < 400"), path, segment="a")
    store.append(rows.where("status = 200"), path, segment="b")
    store.compact(spark, path)
    store.append(rows.where("status >= 400"), path, segment="a")
    return store.read_store(spark, path)


def store_spread_ips(spark, sf_dir):
    """Bytes per IP from a store of spread IPs and many equal lines, read back after five
    appends and a compaction."""
    path = scratch_path(spark, "store")
    for k in range(5):
        part = hard_lines(spark, sf_dir).where(F.col("event_id") % 5 == k).select("line")
        store.ingest_lines(part, path)
    store.compact(spark, path)
    return R.ip_bytes(store.read_store(spark, path))


def store_failed_rewrite(spark, sf_dir):
    """A re-write of a segment whose job fails leaves its rows as they were."""
    path, rows = scratch_path(spark, "store"), _usable(spark, sf_dir)
    store.append(rows.where("status < 400"), path, segment="a")
    broken = rows.withColumn("bytes", F.expr("CAST(raise_error('stopped on purpose') AS BIGINT)"))
    try:
        store.append(broken, path, segment="a")
    except Exception as failure:
        if "stopped on purpose" not in str(failure):
            raise
    return store.read_store(spark, path)


def _store_in_parts(spark, sf_dir) -> str:
    """A store of four segments, each merged with its tier, but for the last; the second was
    written twice, the second time after it was merged."""
    path, lines = scratch_path(spark, "store"), _lines(spark, sf_dir)
    for k in (0, 1, 2, 1, 3):
        part = lines.where(F.crc32(F.col("line").cast("binary")) % 4 == k)
        store.ingest_lines(part, path, segment=f"part-{k}")
        if k < 3:
            store.compact(spark, path)
    return path


def store_tiers(spark, sf_dir):
    """Records of a store of several runs, one of which holds rows that no longer count."""
    return store.read_store(spark, _store_in_parts(spark, sf_dir))


def store_compacted_ip_list(spark, sf_dir):
    """The explicit list against a compacted store: at most one bucket an IP is opened."""
    path = _store_of(spark, sf_dir)
    store.compact(spark, path)
    return R.ip_list_breakdown(store.read_store(spark, path, ips=IP_LIST), IP_LIST)


def store_compacted_ip_frame(spark, sf_dir):
    """The key table against a compacted store: its buckets are chosen at run time."""
    path = _store_of(spark, sf_dir)
    store.compact(spark, path)
    records = store.read_store(spark, path, ips=_ip_frame(spark, sf_dir))
    return R.status_bytes_by_ip(records)


def store_terms_breakdown(spark, sf_dir):
    """Bytes and share by status from the store's terms: no records are read."""
    return R.status_breakdown(store.read_terms(spark, _store_in_parts(spark, sf_dir)))


def store_terms_top_ip(spark, sf_dir):
    return R.top_ip(store.read_terms(spark, _store_in_parts(spark, sf_dir)))


def store_terms_ips(spark, sf_dir):
    """Bytes and hits of every IP from the store's terms."""
    return R.ip_bytes(store.read_terms(spark, _store_in_parts(spark, sf_dir)))


def store_terms_distinct_ips(spark, sf_dir):
    return R.distinct_values(store.read_terms(spark, _store_in_parts(spark, sf_dir)), "ip")


def store_top_ips_pruned(spark, sf_dir):
    """The top IPs from the store's sums by IP, of which only the large ones are read."""
    path = _store_of(spark, sf_dir)
    store.compact(spark, path)
    return R.top_ips(store.top_entries(spark, path, TOP_N), TOP_N)


def store_top_ip_pruned(spark, sf_dir):
    path = _store_of(spark, sf_dir)
    return R.top_ip(store.top_entries(spark, path, 1))


def store_breakdown_serde(spark, sf_dir):
    """SerDe records, whose statuses have no bound, from the store: the total is a scalar
    subquery."""
    path = scratch_path(spark, "store")
    store.ingest_lines(_hard(spark, sf_dir), path, "regexserde", "null")
    return R.status_breakdown(store.read_store(spark, path))


def ingest_rejects(spark, sf_dir):
    """The lines that an ingest kept no record of, from the same pass as the records."""
    path = scratch_path(spark, "store")
    store.ingest_lines(_hard(spark, sf_dir), path)
    return store.read_rejects(spark, path).select("line", "reason")


def ingest_rejects_serde(spark, sf_dir):
    """The same in the SerDe dialect, after a compaction."""
    path = scratch_path(spark, "store")
    store.ingest_lines(_hard(spark, sf_dir), path, "regexserde", "drop")
    store.compact(spark, path)
    return store.read_rejects(spark, path).select("line", "reason")


def double_gzip_to_store(spark, sf_dir):
    """Double-gzip files straight into the store, decoded and parsed in one pass."""
    out, path = scratch_path(spark, "double-gzip"), scratch_path(spark, "store")
    write_double_gzip(_lines(spark, sf_dir), out, files=6)
    store.ingest_lines(read_double_gzip(spark, out).select("line"), path)
    return store.read_store(spark, path)


def store_breakdown_ip(spark, sf_dir):
    records = store.read_store(spark, _store_of(spark, sf_dir), ip=IP)
    return R.status_breakdown(records, order="status")


def store_breakdown_global(spark, sf_dir):
    records = store.read_store(spark, _store_of(spark, sf_dir))
    return R.status_breakdown(records)


def store_status_total(spark, sf_dir):
    """Total of one status from the store: row groups of other statuses are skipped."""
    return R.status_total(store.read_store(spark, _store_of(spark, sf_dir)), STATUS)


def store_ip_total(spark, sf_dir):
    """Total and hits of one IP from the store: its pushed filter skips row groups."""
    return R.ip_total(store.read_store(spark, _store_of(spark, sf_dir), ip=IP), IP)


def store_top_ip(spark, sf_dir):
    return R.top_ip(store.read_store(spark, _store_of(spark, sf_dir)))


def store_distinct_statuses(spark, sf_dir):
    return R.distinct_values(store.read_store(spark, _store_of(spark, sf_dir)), "status")


def double_gzip_roundtrip(spark, sf_dir):
    out = scratch_path(spark, "double-gzip")
    write_double_gzip(_lines(spark, sf_dir), out, files=6)
    return read_double_gzip(spark, out).select("line")


def double_gzip_members(spark, sf_dir):
    """Two files of many gzip members, whose members are dealt to tasks."""
    out = scratch_path(spark, "double-gzip")
    write_double_gzip(_lines(spark, sf_dir), out, files=2, member_bytes=20_000)
    return read_double_gzip(spark, out, split_members=True).select("line")


def text_source_roundtrip(spark, sf_dir):
    out = scratch_path(spark, "text-gz")
    sinks.write_text(_lines(spark, sf_dir).repartition(4), out, compression="gzip")
    return read_lines(spark, out)


def _log_table(spark: SparkSession) -> str:
    location = scratch_path(spark, "log-table")
    name = "logtally_" + location.rsplit("-", 1)[-1]
    return tables.create_log_table(spark, name, location=location)


def table_load(spark, sf_dir):
    """Load the lines twice (append), then the SQL report over the parsed table."""
    name = _log_table(spark)
    tables.load_lines(spark, name, _lines(spark, sf_dir))
    tables.load_lines(spark, name, _lines(spark, sf_dir))
    tables.parsed_view(spark, name, name + "_v", fields=STATUS_FIELDS)
    return status_share_sql(spark, name + "_v")


def table_overwrite(spark, sf_dir):
    """Load, then overwrite with the same lines: the table holds them once."""
    name = _log_table(spark)
    tables.load_lines(spark, name, _lines(spark, sf_dir))
    tables.load_lines(spark, name, _lines(spark, sf_dir), overwrite=True)
    tables.parsed_view(spark, name, name + "_v", fields=STATUS_FIELDS)
    return status_share_sql(spark, name + "_v")


def managed_table(spark, sf_dir):
    """A managed table (no LOCATION): created, loaded, reported on; the catalog owns and
    drops its files."""
    name = "logtally_managed_" + scratch_path(spark, "m").rsplit("-", 1)[-1]
    tables.create_log_table(spark, name)
    tables.load_lines(spark, name, _lines(spark, sf_dir))
    tables.parsed_view(spark, name, name + "_v", fields=STATUS_FIELDS)
    out = scratch_path(spark, "managed-report")
    status_share_sql(spark, name + "_v").write.parquet(out)
    tables.drop_table(spark, name)
    return spark.read.parquet(out)


def accesslog_view(spark, sf_dir):
    """A report in SQL over a catalog view of raw files, read through the data source."""
    files = scratch_path(spark, "raw-logs")
    sinks.write_text(_lines(spark, sf_dir).repartition(3), files)
    name = accesslog.create_log_view(spark, "logtally_raw_" + files.rsplit("-", 1)[-1], files)
    return spark.sql(
        "SELECT ip, status, CAST(sum(bytes) AS DECIMAL(38,0)) AS bytes "
        f"FROM {name} WHERE status >= 300 AND ip LIKE '10.%' GROUP BY ip, status"
    )


def accesslog_serde(spark, sf_dir):
    """All fields of all lines in the SerDe dialect, from gzip files."""
    files = scratch_path(spark, "raw-logs")
    sinks.write_text(_hard(spark, sf_dir).where("line IS NOT NULL").repartition(3), files, compression="gzip")
    accesslog.register(spark)
    options = {"files": files, "dialect": "regexserde", "onBadBytes": "null", "pushdown": "true"}
    return spark.read.format(accesslog.NAME).options(**options).load()


def streaming_ingest(spark, sf_dir):
    """Lines land as text files; a streaming query appends them to the store."""
    from ..streaming.ingest import ingest

    landing = scratch_path(spark, "landing")
    sinks.write_text(_lines(spark, sf_dir).repartition(3), landing)
    path = scratch_path(spark, "stream-store")
    for _ in range(2):  # the second run finds nothing new
        ingest(spark, landing, path, available_now=True).awaitTermination()
    return store.read_store(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_combined": parse_combined,
    "parse_regexserde": parse_regexserde,
    "rejects": rejects_q,
    "parse_counts": parse_counts_q,
    "bytes_drop": _bytes_by_policy("drop"),
    "bytes_zero": _bytes_by_policy("zero"),
    "bytes_null": _bytes_by_policy("null"),
    "bytes_fail": bytes_fail,
    "status_breakdown_global": status_breakdown_global,
    "status_breakdown_ip": status_breakdown_ip,
    "status_breakdown_ip_of_global": status_breakdown_ip_of_global,
    "status_breakdown_prefix": status_breakdown_prefix,
    "hive_style_breakdown": hive_style_breakdown,
    "percent_text": percent_text,
    "total_bytes": total_bytes,
    "status_total": status_total,
    "status_range": status_range,
    "ip_total": ip_total,
    "ip_hits": ip_hits,
    "ip_bytes": ip_bytes,
    "top_ip": top_ip,
    "top_ips_10": top_ips_10,
    "distinct_ips": distinct_ips,
    "distinct_statuses": distinct_statuses,
    "ip_list_breakdown": ip_list_breakdown,
    "ip_set_breakdown": ip_set_breakdown,
    "status_map_text": status_map_text,
    "status_map_merge": status_map_merge,
    "status_map_export": status_map_export,
    "sum_identical_records": sum_identical_records,
    "ctrl_a_rows": ctrl_a_rows,
    "format_line": format_line,
    "store_roundtrip": store_roundtrip,
    "store_compact": store_compact,
    "store_breakdown_ip": store_breakdown_ip,
    "store_breakdown_global": store_breakdown_global,
    "store_status_total": store_status_total,
    "store_ip_total": store_ip_total,
    "store_top_ip": store_top_ip,
    "store_distinct_statuses": store_distinct_statuses,
    "double_gzip_roundtrip": double_gzip_roundtrip,
    "text_source_roundtrip": text_source_roundtrip,
    "table_load": table_load,
    "table_overwrite": table_overwrite,
    "streaming_ingest": streaming_ingest,
    "top_ips_breakdown": top_ips_breakdown,
    "ip_frame_breakdown": ip_frame_breakdown,
    "store_ip_list_breakdown": store_ip_list_breakdown,
    "store_ip_frame_breakdown": store_ip_frame_breakdown,
    "rejects_hard": rejects_hard,
    "big_sum_breakdown": big_sum_breakdown,
    "big_sum_ips": big_sum_ips,
    "status_breakdown_serde": status_breakdown_serde,
    "status_range_serde": status_range_serde,
    "status_total_serde": status_total_serde,
    "status_map_serde": status_map_serde,
    "top_ips_breakdown_serde": top_ips_breakdown_serde,
    "top_ips_breakdown_serde_all": top_ips_breakdown_serde_all,
    "store_compact_in_place": store_compact_in_place,
    "store_compacted_ip": store_compacted_ip,
    "store_replace_segment": store_replace_segment,
    "store_replace_compacted": store_replace_compacted,
    "store_spread_ips": store_spread_ips,
    "store_failed_rewrite": store_failed_rewrite,
    "store_tiers": store_tiers,
    "store_compacted_ip_list": store_compacted_ip_list,
    "store_compacted_ip_frame": store_compacted_ip_frame,
    "store_terms_breakdown": store_terms_breakdown,
    "store_terms_top_ip": store_terms_top_ip,
    "store_terms_ips": store_terms_ips,
    "store_terms_distinct_ips": store_terms_distinct_ips,
    "store_top_ips_pruned": store_top_ips_pruned,
    "store_top_ip_pruned": store_top_ip_pruned,
    "store_breakdown_serde": store_breakdown_serde,
    "ingest_rejects": ingest_rejects,
    "ingest_rejects_serde": ingest_rejects_serde,
    "accesslog_view": accesslog_view,
    "accesslog_serde": accesslog_serde,
    "double_gzip_members": double_gzip_members,
    "double_gzip_to_store": double_gzip_to_store,
    "managed_table": managed_table,
}
