"""Web access-log bandwidth analytics on Spark DataFrames.

Typical use::

    from logtally import read_lines, parse, status_breakdown
    records = parse(read_lines(spark, "hdfs:///logs/2026/*"))          # combined, drop
    status_breakdown(records).show()                                    # all traffic
    status_breakdown(records, "178.154.179.250", order="status").show()  # one IP
"""

from .operators.parse import clean_lines, observe_counts, parse, parse_counts, rejects, split_fields
from .operators.reports import (
    distinct_values,
    ip_bytes,
    ip_hits,
    ip_list_breakdown,
    ip_total,
    line_status_maps,
    merge_status_maps,
    status_breakdown,
    status_bytes,
    status_map,
    status_range,
    status_range_total,
    status_total,
    sum_identical,
    top_ip,
    top_ips,
    top_ips_breakdown,
    total_bytes,
)
from .operators.select import non_empty_ip, prefilter_lines, status_between, where_ip
from .operators.sinks import (
    ctrl_a_lines,
    format_lines,
    map_text,
    status_map_text,
    write_ctrl_a,
    write_key_value,
    write_text,
)
from .operators.store import append, compact, ingest_lines, read_store, vacuum
from .session import checkpoint_root, get_session, scratch_path
from .sources.double_gzip import read_double_gzip, write_double_gzip
from .sources.tables import create_log_table, drop_table, load_lines, parsed_view, register_lines
from .sources.text import read_lines

__all__ = [name for name in dir() if not name.startswith("_")]
