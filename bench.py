"""Benchmark: the four reported cells (raw scan / parsed store x one IP / all traffic).

Input: the access-log lines generated from ``$BENCH_SF_DIR/events.parquet`` (default
``/root/testdata/sf0.1``), written once as plain text files and as double-gzipped files
(the original input format) under the session's shared scratch folder. The Parquet store
is built from them (timed as ``store_build``, median of three builds after warm-up). Each query runs
``$BENCH_REPEAT`` times (default 7, round-robin over the queries) after two warm-up
runs; the median is reported.

Prints one JSON line: ``{"metric", "value", "unit", "queries", "sf", ...}``; ``value``
is the sum of the four headline cells.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from logtally.operators import reports as R  # noqa: E402
from logtally.operators import store  # noqa: E402
from logtally.operators.parse import parse  # noqa: E402
from logtally.operators.select import prefilter_lines  # noqa: E402
from logtally.session import get_session, scratch_path  # noqa: E402
from logtally.sources.double_gzip import read_double_gzip, write_double_gzip  # noqa: E402
from logtally.sources.fixtures import hard_lines, log_lines  # noqa: E402
from logtally.sources.text import read_lines  # noqa: E402
from logtally.operators.sinks import write_text  # noqa: E402

IP = "10.2.7.128"
APPENDS = 20


def _timed(fn, repeat: int) -> float:
    fn()  # warm-up: JIT, codegen cache, file listing cache of the OS
    fn()
    runs = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t0)
    return round(statistics.median(runs), 4)


def _timed_interleaved(fns: dict, repeat: int) -> dict[str, float]:
    """Median seconds per query; the repeats run round-robin over the queries, so a burst
    of machine noise spreads over all of them instead of shifting one."""
    for fn in fns.values():  # warm-up, as in _timed
        fn()
        fn()
    runs: dict[str, list[float]] = {name: [] for name in fns}
    for _ in range(repeat):
        for name, fn in fns.items():
            t0 = time.perf_counter()
            fn()
            runs[name].append(time.perf_counter() - t0)
    return {name: round(statistics.median(r), 4) for name, r in runs.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "7"))
    spark = get_session(
        f"local[{cpus}]",
        app_name="logtally-bench",
        shuffle_partitions=cpus,
        conf={"spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    timings: dict[str, float] = {}

    # Inputs, written once.
    lines = log_lines(spark, sf_dir).select("line")
    text_dir = scratch_path(spark, "bench-text")
    gz2_dir = scratch_path(spark, "bench-double-gzip")
    t0 = time.perf_counter()
    write_text(lines.repartition(cpus), text_dir)
    n_lines = write_double_gzip(lines, gz2_dir, files=6)
    timings["prepare_inputs"] = round(time.perf_counter() - t0, 4)

    # The store build is timed like the queries (warm-up, then the median of fresh
    # builds); the last store built serves the store queries.
    store_paths: list[str] = []

    def build_store():
        store_paths.append(scratch_path(spark, "bench-store"))
        store.ingest_lines(read_lines(spark, text_dir), store_paths[-1])

    timings["store_build"] = _timed(build_store, 3)
    store_path = store_paths[-1]

    # A store of spread IPs and many statuses: twenty appends, then the same compacted.
    spread, compacted = scratch_path(spark, "bench-spread"), scratch_path(spark, "bench-compacted")
    t0 = time.perf_counter()
    for k in range(APPENDS):
        part = hard_lines(spark, sf_dir).where(f"event_id % {APPENDS} = {k}").select("line")
        store.ingest_lines(part, spread)
    timings["append_spread_each"] = round((time.perf_counter() - t0) / APPENDS, 4)
    t0 = time.perf_counter()
    store.compact(spark, spread, compacted)
    timings["compact_spread"] = round(time.perf_counter() - t0, 4)
    # In place: merging a small append leaves the large run alone.
    first = store_paths[0]
    store.compact(spark, first)
    store.ingest_lines(hard_lines(spark, sf_dir).where("event_id % 1000 = 0").select("line"), first)
    t0 = time.perf_counter()
    store.compact(spark, first)
    timings["compact_small_append"] = round(time.perf_counter() - t0, 4)
    spread_ip = store.read_store(spark, spread).where("ip <> '9.9.9.9'").first().ip

    def store_ip_20_appends():
        return R.ip_total(store.read_store(spark, spread, ip=spread_ip), spread_ip).collect()

    def store_ip_compacted():
        return R.ip_total(store.read_store(spark, compacted, ip=spread_ip), spread_ip).collect()

    def scan_ip():
        raw = prefilter_lines(read_lines(spark, text_dir), IP, "exact")
        return R.status_breakdown(parse(raw, fields=R.REPORT_FIELDS), IP, order="status").collect()

    def scan_global():
        return R.status_breakdown(parse(read_lines(spark, text_dir), fields=R.REPORT_FIELDS)).collect()

    def store_ip():
        records = store.read_store(spark, store_path, ip=IP)
        return R.status_breakdown(records, order="status").collect()

    def store_global():
        return R.status_breakdown(store.read_store(spark, store_path)).collect()

    def scan_double_gzip_global():
        # Six files for eight cores: redistributing the decoded lines costs a shuffle and
        # measured slower here; it pays with far fewer files than cores.
        lines = read_double_gzip(spark, gz2_dir)
        return R.status_breakdown(parse(lines, fields=R.REPORT_FIELDS)).collect()

    def store_top_ip():
        return R.top_ip(store.read_store(spark, store_path)).collect()

    def store_terms_global():
        return R.status_breakdown(store.read_terms(spark, store_path)).collect()

    def store_top_ip_pruned():
        return R.top_ip(store.top_entries(spark, store_path, 1)).collect()

    def scan_status_map():
        return R.status_map(parse(read_lines(spark, text_dir), fields=R.REPORT_FIELDS)).collect()

    headline = {
        "scan_ip": scan_ip,
        "scan_global": scan_global,
        "store_ip": store_ip,
        "store_global": store_global,
    }
    extra = {
        "scan_double_gzip_global": scan_double_gzip_global,
        "store_top_ip": store_top_ip,
        "scan_status_map": scan_status_map,
        "store_ip_20_appends": store_ip_20_appends,
        "store_terms_global": store_terms_global,
        "store_top_ip_pruned": store_top_ip_pruned,
        "store_ip_compacted": store_ip_compacted,
    }
    timings.update(_timed_interleaved({**headline, **extra}, repeat))

    sf_match = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "bandwidth_reports_total",
                "value": round(sum(timings[k] for k in headline), 4),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf_match.group(1)) if sf_match else sf_dir,
                "lines": n_lines,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
