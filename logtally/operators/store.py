"""The parsed-log store: typed records in Parquet, in segments that are merged in tiers.

Layout::

    <path>/segment=<id>/gen=<n>/outcome=records|rejects/part-*.parquet   one append
    <path>/run=<id>/outcome=..|../ip_bucket=<n>/part-*.parquet           segments merged
    <path>/_terms/..                     per segment and run: hits and bytes by (ip, status)
    <path>/_ips/..                       the same by ip, the largest sums first
    <path>/_live/<segment>@<gen>@<bytes>@<statuses>                      published appends
    <path>/_current/<number>.json                                        the runs, what they hold

* An append is one pass: parse, sort within the task by ``(outcome, status, ip)``, write.
  Without a shuffle there is no key that could gather rows in one task, and there are as many
  files as input tasks, whatever the number of statuses and IPs. ``partitions`` deals the raw
  lines out evenly first, for inputs with fewer (unsplittable) files than cores. Lines that
  give no record are written beside the records, with their reason (:func:`read_rejects`).
* **Generations.** Every append of a segment is a folder of its own. An empty file created in
  ``_live`` publishes it once its job has succeeded, so a re-write of a named segment that
  fails leaves the rows as they were, and a reader that has begun goes on reading the
  generation it listed. Of a segment's generations the latest published one counts.
* **Tiers.** ``compact`` merges the segments published since into a run, together with those
  runs that are no larger than ``TIER`` times what is merged so far: a run is re-written only
  when it grows by a fixed factor, so k small appends re-write every byte O(log k) times.
  Rows lie in folders by a hash of the IP (a number of buckets by the run's size) and a
  new pointer file publishes the result; readers and writers go on meanwhile.
* **Lookups** of one IP or a list of them list and read the IPs' buckets of each run, and the
  segments appended since. Files carry min/max statistics of the sorted columns and a bloom
  filter of ``ip``, so pushed filters skip row groups.
* **Terms.** Each segment and run has a small dictionary of its (ip, status) pairs with
  hits and byte sums; :func:`read_terms` answers reports without reading records.
* **Top IPs.** Of the sums by IP, each sorted by bytes, :func:`top_entries` reads only those
  that can matter: if the n-th best IP has at least B bytes in all and there are S
  dictionaries, an IP below B / S in each of them is not among the n best.
* ``vacuum`` deletes what is merged or replaced, and forgets it: pointers and readers
  know only what is still there.

Reads list ``_live`` and read the newest pointer file; Spark gets the folders it needs. One
compaction runs at a time: its pointer file has the next number, and creating it fails if
another one got there first. The small file-system calls need a classic Spark session.
"""

from __future__ import annotations

import json
import re
import time
import uuid
import zlib
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.patterns import FIELDS
from ..sources import hadoop_fs
from .parse import parse_outcomes
from .reports import OPEN_STATUSES, TERM_SUMS, exact_bytes

RECORD = [T.StructField(f, {"status": T.IntegerType(), "bytes": T.LongType()}.get(f, T.StringType())) for f in FIELDS]
TEXTS = [T.StructField(f, T.StringType()) for f in ("line", "reason")]
SEGMENT_SCHEMA = T.StructType([*RECORD, *TEXTS, *(T.StructField(f, T.StringType()) for f in ("segment", "gen", "outcome"))])
RUN_SCHEMA = T.StructType(
    [*RECORD, *TEXTS, *(T.StructField(f, T.StringType()) for f in ("segment", "outcome")), T.StructField("ip_bucket", T.IntegerType())]
)
TERM_SCHEMA = "ip string, status int, hits long, counted long, bytes_p0 long, bytes_p1 long, bytes_p2 long"

IP_BUCKETS = 64  # of a run at least
BUCKET_BYTES = 1 << 32
TIER = 2.0
TASK_BYTES = 1 << 28  # of rows in memory that a task of a compaction sorts, at most on average
LEAST_TASK_BYTES = 1 << 24  # the same where there are more cores than tasks
ROW_BYTES = 160  # of a row in memory besides its texts
IP_SCHEMA = "ip string, top long, hits long, bytes_p0 long, bytes_p1 long, bytes_p2 long"
HEAD = 4  # entries read per asked IP to find a lower bound

POINTERS, LIVE, TERMS, IPS, NAMES = "_current", "_live", "_terms", "_ips", "_names"
GENERATED = r"s\d{20}-[0-9a-f]{8}"
FILE_OPTIONS = {
    "parquet.bloom.filter.enabled#ip": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def ip_bucket(ip: Column, buckets: int) -> Column:
    """The bucket of an IP ('' and NULL share one)."""
    return F.pmod(F.crc32(F.coalesce(ip, F.lit("")).cast("binary")), F.lit(buckets)).cast("int")


def ip_bucket_of(ip: str | None, buckets: int) -> int:
    """:func:`ip_bucket` of one value, computed here."""
    return zlib.crc32((ip or "").encode("utf-8")) % buckets


def new_segment_id() -> str:
    return f"s{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _segment_id(segment: str | None) -> str:
    segment = segment or new_segment_id()
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", segment):
        raise ValueError(f"segment id {segment!r}: use letters, digits, '_', '.', '-'")
    return segment


class Live(NamedTuple):
    """A published generation of a segment that no run holds."""

    gen: str
    size: int
    open: bool  # its statuses may be any numbers, not only those of three digits
    marker: str

    @property
    def rewritten(self) -> bool:
        """Runs may hold an earlier generation, whose rows do not count any more."""
        return not self.gen.startswith("000001-")


class State(NamedTuple):
    """What a store holds: its newest pointer, and the live segments."""

    pointer: dict
    live: dict[str, Live]
    old: list[tuple[str, Live]]  # published generations that are merged or replaced

    def hidden(self, run: dict) -> list[str]:
        """The segments whose rows in ``run`` were replaced since."""
        return sorted({*run["replaced"], *(s for s, g in self.live.items() if g.rewritten)})


def _pointer(spark: SparkSession, path: str) -> dict:
    """The latest pointer: its ``number``, the ``runs``, the ``merged`` generations that are
    not vacuumed yet, and the ``dead`` runs of the same kind."""
    names = hadoop_fs.child_names(spark, f"{path}/{POINTERS}")
    for name in sorted((n for n in names if re.fullmatch(r"\d+\.json", n)), reverse=True):
        try:
            return json.loads(hadoop_fs.read_text(spark, f"{path}/{POINTERS}/{name}"))
        except ValueError:  # being written just now
            continue
    return {"number": 0, "runs": [], "merged": {}, "dead": []}


def _state(spark: SparkSession, path: str) -> State:
    # The markers first: what a compaction merges meanwhile is then seen as merged.
    names = hadoop_fs.child_names(spark, f"{path}/{LIVE}")
    pointer = _pointer(spark, path)
    live, old = {}, []
    for name in sorted(names):  # a segment's generations in ascending order
        segment, gen, size, kind = name.split("@")
        found = Live(gen, int(size), kind == "open", name)
        if gen <= pointer["merged"].get(segment, ""):
            old.append((segment, found))
            continue
        if segment in live:
            old.append((segment, live[segment]))
        live[segment] = found
    return State(pointer, live, old)


def _publish(spark: SparkSession, path: str, pointer: dict) -> None:
    pointer = {**pointer, "number": pointer["number"] + 1}
    name = f"{pointer['number']:010d}.json"
    hadoop_fs.create_text(spark, f"{path}/{POINTERS}/{name}", json.dumps(pointer))


def _name_file(path: str, segment: str) -> str:
    """The file that stands for a merged segment after its folder is gone; looked up by
    name, never listed."""
    return f"{path}/{NAMES}/{zlib.crc32(segment.encode()) % 256:02x}/{segment}"


def _next_gen(spark: SparkSession, path: str, segment: str, named: bool) -> str:
    number = 1
    if named:
        state = _state(spark, path)
        known = [g.gen for s, g in [*state.live.items(), *state.old] if s == segment]
        known += [g for s, g in state.pointer["merged"].items() if s == segment]
        if known:
            number = int(max(known)[:6]) + 1
        elif re.fullmatch(GENERATED, segment) or hadoop_fs.exists(spark, _name_file(path, segment)):
            number = 2  # merged long ago
    return f"{number:06d}-{uuid.uuid4().hex[:8]}"


def _write_segment(rows: DataFrame, path: str, segment: str, named: bool, open_statuses: bool) -> None:
    spark = rows.sparkSession
    gen = _next_gen(spark, path, segment, named)
    folder = f"{path}/segment={segment}/gen={gen}"
    rows.sortWithinPartitions("outcome", "status", "ip").write.options(**FILE_OPTIONS).partitionBy("outcome").parquet(folder)
    written = spark.read.schema(SEGMENT_SCHEMA).option("basePath", path).parquet(folder)
    _write_terms(_terms_of(written), path, f"segment={segment}/gen={gen}")
    kind = "open" if open_statuses else "three"
    marker = f"{segment}@{gen}@{hadoop_fs.size_of(spark, folder)}@{kind}"
    hadoop_fs.create_text(spark, f"{path}/{LIVE}/{marker}", "")


def _store_rows(parsed: DataFrame) -> DataFrame:
    """The nine fields in the store's types. A SerDe status such as ``-`` becomes NULL; a row
    of NULLs stands for a line that did not match, and is no record."""
    typed = {"status": "TRY_CAST(status AS INT) AS status", "bytes": "TRY_CAST(bytes AS BIGINT) AS bytes"}
    record = parsed.where("coalesce(" + ", ".join(f"CAST(`{c}` AS STRING)" for c in FIELDS if c != "bytes") + ") IS NOT NULL")
    none = ["CAST(NULL AS STRING) AS line", "CAST(NULL AS STRING) AS reason"]
    return record.selectExpr(*[typed.get(c, f"`{c}`") for c in FIELDS], *none, "'records' AS outcome")


def append(
    parsed: DataFrame,
    path: str,
    segment: str | None = None,
    partitions: int | None = None,
) -> str:
    """Append typed records (the nine fields) to the store; returns the segment id.

    With ``segment`` given, an existing segment of that id is replaced as a whole
    (idempotent retries) once the new one is written; otherwise a new id is generated.
    """
    named, segment = segment is not None, _segment_id(segment)
    rows = _store_rows(parsed)
    _write_segment(rows.repartition(partitions) if partitions else rows, path, segment, named, True)
    return segment


def ingest_lines(
    lines: DataFrame,
    path: str,
    dialect: str = "combined",
    on_bad_bytes: str | None = "drop",
    segment: str | None = None,
    partitions: int | None = None,
) -> str:
    """Parse raw lines and append the records as one segment; returns the segment id.

    ``lines`` can come from any source (``read_lines``, ``read_double_gzip``, a table); it
    is read and parsed once. Lines that give no record are kept as the segment's rejects
    (:func:`read_rejects`): those that do not match, and under the ``drop`` policy (the
    default) those whose byte count is no integer.
    """
    named, segment = segment is not None, _segment_id(segment)
    dealt = lines.repartition(partitions) if partitions else lines
    rows = parse_outcomes(dealt, dialect, on_bad_bytes)
    _write_segment(rows, path, segment, named, dialect != "combined")
    return segment


def _folders(spark: SparkSession, path: str, state: State) -> DataFrame | None:
    """Rows of the live segments."""
    folders = [f"{path}/segment={s}/gen={g.gen}" for s, g in state.live.items()]
    if not folders:
        return None
    return spark.read.schema(SEGMENT_SCHEMA).option("basePath", path).parquet(*folders).drop("gen")


def _run(spark: SparkSession, path: str, run: dict, ips: list[str] | None, outcome: str) -> DataFrame | None:
    """Rows of a run with their bucket, from the buckets of ``ips`` only, if they are given."""
    base = f"{path}/run={run['id']}"
    folders = [base]
    if ips is not None:
        wanted = {f"ip_bucket={ip_bucket_of(ip, run['buckets'])}" for ip in ips}
        folders = [f"{base}/outcome={outcome}/{n}" for n in hadoop_fs.child_names(spark, f"{base}/outcome={outcome}") if n in wanted]
    return spark.read.schema(RUN_SCHEMA).option("basePath", base).parquet(*folders) if folders else None


def _rows(
    spark: SparkSession, path: str, state: State, runs: list[dict], outcome: str | None,
    ips: list[str] | None = None, keys: DataFrame | None = None,
) -> DataFrame:
    """``(nine fields, line, reason, segment, outcome)`` of the live segments and ``runs``;
    with ``keys``, a table of IPs ``(_ip)``, only its IPs' rows."""
    parts = []
    for run in [None, *runs]:
        part = _folders(spark, path, state) if run is None else _run(spark, path, run, ips, outcome or "records")
        if part is None:
            continue
        if outcome:
            part = part.where(F.col("outcome") == outcome)
        if run and (hidden := state.hidden(run)):
            part = part.where(~F.col("segment").isin(hidden))
        if keys is not None:
            same, wanted = F.col("ip") == F.col("_ip"), keys
            if run:  # dynamic partition pruning chooses the buckets' folders
                wanted = keys.withColumn("_bucket", ip_bucket(F.col("_ip"), run["buckets"]))
                same = same & (F.col("ip_bucket") == F.col("_bucket"))
            part = part.join(wanted, same, "left_semi")
        parts.append(part.drop("ip_bucket"))
    out = parts[0] if parts else spark.createDataFrame([], T.StructType(RUN_SCHEMA.fields[:-1]))
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _is_open(state: State) -> bool:
    return any(g.open for g in state.live.values()) or any(r["open"] for r in state.pointer["runs"])


def read_store(
    spark: SparkSession,
    path: str,
    with_segment: bool = False,
    ip: str | None = None,
    ips: Iterable[str] | DataFrame | None = None,
) -> DataFrame:
    """The records of the store, in field order; filters on ``status`` and ``ip`` are pushed
    into the Parquet scan.

    With ``ip`` or a list ``ips``, only those IPs' records: of the runs only their buckets'
    folders are listed and read. ``ips`` can be a DataFrame with a column ``ip``: a semi join,
    whose keys choose the buckets at run time where Catalyst finds it worth while.
    """
    state = _state(spark, path)
    wanted = [ip] if ip is not None else None if ips is None or isinstance(ips, DataFrame) else sorted(set(ips))
    keys = ips.select(F.col("ip").alias("_ip")) if isinstance(ips, DataFrame) else None
    df = _rows(spark, path, state, state.pointer["runs"], "records", wanted, keys)
    if wanted is not None:
        df = df.where(F.col("ip") == wanted[0] if ip is not None else F.col("ip").isin(wanted))
    df = df.selectExpr(*FIELDS, *(["segment"] if with_segment else []))
    return df.withMetadata("status", {OPEN_STATUSES: True}) if _is_open(state) else df


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``(line, reason, segment)`` of the lines that :func:`ingest_lines` kept no record of."""
    state = _state(spark, path)
    return _rows(spark, path, state, state.pointer["runs"], "rejects").select("line", "reason", "segment")


# Terms.


def _terms_of(rows: DataFrame) -> DataFrame:
    """The dictionary of some rows of the store: one row per (ip, status)."""
    parts = [*TERM_SUMS, "count(1) AS hits", "count(bytes) AS counted"]
    records = rows.where("outcome = 'records'").groupBy("ip", "status").agg(*map(F.expr, parts))
    return records.select("ip", "status", "hits", "counted", "bytes_p0", "bytes_p1", "bytes_p2")


def _merged_terms(terms: DataFrame) -> DataFrame:
    """Dictionaries added up; pairs without hits go, sums of no value are NULL."""
    names = ("hits", "counted", "bytes_p0", "bytes_p1", "bytes_p2")
    sums = terms.groupBy("ip", "status").agg(*(F.sum(n).alias(n) for n in names)).where("hits > 0")
    parts = [F.when(F.col("counted") > 0, F.col(n)).alias(n) for n in names[2:]]
    return sums.select("ip", "status", "hits", "counted", *parts)


def _terms(spark: SparkSession, path: str, state: State, runs: list[dict]) -> DataFrame:
    """The dictionaries of the live segments and ``runs``, less replaced rows of the runs."""
    folders = [f"{path}/{TERMS}/segment={s}/gen={g.gen}" for s, g in state.live.items()]
    folders += [f"{path}/{TERMS}/run={r['id']}" for r in runs]
    if not folders:
        return spark.createDataFrame([], TERM_SCHEMA)
    terms = spark.read.schema(TERM_SCHEMA).parquet(*folders)
    for run in runs:
        if hidden := state.hidden(run):
            gone = _terms_of(_run(spark, path, run, None, "records").where(F.col("segment").isin(hidden)))
            less = [F.col("ip"), F.col("status"), *((-F.col(n)).alias(n) for n in gone.columns[2:])]
            terms = terms.unionByName(gone.select(*less))
    return terms


def _write_terms(terms: DataFrame, path: str, folder: str) -> None:
    """Write a dictionary, and its sums by IP in descending order."""
    spark = terms.sparkSession
    terms.write.parquet(f"{path}/{TERMS}/{folder}")
    written = spark.read.schema(TERM_SCHEMA).parquet(f"{path}/{TERMS}/{folder}").where("ip <> ''")
    parts = ("hits", "bytes_p0", "bytes_p1", "bytes_p2")
    sums = written.groupBy("ip").agg(*(F.sum(c).alias(c) for c in parts))
    top = f"CAST(coalesce(least({exact_bytes('bytes')}, {2**63 - 1}BD), 0BD) AS BIGINT) AS top"
    ranked = sums.selectExpr("ip", top, *parts).repartitionByRange(F.desc("top")).sortWithinPartitions(F.desc("top"))
    ranked.write.parquet(f"{path}/{IPS}/{folder}")


def top_entries(spark: SparkSession, path: str, n: int) -> DataFrame:
    """Rows ``(ip, hits, bytes_p0 .. p2)`` of every IP that can be among the ``n`` with the
    most bytes, for :func:`logtally.operators.reports.top_ips` and ``top_ip``.

    Three steps over the sums by IP: the largest entries of all dictionaries give a lower
    bound of the n-th best IP's bytes; entries of at least that bound divided by the number
    of dictionaries name the candidates (a pushed filter on sorted files); the candidates'
    entries are read whole. IPs that have less in every dictionary sum up to less than the
    bound. Where rows of a run were replaced since, or some sum is negative, bounds do not
    hold, and all terms are read.
    """
    state = _state(spark, path)
    runs = state.pointer["runs"]
    folders = [f"segment={s}/gen={g.gen}" for s, g in state.live.items()] + [f"run={r['id']}" for r in runs]
    if not folders or any(state.hidden(r) for r in runs):
        return read_terms(spark, path)
    entries = spark.read.schema(IP_SCHEMA).parquet(*(f"{path}/{IPS}/{f}" for f in folders))
    least = entries.agg(F.min("top")).first()[0]  # from the files' statistics or one column
    if least is not None and least < 0:
        return read_terms(spark, path)
    head = entries.select("ip", F.col("top").cast("decimal(38,0)").alias("top")).orderBy(F.desc("top")).limit(HEAD * n)
    known = head.groupBy("ip").agg(F.sum("top").alias("bytes")).orderBy(F.desc("bytes")).limit(n).collect()
    bound = int(known[-1]["bytes"]) if n and len(known) == n else 0
    wanted = entries.where(F.col("top") >= min(bound // len(folders), 2**63 - 1)).select("ip").distinct()
    return entries.drop("top").join(wanted, "ip", "left_semi")


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """``(ip, status, hits, counted, bytes_p0 .. p2)``: one row per pair of the whole store. The
    reports that group by IP or status take it in place of records.

    Only dictionaries are read, but for rows of runs whose segment was written again since
    they were merged: these are read and subtracted until the next compaction.
    """
    state = _state(spark, path)
    terms = _merged_terms(_terms(spark, path, state, state.pointer["runs"]))
    return terms.withMetadata("status", {OPEN_STATUSES: True}) if _is_open(state) else terms


# Compaction.


def _tier(state: State) -> list[dict]:
    """The runs to merge with the live segments: those no larger than ``TIER`` times what is
    merged so far, from the smallest up."""
    size, chosen = sum(g.size for g in state.live.values()), []
    for run in sorted(state.pointer["runs"], key=lambda r: r["bytes"]):
        if run["bytes"] > TIER * size:
            break
        size += run["bytes"]
        chosen.append(run)
    return chosen


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows with ``outcome`` and ``ip_bucket`` dealt to tasks that hold about equal bytes in memory,
    neighbouring buckets together and large ones in several tasks.

    Sizes of shuffled blocks say little here: equal lines shrink a hundredfold in them. So
    the rows' own bytes are added up by bucket first. A row's place in its bucket comes from
    its place in the input, so neither a hot IP nor one repeated line is a key.
    """
    spark = rows.sparkSession
    texts = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType)]
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(ROW_BYTES)).cast("long")
    sizes = rows.groupBy("outcome", "ip_bucket").agg(F.sum(size).alias("held"))
    groups, before = [], 0
    for outcome, bucket, held in sorted(map(tuple, sizes.collect())):  # at most two rows a bucket
        groups.append((outcome, bucket, before, held))
        before += held
    most = min(TASK_BYTES, max(LEAST_TASK_BYTES, before // spark.sparkContext.defaultParallelism))
    tasks = max(1, -(-before // most))
    places = spark.createDataFrame(groups, "outcome string, ip_bucket int, before long, held long")
    # Drawn before the join, so that it follows the rows as they are read.
    placed = rows.withColumn("_drawn", F.rand(0)).join(F.broadcast(places), ["outcome", "ip_bucket"], "left")
    task = F.floor((F.col("before") + F.col("_drawn") * F.col("held")) / F.lit(before / tasks if before else 1.0))
    task = F.least(F.coalesce(task, F.lit(0)), F.lit(tasks - 1)).cast("int")
    return placed.withColumn("_task", task).repartitionById(tasks, "_task").select(*rows.columns)


def compact(
    spark: SparkSession, path: str, target: str | None = None, buckets: int | None = None, full: bool = False
) -> str | None:
    """Merge the live segments, and the runs of their tier, into one run; returns its id
    (None if there is nothing to merge).

    In place, or all of them into the store at ``target``; ``full`` merges every run. Rows keep
    their segment's name. Tasks get about ``TASK_BYTES`` of rows in memory each, parts of a
    large bucket (a hot IP) or several small ones, so neither files nor the memory of a sort
    follow the buckets.
    """
    state = _state(spark, path)
    pointer, out = state.pointer, target or path
    if target and _pointer(spark, target)["runs"]:
        raise ValueError(f"{target} has compacted records already; compact into a new store")
    chosen = pointer["runs"] if full or target else _tier(state)
    if not target and not state.live and len(chosen) < 2:
        return None
    size = sum(g.size for g in state.live.values()) + sum(r["bytes"] for r in chosen)
    buckets = buckets or max(IP_BUCKETS, 1 << (size // BUCKET_BYTES).bit_length())
    name = new_segment_id()
    rows = _rows(spark, path, state, chosen, None)
    key = F.when(F.col("outcome") == "records", F.col("ip")).otherwise(F.col("line"))
    rows = _dealt(rows.withColumn("ip_bucket", ip_bucket(key, buckets)))
    folder, order = f"{out}/run={name}", ("outcome", "ip_bucket", "ip", "status")
    rows.sortWithinPartitions(*order).write.options(**FILE_OPTIONS).partitionBy(*order[:2]).parquet(folder)
    _write_terms(_merged_terms(_terms(spark, path, state, chosen)), out, f"run={name}")
    is_open = any(g.open for g in state.live.values()) or any(r["open"] for r in chosen)
    run = {"id": name, "buckets": buckets, "bytes": hadoop_fs.size_of(spark, folder), "replaced": [], "open": is_open}
    if target:
        _publish(spark, target, {**_pointer(spark, target), "runs": [run]})
        return name
    # What stays keeps in mind which of its segments have newer rows elsewhere.
    again = {s for s, g in state.live.items() if g.rewritten}
    gone = {r["id"] for r in chosen}
    kept = [{**r, "replaced": sorted({*r["replaced"], *again})} for r in pointer["runs"] if r["id"] not in gone]
    merged = {**pointer["merged"], **{s: g.gen for s, g in state.live.items()}}
    _publish(spark, path, {**pointer, "runs": [*kept, run], "merged": merged, "dead": sorted({*pointer["dead"], *gone})})
    return name


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete the generations and runs that compactions or re-writes have replaced, and the
    pointers before the newest; returns the deleted folders. Run it when no query started
    before the last compaction is still reading. What a failed append left behind, which
    was never published, stays until :func:`sweep`."""
    state = _state(spark, path)
    deleted = []
    for segment, gen in state.old:
        folder = f"segment={segment}/gen={gen.gen}"
        if segment in state.pointer["merged"] and not re.fullmatch(GENERATED, segment):
            hadoop_fs.touch(spark, _name_file(path, segment))
        _forget(spark, path, folder)
        hadoop_fs.delete(spark, f"{path}/{LIVE}/{gen.marker}")
        if segment not in state.live:
            hadoop_fs.delete(spark, f"{path}/segment={segment}")
            for kept in (TERMS, IPS):
                hadoop_fs.delete(spark, f"{path}/{kept}/segment={segment}")
        deleted.append(folder)
    for run in state.pointer["dead"]:
        _forget(spark, path, f"run={run}")
        deleted.append(f"run={run}")
    if deleted and state.pointer["number"]:
        # A live segment's merged generation is kept in mind: its next one has a higher number.
        merged = {s: g for s, g in state.pointer["merged"].items() if s in state.live}
        _publish(spark, path, {**state.pointer, "merged": merged, "dead": []})
    names = hadoop_fs.child_names(spark, f"{path}/{POINTERS}")
    for name in names[:-1]:
        hadoop_fs.delete(spark, f"{path}/{POINTERS}/{name}")
    return deleted


def _forget(spark: SparkSession, path: str, folder: str) -> None:
    for place in (folder, f"{TERMS}/{folder}", f"{IPS}/{folder}"):
        hadoop_fs.delete(spark, f"{path}/{place}")


def sweep(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders of appends and compactions that were never published (their job
    failed); returns them. Run it when nothing is being written."""
    state = _state(spark, path)
    known = {f"segment={s}/gen={g.gen}" for s, g in [*state.live.items(), *state.old]}
    known |= {f"run={r}" for r in [*(r["id"] for r in state.pointer["runs"]), *state.pointer["dead"]]}
    found = []
    for name in hadoop_fs.child_names(spark, path):
        if name.startswith("segment="):
            found += [f"{name}/{gen}" for gen in hadoop_fs.child_names(spark, f"{path}/{name}")]
        elif name.startswith("run="):
            found.append(name)
    left = [f for f in found if f not in known]
    for folder in left:
        _forget(spark, path, folder)
    return left
