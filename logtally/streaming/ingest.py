"""Incremental ingestion: new log files in a folder are parsed and appended to the store.

A Structured Streaming file source picks up new files; every micro-batch is parsed and
written as its own store segment named after the query and the batch id. If a batch is
replayed after a failure (the checkpoint records which batches committed), it rewrites
the folder of the same segment instead of adding a duplicate, so the store receives every
batch exactly once.

The query part of the name is derived from the checkpoint location: a restarted query
keeps it, and two ingest queries feeding one store (each with its own checkpoint) never
write - and so never replace - each other's segments.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import reports
from ..operators.parse import parse
from ..operators.store import ingest_lines
from ..session import checkpoint_root


def stream_lines(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame ``(line)`` over the text files arriving in ``source_dir``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(source_dir).withColumnRenamed("value", "line")


def default_checkpoint(spark: SparkSession, source_dir: str, store_path: str) -> str:
    """The checkpoint folder of the ingest from ``source_dir`` into ``store_path``."""
    pair = "\n".join(p.rstrip("/") for p in (source_dir, store_path))
    return f"{checkpoint_root(spark)}/logtally/ingest-{hashlib.sha256(pair.encode('utf-8')).hexdigest()[:24]}"


def segment_tag(checkpoint: str) -> str:
    """A short, stable name for the ingest query that owns ``checkpoint``."""
    return hashlib.sha256(checkpoint.rstrip("/").encode("utf-8")).hexdigest()[:12]


def ingest(
    spark: SparkSession,
    source_dir: str,
    store_path: str,
    checkpoint: str | None = None,
    dialect: str = "combined",
    on_bad_bytes: str = "drop",
    available_now: bool = False,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the ingestion query; ``available_now`` processes what is there and stops.

    Without ``checkpoint``, its folder under the shared checkpoint folder is derived from
    source and store, so a restarted ingest goes on where it stopped."""
    lines = stream_lines(spark, source_dir, max_files_per_trigger)
    checkpoint = checkpoint or default_checkpoint(spark, source_dir, store_path)
    tag = segment_tag(checkpoint)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        ingest_lines(batch, store_path, dialect, on_bad_bytes, segment=f"q{tag}-b{batch_id:012d}")

    writer = lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def running_status_bytes(lines: DataFrame, on_bad_bytes: str = "drop") -> DataFrame:
    """Bytes per status over a stream of lines, for ``outputMode('complete')``.

    The state is one running sum per status (at most 1000 keys), kept by the streaming
    aggregation in the state store.
    """
    return reports.status_bytes(parse(lines, "combined", on_bad_bytes))
