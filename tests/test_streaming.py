"""Incremental ingestion with Structured Streaming."""

from logtally.operators import store
from logtally.operators.sinks import write_text
from logtally.session import scratch_path
from logtally.streaming.ingest import ingest, running_status_bytes, stream_lines

LINES = [
    '1.1.1.1 - - [x] "G /a" 200 10 "-" "a"',
    '2.2.2.2 - - [x] "G /b" 404 5 "-" "a"',
    '1.1.1.1 - - [x] "G /c" 304 - "-" "a"',
]


def test_ingest_new_files_once(spark, lines_df):
    landing = scratch_path(spark, "t-landing")
    write_text(lines_df(LINES), f"{landing}/a")
    path = scratch_path(spark, "t-stream-store")
    checkpoint = scratch_path(spark, "t-stream-ckpt")
    ingest(spark, f"{landing}/*", path, checkpoint=checkpoint, available_now=True).awaitTermination()
    assert store.read_store(spark, path).count() == 2
    # a second run with the same checkpoint only takes the new file
    write_text(lines_df(LINES[:1]), f"{landing}/b")
    ingest(spark, f"{landing}/*", path, checkpoint=checkpoint, available_now=True).awaitTermination()
    records = store.read_store(spark, path, with_segment=True)
    assert records.count() == 3
    assert records.select("segment").distinct().count() == 2


def test_two_streams_into_one_store(spark, lines_df):
    """Separate ingest queries (own checkpoints) never replace each other's segments."""
    path = scratch_path(spark, "t-shared-store")
    other = '3.3.3.3 - - [x] "G /d" 200 7 "-" "a"'  # same status folder as LINES[0]
    for name, lines in (("x", LINES[:1]), ("y", [other])):
        landing = scratch_path(spark, f"t-landing-{name}")
        write_text(lines_df(lines), landing)
        checkpoint = scratch_path(spark, f"t-ckpt-{name}")
        ingest(spark, landing, path, checkpoint=checkpoint, available_now=True).awaitTermination()
    records = store.read_store(spark, path, with_segment=True)
    assert sorted(r.ip for r in records.collect()) == ["1.1.1.1", "3.3.3.3"]
    assert records.select("segment").distinct().count() == 2


def test_running_status_bytes(spark, lines_df):
    landing = scratch_path(spark, "t-landing2")
    write_text(lines_df(LINES), landing)
    query = (
        running_status_bytes(stream_lines(spark, landing))
        .writeStream.outputMode("complete").format("memory").queryName("logtally_running")
        .trigger(availableNow=True)
        .option("checkpointLocation", scratch_path(spark, "t-running-ckpt"))
        .start()
    )
    query.awaitTermination()
    got = {r.status: r.bytes for r in spark.sql("SELECT * FROM logtally_running").collect()}
    assert got == {200: 10, 404: 5}


def test_restart_without_checkpoint_adds_nothing(spark, lines_df):
    landing, path = scratch_path(spark, "t-landing3"), scratch_path(spark, "t-stream-store3")
    write_text(lines_df(LINES), landing)
    for _ in range(2):
        ingest(spark, landing, path, available_now=True).awaitTermination()
    assert store.read_store(spark, path).count() == 2
