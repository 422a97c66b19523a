"""Task failures: a writer attempt that dies half-way leaves nothing a reader sees.

A fresh driver with task retries (``local[2,3]``) runs the task-side writer of the
double-gzip sink while the first attempt of every task fails after its first Arrow
batch was already compressed into the file. Spark retries the tasks; the files published by rename must hold every
line exactly once, and the abandoned temporary files (names starting with ``_``) are
skipped by the file listing.
"""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import os, sys
sys.path.insert(0, {REPO!r})
from pyspark import TaskContext
from logtally.session import get_session, scratch_path
from logtally.sources.double_gzip import _write_partition, read_double_gzip

spark = get_session("local[2,3]", shuffle_partitions=2,
                    conf={{"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}})
n = 6000
out = scratch_path(spark, "t-retry")

def flaky_writer(batches):
    # the first attempt of each task dies after one batch went into its file
    attempt = TaskContext.get().attemptNumber()
    def feed():
        for i, batch in enumerate(batches):
            if attempt == 0 and i == 1:
                raise RuntimeError("injected task failure")
            yield batch
    yield from _write_partition(feed(), out_dir=out, line_col="line", level=6)

lines = spark.range(n).selectExpr("concat('line-', id) AS line").repartition(2)
written = lines.mapInPandas(flaky_writer, "path string, lines long").agg({{"lines": "sum"}}).first()[0]
assert written == n, written
names = sorted(os.listdir(out.replace("file:", "")))
got = [r.line for r in read_double_gzip(spark, out).collect()]
assert sorted(got) == sorted(f"line-{{i}}" for i in range(n)), (len(got), names)
assert any(x.startswith("_tmp-") for x in names), names  # the failed attempts did start files
print("RETRY-OK", names)
"""


def test_double_gzip_writer_survives_task_failures():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory() as cwd:
        run = subprocess.run(
            [sys.executable, "-c", SCRIPT], cwd=cwd, env=env,
            capture_output=True, text=True, timeout=300,
        )
    assert "RETRY-OK" in run.stdout, (run.stdout[-2000:], run.stderr[-4000:])
