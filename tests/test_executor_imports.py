"""Python that runs on executors must not need this package installed there.

The double-gzip reader and writer run Python in executor processes. A fresh driver
process is started outside the repository, with the package on the driver's path only
(as when the entry module is loaded by path, or on a cluster without ``--py-files``).
"""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from logtally.session import get_session, scratch_path
from logtally.sources.double_gzip import read_double_gzip, write_double_gzip
spark = get_session("local[2]", shuffle_partitions=2)
lines = spark.createDataFrame([(f"line {{i}}",) for i in range(50)], "line string")
out = scratch_path(spark, "t-exec-imports")
assert write_double_gzip(lines, out, files=2) == 50
got = sorted(r.line for r in read_double_gzip(spark, out).collect())
assert got == sorted(f"line {{i}}" for i in range(50)), got[:3]
print("ROUNDTRIP-OK")
"""


def test_double_gzip_without_package_on_executors():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory() as cwd:
        run = subprocess.run(
            [sys.executable, "-c", SCRIPT], cwd=cwd, env=env,
            capture_output=True, text=True, timeout=300,
        )
    assert "ROUNDTRIP-OK" in run.stdout, run.stderr[-3000:]
