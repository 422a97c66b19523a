"""Session settings and the shared scratch location.

Jobs that must write intermediate files (stores, exported text, test round trips) put
them under the cluster's shared checkpoint folder (``spark.checkpoint.dir``), never in a
machine-local temporary folder. Only when the session names no such folder, as in local
tests, a temporary one is created and registered as the checkpoint directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a session built by this package. A cluster deployment passes its own
# master, memory and shuffle sizing; AQE re-plans partition counts and skewed joins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "logtally",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate data: ``spark.checkpoint.dir`` of the session.

    If it is unset and the session runs in local mode (tests), a temporary folder is
    created and registered with ``setCheckpointDir`` so that ``DataFrame.checkpoint()``
    uses it too. On a cluster a machine-local folder would not be visible to the
    executors, so an unset ``spark.checkpoint.dir`` is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # Spark appends a per-application sub-folder; keep our files next to it.
        return os.path.dirname(current.rstrip("/"))
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder shared by the cluster (e.g. on HDFS or "
            "object storage); logtally writes its intermediate files there"
        )
    local = tempfile.mkdtemp(prefix="logtally-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name under :func:`checkpoint_root` (not created)."""
    return f"{checkpoint_root(spark)}/logtally/{name}-{uuid.uuid4().hex}"
