"""Small file-system calls through Hadoop's API, for any store path Spark can write to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path`` (one listing, no recursion); empty if it is missing."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files under ``path``."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def touch(spark: SparkSession, path: str) -> None:
    """Make sure that a file exists."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file; fails if it exists (two writers cannot both create it)."""
    fs, p = _fs(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
