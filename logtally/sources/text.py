"""Plain and gzip text sources: one row per line.

``spark.read.text`` handles directories, globs and lists of paths (the union of all
input files), splits uncompressed files into blocks, and decompresses single-layer
``.gz`` files (one task per file, since gzip cannot be split). Files wrapped in gzip
twice need :mod:`logtally.sources.double_gzip`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    with_path: bool = False,
    recursive: bool = False,
    glob: str | None = None,
) -> DataFrame:
    """``(line string[, path string])`` for every line of the given files or folders."""
    reader = spark.read.format("text")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(paths if isinstance(paths, str) else list(paths))
    if with_path:
        return df.selectExpr("value AS line", "_metadata.file_path AS path")
    return df.withColumnRenamed("value", "line")
