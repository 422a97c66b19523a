"""Connected components of a link table, by contraction.

Every node points to its smallest neighbour if that is smaller than itself, pointers are
followed to their roots by doubling, and the links are rewritten between roots. At least
half of the linked nodes go in each round, so rounds and doublings are logarithmic. All
of it is joins and partial aggregates; a node with very many links is a skewed join key,
which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.llm.common import reliable


def _roots(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (a, b): the end of its pointers."""
    both = links.union(links.select("b", "a"))
    to = reliable(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("root")
    ))
    while True:
        hop = to.select(F.col("node").alias("n2"), F.col("root").alias("r2"))
        step = reliable(to.join(hop, F.col("root") == F.col("n2")).select("node", "root", "r2"))
        moved = not step.where("root <> r2").isEmpty()
        to = step.select("node", F.col("r2").alias("root"))
        if not moved:
            return to


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (columns a, b, no nulls)."""
    links = reliable(links.toDF("a", "b").where("a <> b").distinct())
    found = links.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    first = True
    while not links.isEmpty():
        roots = _roots(links)
        if first:
            found, first = roots.withColumnRenamed("root", "component"), False
        else:
            step = roots.select(F.col("node").alias("n2"), "root")
            found = reliable(
                found.join(step, F.col("component") == F.col("n2"), "left").select(
                    "node", F.coalesce("root", "component").alias("component")
                )
            )
        ra = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        rb = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        links = reliable(
            links.join(ra, "a").join(rb, "b").where("ra <> rb").select(
                F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")
            ).distinct()
        )
    return found
