"""Reports as Spark SQL over a registered view of SerDe-parsed records.

The Hive report sums the byte column, which is text in the SerDe view, so it is read as
a double (a value like ``-`` counts as NULL), and divides each status sum by the grand
total. The grand total is a scalar subquery over the grouped rows of the same CTE: Spark
runs it first and uses its single value as a constant, and both references to the CTE
share one shuffle (``ReusedExchange``), so the raw lines are scanned once and no join is
needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STATUS_SHARE_SQL = """
WITH grouped AS (
  SELECT status, sum(try_cast(bytes AS DOUBLE)) AS bytes
  FROM {view}
  GROUP BY status
)
SELECT status, bytes, 100 * (bytes / (SELECT sum(bytes) FROM grouped)) AS pct
FROM grouped
"""


def status_share_sql(spark: SparkSession, view: str) -> DataFrame:
    """``(status string, bytes double, pct double)`` over a SerDe view, via ``spark.sql``."""
    return spark.sql(STATUS_SHARE_SQL.format(view=view))
