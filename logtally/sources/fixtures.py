"""``log_lines``: access-log lines generated from the ``events`` table.

The test tables carry no web logs, so every report runs on lines that Spark derives from
``events``, one line per event. The rule mixes in junk lines (every 29th event), host
names instead of IPs (every 10th), ``-`` byte counts (every 13th) and short lines
without referer/agent (every 31st). :data:`LOG_LINES_SQL` is the same rule in ANSI SQL
for the DuckDB oracle; both produce identical text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _s(c: Column) -> Column:
    return c.cast("string")


def lines_from_events(events: DataFrame) -> DataFrame:
    """``(event_id bigint, line string)`` for every row of ``events``."""
    eid, uid = F.col("event_id"), F.col("user_id")
    host = F.when(
        eid % 10 == 0, F.concat(F.lit("host"), _s(uid % 50), F.lit(".example.net"))
    ).otherwise(
        F.concat(F.lit("10."), _s(uid % 7), F.lit("."), _s(uid % 11), F.lit("."), _s(uid % 256))
    )
    user = F.when(eid % 3 == 0, F.lit("-")).otherwise(F.concat(F.lit("u"), _s(uid % 20)))
    ts = F.date_format(F.col("ts"), "dd/MMM/yyyy:HH:mm:ss")
    status = (
        F.when(eid % 8 == 0, "404")
        .when(eid % 8 == 1, "304")
        .when(eid % 8 == 2, "301")
        .when(eid % 8 == 3, "500")
        .when(eid % 8 == 4, "206")
        .otherwise("200")
    )
    size = F.when(eid % 13 == 0, F.lit("-")).otherwise(
        _s(F.floor(F.col("value") * 100).cast("bigint"))
    )
    tail = F.when(eid % 31 == 0, F.lit("")).otherwise(
        F.concat(F.lit(' "-" "agent/'), _s(uid % 5), F.lit('"'))
    )
    line = F.when(eid % 29 == 0, F.concat(F.lit("garbage "), _s(eid))).otherwise(
        F.concat(
            host, F.lit(" - "), user, F.lit(" ["), ts, F.lit(' +0000] "GET /'),
            F.col("event_type"), F.lit("/"), _s(eid % 97), F.lit(' HTTP/1.1" '),
            status, F.lit(" "), size, tail,
        )
    )
    return events.select(eid.alias("event_id"), line.alias("line"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, line)`` generated from ``{sf_dir}/events.parquet``."""
    return lines_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


LOG_LINES_SQL = """
SELECT event_id, CASE
 WHEN event_id % 29 = 0 THEN concat('garbage ', event_id)
 ELSE concat(
  CASE WHEN event_id % 10 = 0 THEN concat('host', user_id % 50, '.example.net')
       ELSE concat('10.', user_id % 7, '.', user_id % 11, '.', user_id % 256) END,
  ' - ', CASE WHEN event_id % 3 = 0 THEN '-' ELSE concat('u', user_id % 20) END,
  ' [', strftime(ts, '%d/%b/%Y:%H:%M:%S'), ' +0000] "GET /', event_type, '/', event_id % 97, ' HTTP/1.1" ',
  CASE event_id % 8 WHEN 0 THEN '404' WHEN 1 THEN '304' WHEN 2 THEN '301'
                    WHEN 3 THEN '500' WHEN 4 THEN '206' ELSE '200' END,
  ' ', CASE WHEN event_id % 13 = 0 THEN '-'
            ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END,
  CASE WHEN event_id % 31 = 0 THEN '' ELSE concat(' "-" "agent/', user_id % 5, '"') END)
 END AS line FROM events
"""


def hard_lines_from_events(events: DataFrame) -> DataFrame:
    """``(event_id bigint, line string)``: the same events as lines that strain the reports.

    First octets spread over 1..223, NULL lines (every 43rd event), empty lines (every
    41st), one identical line (half of all others), statuses of any text that the SerDe
    format admits (``-``, none, five digits) and byte counts near 2^62.
    """
    eid, uid = F.col("event_id"), F.col("user_id")
    ip = F.concat(_s(eid % 223 + 1), F.lit("."), _s(uid % 11), F.lit("."), _s(eid % 7), F.lit("."), _s(uid % 256))
    status = (
        F.when(eid % 12 == 1, "-").when(eid % 12 == 3, "").when(eid % 12 == 5, _s(eid % 100000 + 1000)).otherwise("200")
    )
    size = F.when(eid % 12 == 7, _s(F.lit(4611686018427387904) - eid)).otherwise(_s(uid * 1000 + eid % 997))
    tail = F.when(eid % 12 == 9, "").otherwise(' "-" "a"')
    line = (
        F.when(eid % 43 == 0, F.lit(None).cast("string"))
        .when(eid % 41 == 0, "")
        .when(eid % 2 == 0, '9.9.9.9 - - [x] "GET /same HTTP/1.1" 200 1234567 "-" "same"')
        .otherwise(F.concat(ip, F.lit(' - - [x] "GET /x" '), status, F.lit(" "), size, tail))
    )
    return events.select(eid.alias("event_id"), line.alias("line"))


def hard_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, line)`` of :func:`hard_lines_from_events` for ``{sf_dir}/events.parquet``."""
    return hard_lines_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


HARD_LINES_SQL = """
SELECT event_id, CASE
 WHEN event_id % 43 = 0 THEN NULL
 WHEN event_id % 41 = 0 THEN ''
 WHEN event_id % 2 = 0 THEN '9.9.9.9 - - [x] "GET /same HTTP/1.1" 200 1234567 "-" "same"'
 ELSE concat(
  event_id % 223 + 1, '.', user_id % 11, '.', event_id % 7, '.', user_id % 256, ' - - [x] "GET /x" ',
  CASE event_id % 12 WHEN 1 THEN '-' WHEN 3 THEN '' WHEN 5 THEN CAST(event_id % 100000 + 1000 AS VARCHAR)
                     ELSE '200' END,
  ' ', CASE WHEN event_id % 12 = 7 THEN CAST(4611686018427387904 - event_id AS VARCHAR)
            ELSE CAST(user_id * 1000 + event_id % 997 AS VARCHAR) END,
  CASE WHEN event_id % 12 = 9 THEN '' ELSE ' "-" "a"' END)
 END AS line FROM events
"""
