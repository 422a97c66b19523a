"""Lets Spark find the ``accesslog`` format by itself (packages named ``pyspark_*``)."""

from logtally.sources.accesslog import AccessLogDataSource as DefaultSource

__all__ = ["DefaultSource"]
