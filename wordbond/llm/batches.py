"""Batches of rows that Spark hands to Python."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROWS = 1000


@contextmanager
def small_batches(spark: SparkSession, rows: int = ROWS) -> Iterator[None]:
    """Hand out texts a thousand at a time in jobs that run inside.

    A batch is held twice, by the executor's JVM and by the Python worker, and ten
    thousand texts are the default. Spark has this as a setting of the session
    only, read when a job is planned, so it is put back at the end.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
