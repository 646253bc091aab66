"""Session settings of the subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from shelfcast.session import tune

BATCH_ROWS = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepared(spark: SparkSession) -> SparkSession:
    """The library's options, and Arrow batches small enough for whole texts. Results do not depend on either."""
    spark.conf.set(_ROWS, BATCH_ROWS)
    return tune(spark)


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows for what runs inside, where rows are much larger than a text."""
    kept = spark.conf.get(_ROWS)
    spark.conf.set(_ROWS, rows)
    try:
        yield
    finally:
        spark.conf.set(_ROWS, kept)
