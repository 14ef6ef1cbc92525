"""Arrow batches in slices, for functions that turn texts into columns one bounded slice at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import SparkSession

SLICE_ROWS = 256


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows, so that what is held besides a batch stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 4 * SLICE_ROWS) -> Iterator[None]:
    """Jobs run inside send batches of ``rows`` rows to Python: whole texts of the usual 10,000 take room outside the heap."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
