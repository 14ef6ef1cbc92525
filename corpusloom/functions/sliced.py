"""Python functions over Arrow columns, one bounded slice at a time.

A pandas function gets a whole batch, 10,000 texts by default, as Python objects; a text cut into words takes some ten times its
own size that way. Here a batch stays in Arrow and only a slice of it is Python objects at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa

SLICE_ROWS = 256


def by_slices(batches: Iterator[pa.Array], of: Callable, kind: pa.DataType) -> Iterator[pa.Array]:
    """``of`` of each value (nulls are ``None``), as an array of ``kind`` for each batch."""
    for batch in batches:
        made = [pa.array(map(of, _slice(batch, at)), kind, size=min(SLICE_ROWS, len(batch) - at)) for at in range(0, len(batch), SLICE_ROWS)]
        yield pa.concat_arrays(made) if made else pa.array([], kind)


def record_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def _slice(batch: pa.Array, at: int) -> list:
    return batch.slice(at, SLICE_ROWS).to_pylist()
