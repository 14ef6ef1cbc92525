"""Runs of rows in sorted Arrow batches, for functions that stream groups of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa


def whole_runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Tables of whole runs, with the (start, end) of each; a run agrees in the first ``n_keys`` columns.

    What is held is one batch and the run that it leaves open.
    """
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        runs = _runs(table, n_keys)
        last = runs.pop()
        if runs:
            yield table, runs
        rest = table.slice(last[0]).combine_chunks()
    if rest is not None:
        yield rest, _runs(rest, n_keys)


def _runs(table: pa.Table, n_keys: int) -> list[tuple[int, int]]:
    keys = list(zip(*[table.column(i).to_pylist() for i in range(n_keys)]))
    cuts = [0] + [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]] + [len(keys)]
    return list(zip(cuts, cuts[1:]))
