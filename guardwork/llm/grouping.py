"""Groups of successive rows in a stream of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs_of_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 1) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the row where each group starts, and the number of rows.

    Rows must come sorted by the keys (whole numbers without nulls).  Groups are passed on
    together once they have `rows` rows; the last group of a batch waits for the next one.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        whole = pa.Table.from_batches(held).combine_chunks()
        starts = _starts(whole, keys)
        last = int(starts[-1])
        if last:
            yield whole.slice(0, last), np.append(starts[:-1], last)
        held, size = whole.slice(last).to_batches(), whole.num_rows - last
    if held:
        whole = pa.Table.from_batches(held).combine_chunks()
        yield whole, np.append(_starts(whole, keys), whole.num_rows)


def _starts(whole: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(whole.num_rows, bool)
    new[0] = True
    for key in keys:
        values = whole.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)
