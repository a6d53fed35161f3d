"""Moving ARRAY<DOUBLE> columns between Arrow batches and NumPy matrices without row loops."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def to_matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Row-major n x width view of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(len(column), width)


def to_lists(matrix: np.ndarray, value_type: pa.DataType = pa.float64()) -> pa.ListArray:
    """List column holding one row of the matrix per entry."""
    rows, width = matrix.shape
    offsets = pa.array(np.arange(rows + 1) * width, pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).ravel(), value_type))


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The rows of one key after the other, from a partition sorted by whole-number ``keys``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(key).to_numpy() for key in keys])
        cuts = [0, *(np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(a, b - a)
            if held and any(held[0].column(key)[0] != part.column(key)[0] for key in keys):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)
