"""Row-local affine maps on vector columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from eigenlake.functions.arrow import to_lists, to_matrix
from eigenlake.functions.numeric import EXPRESSION_TERMS, total


def affine(
    vector: Column,
    matrix: np.ndarray,
    *,
    before: np.ndarray | None = None,
    after: np.ndarray | None = None,
) -> Column:
    """``(vector - before) @ matrix + after`` as an ARRAY<DOUBLE> column.

    Small maps are plain arithmetic inside generated code; larger ones are one
    matrix product per Arrow batch. Both are narrow, so they also run on streams.
    """
    weights = np.asarray(matrix, dtype=float)
    rows, cols = weights.shape
    shift = np.zeros(rows) if before is None else np.asarray(before, dtype=float)
    offset = np.zeros(cols) if after is None else np.asarray(after, dtype=float)
    if rows * cols <= EXPRESSION_TERMS:
        centred = [
            vector[i] - F.lit(float(shift[i])) if shift[i] else vector[i] for i in range(rows)
        ]
        outputs = []
        for j in range(cols):
            value = total([centred[i] * F.lit(float(weights[i, j])) for i in range(rows)])
            outputs.append(value + F.lit(float(offset[j])) if offset[j] else value)
        return F.array(*outputs)

    @F.arrow_udf("array<double>")
    def apply(batch: pa.Array) -> pa.Array:
        return to_lists((to_matrix(batch, rows) - shift) @ weights + offset)

    return apply(vector)
