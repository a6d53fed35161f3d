"""Leading directions of very wide tables by a block Krylov range finder, without any matrix of width x width.

A pass multiplies a narrow block of directions by the centred rows and back; the blocks span the space in which the leading
directions lie (after Musco and Musco, 2015). The rows' coordinates in that space are narrow, and the
triangular factor of these gives singular values without squaring them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from eigenlake.functions.arrow import to_lists, to_matrix
from eigenlake.functions.blocks import sum_partials, tiles
from eigenlake.operators.moments import triangular_factor
from eigenlake.operators.spectral import orient

# Directions of a block beyond those wanted, and cells of a product of sparse rows made at once.
EXTRA = 10
SPARSE_CELLS = 1 << 22


@dataclass(frozen=True)
class Leading:
    """The leading directions (rows of ``basis``), their variances and the share of all variance they carry."""

    rows: int
    mean: np.ndarray
    basis: np.ndarray
    singular_values: np.ndarray
    ratio: np.ndarray
    passes: int

    @property
    def variance(self) -> np.ndarray:
        return self.singular_values**2 / (self.rows - 1)

    def transform(self, df: DataFrame, column: str = "features", output: str = "reduced") -> DataFrame:
        """Coordinates of dense or sparse rows in the directions."""
        return _projected(df, column, self.mean, self.basis.T, output, list(df.columns))


def fit_leading(
    df: DataFrame, count: int, width: int, column: str = "features", *, most_passes: int = 12, tol: float = 1e-10, seed: int = 42
) -> Leading:
    """The ``count`` leading directions of the centred rows of a staged frame.

    Rows are ``ARRAY<DOUBLE>`` of ``width`` values or sparse, ``STRUCT<indices ARRAY<INT>, values ARRAY<DOUBLE>>``. Passes end when the leading
    values change by less than ``tol`` of themselves, or the blocks span all ``width`` directions. Tasks and driver hold width x
    (count + 10) numbers per pass, the driver those of all passes.
    """
    if not 1 <= count <= width:
        raise ValueError(f"{count} directions wanted of {width}")
    sums = sum_partials(df.select(column), _totals(width), width + 2)
    rows, mean = int(sums[-2]), sums[:width] / max(1.0, sums[-2])
    if count >= rows:
        raise ValueError(f"{count} directions wanted of {rows} centred rows")
    spread = float(sums[-1] - rows * (mean @ mean))
    if spread <= 0.0:
        raise ValueError("The rows do not vary")
    size = min(width, count + EXTRA)
    block = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, size)))[0]
    space, images, before = block, np.zeros((width, 0)), None
    passes = 0
    while True:
        images = np.hstack([images, _back_and_forth(df, column, mean, block)])
        passes += 1
        # Rayleigh quotients in the space so far.
        values = np.linalg.eigvalsh((space.T @ images + images.T @ space) / 2)[::-1][:count]
        settled = before is not None and np.abs(values - before).max() <= tol * max(values[0], 1e-300)
        room = width - space.shape[1]
        if settled or passes >= most_passes or not room:
            break
        before = values
        rest = images[:, -block.shape[1] :]
        for _ in range(2):
            rest = rest - space @ (space.T @ rest)
        fresh, factor = np.linalg.qr(rest)
        alive = np.abs(np.diag(factor)) > 1e-12 * max(values[0], 1e-300)
        block = fresh[:, alive][:, :room]
        if not block.shape[1]:
            break
        # Directions of rounding noise may lean on the space; they are taken out once more.
        block = np.linalg.qr(block - space @ (space.T @ block))[0]
        space = np.hstack([space, block])
    narrow = _projected(df, column, mean, space, "narrow", [])
    _, sigma, turned = np.linalg.svd(triangular_factor(narrow, "narrow", space.shape[1]), full_matrices=False)
    basis = orient((space @ turned[:count].T).T)
    return Leading(rows, mean, basis, sigma[:count], sigma[:count] ** 2 / spread, passes)


class _Rows:
    """Rows of a batch, dense or sparse, and their products with narrow matrices."""

    def __init__(self, column: pa.Array, width: int) -> None:
        self.width, self.count = width, len(column)
        self.dense = None
        if not pa.types.is_struct(column.type):
            self.dense = to_matrix(column, width)
            return
        places, values = column.field("indices"), column.field("values")
        self.values = values.flatten().to_numpy(zero_copy_only=False).astype(float)
        self.places = places.flatten().to_numpy(zero_copy_only=False)
        sizes = np.diff(places.offsets.to_numpy())
        self.row = np.repeat(np.arange(self.count), sizes)
        if len(self.places) and not 0 <= self.places.min() <= self.places.max() < width:
            raise ValueError(f"An index lies outside 0..{width - 1}")

    def totals(self) -> np.ndarray:
        if self.dense is not None:
            return np.concatenate([self.dense.sum(axis=0), [self.count, (self.dense**2).sum()]])
        return np.concatenate([np.bincount(self.places, self.values, self.width), [self.count, (self.values**2).sum()]])

    def times(self, matrix: np.ndarray) -> np.ndarray:
        if self.dense is not None:
            return self.dense @ matrix
        out = np.zeros((self.count, matrix.shape[1]))
        for part in tiles(len(self.values), max(1, matrix.shape[1] * (1 << 21) // SPARSE_CELLS)):
            _add_rows(out, self.row[part], matrix[self.places[part]] * self.values[part, None])
        return out

    def add_transposed(self, out: np.ndarray, matrix: np.ndarray) -> None:
        """``out += rows' @ matrix``"""
        if self.dense is not None:
            out += self.dense.T @ matrix
            return
        order = np.argsort(self.places, kind="stable")
        for part in tiles(len(order), max(1, matrix.shape[1] * (1 << 21) // SPARSE_CELLS)):
            some = order[part]
            _add_rows(out, self.places[some], matrix[self.row[some]] * self.values[some, None])


def _add_rows(out: np.ndarray, place: np.ndarray, values: np.ndarray) -> None:
    """Add rows to the places of ``out``, which ascend."""
    if len(place):
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        out[place[first]] += np.add.reduceat(values, first, axis=0)


def _totals(width: int):
    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        sums, seen = np.zeros(width + 2), False
        for batch in batches:
            if batch.num_rows:
                sums, seen = sums + _Rows(batch.column(0), width).totals(), True
        return sums if seen else None

    return partial


def _back_and_forth(df: DataFrame, column: str, mean: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Centred rows times the block, and their transpose times that: one pass."""
    width, size = block.shape
    shared = df.sparkSession.sparkContext.broadcast((mean, block))

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        mean, block = shared.value
        out, lean, shift, seen = np.zeros((width, size)), np.zeros(size), mean @ block, False
        for batch in batches:
            if batch.num_rows:
                rows = _Rows(batch.column(0), width)
                product = rows.times(block) - shift
                rows.add_transposed(out, product)
                lean += product.sum(axis=0)
                seen = True
        return np.concatenate([out.ravel(), lean]) if seen else None

    flat = sum_partials(df.select(column), partial, width * size + size)
    shared.unpersist()
    return flat[:-size].reshape(width, size) - np.outer(mean, flat[-size:])


def _projected(df: DataFrame, column: str, mean: np.ndarray, matrix: np.ndarray, output: str, keep: list[str]) -> DataFrame:
    """``keep`` and the centred rows times a narrow matrix."""
    shared, width = df.sparkSession.sparkContext.broadcast((mean @ matrix, matrix)), len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, matrix = shared.value
        for batch in batches:
            if batch.num_rows:
                found = to_lists(_Rows(batch.column(len(keep)), width).times(matrix) - shift)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], found], names=[*keep, output])

    schema = StructType([df.schema[name] for name in keep]).add(output, ArrayType(DoubleType()))
    return df.select(*[f"`{name}`" for name in keep], F.col(column).alias("__rows")).mapInArrow(run, schema)
