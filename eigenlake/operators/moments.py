"""Mean vector, centred covariance and the triangular factor of a matrix frame."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from eigenlake.functions.arrow import to_lists, to_matrix
from eigenlake.functions.blocks import sum_partials

# Up to this width the covariance is one JVM aggregate of covar_samp pairs.
PAIRWISE_WIDTH = 12
REDUCE_TASKS = 64
FINAL_BLOCKS = 8


def column_means(df: DataFrame, column: str, width: int) -> np.ndarray:
    """Mean vector in one aggregate."""
    if width <= PAIRWISE_WIDTH:
        row = df.agg(*[F.avg(F.col(column)[i]) for i in range(width)]).first()
        return np.array(row, dtype=float)
    row = df.select(Summarizer.mean(array_to_vector(F.col(column))).alias("m")).first()
    return row["m"].toArray()


def covariance(df: DataFrame, column: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, sample covariance). Narrow matrices: one pass with stable co-moments in the
    JVM. Wider ones: a mean pass, then a centred Gram block per task, summed by cell."""
    vector = F.col(column)
    if width <= PAIRWISE_WIDTH:
        pairs = [(i, j) for i in range(width) for j in range(i, width)]
        row = df.agg(
            *[F.avg(vector[i]) for i in range(width)],
            *[F.covar_samp(vector[i], vector[j]) for i, j in pairs],
        ).first()
        matrix = np.zeros((width, width))
        for (i, j), value in zip(pairs, row[width:]):
            matrix[i, j] = matrix[j, i] = value
        return np.array(row[:width], dtype=float), matrix
    mean = column_means(df, column, width)

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        block, rows = np.zeros((width, width)), 0
        for batch in batches:
            values = to_matrix(batch.column(0), width) - mean
            block += values.T @ values
            rows += len(values)
        return np.append(block.ravel(), float(rows)) if rows else None

    sums = sum_partials(df.select(column), partial, width * width + 1)
    return mean, sums[:-1].reshape(width, width) / (sums[-1] - 1)


def gram_cells(df: DataFrame, width: int, mean: np.ndarray | None = None) -> DataFrame:
    """``(i, j, value)`` cells, i <= j, of the (centred) Gram matrix of a one-column frame;
    the cell (-1, -1) is the row count. Each task sends width^2 / 2 partial cells."""
    centre = np.zeros(width) if mean is None else np.asarray(mean, dtype=float)
    upper_i, upper_j = np.triu_indices(width)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows = np.zeros((width, width)), 0
        for batch in batches:
            values = to_matrix(batch.column(0), width) - centre
            block += values.T @ values
            rows += len(values)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(upper_i, -1), pa.int32()),
                    pa.array(np.append(upper_j, -1), pa.int32()),
                    pa.array(np.append(block[upper_i, upper_j], float(rows))),
                ],
                names=["i", "j", "value"],
            )

    cells = df.mapInArrow(partial, "i int, j int, value double")
    return cells.groupBy("i", "j").agg(F.sum("value").alias("value"))


def triangular_factor(
    df: DataFrame, column: str, width: int, mean: np.ndarray | None = None
) -> np.ndarray:
    """R of the QR factorisation of the (centred) matrix.

    Every task folds its rows into one width x width block, blocks are folded again in
    ever fewer tasks, and the driver stacks at most FINAL_BLOCKS of them. Memory per task
    stays at a few blocks whatever the row count.
    """
    first = np.zeros(width) if mean is None else np.asarray(mean, dtype=float)
    blocks = df.select(F.col(column).alias("r")).mapInArrow(_folder(width, first), "r array<double>")
    fold = _folder(width, np.zeros(width))
    if int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) > REDUCE_TASKS:
        blocks = blocks.repartition(REDUCE_TASKS).mapInArrow(fold, "r array<double>")
    blocks = blocks.repartition(FINAL_BLOCKS).mapInArrow(fold, "r array<double>")
    stacked = np.array([row["r"] for row in blocks.collect()], dtype=float).reshape(-1, width)
    return np.linalg.qr(stacked, mode="r")


def _folder(width: int, centre: np.ndarray):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = np.empty((0, width))
        for batch in batches:
            if batch.num_rows:
                rows = to_matrix(batch.column(0), width) - centre
                factor = np.linalg.qr(np.vstack([factor, rows]), mode="r")
        if len(factor):
            yield pa.RecordBatch.from_arrays([to_lists(factor)], names=["r"])

    return fold
