"""Fitting state that adds up: moments, triangular factors and histograms of parts of a table.

A part is measured once and saved. New files are measured alone and merged with what is saved, and the models of
the whole follow from the merged state without reading the older files again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from eigenlake.operators.clean import MatrixShape, check_matrix
from eigenlake.operators.moments import column_means, triangular_factor
from eigenlake.operators.spectral import SpectralModel, model_of_factor

# Bins of the histograms per doubling of a value: a quantile then errs by 1.1 percent of itself at most.
BINS_PER_DOUBLING = 32


@dataclass(frozen=True)
class Moments:
    """Rows, mean and the triangular factor R of the centred rows (R'R is their co-moment matrix)."""

    rows: int
    mean: np.ndarray
    factor: np.ndarray

    def merged(self, other: "Moments") -> "Moments":
        """The state of both parts together: the factors are stacked with the step between the means, and factored again."""
        if len(self.mean) != len(other.mean):
            raise ValueError(f"Parts of {len(self.mean)} and {len(other.mean)} features do not add up")
        rows = self.rows + other.rows
        step = math.sqrt(self.rows * other.rows / rows) * (other.mean - self.mean)
        factor = np.linalg.qr(np.vstack([self.factor, other.factor, step[None, :]]), mode="r")
        return Moments(rows, self.mean + (other.mean - self.mean) * (other.rows / rows), factor)

    @property
    def deviations(self) -> np.ndarray:
        """Population standard deviation of every feature."""
        return np.sqrt((self.factor**2).sum(axis=0) / self.rows)

    def model(self, method: str, *, n_components: int | None = None, variance_threshold: float | None = 0.95) -> SpectralModel:
        """PCA or SVD of all rows measured so far."""
        return model_of_factor(
            method, self.mean, self.factor, self.rows, n_components=n_components, variance_threshold=variance_threshold
        )

    def save(self, spark: SparkSession, path: str) -> None:
        cells = [("rows", 0, 0, float(self.rows)), *[("mean", 0, i, float(v)) for i, v in enumerate(self.mean)]]
        cells += [("factor", i, j, float(v)) for (i, j), v in np.ndenumerate(self.factor)]
        spark.createDataFrame(cells, "kind string, i int, j int, value double").coalesce(1).write.mode("errorifexists").parquet(path)


def measure(df: DataFrame, column: str = "features", shape: MatrixShape | None = None) -> Moments:
    """The moments of one part; d x d numbers leave the tasks."""
    shape = shape or check_matrix(df, column, min_rows=1)
    mean = column_means(df, column, shape.width)
    return Moments(shape.rows, mean, triangular_factor(df, column, shape.width, mean))


def merge(parts: Sequence[Moments]) -> Moments:
    return reduce(Moments.merged, parts)


def load_moments(spark: SparkSession, path: str) -> Moments:
    cells: dict[str, dict[tuple[int, int], float]] = {"rows": {}, "mean": {}, "factor": {}}
    for row in spark.read.parquet(path).collect():
        cells[row["kind"]][row["i"], row["j"]] = row["value"]
    width = len(cells["mean"])
    if not cells["rows"] or not width or len(cells["factor"]) % width:
        raise ValueError(f"The moments under {path} lack cells")
    mean = np.array([cells["mean"][0, j] for j in range(width)])
    height = len(cells["factor"]) // width
    return Moments(int(cells["rows"][0, 0]), mean, np.array([[cells["factor"][i, j] for j in range(width)] for i in range(height)]))


def histograms(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, bin, n)`` of the finite values: bins by sign and logarithm, the same for every table, so that they add up."""
    cells = []
    for name in features:
        value = F.col(f"`{name}`")
        size = F.floor(F.log2(F.abs(value)) * BINS_PER_DOUBLING).cast("long") + F.lit(1 << 20)
        place = F.when(value > 0, size).when(value < 0, -size).when(value == 0, F.lit(0).cast("long"))
        finite = F.abs(value) < float("inf")
        cells.append(F.struct(F.lit(name).alias("feature"), F.when(finite, place).alias("bin")))
    long = df.select(F.explode(F.array(*cells)).alias("c")).where(F.col("c.bin").isNotNull())
    return long.groupBy("c.feature", "c.bin").agg(F.count(F.lit(1)).alias("n"))


def merge_histograms(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).groupBy("feature", "bin").agg(F.sum("n").alias("n"))


def quantiles(counts: DataFrame, share: float = 0.5) -> dict[str, float]:
    """The value that ``share`` of a feature's values do not exceed, within half a bin of it."""
    found: dict[str, list[tuple[int, int]]] = {}
    for row in counts.collect():
        found.setdefault(row["feature"], []).append((row["bin"], row["n"]))
    out = {}
    for feature, bins in found.items():
        bins.sort()
        places, sizes = zip(*bins, strict=True)
        place = places[int(np.searchsorted(np.cumsum(sizes), share * sum(sizes)))]
        out[feature] = 0.0 if place == 0 else math.copysign(2.0 ** ((abs(place) - (1 << 20) + 0.5) / BINS_PER_DOUBLING), place)
    return out
