"""The tables behind the figures: distributions, correlations, curves and embedding points."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from eigenlake.functions.arrow import to_matrix
from eigenlake.functions.blocks import sum_partials

# Up to this many features the correlation is one JVM aggregate.
PAIRWISE_FEATURES = 12
GRID_POINTS = 200


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(F.col(f"`{target}`").alias("target")).agg(F.count(F.lit(1)).alias("n"))


def _ranges(df: DataFrame, features: Sequence[str]):
    row = df.agg(
        *[
            F.struct(
                F.min(c).alias("low"),
                F.max(c).alias("high"),
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.when(F.count(c) > 1, F.stddev_samp(c)).alias("spread"),
            ).alias(f"r{i}")
            for i, c in enumerate(F.col(f"`{name}`") for name in features)
        ]
    ).first()
    return [row[f"r{i}"] for i in range(len(features))]


def feature_histograms(
    df: DataFrame, features: Sequence[str], bins: int = 30, max_features: int | None = None
) -> DataFrame:
    """``(feature, bin, low, high, n)`` of all features or the first ``max_features``, missing values dropped.

    Bins have equal width between each feature's minimum and maximum. Counts are combined
    in the tasks, so the shuffle carries features x bins rows per task. Empty bins have n = 0;
    a constant feature has one bin.
    """
    names = list(features)[:max_features]
    if not names:
        raise ValueError("A histogram is of features; none is named")
    ranges = _ranges(df, names)
    cells, grid = [], []
    for name, r in zip(names, ranges):
        if not r["n"]:
            continue
        value, low = F.col(f"`{name}`"), float(r["low"])
        width = (float(r["high"]) - low) / bins
        place = F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(bins - 1)) if width > 0 else F.lit(0)
        cells.append(
            F.struct(F.lit(name).alias("feature"), F.when(value.isNotNull(), place.cast("int")).alias("bin"))
        )
        grid += [(name, b, low + b * width, low + (b + 1) * width) for b in range(bins if width > 0 else 1)]
    schema = "feature string, bin int, low double, high double"
    edges = df.sparkSession.createDataFrame(grid, schema)
    counts = df.select(F.explode(F.array(*cells)).alias("c")).where(F.col("c.bin").isNotNull()) if cells else None
    if counts is None:
        return edges.withColumn("n", F.lit(0).cast("long"))
    counts = counts.groupBy("c.feature", "c.bin").agg(F.count(F.lit(1)).alias("n"))
    return edges.join(counts, ["feature", "bin"], "left").select(
        "feature", "bin", "low", "high", F.coalesce("n", F.lit(0).cast("long")).alias("n")
    )


# Bins per bandwidth, and the highest moment kept of each: the expansion of a kernel then errs by less than 2e-11 of its peak.
BINS_PER_WIDTH, MOMENTS = 4, 8


def feature_density(
    df: DataFrame, features: Sequence[str], points: int = GRID_POINTS, max_features: int | None = None
) -> DataFrame:
    """``(feature, x, density)``: Gaussian kernel density on an even grid over each feature's
    range. Bandwidth by Scott's rule, sample deviation x n^(-1/5). Constant features have no curve.

    Values are counted into bins of a quarter bandwidth with their moments about the bin's centre, by plain
    aggregation. About a centre the kernel is a Hermite series in those moments, so a bin stands for its rows up to an
    error of 1.09 (1/8)^9 / sqrt(9!) < 2e-11 per row, relative to the kernel's peak; only bins meet the grid.
    """
    names = list(features)[:max_features]
    ranges = _ranges(df, names)
    kept = [(n, r) for n, r in zip(names, ranges) if r["spread"]]
    if not kept:
        raise ValueError("No feature varies, so there is no density curve")
    grids = np.array([np.linspace(r["low"], r["high"], points) for _, r in kept])
    widths = np.array([r["spread"] * r["n"] ** -0.2 for _, r in kept])
    cells = []
    for f, (name, r) in enumerate(kept):
        value, step = F.col(f"`{name}`"), F.lit(float(widths[f]) / BINS_PER_WIDTH)
        place = F.floor((value - F.lit(float(r["low"]))) / step)
        centre = F.lit(float(r["low"])) + (place + 0.5) * step
        shift = (value - centre) / F.lit(float(widths[f]))
        cells.append(F.struct(F.lit(f).alias("feature"), place.alias("bin"), centre.alias("centre"), shift.alias("u")))
    long = df.select(F.explode(F.array(*cells)).alias("c")).where(F.col("c.bin").isNotNull()).select("c.*")
    binned = long.groupBy("feature", "bin").agg(
        F.first("centre").alias("centre"), F.array(*[F.sum(F.pow("u", F.lit(p))) for p in range(MOMENTS + 1)]).alias("moments")
    )

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        sums, seen = np.zeros(grids.shape), False
        for batch in batches:
            feature, centre = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            moments = to_matrix(batch.column(2), MOMENTS + 1)
            for f in np.unique(feature).tolist():
                seen, own = True, np.flatnonzero(feature == f)
                for start in range(0, len(own), 4096):
                    some = own[start : start + 4096]
                    t = (grids[f][:, None] - centre[some][None, :]) / widths[f]
                    # Hermite polynomials over factorials, by their recurrence.
                    before, here = np.zeros_like(t), np.exp(-0.5 * t * t)
                    total = here * moments[some, 0]
                    for p in range(1, MOMENTS + 1):
                        before, here = here, (t * here - before) / p
                        total += here * moments[some, p]
                    sums[f] += total.sum(axis=1)
        return sums if seen else None

    summed = sum_partials(binned.select("feature", "centre", "moments"), partial, grids.size).reshape(grids.shape)
    rows = [
        (name, p, float(grids[f, p]), float(summed[f, p] / (r["n"] * widths[f] * np.sqrt(2 * np.pi))))
        for f, (name, r) in enumerate(kept)
        for p in range(points)
    ]
    return df.sparkSession.createDataFrame(rows, "feature string, point int, x double, density double")


def correlation_matrix(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Pearson correlation of raw features over pairwise complete rows:
    ``(feature_a, feature_b, correlation)``, NULL where a side is constant."""
    names = list(features)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    if len(names) <= PAIRWISE_FEATURES:
        values = df.agg(*[_pair_correlation(names[i], names[j]).alias(f"c{p}") for p, (i, j) in enumerate(pairs)]).first()
        found = {pair: values[p] for p, pair in enumerate(pairs)}
    else:
        found = _block_correlation(df, names, pairs)
    rows = [
        (names[a], names[b], found[(min(a, b), max(a, b))]) for a in range(len(names)) for b in range(len(names))
    ]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, correlation double")


def _pair_correlation(a: str, b: str) -> Column:
    x, y = F.col(f"`{a}`"), F.col(f"`{b}`")
    joint_x, joint_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = F.sqrt(F.var_pop(joint_x)) * F.sqrt(F.var_pop(joint_y))
    return F.when(spread > 0, F.try_divide(F.covar_pop(x, y), spread))


def _block_correlation(df: DataFrame, names: list[str], pairs: list[tuple[int, int]]):
    # Pair-complete moments by masked matrix products, after centring on the column means.
    d = len(names)
    means = np.array([r["mean"] if r["n"] else 0.0 for r in _ranges(df, names)], dtype=float)

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        sums, seen = np.zeros((4, d, d)), False
        for batch in batches:
            seen = seen or batch.num_rows > 0
            raw = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(d)]).astype(float)
            mask = (~np.isnan(raw)).astype(float)
            x = np.where(mask > 0, raw - means, 0.0)
            sums += np.stack([x.T @ x, x.T @ mask, (x * x).T @ mask, mask.T @ mask])
        return sums if seen else None

    sums = sum_partials(df.select(*[f"`{n}`" for n in names]), partial, 4 * d * d).reshape(4, d, d)
    product, first, second, count = sums
    n = np.maximum(count, 1.0)
    spread = np.maximum(second / n - (first / n) ** 2, 0.0)
    cov = product / n - (first / n) * (first.T / n)
    scale = np.sqrt(spread * spread.T)
    # Rounding noise in a constant column is not a spread.
    flat = spread <= 1e-14 * np.maximum(second / n, 0.0)
    return {
        (i, j): None if count[i, j] == 0 or flat[i, j] or flat[j, i] or scale[i, j] == 0 else float(cov[i, j] / scale[i, j])
        for i, j in pairs
    }


def variance_curves(spectra: Mapping[str, DataFrame], threshold: float | None) -> DataFrame:
    """``(method, k, cumulative, threshold)``; no threshold when the count was explicit."""
    parts = [
        table.select(
            F.lit(method).alias("method"),
            F.col("component").alias("k"),
            "cumulative",
            F.lit(threshold).cast("double").alias("threshold"),
        )
        for method, table in spectra.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def curves_overlap(left: DataFrame, right: DataFrame, key: str = "k", value: str = "cumulative") -> DataFrame:
    """One row: do two curves have equal length and equal values within rounding, how many points, how far apart?"""
    joined = left.select(key, F.col(value).alias("a")).join(right.select(key, F.col(value).alias("b")), key, "full")
    apart = F.abs(F.col("a") - F.col("b"))
    close = apart <= 1e-12 + 1e-10 * F.abs(F.col("b"))
    return joined.agg(
        F.coalesce(F.bool_and(F.coalesce(close, F.lit(False))), F.lit(False)).alias("overlap"),
        F.count(F.lit(1)).alias("points"),
        F.max(apart).alias("gap"),
        F.sum("a").alias("left_sum"),
        F.sum("b").alias("right_sum"),
    )


def embedding_points(df: DataFrame, dimensions: int, label: str, keep: Sequence[str], column: str = "reduced") -> DataFrame:
    """First two or three coordinates of every row and its label (target, else cluster)."""
    vector = F.col(column)
    wide = F.when(F.size(vector) >= dimensions, vector).otherwise(
        F.raise_error(F.lit(f"Embedding needs at least {dimensions} dimensions"))
    )
    return df.select(
        *[F.col(f"`{name}`") for name in keep],
        *[wide[i].alias(axis) for i, axis in zip(range(dimensions), ("x", "y", "z"))],
        F.col(f"`{label}`").alias("label"),
    )


def loadings_table(components: DataFrame, features: Sequence[str], max_components: int | None = None) -> DataFrame:
    """All components, or the first ``max_components``, x features, signed: one row per component."""
    return (
        components.where(F.lit(True) if max_components is None else F.col("component") <= max_components)
        .groupBy("component")
        .pivot("feature", list(features))
        .agg(F.first("loading"))
    )


def metric_curve(sweep: DataFrame, metric: str) -> DataFrame:
    """One metric across k per representation."""
    return sweep.where(F.col("metric") == metric).select("representation", "k", "value")
