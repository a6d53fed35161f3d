"""Low-rank denoising of many time series ``(series_id, t, value)`` at once."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from eigenlake.functions.numeric import is_finite
from eigenlake.session import small_side, stage

# Fixed value: the longest default window.
DEFAULT_WINDOW = 200
# Window starts per task group; a long series is cut into this many starts plus an overlap.
BLOCK_STARTS = 20_000

KEYS = ["series_id", "block"]


def check_series(series: DataFrame, rank: int | None = None, window: int | None = None) -> DataFrame:
    """Validate all series in one pass; returns ``(series_id, n, first_t, window)``.

    ``t`` must be a gap-free integer step per series (see ``index_series``).
    """
    sizes = series.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("t").alias("first_t"),
        F.max("t").alias("last_t"),
        F.count(F.when(~F.coalesce(is_finite(F.col("value")), F.lit(False)), 1)).alias("bad"),
    )
    length = F.least(F.floor(F.col("n") / 2), F.lit(DEFAULT_WINDOW)) if window is None else F.lit(int(window))
    sizes = stage(sizes.withColumn("window", length.cast("int")), "sizes")
    limit = F.least(F.col("window"), F.col("n") - F.col("window") + 1)
    found = sizes.agg(
        F.min("n").alias("short"),
        F.sum("bad").alias("bad"),
        F.max(F.col("last_t") - F.col("first_t") + 1 - F.col("n")).alias("gaps"),
        F.min("window").alias("low"),
        F.min(F.col("n") - F.col("window")).alias("room"),
        F.min(limit).alias("max_rank"),
    ).first()
    if found["short"] is None or found["short"] < 4 or found["bad"]:
        raise ValueError("every series needs four samples or more, all of them finite")
    if found["gaps"]:
        raise ValueError("t must number the samples of each series without gaps")
    if found["low"] < 2 or found["room"] < 1:
        raise ValueError("a window is shorter than 2 or not shorter than its series")
    if rank is not None and not 1 <= rank <= found["max_rank"]:
        raise ValueError(f"rank {rank} is outside 1..{found['max_rank']}, what the shortest series allows")
    return sizes.select("series_id", "n", "first_t", "window")


def index_series(series: DataFrame, order: str) -> DataFrame:
    """Number the samples of every series by an ordering column, 0-based.

    Rows are range-partitioned by (series, order), numbered within each partition and
    shifted by the counts of the series' earlier partitions, so one very long series is
    numbered by many tasks.
    """
    ranged = stage(
        series.repartitionByRange("series_id", order).withColumn("part", F.spark_partition_id()), "ranged"
    )
    counts = ranged.groupBy("series_id", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("series_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("series_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    local = Window.partitionBy("series_id", "part").orderBy(order)
    numbered = ranged.withColumn("local", F.row_number().over(local) - 1)
    return numbered.join(offsets, ["series_id", "part"]).select(
        "series_id", (F.col("offset") + F.col("local")).cast("bigint").alias("t"), "value"
    )


def blocked(series: DataFrame, sizes: DataFrame, block_starts: int = BLOCK_STARTS) -> DataFrame:
    """Cut every series into blocks of window starts; samples a later block's neighbour
    needs are copied into it, so blocks of one series are independent."""
    placed = series.join(small_side(sizes), "series_id").withColumn("at", (F.col("t") - F.col("first_t")).cast("bigint"))
    starts = F.col("n") - F.col("window") + 1
    own = F.least(F.col("at"), starts - 1)
    last = F.floor(own / block_starts)
    first = F.floor(F.greatest(F.col("at") - F.col("window") + 1, F.lit(0)) / block_starts)
    return placed.withColumn("block", F.explode(F.sequence(first, last))).select(
        "series_id", "block", "at", "t", "value", "n", "window"
    )


def trajectory(series: DataFrame, window: int | None = None, block_starts: int = BLOCK_STARTS) -> DataFrame:
    """Hankel windows ``(series_id, t, window ARRAY<DOUBLE>)``: full windows only, t is the
    first sample. Windows are built per block, so a long series uses many tasks."""
    sizes = check_series(series, window=window)
    cut = blocked(series, sizes, block_starts)

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("at")
        views = _windows(part, block_starts)
        return pd.DataFrame(
            {"series_id": part["series_id"].iloc[0], "t": part["t"].to_numpy()[: len(views)], "window": list(views)}
        )

    id_type = series.schema["series_id"].dataType.simpleString()
    return cut.groupBy(*KEYS).applyInPandas(build, f"series_id {id_type}, t bigint, window array<double>")


def _windows(part: pd.DataFrame, block_starts: int) -> np.ndarray:
    values = part["value"].to_numpy(dtype=float)
    views = np.lib.stride_tricks.sliding_window_view(values, int(part["window"].iloc[0]))
    return views[:block_starts]


def trajectory_bases(cut: DataFrame, rank: int, block_starts: int = BLOCK_STARTS) -> DataFrame:
    """Leading directions of every series' trajectory: ``(series_id, basis ARRAY<DOUBLE>, energy)``.

    A step down a diagonal of the trajectory's Gram matrix drops one product of samples and adds another, so the
    whole matrix follows from its first row and the first and last samples of the series. A block sends that
    row, one sum per lag, in O(starts x window); the matrix is built where the sums of a series meet.
    """
    id_type = cut.schema["series_id"].dataType.simpleString()

    def lag_sums(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("at")
        values, window = part["value"].to_numpy(dtype=float), int(part["window"].iloc[0])
        starts = len(_windows(part, block_starts))
        parts = [("lag", np.array([values[:starts] @ values[lag : lag + starts] for lag in range(window)]))]
        if part["at"].iloc[0] == 0:
            parts.append(("head", values[:window]))
        if part["at"].iloc[-1] == part["n"].iloc[0] - 1:
            parts.append(("tail", values[starts : starts + window - 1]))
        return pd.concat(
            pd.DataFrame({"series_id": part["series_id"].iloc[0], "kind": kind, "place": np.arange(len(v)), "value": v}) for kind, v in parts
        )

    sums = (
        cut.groupBy(*KEYS)
        .applyInPandas(lag_sums, f"series_id {id_type}, kind string, place int, value double")
        .groupBy("series_id", "kind", "place")
        .agg(F.sum("value").alias("value"))
    )

    def leading(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("place")
        lag, head, tail = (part["value"][part["kind"] == kind].to_numpy() for kind in ("lag", "head", "tail"))
        window = len(lag)
        matrix = np.empty((window, window))
        for shift in range(window):
            steps = tail[: window - 1 - shift] * tail[shift:] - head[: window - 1 - shift] * head[shift : window - 1]
            diagonal = lag[shift] + np.concatenate([[0.0], np.cumsum(steps)])
            place = np.arange(window - shift)
            matrix[place, place + shift] = matrix[place + shift, place] = diagonal
        values, vectors = np.linalg.eigh(matrix)
        basis = vectors[:, ::-1][:, :rank]
        return pd.DataFrame(
            {"series_id": [part["series_id"].iloc[0]], "basis": [basis.ravel()], "energy": [float(values.sum())]}
        )

    return sums.groupBy("series_id").applyInPandas(
        leading, f"series_id {id_type}, basis array<double>, energy double"
    )


def diagonal_average(windows: DataFrame, column: str = "window") -> DataFrame:
    """Mean of all window entries covering each sample of ``(series_id, t, window)`` rows."""
    return (
        windows.select("series_id", "t", F.posexplode(column).alias("shift", "estimate"))
        .groupBy("series_id", (F.col("t") + F.col("shift")).alias("t"))
        .agg(F.avg("estimate").alias("value"))
    )


def denoise(
    series: DataFrame, *, rank: int = 2, window: int | None = None, block_starts: int = BLOCK_STARTS
) -> DataFrame:
    """Low-rank Hankel approximation and diagonal averaging of every series:
    ``(series_id, t, value, denoised)``.

    Series whose window starts fit one block are denoised whole in one task each. Longer
    ones are cut into overlapping blocks: Gram cells are summed per series, each block
    projects its windows and sends one partial sum per sample.
    """
    sizes = check_series(series, rank, window)
    long = sizes.where(F.col("n") - F.col("window") + 1 > block_starts)
    if not long.take(1):
        return _denoise_whole(series.join(small_side(sizes), "series_id"), rank)
    short = sizes.where(F.col("n") - F.col("window") + 1 <= block_starts)
    return _denoise_whole(series.join(small_side(short), "series_id"), rank).unionByName(
        _denoise_blocked(series, long, rank, block_starts)
    )


def _denoise_whole(series: DataFrame, rank: int) -> DataFrame:
    id_type = series.schema["series_id"].dataType.simpleString()

    def approximate(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("t")
        values = part["value"].to_numpy(dtype=float)
        views = np.lib.stride_tricks.sliding_window_view(values, int(part["window"].iloc[0]))
        _, _, vt = np.linalg.svd(views, full_matrices=False)
        sums, counts = _overlap_add((views @ vt[:rank].T) @ vt[:rank], len(values))
        return pd.DataFrame(
            {"series_id": part["series_id"], "t": part["t"], "value": values, "denoised": sums / counts}
        )

    return (
        series.select("series_id", "t", "value", "window")
        .groupBy("series_id")
        .applyInPandas(approximate, f"series_id {id_type}, t bigint, value double, denoised double")
    )


def _denoise_blocked(series: DataFrame, sizes: DataFrame, rank: int, block_starts: int) -> DataFrame:
    id_type = series.schema["series_id"].dataType.simpleString()
    cut = blocked(series, sizes, block_starts)
    bases = trajectory_bases(cut, rank, block_starts)

    def project(key: tuple, part: pd.DataFrame, basis: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("at")
        views = _windows(part, block_starts)
        vectors = basis["basis"].iloc[0].reshape(views.shape[1], -1)
        sums, counts = _overlap_add((views @ vectors) @ vectors.T, len(part))
        return pd.DataFrame({"series_id": key[0], "t": part["t"], "total": sums, "n": counts})

    # The basis of a series is repeated for each of its blocks and meets it by key.
    blocks = sizes.select(
        "series_id",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - F.col("window")) / block_starts))).alias("block"),
    )
    repeated = blocks.join(bases, "series_id")
    partial = (
        cut.groupBy(*KEYS)
        .cogroup(repeated.toDF("series_id", "block", "basis", "energy").groupBy(*KEYS))
        .applyInPandas(project, f"series_id {id_type}, t bigint, total double, n double")
    )
    estimate = partial.groupBy("series_id", "t").agg((F.sum("total") / F.sum("n")).alias("denoised"))
    return series.join(estimate, ["series_id", "t"]).select("series_id", F.col("t").cast("bigint").alias("t"), "value", "denoised")


def _overlap_add(windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    sums, counts = np.zeros(length), np.zeros(length)
    rows = len(windows)
    for shift in range(windows.shape[1]):
        sums[shift : shift + rows] += windows[:, shift]
        counts[shift : shift + rows] += 1.0
    return sums, counts


def series_errors(df: DataFrame, reference: str = "reference", estimate: str = "estimate") -> DataFrame:
    """``(series_id, mse, snr_db)`` of an estimate against a reference column; the ratio is
    infinite for an exact estimate."""
    noise = F.sum((F.col(reference) - F.col(estimate)) * (F.col(reference) - F.col(estimate)))
    power = F.sum(F.col(reference) * F.col(reference))
    sums = df.groupBy("series_id").agg(noise.alias("noise"), power.alias("power"), F.count(F.lit(1)).alias("n"))
    ratio = F.when(F.col("noise") == 0, F.lit(float("inf"))).when(
        F.col("power") > 0, 10.0 * F.log10(F.col("power") / F.col("noise"))
    ).otherwise(F.lit(float("-inf")))
    return sums.select("series_id", (F.col("noise") / F.col("n")).alias("mse"), ratio.alias("snr_db"))
