"""Uncentred rank-r approximation of many planes (image channels or row groups)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eigenlake.functions.arrow import to_lists, to_matrix
from eigenlake.session import small_side, stage

# Planes up to this size are factored inside one task; taller ones are spread over tasks.
PLANE_BYTES = 64 * 1024 * 1024

REBUILT_SCHEMA = "image_id string, channel int, row_idx bigint, rank int, pixels array<double>, rebuilt array<double>"


def _plane_sizes(planes: DataFrame) -> DataFrame:
    return planes.groupBy("image_id", "channel").agg(
        F.count(F.lit(1)).alias("height"), F.max(F.size("pixels")).alias("width")
    )


def check_ranks(planes: DataFrame, ranks: Sequence[int]) -> None:
    """Every rank must be within the smaller side of every plane."""
    low = _plane_sizes(planes).agg(F.min(F.least("height", "width")).alias("m")).first()["m"]
    if low is None:
        raise ValueError("Image is empty")
    for rank in ranks:
        if not 1 <= rank <= low:
            raise ValueError(f"rank must be between 1 and {low}")


def rebuild_planes(
    planes: DataFrame, ranks: Sequence[int], *, plane_bytes: int = PLANE_BYTES
) -> DataFrame:
    """Rank-r rows of every plane for every rank; each plane is factored once.

    Input and output rows are ``(image_id, channel, row_idx, pixels)``, output adds the
    rank and ``rebuilt``. Planes within the byte bound are factored whole in one task;
    taller ones by summed Gram cells and a row-local projection, so that a plane holding
    a large share of all rows is still spread over the cluster.
    """
    check_ranks(planes, ranks)
    rows = planes.select(
        F.col("image_id").cast("string"), F.col("channel").cast("int"), F.col("row_idx").cast("bigint"), "pixels"
    )
    sizes = _plane_sizes(rows)
    tall = sizes.where(F.col("height") * F.col("width") * 8 > plane_bytes).select("image_id", "channel")
    if not tall.take(1):
        return _factor_whole(rows, ranks)
    keys, tall = ["image_id", "channel"], small_side(stage(tall, "tall"))
    whole = _factor_whole(rows.join(tall, keys, "left_anti"), ranks)
    return whole.unionByName(_factor_spread(rows.join(tall, keys, "left_semi"), ranks))


def _factor_whole(rows: DataFrame, ranks: Sequence[int]) -> DataFrame:
    wanted = [int(r) for r in ranks]

    def factor(plane: pa.Table) -> pa.Table:
        matrix = to_matrix(plane.column("pixels"), len(plane.column("pixels")[0]))
        u, sigma, vt = np.linalg.svd(matrix, full_matrices=False)
        parts = [
            pa.table(
                {
                    "image_id": plane.column("image_id").combine_chunks(),
                    "channel": plane.column("channel").combine_chunks(),
                    "row_idx": plane.column("row_idx").combine_chunks(),
                    "rank": pa.array([r] * len(matrix), pa.int32()),
                    "pixels": to_lists(matrix),
                    "rebuilt": to_lists((u[:, :r] * sigma[:r]) @ vt[:r]),
                }
            )
            for r in wanted
        ]
        return pa.concat_tables(parts)

    return rows.groupBy("image_id", "channel").applyInArrow(factor, REBUILT_SCHEMA)


def _factor_spread(rows: DataFrame, ranks: Sequence[int]) -> DataFrame:
    wanted = [int(r) for r in ranks]
    grams = plane_grams(rows)

    def directions(cells: pd.DataFrame) -> pd.DataFrame:
        width = int(cells["j"].max()) + 1
        gram = np.zeros((width, width))
        gram[cells["i"], cells["j"]] = gram[cells["j"], cells["i"]] = cells["value"]
        _, vectors = np.linalg.eigh(gram)
        basis = vectors[:, ::-1][:, : max(wanted)]
        return pd.DataFrame(
            {"image_id": [cells["image_id"].iloc[0]], "channel": [cells["channel"].iloc[0]], "basis": [basis.ravel()]}
        )

    bases = grams.groupBy("image_id", "channel").applyInPandas(
        directions, "image_id string, channel int, basis array<double>"
    )

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in _plane_runs(batch):
                part = batch.slice(first, last - first)
                matrix = to_matrix(part["pixels"], len(part["pixels"][0]))
                basis = np.array(part["basis"][0].as_py()).reshape(matrix.shape[1], -1)
                scores = matrix @ basis
                for r in wanted:
                    yield pa.RecordBatch.from_arrays(
                        [
                            part["image_id"],
                            part["channel"],
                            part["row_idx"],
                            pa.array([r] * len(matrix), pa.int32()),
                            to_lists(matrix),
                            to_lists(scores[:, :r] @ basis[:, :r].T),
                        ],
                        names=["image_id", "channel", "row_idx", "rank", "pixels", "rebuilt"],
                    )

    joined = rows.join(bases, ["image_id", "channel"])
    return joined.sortWithinPartitions("image_id", "channel").mapInArrow(project, REBUILT_SCHEMA)


def _plane_runs(batch: pa.RecordBatch) -> list[tuple[int, int]]:
    """First and last row of each plane in a batch that is sorted by image and channel."""
    if not batch.num_rows:
        return []
    image = batch.column("image_id").dictionary_encode().indices.to_numpy(zero_copy_only=False)
    channel = batch.column("channel").to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((image[1:] != image[:-1]) | (channel[1:] != channel[:-1])) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]))


def plane_grams(rows: DataFrame) -> DataFrame:
    """``(image_id, channel, i, j, value)`` Gram cells (i <= j) per plane. Tasks add up the
    rows they hold of each plane, over all their batches, before anything is shuffled."""

    def cells_of(done) -> pa.RecordBatch:
        corners = [np.triu_indices(len(gram)) for _, _, gram in done]
        sizes = [len(i) for i, _ in corners]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat([image for image, _, _ in done], sizes), pa.string()),
                pa.array(np.repeat([channel for _, channel, _ in done], sizes), pa.int32()),
                pa.array(np.concatenate([i for i, _ in corners]), pa.int32()),
                pa.array(np.concatenate([j for _, j in corners]), pa.int32()),
                pa.array(np.concatenate([gram[c] for c, (_, _, gram) in zip(corners, done)])),
            ],
            names=["image_id", "channel", "i", "j", "value"],
        )

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for batch in batches:
            done = []
            for first, last in _plane_runs(batch):
                key = batch["image_id"][first].as_py(), batch["channel"][first].as_py()
                pixels = batch["pixels"].slice(first, last - first)
                matrix = to_matrix(pixels, len(pixels[0]))
                gram = matrix.T @ matrix
                if current is not None and current[:2] == key:
                    gram += current[2]
                elif current is not None:
                    done.append(current)
                current = (*key, gram)
            if done:
                yield cells_of(done)
        if current is not None:
            yield cells_of([current])

    cells = (
        rows.select("image_id", "channel", "pixels")
        .sortWithinPartitions("image_id", "channel")
        .mapInArrow(partial, "image_id string, channel int, i int, j int, value double")
    )
    return cells.groupBy("image_id", "channel", "i", "j").agg(F.sum("value").alias("value"))


def clip_to_image(rebuilt: DataFrame, planes: DataFrame) -> DataFrame:
    """Clip rebuilt pixels to the original minimum and maximum over all channels."""
    limits = planes.groupBy(F.col("image_id").cast("string").alias("image_id")).agg(
        F.min(F.array_min("pixels")).alias("low"), F.max(F.array_max("pixels")).alias("high")
    )
    limits = small_side(stage(limits, "limits"))
    clipped = F.transform("rebuilt", lambda x: F.least(F.greatest(x, F.col("low")), F.col("high")))
    return rebuilt.join(limits, "image_id").withColumn("rebuilt", clipped)


def compression_metrics(clipped: DataFrame) -> DataFrame:
    """``(image_id, rank, mse, psnr_db, storage_ratio_estimate)`` from clipped rows."""
    error = F.aggregate(
        F.zip_with("pixels", "rebuilt", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x
    )
    sums = clipped.groupBy("image_id", "rank").agg(
        F.sum(error).alias("error"),
        F.sum(F.size("pixels")).alias("cells"),
        F.max(F.size("pixels")).alias("width"),
        F.count(F.lit(1)).alias("rows"),
        (F.max("channel") + 1).alias("channels"),
        (F.first("high") - F.first("low")).alias("range"),
    )
    mse = F.col("error") / F.col("cells")
    height = F.col("rows") / F.col("channels")
    psnr = F.when(mse == 0, F.lit(float("inf"))).when(
        F.col("range") > 0, 20.0 * F.log10(F.col("range") / F.sqrt(mse))
    )
    ratio = F.col("cells") / (F.col("rank") * (height + F.col("width") + 1) * F.col("channels"))
    return sums.select("image_id", "rank", mse.alias("mse"), psnr.alias("psnr_db"), ratio.alias("storage_ratio_estimate"))


def compress_images(planes: DataFrame, ranks: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """Rank sweep over all images: (clipped rows, metrics)."""
    clipped = clip_to_image(rebuild_planes(planes, ranks), planes)
    return clipped.select("image_id", "channel", "row_idx", "rank", "rebuilt"), compression_metrics(clipped)
