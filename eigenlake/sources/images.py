"""Image files to plane rows ``(image_id, channel, row_idx, pixels)``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from eigenlake.functions.arrow import to_lists
from eigenlake.functions.numeric import is_finite

PLANE_SCHEMA = "image_id string, channel int, row_idx int, pixels array<double>"

# The largest value of each integer pixel type.
PIXEL_MAX = {"uint8": 255.0, "int8": 127.0, "uint16": 65535.0, "int16": 32767.0, "int32": 2147483647.0}


def read_image_planes(spark: SparkSession, path: str) -> DataFrame:
    """Decode a file or folder of images; 8-bit pixels scaled to [0, 1], channels in
    red-green-blue(-alpha) order."""
    images = spark.read.format("image").load(path)
    if not images.take(1):
        raise FileNotFoundError(f"Image not found: {path}")
    return images.select(
        F.col("image.origin").alias("image_id"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("channels"),
        F.col("image.data").alias("data"),
    ).mapInArrow(_planes, PLANE_SCHEMA)


def _planes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for image in batch.to_pylist():
            height, width, channels = image["height"], image["width"], image["channels"]
            cube = np.frombuffer(image["data"], dtype=np.uint8).reshape(height, width, channels)
            order = [0] if channels == 1 else [2, 1, 0, *range(3, channels)]
            for channel, stored in enumerate(order):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([image["image_id"]] * height),
                        pa.array([channel] * height, pa.int32()),
                        pa.array(range(height), pa.int32()),
                        to_lists(cube[:, :, stored] / PIXEL_MAX["uint8"]),
                    ],
                    names=["image_id", "channel", "row_idx", "pixels"],
                )


def normalise_pixels(df: DataFrame, pixel_type: str = "float", column: str = "pixels") -> DataFrame:
    """Integer pixels divided by their type's maximum; float pixels must be finite and
    already within [0, 1]."""
    vector = F.col(column)
    if pixel_type in PIXEL_MAX:
        top = PIXEL_MAX[pixel_type]
        return df.withColumn(column, F.transform(vector, lambda x: x.cast("double") / F.lit(top)))
    found = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.exists(vector, lambda x: ~F.coalesce(is_finite(x), F.lit(False))).cast("int")).alias("bad"),
        F.min(F.array_min(vector)).alias("low"),
        F.max(F.array_max(vector)).alias("high"),
    ).first()
    if not found["rows"] or found["low"] is None:
        raise ValueError("Image is empty")
    if found["bad"]:
        raise ValueError("Image contains NaN or infinite values")
    if found["low"] < 0.0 or found["high"] > 1.0:
        raise ValueError(
            "Floating-point image values must already be normalized to the [0, 1] range"
        )
    return df.withColumn(column, vector.cast("array<double>"))
