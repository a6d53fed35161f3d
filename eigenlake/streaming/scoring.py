"""Scoring rows as they arrive. Scoring is stateless, so the batch plan runs unchanged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from eigenlake.operators.preprocess import Preprocessor
from eigenlake.operators.spectral import SpectralModel
from eigenlake.plans.jobs import score


def score_stream(
    source: DataFrame,
    preprocessor: Preprocessor,
    model: SpectralModel,
    *,
    output_path: str,
    checkpoint_path: str,
    keep: Sequence[str] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Write the component coordinates of a streaming frame as parquet, exactly once."""
    writer = (
        score(source, preprocessor, model, keep)
        .writeStream.format("parquet")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
