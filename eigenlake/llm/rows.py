"""Filtering whole rows by their text inside tasks, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eigenlake.llm.text import string_parts


def filter_by_text(docs: DataFrame, task: Callable[[], Callable[[pa.Array], np.ndarray]]) -> DataFrame:
    """The rows of ``docs`` whose lower-cased ``text`` a task's function keeps, with all their columns.

    ``task`` makes, once per task, the function from a slice of texts to a mask of rows to keep.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = task()
        for batch in batches:
            last = batch.num_columns - 1
            masks = [keep(part) for part in string_parts(batch.column(last))]
            mask = np.concatenate(masks) if masks else np.zeros(0, bool)
            yield batch.select(range(last)).filter(pa.array(mask, pa.bool_()))

    folded = docs.select("*", F.lower(F.col("text").cast("string")).alias("_folded_text"))
    return folded.mapInArrow(run, docs.schema)
