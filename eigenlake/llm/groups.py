"""Comparing the members of groups of any size: hot groups are cut into blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Pairs looked at in one NumPy step.
PAIR_STEP = 1 << 19


def in_blocks(df: DataFrame, unit: str, blocks: Column) -> DataFrame:
    """Deal rows to pairs of blocks by the hash of ``unit``; any two rows of a group meet in one block pair.

    Adds ``block_i <= block_j`` and ``side``: 0 for rows of block i, 1 for rows of block j,
    0 for both where i = j. A group of one block is not copied.
    """
    return (
        df.withColumn("_blocks", blocks.cast("int"))
        .withColumn("_block", F.pmod(F.xxhash64(unit), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumns(
            {
                "block_i": F.least("_block", "_other"),
                "block_j": F.greatest("_block", "_other"),
                "side": (F.col("_block") > F.col("_other")).cast("int"),
            }
        )
        .drop("_block", "_blocks", "_other")
    )


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete groups, with the first row of each group and the row count at the end.

    The partition must be sorted by ``keys``, which hold no nulls.
    """
    carried = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if carried is not None:
            table = pa.concat_tables([carried, table])
        starts = _starts(table, keys)
        cut = int(starts[-1])
        carried = table.slice(cut)
        if cut:
            yield table.slice(0, cut).combine_chunks(), starts
    if carried is not None:
        yield carried.combine_chunks(), np.array([0, carried.num_rows])


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for key in keys:
        values = table.column(key).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def pairs(starts: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of all pairs within the groups, a bounded number at a time.

    Rows of a group are ordered by side; a group with both sides pairs the one with the other.
    """
    sizes = np.diff(starts)
    ones = np.add.reduceat(side, starts[:-1])
    end = np.repeat(starts[1:], sizes)
    row = np.arange(len(side))
    crossed = np.repeat(ones > 0, sizes)
    low = np.where(crossed, end - np.repeat(ones, sizes), row + 1)
    count = np.where(crossed & (side == 1), 0, end - low)
    totals = np.concatenate([[0], np.cumsum(count)])
    first = 0
    while first < len(row):
        last = int(np.searchsorted(totals, totals[first] + PAIR_STEP, "right")) - 1
        last = min(max(last, first + 1), len(row))
        wanted = count[first:last]
        left = np.repeat(row[first:last], wanted)
        right = np.arange(len(left)) + np.repeat(low[first:last] - (totals[first:last] - totals[first]), wanted)
        if len(left):
            yield left, right
        first = last


def bounded_groups(
    batches: Iterator[pa.RecordBatch], key: str, limit: int
) -> Iterator[tuple[pa.Table, np.ndarray | None]]:
    """As ``whole_groups`` for groups of up to ``limit`` rows; larger ones come in pieces with None."""
    carried, over = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if over:
            same = table.column(key).to_numpy() == carried
            cut = len(same) if same.all() else int(np.argmin(same))
            if cut:
                yield table.slice(0, cut), None
            if cut == table.num_rows:
                continue
            table, carried, over = table.slice(cut), None, False
        if carried is not None:
            table = pa.concat_tables([carried, table])
        starts = _starts(table, [key])
        bounds = np.concatenate([starts, [table.num_rows]])
        large = np.flatnonzero(np.diff(bounds)[:-1] > limit)
        previous = 0
        for g in [*large.tolist(), len(starts) - 1]:
            if g > previous:
                part = table.slice(bounds[previous], bounds[g] - bounds[previous]).combine_chunks()
                yield part, bounds[previous : g + 1] - bounds[previous]
            if g < len(starts) - 1:
                yield table.slice(bounds[g], bounds[g + 1] - bounds[g]), None
            previous = g + 1
        carried = table.slice(bounds[-2])
        if carried.num_rows > limit:
            yield carried, None
            carried, over = carried.column(key)[0].as_py(), True
    if carried is not None and not over:
        yield carried.combine_chunks(), np.array([0, carried.num_rows])


class Forest:
    """Disjoint sets over the rows of one table; the spanning links are what gets emitted."""

    def __init__(self, count: int) -> None:
        self.parent = list(range(count))

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, left: np.ndarray, right: np.ndarray) -> list[int]:
        """Positions of the pairs that joined two sets."""
        kept = []
        for i, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
            a, b = self.root(a), self.root(b)
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                kept.append(i)
        return kept

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.parent))], np.int64)
