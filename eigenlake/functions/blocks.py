"""Bounded point sets shipped to the tasks, and the NumPy kernels that use them."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from eigenlake.functions.arrow import to_lists, to_matrix

# Largest point set sent to every executor at once; more points are taken in blocks.
BLOCK_BYTES = 64 * 1024 * 1024
# Largest temporary distance block inside a task.
TILE_CELLS = 2_000_000


@dataclass(frozen=True)
class PointBlock:
    """Row ids and vectors of one block, in row-id order, plus carried integer arrays."""

    ids: np.ndarray
    points: np.ndarray
    carried: np.ndarray | None = None


def block_count(rows: int, width: int, block_bytes: int = BLOCK_BYTES) -> int:
    """How many blocks keep each block within the byte bound."""
    return max(1, math.ceil(rows * width * 8 / block_bytes))


def in_block(df: DataFrame, row_id: str, block: int, blocks: int) -> DataFrame:
    """The rows of one block; blocks are cut by hash, so clusters or copies do not skew them."""
    if blocks == 1:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(f"`{row_id}`")), F.lit(blocks)) == block)


def collect_block(
    df: DataFrame, row_id: str, column: str, width: int, carried: str | None = None
) -> PointBlock:
    """Read a block whose size the caller has checked."""
    names = [f"`{row_id}`", column] + ([carried] if carried else [])
    table = df.select(*names).toArrow()
    ids = table.column(0).to_numpy()
    points = to_matrix(table.column(1), width)
    order = np.argsort(ids, kind="stable")
    extra = None
    if carried:
        extra = to_matrix(table.column(2), len(table.column(2)[0])).astype(np.int64)[order]
    return PointBlock(ids[order], points[order], extra)


def share(df: DataFrame, block: PointBlock) -> Broadcast:
    """Broadcast ``(ids, points, carried)`` as plain arrays."""
    return df.sparkSession.sparkContext.broadcast((block.ids, block.points, block.carried))


# Rows that meet points of several blocks together: every meeting reads all blocks again.
MET_ROWS = 16


@dataclass(frozen=True)
class OrderedPoints:
    """A bounded sample in row-id order at the tasks: its ids, and its points in blocks of which a task holds one at a time."""

    ids: Broadcast
    blocks: tuple[Broadcast, ...]
    count: int

    @classmethod
    def of(cls, df: DataFrame, row_id: str, column: str, rows: int, width: int, block_bytes: int = BLOCK_BYTES) -> OrderedPoints:
        context, parts = df.sparkSession.sparkContext, block_count(rows, width, block_bytes)
        if parts == 1:
            block = collect_block(df, row_id, column, width)
            return cls(context.broadcast(block.ids), (context.broadcast(block.points),), len(block.ids))
        ids = np.sort(df.select(f"`{row_id}`").toArrow().column(0).to_numpy(), kind="stable")
        # Equal ids are never cut apart; whatever has no order among the ids belongs to the last block.
        cuts = list(dict.fromkeys(ids[np.arange(1, parts) * len(ids) // parts].tolist()))
        key = F.col(f"`{row_id}`")
        blocks = []
        for low, high in zip([None, *cuts], [*cuts, None]):
            own = F.lit(True) if low is None else F.coalesce(key >= low, F.lit(True))
            own &= F.lit(True) if high is None else F.coalesce(key < high, F.lit(False))
            blocks.append(context.broadcast(collect_block(df.where(own), row_id, column, width).points))
        return cls(context.broadcast(ids), tuple(blocks), len(ids))

    def places(self, ids: pa.Array) -> np.ndarray:
        return np.searchsorted(self.ids.value, ids.to_numpy(zero_copy_only=False))

    def tiles(self, rows: int) -> Iterator[slice]:
        """Row ranges that meet all points together."""
        if len(self.blocks) == 1:
            yield from tiles(rows, self.count)
            return
        step = max(MET_ROWS, TILE_CELLS // self.count)
        yield from (slice(start, min(rows, start + step)) for start in range(0, rows, step))

    def squared_distances(self, rows: np.ndarray) -> np.ndarray:
        """All squared distances to the points."""
        if len(self.blocks) == 1:
            return squared_distances(rows, self.blocks[0].value)
        out, start = np.empty((len(rows), self.count)), 0
        for block in self.blocks:
            points = block.value
            # A block is read again from the executor's disk rather than kept, unless it was sent encrypted.
            if vars(block).get("_path"):
                vars(block).pop("_value", None)
            out[:, start : start + len(points)] = squared_distances(rows, points)
            start += len(points)
        return out


# Rows from which work on all pairs takes all cores.
SPREAD_PAIRS = 1_000


def dealt(df: DataFrame, row_id: str, rows: int) -> DataFrame:
    """Rows that each meet all others, in some tasks per core: a small table in few files still is much work."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(4 * cores, F.col(f"`{row_id}`")) if rows >= SPREAD_PAIRS else df


def tiles(rows: int, columns: int) -> Iterator[slice]:
    """Row ranges whose distance block to ``columns`` points stays small."""
    step = max(1, TILE_CELLS // max(1, columns))
    for start in range(0, rows, step):
        yield slice(start, min(rows, start + step))


def squared_distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """All squared distances by the expanded form, floored at zero."""
    out = -2.0 * (rows @ points.T)
    out += np.einsum("ij,ij->i", rows, rows)[:, None]
    out += np.einsum("ij,ij->i", points, points)[None, :]
    return np.maximum(out, 0.0, out=out)


def row_factor(rows: np.ndarray) -> np.ndarray:
    """With ``point_factor`` of some points, one product gives all squared distances to them."""
    return np.column_stack([-2.0 * rows, np.ones(len(rows)), np.einsum("ij,ij->i", rows, rows)])


def point_factor(points: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.column_stack([points, np.einsum("ij,ij->i", points, points), np.ones(len(points))]).T)


# Rows and points whose distances are added up together: they stay in a core's cache. Runs of points shorter than this are not
# worth a sum of their own.
SUMMED_ROWS, SUMMED_POINTS = 128, 1000
SHORT_RUN = 8


def summed_distances(left: np.ndarray, right: np.ndarray, firsts: np.ndarray, member: np.ndarray) -> np.ndarray:
    """Distances from rows to points, both as factors, added up over the runs of points that begin at ``firsts`` and
    dealt out to the columns of ``member``, tile by tile: there may be nearly as many runs as points."""
    count = right.shape[1]
    out, space = np.zeros((len(left), member.shape[1])), np.empty((SUMMED_ROWS, min(count, SUMMED_POINTS)))
    for start in range(0, count, SUMMED_POINTS):
        points = np.ascontiguousarray(right[:, start : start + SUMMED_POINTS])
        stop = start + points.shape[1]
        runs = slice(np.searchsorted(firsts, start, side="right") - 1, np.searchsorted(firsts, stop))
        begins, dealt_to = np.maximum(firsts[runs] - start, 0), member[runs]
        short = len(begins) * SHORT_RUN > stop - start
        if short:
            dealt_to = np.repeat(dealt_to, np.diff(begins, append=stop - start), axis=0)
        for at in range(0, len(left), SUMMED_ROWS):
            rows = left[at : at + SUMMED_ROWS]
            d = np.matmul(rows, points, out=space[: len(rows), : stop - start])
            np.maximum(d, 0.0, out=d)
            np.sqrt(d, out=d)
            out[at : at + SUMMED_ROWS] += (d if short else np.add.reduceat(d, begins, axis=1)) @ dealt_to
    return out


# Points of a block from which distances are taken in single precision; the least squared distance that is trusted so, as a share of
# the squared coordinates around a tile's middle; and kinds of a tile that are added up one after the other.
SINGLE_POINTS = 5_000
SINGLE_SHARE = 3e-4
FEW_KINDS = 24
# Kinds of a block beyond which its rows are dealt out to the clusters at once.
MANY_KINDS = 2_000


class NearTiles:
    """A block of points that count as often as their weights say, in tiles of near ones that are ordered by kind.

    ``member`` has a row per kind and a column per cluster.
    """

    def __init__(self, points: np.ndarray, weights: np.ndarray, kinds: np.ndarray, member: np.ndarray) -> None:
        tiles_ = [tile[np.argsort(kinds[tile], kind="stable")] for tile in near_tiles(points, SUMMED_POINTS)]
        self.order, self.member = np.concatenate(tiles_), member
        self.points, self.weights, self.kinds = points[self.order], weights[self.order].astype(float), kinds[self.order]
        self.ends = np.cumsum([len(tile) for tile in tiles_]).tolist()
        self.tiles = [slice(a, b) for a, b in zip([0, *self.ends], self.ends)]
        self.centres = [self.points[tile].mean(axis=0) for tile in self.tiles]
        self.radii = [float(np.sqrt(((self.points[tile] - c) ** 2).sum(axis=1).max())) for tile, c in zip(self.tiles, self.centres)]

    def __len__(self) -> int:
        return len(self.points)

    def runs(self, part: slice) -> tuple[np.ndarray, np.ndarray]:
        """The kinds of a part of one tile, and where each begins in it."""
        return np.unique(self.kinds[part], return_index=True)

    def factor(self) -> tuple[np.ndarray, ...]:
        """Factor for ``summed_distances`` around the middle, the first point of every kind, the clusters of the kinds, and the middle."""
        order = np.argsort(self.kinds, kind="stable")
        centre = self.points.mean(axis=0)
        kinds, firsts = np.unique(self.kinds[order], return_index=True)
        return point_factor(self.points[order] - centre) * self.weights[order] ** 2, firsts, self.member[kinds], centre

    def restored(self, sums: np.ndarray) -> np.ndarray:
        """Sums per point in the order in which the points were given."""
        out = np.empty_like(sums)
        out[self.order] = sums
        return out


def met_sums(rows: NearTiles, points: NearTiles, both: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Distances between two blocks, added up per row and cluster of the points and, if ``both``, per point and cluster of the rows.

    A distance is taken once for both sums. In large blocks it is taken in single precision around the middle of the points' tile, which
    holds it to some 1e-7; these errors have either sign, and sums over tiles are in double precision. Distances of rows
    that are too near to a point of the tile for that are taken in double precision.
    """
    if min(len(rows), len(points)) < SINGLE_POINTS:
        found = [_plain_sums(rows, points), _plain_sums(points, rows) if both else None]
        return rows.restored(found[0]), points.restored(found[1]) if both else None
    out, back = np.zeros((len(rows), points.member.shape[1])), np.zeros((len(points), rows.member.shape[1]))
    space = np.empty((SUMMED_ROWS, SUMMED_POINTS), np.float32)
    single_rows = rows.weights.astype(np.float32)
    chunks = [
        (slice(at, min(at + SUMMED_ROWS, tile.stop)), centre, radius)
        for tile, centre, radius in zip(rows.tiles, rows.centres, rows.radii)
        for at in range(tile.start, tile.stop, SUMMED_ROWS)
    ]
    scattered = len(rows.member) > MANY_KINDS
    row_runs = [rows.runs(part) for part, _, _ in chunks] if both and not scattered else []
    for tile, centre, radius in zip(points.tiles, points.centres, points.radii):
        near, heavy = points.points[tile] - centre, points.weights[tile].astype(np.float32)
        kinds, firsts = points.runs(tile)
        dealt_to = points.member[kinds]
        moved, left_size, left_parts = _single(rows.points - centre)
        others, right_size, right_parts = _single(near)
        left = np.column_stack([-2 * moved, left_parts, np.ones_like(left_parts)])
        right = np.ascontiguousarray(np.column_stack([others, np.ones_like(right_parts), right_parts]).T)
        least = (SINGLE_SHARE * (left_size + right_size.max())).astype(np.float32)
        heard = np.zeros((rows.member.shape[scattered], len(near)))
        for place, (part, middle, around) in enumerate(chunks):
            d = np.matmul(left[part], right, out=space[: part.stop - part.start, : len(near)])
            apart = float(np.sqrt(((middle - centre) ** 2).sum())) - around - radius
            if apart**2 < float(least[part].max()) or apart < 0:
                unsure = np.flatnonzero(d.min(axis=1) < least[part])
                if len(unsure):
                    d[unsure] = squared_distances(rows.points[part][unsure] - centre, near)
            np.sqrt(d, out=d)
            out[part] += _run_sums(d, heavy, firsts, dealt_to)
            if both and scattered:
                heard += (rows.member[rows.kinds[part]] * rows.weights[part][:, None]).T.astype(np.float32) @ d
            elif both:
                own, begins = row_runs[place]
                weights = single_rows[part]
                for kind, a, b in zip(own, begins, [*begins[1:], len(d)]):
                    heard[kind] += weights[a:b] @ d[a:b]
        if both:
            back[tile] = heard.T if scattered else heard.T @ rows.member
    return rows.restored(out), points.restored(back) if both else None


def _run_sums(d: np.ndarray, weights: np.ndarray, firsts: np.ndarray, dealt_to: np.ndarray) -> np.ndarray:
    """Weighted sums of the columns of every run, dealt out to the clusters."""
    lasts = [*firsts[1:], len(weights)]
    if len(firsts) <= FEW_KINDS:
        sums = np.column_stack([d[:, a:b] @ weights[a:b] for a, b in zip(firsts, lasts)])
    elif len(firsts) * SHORT_RUN <= len(weights):
        sums = np.add.reduceat(d * weights, firsts, axis=1)
    else:
        each = np.repeat(dealt_to, np.diff(lasts, prepend=0), axis=0) * weights[:, None]
        return (d @ each.astype(np.float32)).astype(float)
    return sums.astype(float) @ dealt_to


def _plain_sums(rows: NearTiles, points: NearTiles) -> np.ndarray:
    if not len(rows) or not len(points):
        return np.zeros((len(rows), points.member.shape[1]))
    right, firsts, member, centre = points.factor()
    return summed_distances(row_factor(rows.points - centre), right, firsts, member)


def near_tiles(points: np.ndarray, most: int) -> list[np.ndarray]:
    """Places of at most ``most`` points each that lie near one another: halves of the widest dimension, cut again."""
    tiles_, rest = [], [np.arange(len(points))]
    while rest:
        places = rest.pop()
        if len(places) <= most:
            tiles_.append(places)
            continue
        own = points[places]
        axis = int((own.max(axis=0) - own.min(axis=0)).argmax())
        # Whole tiles on the left.
        half = -(-len(places) // most) // 2 * most
        order = np.argpartition(own[:, axis], half)
        rest += [places[order[half:]], places[order[:half]]]
    return tiles_


def _single(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points in single precision and their squared lengths, also each as two single numbers that add up to it."""
    single = points.astype(np.float32)
    size = np.einsum("ij,ij->i", single, single, dtype=float)
    most = size.astype(np.float32)
    return single, size, np.column_stack([most, (size - most).astype(np.float32)])


# Partial arrays from this few tasks, with this few cells in all, go straight to the driver: some callers sum in every one of many passes.
NEAR_TASKS = 16
DIRECT_CELLS = 1_000_000
DIRECT_TASKS = 64
FOLD_TASKS = 256
FINAL_TASKS = 8
# Tasks that fold the arrays of at most DIRECT_TASKS tasks.
FEW_TASKS = 2


def task_count(staged: DataFrame) -> int:
    """Tasks of a staged frame (asking an unstaged one would run its shuffles)."""
    return staged.rdd.getNumPartitions()


def sum_partials(df: DataFrame, partial, cells: int, tasks: int | None = None) -> np.ndarray:
    """Sum of one fixed-length array per task.

    ``partial`` maps a task's batches to at most one array. The arrays are added up in a
    shrinking number of tasks, unless the task count is known to be small, so the driver
    sees a handful of arrays at any scale.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = partial(batches)
        if found is not None:
            yield pa.RecordBatch.from_arrays([to_lists(np.asarray(found).reshape(1, -1))], names=["value"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summed = None
        for batch in batches:
            if batch.num_rows:
                part = to_matrix(batch.column(0), cells).sum(axis=0)
                summed = part if summed is None else summed + part
        if summed is not None:
            yield pa.RecordBatch.from_arrays([to_lists(summed.reshape(1, -1))], names=["value"])

    arrays = df.mapInArrow(run, "value array<double>")
    if tasks is None or tasks > NEAR_TASKS or tasks * cells > DIRECT_CELLS:
        if tasks is None or tasks > FOLD_TASKS:
            wide = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            if wide > FINAL_TASKS:
                arrays = arrays.repartition(min(wide, FOLD_TASKS)).mapInArrow(fold, "value array<double>")
        if tasks is not None and tasks <= DIRECT_TASKS:
            # In the order of the tasks, so that the sums of two runs agree to the last digit.
            arrays = arrays.withColumn("part", F.spark_partition_id()).repartition(FEW_TASKS, "part").sortWithinPartitions("part")
        else:
            arrays = arrays.repartition(FINAL_TASKS)
        arrays = arrays.mapInArrow(fold, "value array<double>")
    table = arrays.toArrow()
    if not table.num_rows:
        return np.zeros(cells)
    return to_matrix(table.column(0), cells).sum(axis=0)
