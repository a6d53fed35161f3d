"""K-means with many restarts and many k at once: one pass over the data per iteration."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from eigenlake.functions.arrow import to_lists, to_matrix
from eigenlake.functions.blocks import DIRECT_TASKS, FINAL_TASKS, FOLD_TASKS, squared_distances, sum_partials, task_count
from eigenlake.functions.numeric import EXPRESSION_TERMS, squared_distance_to
from eigenlake.operators.clean import MatrixShape, check_matrix
from eigenlake.session import stage

# k-means||: passes that draw candidates, and candidates drawn per pass and wanted centre.
SEED_PASSES = 5
OVERSAMPLING = 2
LEAST_DRAWN = 64
# How often a row of a frame of different rows occurs.
COPIES = "_copies"


@dataclass(frozen=True)
class KMeansModel:
    centers: np.ndarray
    inertia: float
    iterations: int

    @property
    def k(self) -> int:
        return len(self.centers)


@dataclass(frozen=True)
class KMeansRequest:
    """Which vector column to cluster, its width, and the cluster counts wanted."""

    column: str
    width: int
    ks: tuple[int, ...]


@dataclass
class _Run:
    """One restart: the request it belongs to and its current centres (mean-centred)."""

    request: int
    centers: np.ndarray
    steps: int = 0
    candidates: np.ndarray | None = None

    def refilled(self, moved: np.ndarray, filled: np.ndarray) -> np.ndarray:
        """Empty clusters restart from the candidates that are farthest from every used centre."""
        if filled.all() or self.candidates is None:
            return moved
        moved = moved.copy()
        nearest = squared_distances(self.candidates, moved[filled]).min(axis=1)
        for cluster in np.flatnonzero(~filled):
            far = int(nearest.argmax())
            moved[cluster] = self.candidates[far]
            nearest = np.minimum(nearest, squared_distances(self.candidates, self.candidates[[far]])[:, 0])
        return moved


def fit_kmeans(
    df: DataFrame,
    row_id: str,
    column: str = "features",
    *,
    ks: Sequence[int],
    seed: int = 42,
    n_init: int = 20,
    max_iter: int = 300,
    tol: float = 1e-4,
    init: np.ndarray | None = None,
    start_rows: Sequence | None = None,
    shape: MatrixShape | None = None,
) -> dict[int, KMeansModel]:
    """Best of ``n_init`` restarts for every k, on all rows of one column. ``init`` gives
    the starting centres of a single run instead. The two columns are staged, as every pass reads them."""
    shape = shape or check_matrix(df, column)
    request = KMeansRequest(column, shape.width, tuple(ks))
    staged = stage(df.select(f"`{row_id}`", f"`{column}`"), "kmeans")
    return fit_kmeans_together(
        staged, row_id, [request], shape.rows, seed=seed, n_init=n_init, max_iter=max_iter, tol=tol, init=init, start_rows=start_rows
    )[0]


def fit_kmeans_together(
    df: DataFrame,
    row_id: str,
    requests: Sequence[KMeansRequest],
    rows: int,
    *,
    seed: int = 42,
    n_init: int = 20,
    max_iter: int = 300,
    tol: float = 1e-4,
    init: np.ndarray | None = None,
    start_rows: Sequence | None = None,
) -> list[dict[int, KMeansModel]]:
    """Several representations of the same rows, several k and all restarts at once.

    Everything moves together, so the number of passes over the (staged) frame is the
    longest run's iteration count, not the sum over runs. Only centres reach the driver.
    ``init`` gives the starting centres of a single run; ``start_rows`` the ids of rows whose vectors start one
    run per k, the first k of them.
    """
    for request in requests:
        if any(not 2 <= k < rows for k in request.ks):
            raise ValueError(f"n_clusters goes from 2 to the number of rows less one, {rows - 1}")
    columns = list(dict.fromkeys(request.column for request in requests))
    vectors = df.select(*[f"`{name}`" for name in columns])
    tasks = task_count(vectors)
    location = _locations(vectors, columns)
    if init is not None:
        runs = [_Run(0, np.array(init, dtype=float) - location[requests[0].column][0])]
    elif start_rows is not None:
        runs = _runs_from_rows(df, row_id, requests, list(start_rows), location)
    else:
        runs = _starting_runs(df, row_id, requests, columns, seed, n_init, location, tasks)
    scan = _Scan(*_different(vectors, columns, rows, tasks), columns, requests, {c: location[c][0] for c in columns})
    active = list(runs)
    for _ in range(max_iter):
        still = []
        for run, (sums, counts, _) in zip(active, scan.assign_and_sum(active)):
            filled = counts > 0
            moved = run.centers.copy()
            moved[filled] = sums[filled] / counts[filled, None]
            moved = run.refilled(moved, filled)
            shift = float(((moved - run.centers) ** 2).sum())
            run.centers, run.steps = moved, run.steps + 1
            if shift > tol * location[requests[run.request].column][1]:
                still.append(run)
        active = still
        if not active:
            break
    best: list[dict[int, KMeansModel]] = [{} for _ in requests]
    for run, (_, counts, cost) in zip(runs, scan.assign_and_sum(runs)):
        found, k = best[run.request], len(run.centers)
        if (counts > 0).sum() >= 2 and (k not in found or cost < found[k].inertia):
            found[k] = KMeansModel(run.centers + location[requests[run.request].column][0], cost, run.steps)
    if any(k not in found for request, found in zip(requests, best) for k in request.ks):
        raise ValueError("The rows fall into fewer than two clusters")
    return best


def _locations(vectors: DataFrame, columns: Sequence[str]) -> dict[str, tuple[np.ndarray, float]]:
    """Mean vector and mean per-feature variance (which scales the tolerance) of every column, in one pass."""
    found = vectors.select(
        *[
            Summarizer.metrics("mean", "variance").summary(array_to_vector(F.col(f"`{c}`"))).alias(f"s{i}")
            for i, c in enumerate(columns)
        ]
    ).first()
    return {
        c: (found[f"s{i}"]["mean"].toArray(), float(found[f"s{i}"]["variance"].toArray().mean()))
        for i, c in enumerate(columns)
    }


# Rows per different row from which the passes take each different row once.
LEAST_COPIES = 2


def _different(vectors: DataFrame, columns: Sequence[str], rows: int, tasks: int) -> tuple[DataFrame, int]:
    """The frame that the passes read, and its tasks: where most rows are copies, the different rows with their number."""
    keys = [f"`{c}`" for c in columns]
    if vectors.select(F.approx_count_distinct(F.xxhash64(*keys))).first()[0] * LEAST_COPIES > rows:
        return vectors, tasks
    parts = max(vectors.sparkSession.sparkContext.defaultParallelism, tasks // LEAST_COPIES)
    counted = vectors.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES))
    kept = stage(counted.repartition(parts, *keys), "different")
    return kept, task_count(kept)


def _starting_runs(df, row_id, requests, columns, seed, n_init, location, tasks) -> list[_Run]:
    """Spread-out starting points per k and restart, from candidates that k-means|| draws from all rows.

    All requests share the passes. The candidates of a column, weighted by the rows nearest to
    each, are a few times its largest k; only they reach the driver.
    """
    keyed = df.select(F.xxhash64(F.lit(seed), F.col(f"`{row_id}`")).alias("_key"), *[f"`{c}`" for c in columns])
    wanted = {c: max(LEAST_DRAWN, OVERSAMPLING * max(max(r.ks) for r in requests if r.column == c)) for c in columns}
    candidates = {c: np.zeros((0, len(location[c][0]))) for c in columns}
    for turn in range(SEED_PASSES + 1):
        drawn = _draw(keyed, columns, candidates, wanted, location, seed + turn, tasks)
        candidates = {c: np.vstack([candidates[c], drawn[c]]) for c in columns}
    candidates = {c: np.unique(points, axis=0) for c, points in candidates.items()}
    pools = [KMeansRequest(c, len(location[c][0]), (len(candidates[c]),)) for c in columns]
    scan = _Scan(keyed.drop("_key"), tasks, list(columns), pools, {c: location[c][0] for c in columns})
    counted = scan.assign_and_sum([_Run(i, candidates[c]) for i, c in enumerate(columns)])
    weights = {c: counts for c, (_, counts, _) in zip(columns, counted)}
    runs = []
    for place, request in enumerate(requests):
        points = candidates[request.column]
        for k in request.ks:
            for restart in range(n_init):
                random = np.random.default_rng([seed, k, restart])
                runs.append(_Run(place, _spread_points(points, weights[request.column], k, random), candidates=points))
    return runs


def _runs_from_rows(df, row_id, requests, start_rows, location) -> list[_Run]:
    wanted = max(k for request in requests for k in request.ks)
    if len(start_rows) < wanted:
        raise ValueError(f"{wanted} starting rows are needed, {len(start_rows)} are given")
    named = df.where(F.col(f"`{row_id}`").isin(start_rows[:wanted]))
    found = {row[0]: row[1:] for row in named.select(f"`{row_id}`", *[f"`{c}`" for c in location]).collect()}
    absent = [row for row in start_rows[:wanted] if row not in found]
    if absent:
        raise ValueError(f"No rows with the ids {absent}")
    points = {
        c: np.array([found[row][i] for row in start_rows[:wanted]], dtype=float) - location[c][0] for i, c in enumerate(location)
    }
    return [_Run(place, points[request.column][:k]) for place, request in enumerate(requests) for k in request.ks]


def _draw(keyed, columns, candidates, wanted, location, seed, tasks) -> dict[str, np.ndarray]:
    """One pass: for every column, rows drawn without replacement with a chance that follows their cost.

    A row's key is an exponential variate over its squared distance to the nearest candidate (1
    before there are any), so the smallest keys are a weighted sample, and each task and each merge keeps
    just those. The variate comes from the row's id: the same in any plan.
    """
    plan = [(i, location[c][0], candidates[c], wanted[c]) for i, c in enumerate(columns)]

    def smallest(parts, number):
        keys = np.concatenate([p[0] for p in parts])
        rows = np.concatenate([p[1] for p in parts])
        order = np.argsort(keys, kind="stable")[:number]
        return keys[order], rows[order]

    def as_batch(found):
        flat = [(i, k, row) for i, (keys, rows) in enumerate(found) for k, row in zip(keys.tolist(), rows.tolist())]
        columns_ = list(zip(*flat)) if flat else [[], [], []]
        kinds = (pa.int32(), pa.float64(), pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns_, kinds)], names=["place", "k", "row"])

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(np.zeros(0), np.zeros((0, len(mean)))) for _, mean, _, _ in plan]
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy().view(np.uint64)
            for i, mean, near, number in plan:
                rows = to_matrix(batch.column(1 + i), len(mean)) - mean
                mixed = key * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 2654435761 + i) % 2**63)
                mixed ^= mixed >> np.uint64(29)
                mixed *= np.uint64(0xBF58476D1CE4E5B9)
                mixed ^= mixed >> np.uint64(32)
                uniform = ((mixed >> np.uint64(11)).astype(float) + 0.5) / 2.0**53
                cost = squared_distances(rows, near).min(axis=1) if len(near) else np.ones(len(rows))
                keys = np.divide(-np.log(uniform), cost, out=np.full(len(rows), np.inf), where=cost > 0)
                some = np.isfinite(keys)
                found[i] = smallest([found[i], (keys[some], rows[some])], number)
        yield as_batch(found)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(np.zeros(0), np.zeros((0, len(mean)))) for _, mean, _, _ in plan]
        for batch in batches:
            place, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, mean, _, number in plan:
                own = np.flatnonzero(place == i)
                rows = to_matrix(batch.column(2).take(pa.array(own)), len(mean))
                found[i] = smallest([found[i], (keys[own], rows)], number)
        yield as_batch(found)

    schema = "place int, k double, row array<double>"
    drawn = keyed.mapInArrow(sample, schema)
    for limit, parts in ((FOLD_TASKS, FOLD_TASKS), (DIRECT_TASKS, FINAL_TASKS)):
        if tasks > limit:
            drawn = drawn.repartition(parts).mapInArrow(merge, schema)
    out, table = {}, list(merge(drawn.toArrow().combine_chunks().to_batches()))[0]
    place = table.column(0).to_numpy()
    for i, mean, _, _ in plan:
        out[columns[i]] = to_matrix(table.column(2).take(pa.array(np.flatnonzero(place == i))), len(mean))
    return out


def _spread_points(points: np.ndarray, weights: np.ndarray, k: int, random: np.random.Generator) -> np.ndarray:
    # Each next centre: the best of a few candidates drawn by weighted squared distance so far.
    weights = np.maximum(weights, 1e-9)
    chosen = [int(random.choice(len(points), p=weights / weights.sum()))]
    nearest = squared_distances(points, points[chosen])[:, 0]
    trials = 2 + int(np.log(k))
    while len(chosen) < k:
        mass = (nearest * weights).cumsum()
        if mass[-1] <= 0:
            chosen.append(int(random.integers(len(points))))
            continue
        drawn = np.searchsorted(mass, random.random(trials) * mass[-1]).clip(max=len(points) - 1)
        reached = np.minimum(squared_distances(points, points[drawn]), nearest[:, None])
        pick = int((reached * weights[:, None]).sum(axis=0).argmin())
        chosen.append(int(drawn[pick]))
        nearest = reached[:, pick]
    return points[chosen].copy()


@dataclass
class _Scan:
    """Passes over the vector columns of one frame."""

    vectors: DataFrame
    tasks: int
    columns: list[str]
    requests: Sequence[KMeansRequest]
    means: dict[str, np.ndarray]

    def assign_and_sum(self, runs: Sequence[_Run]) -> list[tuple[np.ndarray, np.ndarray, float]]:
        """One pass: per run the coordinate sums and counts of each cluster, and the cost."""
        places = [[i for i, run in enumerate(runs) if self.requests[run.request].column == c] for c in self.columns]
        groups = [
            (index, self.means[column], [runs[i].centers for i in members])
            for index, (column, members) in enumerate(zip(self.columns, places))
            if members
        ]
        sizes = [sum(len(c) for c in centers) * (len(mean) + 2) for _, mean, centers in groups]
        flat = sum_partials(self.vectors, _assign_partial(groups, COPIES in self.vectors.columns), sum(sizes), self.tasks)
        results: list = [None] * len(runs)
        filled = [members for members in places if members]
        for (_, mean, centers), members, cells in zip(groups, filled, np.split(flat, np.cumsum(sizes)[:-1])):
            width = len(mean)
            blocks = np.split(cells.reshape(-1, width + 2), np.cumsum([len(c) for c in centers])[:-1])
            for place, block in zip(members, blocks):
                results[place] = (block[:, :width], block[:, width], float(block[:, -1].sum()))
        return results


def _assign_partial(groups, counted):
    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        sums = [[np.zeros((len(c), len(mean) + 2)) for c in centers] for _, mean, centers in groups]
        seen = False
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = True
            copies = batch.column(batch.num_columns - 1).to_numpy().astype(float) if counted else np.ones(batch.num_rows)
            for (index, mean, centers), blocks in zip(groups, sums):
                rows = to_matrix(batch.column(index), len(mean)) - mean
                squares = np.einsum("ij,ij->i", rows, rows)
                columns = np.ascontiguousarray(rows.T)
                # Coordinates, one, and the row's cost: their sums per cluster are the result.
                padded = np.column_stack([rows * copies[:, None] if counted else rows, copies, squares])
                for center, block in zip(centers, blocks):
                    near = (-2.0 * center) @ columns
                    near += np.einsum("ij,ij->i", center, center)[:, None]
                    lowest = near.min(axis=0)
                    padded[:, -1] = np.maximum(lowest + squares, 0.0) * copies
                    found = (near == lowest).astype(float) @ padded
                    if found[:, -2].sum() != copies.sum():
                        # Equally near centres: the first one takes the row.
                        first = near.argmin(axis=0) == np.arange(len(center))[:, None]
                        found = first.astype(float) @ padded
                    block += found
        return np.concatenate([b.ravel() for blocks in sums for b in blocks]) if seen else None

    return partial


def nearest_centre(vector: Column, centers: np.ndarray) -> Column:
    """Index of the closest centre; the lower index wins a tie. Narrow, stream-safe."""
    k, width = centers.shape
    if k * width <= EXPRESSION_TERMS:
        distances = [
            F.struct(squared_distance_to(vector, center).alias("d"), F.lit(i).alias("i"))
            for i, center in enumerate(centers)
        ]
        return F.array_min(F.array(*distances))["i"]

    @F.arrow_udf("int")
    def label(batch: pa.Array) -> pa.Array:
        return pa.array(_nearest(to_matrix(batch, width), centers), pa.int32())

    return label(vector)


def label_all(df: DataFrame, models: Sequence[KMeansModel], column: str, output: str = "labels") -> DataFrame:
    """One ARRAY<INT> of labels per row, one entry per model, in a single narrow pass."""
    centres = [model.centers for model in models]
    width = centres[0].shape[1]
    if sum(len(c) for c in centres) * width <= EXPRESSION_TERMS:
        return df.withColumn(output, F.array(*[nearest_centre(F.col(column), c) for c in centres]))

    @F.arrow_udf("array<int>")
    def labels(batch: pa.Array) -> pa.Array:
        rows = to_matrix(batch, width)
        found = np.column_stack([_nearest(rows, c) for c in centres])
        return to_lists(found, pa.int32())

    return df.withColumn(output, labels(F.col(column)))


def _nearest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    scores = np.einsum("ij,ij->i", centers, centers) - 2.0 * (rows @ centers.T)
    return scores.argmin(axis=1)
