"""Cluster quality for one or many labellings of the same rows.

Labellings are an ``ARRAY<INT>`` column: entry r holds the row's cluster (0 .. k_r - 1) in
labelling r. Evaluating them together shares every scan and every distance.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from eigenlake.functions.arrow import sorted_groups, to_lists, to_matrix
from eigenlake.functions.blocks import (
    BLOCK_BYTES,
    NearTiles,
    block_count,
    collect_block,
    met_sums,
    point_factor,
    row_factor,
    share,
    squared_distances,
    sum_partials,
    summed_distances,
    task_count,
)
from eigenlake.operators.clean import MatrixShape
from eigenlake.operators.sample import sample_rows
from eigenlake.session import small_side, stage

METRIC_SCHEMA = "run int, metric string, value double"


def _label_sums(df, column, labels, width, bounds, tasks, mean, centres=None):
    """Per labelling and cluster: coordinate sums and count, or (with centres) the summed
    distance and squared distance to the own centre."""
    runs = len(bounds) - 1
    slots = width + 1 if centres is None else 2

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        sums, seen = np.zeros((bounds[-1], slots)), False
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = True
            rows = to_matrix(batch.column(0), width) - mean
            label = to_matrix(batch.column(1), runs).astype(np.int64)
            for run in range(runs):
                start, stop = bounds[run], bounds[run + 1]
                member = (label[:, [run]] == np.arange(stop - start)).astype(float)
                if centres is None:
                    sums[start:stop] += member.T @ np.column_stack([rows, np.ones(len(rows))])
                else:
                    square = ((rows - centres[start:stop][label[:, run]]) ** 2).sum(axis=1)
                    sums[start:stop] += member.T @ np.column_stack([np.sqrt(square), square])
        return sums if seen else None

    return sum_partials(df.select(column, labels), partial, int(bounds[-1]) * slots, tasks).reshape(-1, slots)


def internal_metrics(
    df: DataFrame, ks: Sequence[int], shape: MatrixShape, column: str = "features", labels: str = "labels"
) -> list[dict[str, float]]:
    """Inertia, Calinski-Harabasz and Davies-Bouldin per labelling, from two scans.

    Edge rules: zero within-cluster dispersion gives a Calinski-Harabasz of 1; clusters
    with coincident centres are skipped as Davies-Bouldin pairs.
    """
    bounds = np.concatenate([[0], np.cumsum(ks)]).astype(int)
    rough = df.select(column).limit(1).first()[0]
    tasks = task_count(df.select(column))
    sums = _label_sums(df, column, labels, shape.width, bounds, tasks, np.array(rough, dtype=float))
    counts = sums[:, -1]
    centres = sums[:, :-1] / np.maximum(counts, 1.0)[:, None] + np.array(rough, dtype=float)
    spread = _label_sums(df, column, labels, shape.width, bounds, tasks, np.zeros(shape.width), centres)
    results = []
    for run in range(len(ks)):
        rows = slice(bounds[run], bounds[run + 1])
        used = counts[rows] > 0
        n, centre = counts[rows][used], centres[rows][used]
        distance, square = spread[rows][used].T
        results.append(_dispersion(n, centre, distance, square))
    return results


def _dispersion(n, centre, distance, square) -> dict[str, float]:
    clusters, rows = len(n), n.sum()
    if clusters < 2:
        raise ValueError("The labels name fewer than two clusters")
    within = float(square.sum())
    middle = (centre * n[:, None]).sum(axis=0) / rows
    between = float((n * ((centre - middle) ** 2).sum(axis=1)).sum())
    ch = 1.0 if within == 0 else between * (rows - clusters) / (within * (clusters - 1))
    gaps = np.sqrt(squared_distances(centre - middle, centre - middle))
    np.fill_diagonal(gaps, 0.0)
    mean_distance = distance / n
    pair = np.divide(
        mean_distance[:, None] + mean_distance[None, :], gaps, out=np.zeros_like(gaps), where=gaps > 0
    )
    return {
        "inertia": within,
        "calinski_harabasz": float(ch),
        "davies_bouldin": float(pair.max(axis=1).mean()),
    }


# --- silhouette ---------------------------------------------------------------------


def _row_scores(sums: np.ndarray, label: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Silhouette per row from its summed distances to each cluster of one labelling."""
    place = np.arange(len(label))
    own = counts[label]
    inside = sums[place, label] / np.maximum(own - 1, 1)
    means = np.divide(sums, counts, out=np.full_like(sums, np.inf), where=counts > 0)
    means[place, label] = np.inf
    outside = means.min(axis=1)
    largest = np.maximum(inside, outside)
    score = np.divide(outside - inside, largest, out=np.zeros_like(largest), where=largest > 0)
    return np.where(own > 1, score, 0.0)


def _membership(labels: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    member = np.zeros((len(labels), bounds[-1]))
    for run in range(labels.shape[1]):
        member[np.arange(len(labels)), bounds[run] + labels[:, run]] = 1.0
    return member


# Largest point set that the tasks of a silhouette hold, and the most blocks that a row travels to until points and sums reach twice that size.
SCORE_BYTES = 16 * 1024 * 1024
MOST_BLOCKS = 12
# Rows from which pairs are taken once for both of their rows.
PAIRED_ROWS = 20_000
# Rows from which a score takes all cores.
SPREAD_SCORES = 1_000


def silhouette_scores(
    df: DataFrame,
    row_id: str,
    ks: Sequence[int],
    shape: MatrixShape,
    column: str = "features",
    labels: str = "labels",
    *,
    block_bytes: int = SCORE_BYTES,
) -> DataFrame:
    """Exact Euclidean silhouette of every row: ``(row_id, scores ARRAY<DOUBLE>)``.

    While there are few points, and they fit the block bound, they are shipped to the tasks and each row is
    scored where it is, without a shuffle. Beyond it blocks of the table meet one another, each two of them in one
    task; pairs are summed inside the tasks and never written.
    """
    bounds = np.concatenate([[0], np.cumsum(ks)]).astype(int)
    scored = _scores(_weighted(df, row_id, column, labels), shape, bounds, block_bytes)
    return scored.select(F.col("id").alias(row_id), "scores")


def _weighted(df: DataFrame, row_id: str, column: str, labels: str) -> DataFrame:
    return df.select(
        F.col(f"`{row_id}`").alias("id"),
        F.col(column).alias("point"),
        F.col(labels).cast("array<int>").alias("labels"),
        F.lit(1).cast("bigint").alias("weight"),
    )


def _scores(points: DataFrame, shape: MatrixShape, bounds: np.ndarray, block_bytes: int) -> DataFrame:
    """``(id, scores, weight)`` of ``points(id, point, labels, weight)``, a row of weight w standing for w equal ones."""
    if shape.rows < PAIRED_ROWS and block_count(shape.rows, shape.width + len(bounds) - 1, block_bytes) == 1:
        return _scores_in_place(points, shape, bounds)
    return _scores_by_pairs(points, shape, bounds)


def _scores_in_place(df, shape, bounds):
    carried = df.select("id", "point", F.concat(F.col("labels").cast("array<bigint>"), F.array("weight")).alias("carried"))
    shared = share(df, collect_block(carried, "id", "point", shape.width, "carried"))
    width, runs = shape.width, len(bounds) - 1
    id_type = df.schema["id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, points, carried = shared.value
        centre = points.mean(axis=0)
        points, weights, firsts, member = _combined(points - centre, carried[:, :-1], carried[:, -1], bounds)
        counts = np.add.reduceat(weights, firsts) @ member
        factor = _weighted_factor(points, weights)
        for batch in batches:
            rows = to_matrix(batch.column(1), width) - centre
            label = to_matrix(batch.column(2), runs).astype(np.int64)
            sums = summed_distances(row_factor(rows), factor, firsts, member)
            out = np.column_stack([_row_scores(sums[:, a:b], label[:, run], counts[a:b]) for run, (a, b) in enumerate(zip(bounds, bounds[1:]))])
            yield pa.RecordBatch.from_arrays([batch.column(0), to_lists(out), batch.column(3)], names=["id", "scores", "weight"])

    return df.select("id", "point", "labels", "weight").mapInArrow(score, f"id {id_type}, scores array<double>, weight bigint")


# Blocks of the table that a block of rows meets in one task.
BLOCKS_PER_TASK = 16


def _combined(points: np.ndarray, labels: np.ndarray, weights: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Points ordered by their labels, their weights, the first of every combination, and its clusters: distances are
    added up once per combination, and only these sums are dealt out to the clusters."""
    kinds, place = np.unique(labels, axis=0, return_inverse=True)
    place = place.ravel()
    order = np.argsort(place, kind="stable")
    firsts = np.searchsorted(place[order], np.arange(len(kinds)))
    return points[order], weights[order].astype(float), firsts, _membership(kinds, bounds)


def _weighted_factor(points: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The factor of points whose distances count as often as their weights say."""
    return point_factor(points) * weights**2


def _kinds(labels: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The combination of labels of every row, and the clusters of every combination."""
    found, kinds = np.unique(labels, axis=0, return_inverse=True)
    return kinds.ravel(), _membership(found, bounds)


def _scores_by_pairs(df: DataFrame, shape: MatrixShape, bounds: np.ndarray) -> DataFrame:
    """Silhouettes of all rows of ``df``; only counts per cluster reach the driver.

    Every two blocks of the table, and every block and itself, meet in one task, where a distance is taken once for both of its
    rows. The partial sums of a block come together in a second exchange.
    """
    width, runs, clusters = shape.width, len(bounds) - 1, int(bounds[-1])
    most = max(1, 2 * SCORE_BYTES // (8 * (width + runs + clusters)))
    across = -(-shape.rows // max(1, min(-(-shape.rows // MOST_BLOCKS), most)))
    id_type = df.schema["id"].dataType.simpleString()
    counts = _label_counts(df, runs, bounds)
    own, other = F.col("target"), F.col("other")
    low, high = F.least(own, other), F.greatest(own, other)
    # Seats of two blocks come first, as one block alone is done sooner.
    pairs = across * (across - 1) // 2
    seat = F.when(low < high, (low * (2 * across - low - 1) / 2).cast("int") + high - low - 1).otherwise(pairs + own)
    names = ["id", "point", "labels", "weight"]
    met = (
        df.select(F.pmod(F.xxhash64("id"), F.lit(across)).cast("int").alias("target"), *names)
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("other"))
        .select(seat.alias("seat"), "target", *names)
    )
    keys, kept_names = ["seat", "target"], ["target", "id", "labels", "weight"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(group: pa.Table) -> NearTiles:
            label = to_matrix(group.column("labels"), runs).astype(np.int64)
            return NearTiles(to_matrix(group.column("point"), width), group.column("weight").to_numpy(), *_kinds(label, bounds))

        def partial(group: pa.Table, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(sums), SENT_ROWS):
                part = group.slice(at, SENT_ROWS)
                kept = [part.column(name).combine_chunks() for name in kept_names]
                place = pa.array(np.arange(at, at + part.num_rows), pa.int64())
                yield pa.RecordBatch.from_arrays([*kept, place, to_lists(sums[at : at + SENT_ROWS])], names=[*kept_names, "place", "sums"])

        def meet(groups: list[pa.Table]) -> Iterator[pa.RecordBatch]:
            if len(groups) == 2:
                first, second = map(block, groups)
                found = met_sums(first, second, True)
            elif groups[0].column("seat")[0].as_py() >= pairs:
                alone = block(groups[0])
                found = [met_sums(alone, alone, False)[0]]
            else:
                # No row fell into the other block.
                found = [np.zeros((groups[0].num_rows, clusters))]
            for group, sums in zip(groups, found):
                yield from partial(group, sums)

        held: list[pa.Table] = []
        for group in sorted_groups(batches, keys):
            if held and held[0].column("seat")[0] != group.column("seat")[0]:
                yield from meet(held)
                held = []
            held.append(group)
        if held:
            yield from meet(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Every row has as many partial sums as there are blocks, and they lie together.
        return _merged(batches, across, runs, bounds, counts)

    # Rows of a block have the same order wherever it goes, so that a row is known by its place.
    seated = met.repartitionById(pairs + across, "seat").sortWithinPartitions(*keys, "id", "point", "labels", "weight")
    partials = seated.mapInArrow(add, f"target int, id {id_type}, labels array<int>, weight bigint, place bigint, sums array<double>")
    dealt = partials.repartitionById(across, "target").sortWithinPartitions("target", "place")
    return dealt.mapInArrow(merge, f"id {id_type}, scores array<double>, weight bigint")


# Rows of a batch of partial sums.
SENT_ROWS = 4_096


def _merged(batches: Iterator[pa.RecordBatch], parts: int, runs: int, bounds: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Scores of rows from their partial sums, of which each has ``parts`` in a row."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        rest.append(batch)
        ready = sum(part.num_rows for part in rest) // parts * parts
        if not ready:
            continue
        whole = pa.Table.from_batches(rest)
        group, rest = whole.slice(0, ready), whole.slice(ready).to_batches()
        once = pa.array(np.arange(0, ready, parts))
        sums = to_matrix(group.column("sums"), int(bounds[-1])).reshape(len(once), parts, -1).sum(axis=1)
        label = to_matrix(group.column("labels").take(once), runs).astype(np.int64)
        scores = [_row_scores(sums[:, a:b], label[:, run], counts[a:b]) for run, (a, b) in enumerate(zip(bounds, bounds[1:]))]
        ids, weight = (group.column(name).take(once).combine_chunks() for name in ("id", "weight"))
        yield pa.RecordBatch.from_arrays([ids, to_lists(np.column_stack(scores)), weight], names=["id", "scores", "weight"])


def _scores_by_grid(targets, df, shape, target_rows, bounds, block_bytes) -> DataFrame:
    """Silhouettes of the rows of ``targets``, a few of the table, against all rows of ``df``; only counts per cluster reach the driver.

    A task holds one block of target rows and takes a segment of the table's blocks one after the other; the
    partial sums of a row come together in a second exchange, one task per block of targets. Blocks of large tables
    grow up to the bound, as every row travels to all of them.
    """
    width, runs, clusters = shape.width, len(bounds) - 1, int(bounds[-1])
    most = SCORE_BYTES // (8 * (width + runs + clusters))
    block_rows = max(1, block_bytes // (8 * (width + runs)), min(-(-shape.rows // MOST_BLOCKS), most))
    cores = df.sparkSession.sparkContext.defaultParallelism
    across = max(-(-target_rows // block_rows), min(2 * cores, target_rows), -(-8 * target_rows * clusters // BLOCK_BYTES))
    down = -(-shape.rows // block_rows)
    segments = -(-down // BLOCKS_PER_TASK)
    id_type = df.schema["id"].dataType.simpleString()
    mark = F.xxhash64("id")
    names = ["id", "point", "labels", "weight"]
    counts = _label_counts(df, runs, bounds)
    block = F.pmod(mark, F.lit(down)).cast("int")
    rows = targets.select(
        F.pmod(mark, F.lit(across)).cast("int").alias("target"),
        F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("segment"),
        F.lit(-1).alias("block"),
        *names,
    )
    table = df.select(
        F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("target"),
        F.floor(block / BLOCKS_PER_TASK).cast("int").alias("segment"),
        block.alias("block"),
        *names,
    )
    keys = ["target", "segment", "block"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, points, sums = None, None, None, None

        def partial() -> pa.RecordBatch:
            kept = ["target", "id", "labels", "weight"]
            return pa.RecordBatch.from_arrays([*[held.column(name).combine_chunks() for name in kept], to_lists(sums)], names=[*kept, "sums"])

        for group in sorted_groups(batches, keys):
            here = tuple(group.column(name)[0].as_py() for name in keys[:2])
            if here != key:
                if held is not None:
                    yield partial()
                key, held = here, None
            if group.column("block")[0].as_py() < 0:
                held, points = group, to_matrix(group.column("point"), width)
                sums = np.zeros((len(points), bounds[-1]))
            elif held is not None:
                label = to_matrix(group.column("labels"), runs).astype(np.int64)
                others, weights, firsts, member = _combined(
                    to_matrix(group.column("point"), width), label, group.column("weight").to_numpy(), bounds
                )
                centre = others.mean(axis=0)
                sums += summed_distances(row_factor(points - centre), _weighted_factor(others - centre, weights), firsts, member)
        if held is not None:
            yield partial()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Every row has as many partial sums as there are segments, and they lie together.
        return _merged(batches, segments, runs, bounds, counts)

    met = rows.unionByName(table).repartition("target", "segment").sortWithinPartitions(*keys)
    partials = met.mapInArrow(add, f"target int, id {id_type}, labels array<int>, weight bigint, sums array<double>")
    dealt = partials.repartition("target").sortWithinPartitions("target", "id")
    return dealt.mapInArrow(merge, f"id {id_type}, scores array<double>, weight bigint")


def _label_counts(df: DataFrame, runs: int, bounds: np.ndarray) -> np.ndarray:
    counts = np.zeros(bounds[-1])
    found = df.select("weight", F.posexplode("labels").alias("run", "cluster")).groupBy("run", "cluster").agg(F.sum("weight").alias("n"))
    for row in found.collect():
        counts[bounds[row["run"]] + row["cluster"]] = row["n"]
    return counts


def silhouette(df, row_id, ks, shape, column="features", labels="labels", *, sample=None, seed=42):
    """Mean silhouette per labelling: exact over all rows, at any size.

    Rows with equal points and labels have one score, so they are taken once, with their number as weight: the work is
    quadratic in the different rows. ``sample`` is for callers who want linear cost: the mean over that many rows in hash order,
    each measured against every row.
    """
    bounds = np.concatenate([[0], np.cumsum(ks)]).astype(int)
    if sample is None or shape.rows <= sample:
        points, rows = _different(df, column, labels)
        scored = _scores(points, MatrixShape(rows, shape.width), bounds, SCORE_BYTES)
    else:
        chosen = sample_rows(df, row_id, max_samples=sample, seed=seed, rows=shape.rows)
        targets, points = (_weighted(frame, row_id, column, labels) for frame in (chosen, df))
        scored = _scores_by_grid(targets, points, shape, sample, bounds, SCORE_BYTES)
    total = F.sum("weight")
    means = scored.agg(*[F.sum(F.col("scores")[r] * F.col("weight")) / total for r in range(len(ks))]).first()
    return [float(v) for v in means]


def _different(df: DataFrame, column: str, labels: str) -> tuple[DataFrame, int]:
    """``(id, point, labels, weight)``: the different rows of a table and how often each occurs; and their number."""
    keys = [F.col(column).alias("point"), F.col(labels).cast("array<int>").alias("labels")]
    kept = stage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("weight")), "different")
    points, rows = kept.select(F.monotonically_increasing_id().alias("id"), "point", "labels", "weight"), kept.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    return (points.repartition(cores, "id") if rows >= SPREAD_SCORES and task_count(kept) < cores else points), rows


def silhouette_squared(df: DataFrame, column: str = "features", cluster: str = "cluster") -> float:
    """Silhouette under the squared Euclidean distance: linear cost, another quantity."""
    vectors = df.select(array_to_vector(F.col(column)).alias("v"), F.col(cluster).cast("double").alias("c"))
    return ClusteringEvaluator(featuresCol="v", predictionCol="c", distanceMeasure="squaredEuclidean").evaluate(vectors)


# --- agreement with a reference label -------------------------------------------------


def contingency(df: DataFrame, reference: str, labels: str = "labels") -> DataFrame:
    """``(run, reference, cluster, n)`` of every labelling against one reference column."""
    return (
        df.select(F.col(f"`{reference}`").alias("reference"), F.posexplode(labels).alias("run", "cluster"))
        .groupBy("run", "reference", "cluster")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def agreement(table: DataFrame) -> DataFrame:
    """``(run, adjusted_rand_index, normalized_mutual_information)`` from a contingency
    table. Edge rules: a zero denominator gives an index of 1; no mutual information gives
    0, and two single-class labellings agree with 1."""
    n = F.col("n").cast("double")
    pairs = n * (n - 1) / 2
    entropy_term = n * F.log(n)
    cells = table.groupBy("run").agg(
        F.sum(pairs).alias("together"), F.sum(entropy_term).alias("cell_log"), F.sum(n).alias("rows")
    )

    def margin(key: str, pair_name: str, log_name: str, classes: str) -> DataFrame:
        return (
            table.groupBy("run", key).agg(F.sum("n").alias("n")).groupBy("run").agg(
                F.sum(pairs).alias(pair_name), F.sum(entropy_term).alias(log_name), F.count(F.lit(1)).alias(classes)
            )
        )

    joined = cells.join(margin("reference", "ref_pairs", "ref_log", "ref_classes"), "run").join(
        margin("cluster", "cl_pairs", "cl_log", "cl_classes"), "run"
    )
    rows = F.col("rows")
    expected = F.col("ref_pairs") * F.col("cl_pairs") / (rows * (rows - 1) / 2)
    ceiling = (F.col("ref_pairs") + F.col("cl_pairs")) / 2
    rand = F.when(ceiling == expected, 1.0).otherwise(
        F.try_divide(F.col("together") - expected, ceiling - expected)
    )
    ref_entropy = F.log(rows) - F.col("ref_log") / rows
    cl_entropy = F.log(rows) - F.col("cl_log") / rows
    mutual = F.greatest(ref_entropy + cl_entropy - (F.log(rows) - F.col("cell_log") / rows), F.lit(0.0))
    single = (F.col("ref_classes") == 1) & (F.col("cl_classes") == 1)
    information = F.when(single, 1.0).otherwise(
        F.coalesce(F.try_divide(mutual, (ref_entropy + cl_entropy) / 2), F.lit(0.0))
    )
    return joined.select("run", rand.alias("adjusted_rand_index"), information.alias("normalized_mutual_information"))


def class_counts(df: DataFrame, group: str) -> DataFrame:
    """Rows per class; a missing class counts as ``<missing>``."""
    name = F.coalesce(F.col(f"`{group}`").cast("string"), F.lit("<missing>"))
    return df.groupBy(name.alias("class")).agg(F.count(F.lit(1)).alias("n"))


def group_views(df: DataFrame, group: str, keep: Sequence[str]) -> DataFrame:
    """Rows of every group with at least two rows, with their global cluster labels."""
    counted = df.where(F.col(f"`{group}`").isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("__rows"))
    kept = stage(counted.where(F.col("__rows") >= 2).select(group), "groups")
    return df.join(small_side(kept), group, "left_semi").select(*[f"`{c}`" for c in [group, *keep]])


def evaluate_labellings(
    df: DataFrame,
    row_id: str,
    ks: Sequence[int],
    shape: MatrixShape,
    *,
    column: str | Sequence[str] = "features",
    labels: str = "labels",
    reference: str | Sequence[str | None] | None = None,
    silhouette_sample: int | None = None,
    seed: int = 42,
) -> list[dict[str, float]]:
    """All metrics of every labelling; agreement metrics only with a reference column, one for all labellings or one for each.

    ``column`` is one for all labellings, or one for each; all of them then have the same distances between rows.
    """
    references = [reference] * len(ks) if reference is None or isinstance(reference, str) else list(reference)
    columns = [column] * len(ks) if isinstance(column, str) else list(column)
    results: list = [None] * len(ks)
    for name in dict.fromkeys(columns):
        own = [i for i, other in enumerate(columns) if other == name]
        some = df if len(own) == len(ks) else df.withColumn(labels, F.array(*[F.col(labels)[i] for i in own]))
        for i, found in zip(own, internal_metrics(some, [ks[i] for i in own], shape, name, labels)):
            results[i] = found
    means = silhouette(df, row_id, ks, shape, columns[0], labels, sample=silhouette_sample, seed=seed)
    for result, value in zip(results, means):
        result["silhouette"] = value
    for name in dict.fromkeys(r for r in references if r is not None):
        for row in agreement(contingency(df, name, labels)).collect():
            if references[row["run"]] == name:
                results[row["run"]]["adjusted_rand_index"] = row["adjusted_rand_index"]
                results[row["run"]]["normalized_mutual_information"] = row["normalized_mutual_information"]
    return results
