"""Clustering and neighbour steps whose work follows the different rows, and whose memory is bounded."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eigenlake.functions import blocks
from eigenlake.functions.numeric import tidy, tidy_many
from eigenlake.operators import affinity, cluster_metrics as cm, kmeans, neighbours
from eigenlake.operators.clean import MatrixShape
from test_clustering import brute_silhouette


def between(x, y):
    return np.sqrt(((x[:, None] - y[None]) ** 2).sum(-1))


@pytest.mark.parametrize("bound", [cm.SCORE_BYTES, 400])
def test_copies_are_scored_once(matrix_frame, monkeypatch, bound):
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(30, 3)), 4, axis=0)
    labels = np.repeat(rng.integers(0, 3, 30), 4)
    labels[:2] = (labels[0] + 1) % 3  # equal points of two clusters are two different rows
    df = matrix_frame(x, one=labels.tolist()).withColumn("labels", F.array(F.col("one").cast("int"))).cache()
    met = []
    place = cm._scores
    monkeypatch.setattr(cm, "SCORE_BYTES", bound)
    monkeypatch.setattr(cm, "_scores", lambda points, shape, *rest: met.append((points.count(), shape.rows)) or place(points, shape, *rest))
    [value] = cm.silhouette(df, "row_id", [3], MatrixShape(120, 3))
    assert met == [(31, 31)]
    assert value == pytest.approx(brute_silhouette(x, labels).mean(), abs=1e-7)


def test_passes_take_copies_once(matrix_frame):
    x = np.repeat(np.random.default_rng(6).normal(size=(40, 3)), 5, axis=0)
    df = matrix_frame(x).cache()
    vectors, _ = kmeans._different(df.select("features"), ["features"], 200, 3)
    assert vectors.count() == 40 and vectors.agg(F.sum(kmeans.COPIES)).first()[0] == 200
    alone, _ = kmeans._different(df.where("row_id % 5 = 0").select("features"), ["features"], 40, 3)
    assert alone.columns == ["features"]
    model = kmeans.fit_kmeans(df, "row_id", ks=[4], init=x[:20:5], max_iter=3, tol=0.0)[4]
    centres = x[:20:5]
    for _ in range(3):
        own = between(x, centres).argmin(axis=1)
        centres = np.array([x[own == c].mean(axis=0) for c in range(4)])
    np.testing.assert_allclose(model.centers, centres, atol=1e-9)
    assert model.inertia == pytest.approx((between(x, centres).min(axis=1) ** 2).sum())


def test_sums_are_dealt_out_tile_by_tile(monkeypatch):
    rng = np.random.default_rng(7)
    x, y = rng.normal(size=(50, 3)), rng.normal(size=(40, 3))
    member = rng.integers(0, 2, (40, 5)).astype(float)
    monkeypatch.setattr(blocks, "TILE_CELLS", 200)
    got = blocks.summed_distances(blocks.row_factor(x), blocks.point_factor(y), np.arange(40), member)
    np.testing.assert_allclose(got, between(x, y) @ member, atol=1e-9)


def test_many_cells_are_folded_before_the_driver(matrix_frame, monkeypatch):
    x = np.random.default_rng(8).normal(size=(90, 2))
    df = matrix_frame(x, partitions=9).select("features")
    sent = []
    to_matrix = blocks.to_matrix
    monkeypatch.setattr(blocks, "DIRECT_CELLS", 10)
    monkeypatch.setattr(blocks, "to_matrix", lambda column, width: sent.append(len(column)) or to_matrix(column, width))

    def partial(batches, matrix=to_matrix):
        found = [matrix(batch.column(0), 2).sum(axis=0) for batch in batches if batch.num_rows]
        return sum(found) if found else None

    np.testing.assert_allclose(blocks.sum_partials(df, partial, 2, 9), x.sum(axis=0), atol=1e-9)
    assert sent[-1] <= blocks.FEW_TASKS


def test_dense_pairs_of_many_rows_are_not_refused():
    neighbours._require_bounded(MatrixShape(100_000, 64))
    with pytest.raises(ValueError, match="bounded"):
        neighbours._require_bounded(MatrixShape(1_000_000, 64))


def test_rows_bisect_alike_in_any_company(monkeypatch):
    d2 = np.random.default_rng(9).uniform(1, 9, size=(30, 50))
    whole = affinity.calibrate(d2, 5.0)
    monkeypatch.setattr(affinity, "CALIBRATED_CELLS", 120)
    for together, apart in zip(whole, affinity.calibrate(d2, 5.0)):
        np.testing.assert_array_equal(together, apart)


def test_divergence_with_ids_from_the_sample(spark, matrix_frame):
    x = np.random.default_rng(10).normal(size=(20, 3))
    df = matrix_frame(x).cache()
    joint = affinity.joint_affinities(df, "row_id", MatrixShape(20, 3), 4.0)
    embedding = df.select("row_id", F.slice("features", 1, 2).alias("embedding"))
    alone = affinity.kl_divergence(joint, embedding, "row_id", 20, 2)
    assert affinity.kl_divergence(joint, embedding, "row_id", 20, 2, ids=df) == pytest.approx(alone)


def test_blocks_of_cells_grow_with_the_table(matrix_frame, monkeypatch):
    monkeypatch.setattr(neighbours, "MOST_PIVOTS", 4)
    x = np.random.default_rng(11).normal(size=(200, 2))
    cells = neighbours.PivotCells(matrix_frame(x), "row_id", 3, MatrixShape(200, 2), "features", 5 * 16)
    assert cells.block_rows == 200
    found = {r["row_id"]: [b["id"] for b in r["best"]] for r in cells.best().collect()}
    d = between(x, x)
    np.fill_diagonal(d, np.inf)
    assert all(found[i] == np.argsort(d[i])[:3].tolist() for i in range(200))


def test_blocks_of_a_grid_grow_with_the_table(matrix_frame, monkeypatch):
    rng = np.random.default_rng(12)
    x, labels = rng.normal(size=(120, 3)), rng.integers(0, 3, 120)
    df = matrix_frame(x, one=labels.tolist()).withColumn("labels", F.array(F.col("one").cast("int"))).cache()
    monkeypatch.setattr(cm, "MOST_BLOCKS", 4)
    cuts = []
    monkeypatch.setattr(cm.F, "pmod", lambda a, b, pmod=F.pmod: cuts.append(str(b)) or pmod(a, b))
    scored = cm.silhouette_scores(df, "row_id", [3], MatrixShape(120, 3), block_bytes=100)
    assert any("4" in cut for cut in cuts) and not any("40" in cut for cut in cuts)
    np.testing.assert_allclose([r["scores"][0] for r in scored.orderBy("row_id").collect()], brute_silhouette(x, labels), atol=1e-7)


@pytest.mark.parametrize("runs", [4, 30, 90])
def test_sums_of_distances_stay_in_cache(monkeypatch, runs):
    rng = np.random.default_rng(13)
    x, y = rng.normal(size=(50, 3)), rng.normal(size=(90, 3))
    firsts = np.sort(np.concatenate([[0], rng.choice(np.arange(1, 90), runs - 1, replace=False)]))
    member = rng.integers(0, 2, (runs, 5)).astype(float)
    monkeypatch.setattr(blocks, "SUMMED_ROWS", 7)
    monkeypatch.setattr(blocks, "SUMMED_POINTS", 11)
    sizes = []
    sqrt = np.sqrt
    monkeypatch.setattr(blocks.np, "sqrt", lambda d, **options: sizes.append(d.shape) or sqrt(d, **options))
    got = blocks.summed_distances(blocks.row_factor(x), blocks.point_factor(y), firsts, member)
    monkeypatch.undo()
    # However many rows and points there are.
    assert sizes and all(rows <= 7 and points <= 11 for rows, points in sizes)
    np.testing.assert_allclose(got, between(x, y) @ np.repeat(member, np.diff(firsts, append=90), axis=0), atol=1e-9)


def plain_bisection(d, goal):
    """``(beta, steps)`` of one row in double precision alone."""
    beta, low, high = 1.0, -np.inf, np.inf
    for step in range(affinity.BISECTION_STEPS):
        weights, used = np.exp(-beta * d), beta
        mass = weights.sum()
        found = np.log(len(d)) if mass <= affinity.VANISHED else np.log(mass) + beta * (d @ weights) / mass
        if abs(found - goal) < affinity.ENTROPY_TOLERANCE:
            break
        if found > goal:
            low, beta = beta, beta * 2 if np.isinf(high) else (beta + high) / 2
        else:
            high, beta = beta, beta / 2 if np.isinf(low) else (beta + low) / 2
    return used, step + 1


def test_most_bisection_steps_are_cheap(monkeypatch):
    rng = np.random.default_rng(14)
    copies = rng.uniform(0, 9, (10, 80))
    copies[:, :30] = 0
    rows = [rng.uniform(1, 9, (40, 80)), rng.uniform(1, 9, (10, 80)) * 1e4, rng.uniform(1, 9, (10, 80)) * 1e-9, copies, 690 + rng.uniform(0, 2, (10, 80)), np.zeros((2, 80)), rng.uniform(1, 9, (5, 80)) * 1e60]
    cells = []
    exp = np.exp
    for d in rows:
        want = [plain_bisection(row, np.log(20.0)) for row in d]
        monkeypatch.setattr(affinity.np, "exp", lambda x, **options: cells.append((x.dtype, x.size)) or exp(x, **options))
        beta, _, _ = affinity.calibrate(d, 20.0)
        monkeypatch.undo()
        np.testing.assert_array_equal(beta, [used for used, _ in want])
        if d is rows[0]:
            double = sum(size for kind, size in cells if kind == np.float64)
            assert double < 0.7 * sum(steps for _, steps in want) * d.shape[1]
    assert affinity.calibrate(np.zeros((0, 5)), 2.0)[0].shape == (0,)


def test_many_values_are_rounded_alike(spark):
    rng = np.random.default_rng(15)
    values = [*rng.uniform(-1e-6, 1e-6, 300), *rng.normal(size=300), *rng.normal(0, 1e12, 50), *(k / 1e8 + 5e-9 for k in range(-50, 50)), 0.285, 1.005, 0.0, -0.0, -1e-12, 5e-9, -5e-9, 1.5e300]
    values += [float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    for digits in (2, 6, 8):
        found = df.select(tidy(F.col("x"), digits).alias("a"), tidy_many(F.col("x"), digits).alias("b"))
        assert all(repr(r["a"]) == repr(r["b"]) for r in found.collect())
    # Few values need decimals.
    plan = df.select(tidy_many(F.col("x"), 8))._jdf.queryExecution().toString()
    assert "rint" in plan.lower()
