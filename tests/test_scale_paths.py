"""Paths for tables beyond one block, against the plain ones and brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import column
from eigenlake.operators import cluster_metrics as cm, descent, explore, kmeans, neighbours, series
from eigenlake.operators.clean import MatrixShape


def near_lists(table):
    found = {}
    for r in table.collect():
        found.setdefault(r["row_id"], []).append((r["rank"], r["neighbour"], r["distance"]))
    return {i: sorted(rows) for i, rows in found.items()}


def brute_lists(x, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = {}
    for i in range(len(x)):
        order = [j for j in np.lexsort((np.arange(len(x)), d[i])) if j != i][:k]
        out[i] = [(r + 1, int(j), d[i, j]) for r, j in enumerate(order)]
    return out


def same_lists(got, want):
    assert got.keys() == want.keys()
    for i in want:
        assert [(r, j) for r, j, _ in got[i]] == [(r, j) for r, j, _ in want[i]]
        np.testing.assert_allclose([d for *_, d in got[i]], [d for *_, d in want[i]], atol=1e-10)


def clustered(rng, clusters, rows, width, spread=0.05):
    return (rng.uniform(-10, 10, (clusters, 1, width)) + rng.normal(0, spread, (clusters, rows, width))).reshape(-1, width)


@pytest.mark.parametrize("shape", ["clustered", "even", "copies", "line"])
def test_pruned_join_equals_brute_force(matrix_frame, shape):
    rng = np.random.default_rng(5)
    x = {
        "clustered": clustered(rng, 12, 25, 3),
        "even": rng.uniform(size=(300, 3)),
        # A third of all rows are one point.
        "copies": np.vstack([np.zeros((100, 3)), rng.normal(size=(200, 3))]),
        "line": np.column_stack([np.arange(300.0) ** 1.5, np.zeros(300), np.zeros(300)]),
    }[shape]
    found = neighbours.nearest_neighbours(matrix_frame(x), "row_id", 4, MatrixShape(*x.shape), block_bytes=20 * 24)
    same_lists(near_lists(found), brute_lists(x, 4))


def test_pruning_sends_less_of_clustered_data(matrix_frame):
    rng = np.random.default_rng(6)
    shares = []
    for x in (rng.normal(size=(600, 8)), clustered(rng, 30, 20, 8)):
        cells = neighbours.PivotCells(matrix_frame(x), "row_id", 5, MatrixShape(600, 8), "features", 40 * 64)
        shares.append(cells.copies().sum() / (600 * len(cells.pivots)))
    # Of all points sent to all cells; clustered ones go to a few.
    assert shares[1] < 0.25 < shares[0] <= 1


def test_silhouettes_by_grid(matrix_frame, monkeypatch):
    monkeypatch.setattr(cm, "BLOCKS_PER_TASK", 3)
    rng = np.random.default_rng(7)
    x = rng.normal(size=(180, 4))
    first, second = rng.integers(0, 5, 180).tolist(), rng.integers(0, 2, 180).tolist()
    first[0] = 5
    df = matrix_frame(x, one=first, two=second).withColumn("labels", F.array(F.col("one").cast("int"), F.col("two").cast("int"))).cache()
    shape = MatrixShape(180, 4)
    whole = column(cm.silhouette_scores(df, "row_id", [6, 2], shape), "scores")
    # 12 blocks in 4 segments: partial sums of a row come from several tasks.
    grid = cm.silhouette_scores(df, "row_id", [6, 2], shape, block_bytes=15 * 8 * 6)
    assert grid.count() == 180
    np.testing.assert_allclose(column(grid, "scores"), whole, atol=1e-9)
    assert whole[0, 0] == 0.0


@pytest.mark.parametrize("shape", ["clustered", "even", "copies"])
def test_descent_reaches_its_recall(matrix_frame, shape):
    rng = np.random.default_rng(8)
    x = {
        "clustered": clustered(rng, 20, 40, 6, 0.5),
        "even": rng.uniform(size=(800, 5)),
        "copies": np.vstack([np.zeros((200, 5)), rng.normal(size=(600, 5))]),
    }[shape]
    found = descent.descend(matrix_frame(x), "row_id", 8, MatrixShape(*x.shape))
    got, want = near_lists(found.edges), brute_lists(x, 8)
    assert all([r for r, *_ in got[i]] == list(range(1, 9)) for i in want) and len(got) == 800
    # Among copies any of the equally near rows will do.
    hits = np.mean([sum(d <= want[i][-1][2] + 1e-9 for *_, d in got[i]) / 8 for i in want])
    assert hits >= 0.9
    if shape != "copies":
        exact = np.mean([len({j for _, j, _ in got[i]} & {j for _, j, _ in want[i]}) / 8 for i in want])
        assert exact >= 0.9 and abs(exact - found.parameters["recall"]) < 0.06


def test_descent_of_few_rows(matrix_frame):
    x = np.random.default_rng(2).normal(size=(12, 2))
    found = descent.descend(matrix_frame(x), "row_id", 4, MatrixShape(12, 2))
    same_lists(near_lists(found.edges), brute_lists(x, 4))
    assert found.parameters["recall"] == 1.0
    with pytest.raises(ValueError, match="n_neighbors"):
        descent.descend(matrix_frame(x), "row_id", 12, MatrixShape(12, 2))


def test_density_error_is_within_its_bound(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(0, 1, 4000), rng.exponential(5, 1000), [250.0]])
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    curve = explore.feature_density(df, ["x"], points=60).orderBy("point").toPandas()
    width = values.std(ddof=1) * len(values) ** -0.2
    exact = np.exp(-0.5 * ((curve.x.to_numpy()[:, None] - values[None]) / width) ** 2).sum(1) / (len(values) * width * np.sqrt(2 * np.pi))
    assert np.abs(curve.density - exact).max() <= 2e-11 / (width * np.sqrt(2 * np.pi)) + 1e-15


def test_trajectory_of_a_wide_window(spark):
    rng = np.random.default_rng(4)
    values = np.sin(np.arange(4000) / 30) + rng.normal(0, 0.3, 4000)
    frame = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(values)], "series_id string, t bigint, value double").repartition(4)
    window = 1200
    cut = series.blocked(frame, series.check_series(frame, 2, window), 500)
    found = series.trajectory_bases(cut, 2, 500).first()
    views = np.lib.stride_tricks.sliding_window_view(values, window)
    gram = views.T @ views
    assert found["energy"] == pytest.approx(np.trace(gram), rel=1e-12)
    basis = np.array(found["basis"]).reshape(window, 2)
    lam = np.linalg.eigvalsh(gram)[::-1][:2]
    np.testing.assert_allclose(gram @ basis, basis * lam, atol=1e-8 * lam[0])


def test_starting_rows(matrix_frame):
    rng = np.random.default_rng(9)
    x = clustered(rng, 3, 30, 2, 0.3)
    df = matrix_frame(x).cache()
    found = kmeans.fit_kmeans(df, "row_id", ks=[2, 3], start_rows=[0, 30, 60], max_iter=1, tol=0.0, shape=MatrixShape(90, 2))
    starts = x[[0, 30, 60]]
    label = ((x[:, None] - starts[None]) ** 2).sum(-1).argmin(1)
    np.testing.assert_allclose(found[3].centers, [x[label == c].mean(0) for c in range(3)])
    assert found[2].k == 2
    with pytest.raises(ValueError, match="starting rows"):
        kmeans.fit_kmeans(df, "row_id", ks=[3], start_rows=[0, 1])
    with pytest.raises(ValueError, match="No rows"):
        kmeans.fit_kmeans(df, "row_id", ks=[2], start_rows=[0, 1000])
