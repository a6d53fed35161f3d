"""Mergeable state, leading directions of wide tables, and graph layouts, against NumPy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import column
from eigenlake.operators import krylov, layout, mergeable
from eigenlake.operators.spectral import fit_pca, fit_svd
from eigenlake.plans import jobs


@pytest.mark.parametrize("method, fit", [("pca", fit_pca), ("svd", fit_svd)])
def test_merged_parts_equal_the_whole(spark, tmp_path, matrix_frame, method, fit):
    rng = np.random.default_rng(1)
    # Parts of unlike means and sizes; one of them is a single row.
    x = np.vstack([rng.normal(5, 3, (70, 5)), rng.normal(-100, 0.5, (40, 5)) * [1, 2, 3, 4, 5], rng.normal(size=(1, 5))])
    df = matrix_frame(x).cache()
    cuts = [F.col("row_id") < 70, (F.col("row_id") >= 70) & (F.col("row_id") < 110), F.col("row_id") == 110]
    parts = []
    for i, cut in enumerate(cuts):
        mergeable.measure(df.where(cut)).save(spark, str(tmp_path / f"p{i}"))
        parts.append(mergeable.load_moments(spark, str(tmp_path / f"p{i}")))
    whole = mergeable.merge(parts)
    np.testing.assert_allclose(whole.mean, x.mean(0))
    np.testing.assert_allclose(whole.deviations, x.std(0))
    model, direct = whole.model(method, n_components=3), fit(df, n_components=3)
    np.testing.assert_allclose(model.variance, direct.variance, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(model.components, direct.components, atol=1e-8)
    assert (model.rows_seen, model.count) == (direct.rows_seen, 3)
    with pytest.raises(ValueError, match="do not add up"):
        whole.merged(mergeable.Moments(3, np.zeros(2), np.zeros((2, 2))))


def test_few_rows_and_lost_cells(spark, tmp_path, matrix_frame):
    x = np.random.default_rng(4).normal(size=(3, 5))
    state = mergeable.measure(matrix_frame(x))
    pca, svd = state.model("pca", n_components=2), state.model("svd", n_components=2)
    assert len(pca.variance) == 5 and len(svd.variance) == 3
    state.save(spark, str(tmp_path / "a"))
    spark.read.parquet(str(tmp_path / "a")).where("NOT (kind = 'factor' AND i = 0 AND j = 1)").write.parquet(str(tmp_path / "b"))
    with pytest.raises(ValueError, match="lack cells"):
        mergeable.load_moments(spark, str(tmp_path / "b"))


def test_histograms_add_up(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.lognormal(2, 3, 3000), -rng.exponential(1e-3, 500), np.zeros(100)])
    rng.shuffle(x)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "i": range(len(x))})).withColumn("y", F.when(F.col("i") % 5 == 0, F.lit(float("nan"))).otherwise(-F.col("x")))
    merged = mergeable.merge_histograms([mergeable.histograms(df.where(F.col("i") % 3 == p), ["x", "y"]) for p in range(3)]).cache()
    direct = mergeable.histograms(df, ["x", "y"])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, direct.collect()))
    for share in (0.05, 0.14, 0.5, 0.9):
        exact = np.sort(x)[int(np.ceil(share * len(x))) - 1]
        assert mergeable.quantiles(merged, share)["x"] == pytest.approx(exact, rel=0.012, abs=1e-12)


def decaying(rng, rows, width, values):
    u = np.linalg.qr(rng.normal(size=(rows, len(values))))[0]
    v = np.linalg.qr(rng.normal(size=(width, len(values))))[0]
    return (u * values) @ v.T + rng.normal(size=width)


def test_leading_directions_of_wide_rows(matrix_frame):
    rng = np.random.default_rng(3)
    x = decaying(rng, 150, 220, 100 * 0.93 ** np.arange(120))
    found = krylov.fit_leading(matrix_frame(x).cache(), 50, 220, tol=1e-13)
    u, sigma, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    np.testing.assert_allclose(found.singular_values, sigma[:50], rtol=1e-8)
    np.testing.assert_allclose(np.abs((found.basis[:20] * vt[:20]).sum(1)), 1.0, atol=1e-7)
    np.testing.assert_allclose(found.ratio, sigma[:50] ** 2 / (sigma**2).sum(), rtol=1e-8)
    reduced = column(found.transform(matrix_frame(x)), "reduced")
    np.testing.assert_allclose(reduced, (x - x.mean(0)) @ found.basis.T, atol=1e-9)


def test_leading_directions_span_a_narrow_table(matrix_frame):
    x = np.random.default_rng(5).normal(size=(200, 12))
    found = krylov.fit_leading(matrix_frame(x).cache(), 6, 12)
    np.testing.assert_allclose(found.singular_values, np.linalg.svd(x - x.mean(0))[1][:6], rtol=1e-10)
    for count, width in ((0, 12), (13, 12)):
        with pytest.raises(ValueError, match="wanted"):
            krylov.fit_leading(matrix_frame(x), count, width)


def test_leading_directions_of_sparse_rows(spark):
    # 100,000 columns: a matrix of all of them would take 80 GB.
    rng, width, rows = np.random.default_rng(6), 100_000, 400
    data, topics = [], [rng.choice(width, 60, replace=False) for _ in range(4)]
    for i in range(rows):
        places = np.unique(np.concatenate([rng.choice(topics[i % 4], 40), rng.choice(width, 10)]))
        values = np.where(np.isin(places, topics[i % 4]), 3.0 + i % 4, 1.0)
        data.append((i, (places.tolist(), values.tolist())))
    schema = "row_id long, features struct<indices array<int>, values array<double>>"
    df = spark.createDataFrame([*data, (rows, ([], []))], schema).repartition(4).cache()
    found = krylov.fit_leading(df, 3, width, tol=1e-12)
    used = np.unique(np.concatenate([d[1][0] for d in data]))
    x = np.zeros((rows + 1, len(used)))
    for i, (places, values) in data:
        x[i, np.searchsorted(used, places)] = values
    sigma = np.linalg.svd(x - x.mean(0), compute_uv=False)
    np.testing.assert_allclose(found.singular_values, sigma[:3], rtol=1e-8)
    assert found.basis.shape == (3, width)
    reduced = column(found.transform(df.drop("other")), "reduced")
    np.testing.assert_allclose(reduced, (x - x.mean(0)) @ found.basis[:, used].T, atol=1e-8)


def student(y):
    near = 1 / (1 + ((y[:, None] - y[None]) ** 2).sum(-1))
    np.fill_diagonal(near, 0)
    return near


def test_repulsion_of_the_grid(spark):
    rng = np.random.default_rng(7)
    for scale in (0.01, 3.0, 30.0):
        y = rng.normal(0, scale, (300, 2))
        points = spark.createDataFrame(pd.DataFrame(y, columns=["x", "y"])).repartition(3).cache()
        grid = layout._Grid.over(points)
        near = student(y)
        assert grid.normaliser == pytest.approx(near.sum(), rel=1e-2)
        place, weight = grid.nodes(y.T)
        read = [(weight * grid.field[k][place]).sum(1) for k in range(1, 4)]
        exact = (near[:, :, None] ** 2 * (y[:, None] - y[None])).sum(1)
        found = np.stack([y[:, a] * read[0] - read[1 + a] for a in range(2)], axis=1)
        assert np.abs(found - exact).max() < 0.02 * np.abs(exact).max()


def test_layout_of_a_neighbour_graph(spark):
    rng = np.random.default_rng(8)
    x = np.vstack([rng.normal(c, 0.4, (40, 4)) for c in (-3, 0, 3)])
    df = spark.createDataFrame([(i, *map(float, r), i // 40) for i, r in enumerate(x)], "row_id long, a double, b double, c double, d double, label int")
    graph = jobs.knn_graph(df, target="label", row_id="row_id", max_samples=None, n_neighbors=10, layout_steps=40)
    found = graph["coordinates"].orderBy("row_id").collect()
    y = np.array([(r["x"], r["y"]) for r in found])
    assert y.shape == (120, 2) and np.isfinite(y).all()
    facts = {r["parameter"]: r["value"] for r in graph["parameters"].collect()}
    # Rows lie among their own kind.
    d = ((y[:, None] - y[None]) ** 2).sum(-1) + np.diag(np.full(120, np.inf))
    assert np.mean(d.argmin(1) // 40 == np.arange(120) // 40) > 0.8
    from eigenlake.operators.affinity import neighbour_affinities

    weights = neighbour_affinities(graph["edges"], "row_id", 10 / 3).collect()
    near = student(y)
    exact = sum(w.weight * np.log(w.weight * near.sum() / near[w.i, w.j]) for w in weights)
    assert facts["layout_kl_divergence"] == pytest.approx(exact, abs=0.01)


def test_divergence_falls(spark):
    rng = np.random.default_rng(9)
    ids = spark.range(60).withColumnRenamed("id", "row_id")
    pairs = [(i, j) for i in range(60) for j in range(60) if i != j and i // 20 == j // 20]
    edges = spark.createDataFrame([(i, j, 1 / len(pairs)) for i, j in pairs], "i long, j long, weight double").repartition(2)
    found = layout.lay_out(edges, ids, "row_id", 60, steps=24, early_steps=6, report_every=12)
    values = [found.divergence[step] for step in sorted(found.divergence)]
    assert values[-1] < 0.5 * values[0] and found.points.count() == 60
    with pytest.raises(ValueError, match="two rows"):
        layout.lay_out(edges, ids, "row_id", 1)
