"""Pairs of rows that meet once for both of their rows, and columns that share their distances."""

from functools import partial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import column
from eigenlake.functions import blocks
from eigenlake.operators import affinity, cluster_metrics as cm, clustering, descent, neighbours, spectral
from eigenlake.operators.clean import MatrixShape
from eigenlake.operators.kmeans import KMeansRequest
from test_clustering import brute_silhouette


def between(x, y):
    return np.sqrt(((x[:, None] - y[None]) ** 2).sum(-1))


def tight(rng, rows, width):
    return rng.normal(size=(4, width))[rng.integers(0, 4, rows)] * 10 + 1e-5 * rng.normal(size=(rows, width))


@pytest.mark.parametrize("kinds", [5, 60, 400])
@pytest.mark.parametrize("shape", ["even", "tails", "tight", "copies"])
def test_sums_of_both_sides(monkeypatch, kinds, shape):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(blocks, "SINGLE_POINTS", 1)
    monkeypatch.setattr(blocks, "MANY_KINDS", 100)
    x = {
        "even": rng.normal(size=(700, 3)) + 50,
        "tails": np.exp(2 * rng.normal(size=(700, 3))),
        "tight": tight(rng, 700, 3),
        "copies": np.repeat(rng.normal(size=(70, 3)), 10, axis=0),
    }[shape]
    weights, own = rng.integers(1, 4, 700), rng.integers(0, kinds, 700)
    member = np.eye(7)[rng.integers(0, 7, kinds)]
    monkeypatch.setattr(blocks, "SUMMED_POINTS", 90)
    monkeypatch.setattr(blocks, "SUMMED_ROWS", 16)
    left, right = (blocks.NearTiles(x[part], weights[part], own[part], member) for part in (slice(0, 300), slice(300, 700)))
    sums, back = blocks.met_sums(left, right, True)
    np.testing.assert_allclose(sums, between(x[:300], x[300:]) @ (member[own[300:]] * weights[300:, None]), rtol=1e-5, atol=1e-6)
    np.testing.assert_allclose(back, between(x[300:], x[:300]) @ (member[own[:300]] * weights[:300, None]), rtol=1e-5, atol=1e-6)


def test_every_two_blocks_meet_once(matrix_frame, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(150, 3))
    first, second = rng.integers(0, 5, 150).tolist(), rng.integers(0, 2, 150).tolist()
    df = matrix_frame(x, one=first, two=second).withColumn("labels", F.array(F.col("one").cast("int"), F.col("two").cast("int"))).cache()
    monkeypatch.setattr(cm, "MOST_BLOCKS", 5)
    found = cm._scores_by_pairs(cm._weighted(df, "row_id", "features", "labels"), MatrixShape(150, 3), np.array([0, 5, 7]))
    got = column(found, "scores", "id")
    assert found.count() == 150
    for run, labels in enumerate((first, second)):
        np.testing.assert_allclose(got[:, run], brute_silhouette(x, np.array(labels)), atol=1e-9)


def test_repeated_ids_keep_their_own_scores(matrix_frame):
    rng = np.random.default_rng(5)
    x, labels = rng.normal(size=(60, 2)), rng.integers(0, 3, 60)
    df = matrix_frame(x, one=labels.tolist()).withColumn("labels", F.array(F.col("one").cast("int")))
    twice = df.withColumn("row_id", F.floor(F.col("row_id") / 2)).cache()
    found = cm.silhouette_scores(twice, "row_id", [3], MatrixShape(60, 2), block_bytes=100)
    want = brute_silhouette(x, labels)
    got = sorted((r["row_id"], round(r["scores"][0], 7)) for r in found.collect())
    assert got == sorted((i // 2, round(float(v), 7)) for i, v in enumerate(want))


def test_alike_columns_share_their_distances(matrix_frame, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(90, 3))
    turn, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    df = matrix_frame(x).withColumn("turned", F.array(*[sum(F.col("features")[j] * float(turn[j, i]) for j in range(3)) for i in range(3)])).cache()
    requests = [KMeansRequest("features", 3, (2, 3)), KMeansRequest("turned", 3, (4, 2)), KMeansRequest("features", 3, (5,))]
    met = []
    plain = cm.silhouette
    monkeypatch.setattr(cm, "silhouette", lambda df, row_id, ks, *rest, **options: met.append(list(ks)) or plain(df, row_id, ks, *rest, **options))
    options = {"references": [None] * 3, "start_rows": list(range(5)), "max_iter": 3}
    apart = clustering.cluster_representations(df, "row_id", requests, 90, **options)
    assert [len(ks) for ks in met] == [3, 2]
    met.clear()
    shared = clustering.cluster_representations(df, "row_id", requests, 90, alike={"turned": "features"}, **options)
    assert met == [[2, 3, 5, 4, 2]]
    for (models, metrics), (others, expected) in zip(shared, apart):
        assert [m.k for m in models] == [m.k for m in others]
        for got, want in zip(metrics, expected):
            assert got == pytest.approx(want, rel=1e-9)


def test_components_of_one_space(matrix_frame):
    rng = np.random.default_rng(7)
    df = matrix_frame(rng.normal(size=(80, 4)) * [4, 3, 2, 1])
    pca, svd = (spectral.build_reducer(name)(df, n_components=3, shape=MatrixShape(80, 4)) for name in ("pca", "svd"))
    assert svd.same_distances(pca) and not svd.same_distances(pca.with_count(2))
    other = spectral.build_reducer("pca")(matrix_frame(rng.normal(size=(80, 4))), n_components=3, shape=MatrixShape(80, 4))
    assert not other.same_distances(pca)


def test_dense_work_reads_points_block_by_block(matrix_frame, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(50, 3))
    df = matrix_frame(x).cache()
    shape, answers = MatrixShape(50, 3), []
    plain = blocks.OrderedPoints.of
    for bound in (10**6, 200):
        monkeypatch.setattr(blocks.OrderedPoints, "of", partial(plain, block_bytes=bound))
        joint = affinity.joint_affinities(df, "row_id", shape, 5.0)
        embedding = df.select("row_id", F.slice("features", 1, 2).alias("embedding"))
        answers.append([
            column(neighbours.pairwise_distances(df, "row_id", shape), "distances"),
            column(affinity.calibrated_rows(df, "row_id", shape, 5.0), "beta"),
            column(joint, "weights"),
            affinity.kl_divergence(joint, embedding, "row_id", 50, 2, ids=df),
        ])
    np.testing.assert_allclose(answers[0][0], between(x, x) ** 2, atol=1e-9)
    for whole, cut in zip(*answers):
        np.testing.assert_allclose(cut, whole, atol=1e-9)


def test_points_in_blocks_keep_the_order_of_their_ids(spark):
    ids = ["b", "a", "d", "c", "c", "e"]
    df = spark.createDataFrame([(i, [float(n)]) for n, i in enumerate(ids)], "row_id string, features array<double>").coalesce(1)
    points = blocks.OrderedPoints.of(df, "row_id", "features", 6, 1, block_bytes=8)
    assert points.ids.value.tolist() == sorted(ids) and points.count == 6
    assert np.concatenate([block.value for block in points.blocks]).ravel().tolist() == [1, 0, 3, 4, 2, 5]


def test_dense_pairs_of_six_gigabytes_are_not_refused():
    neighbours._require_bounded(MatrixShape(615_384, 64))


def test_edges_to_one_row_lie_together(spark):
    rng = np.random.default_rng(9)
    ids = ["b", "a", None, "c", "c"]
    weights = rng.uniform(size=(5, 5))
    order = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "row_id string, position int")
    joint = spark.createDataFrame([(i, w.tolist()) for i, w in zip(ids, weights)], "row_id string, weights array<double>").coalesce(1)
    found = [(r["i"], r["j"], r["weight"]) for r in affinity.affinity_edges(joint, "row_id", order).collect()]
    want = [(ids[a], ids[b], weights[a, b]) for b in range(5) for a in range(5) if ids[a] and ids[b] and ids[a] != ids[b]]
    assert found == want


@pytest.mark.parametrize("shape", ["even", "tight", "copies", "huge"])
def test_groups_find_the_nearest(monkeypatch, shape):
    rng = np.random.default_rng(10)
    points = {
        "even": rng.normal(size=(500, 6)),
        "tight": tight(rng, 500, 6),
        "copies": np.repeat(rng.normal(size=(20, 6)), 25, axis=0),
        "huge": rng.normal(size=(500, 6)) * 1e25,
    }[shape]
    rows = np.vstack([points[:30], points[:10] + rng.normal(size=(10, 6))])
    for name, value in (("GROUPED_POINTS", 1), ("GROUPED_ROWS", 7), ("GROUPED_COLUMNS", 64), ("GROUP", 4), ("MOST_GROUPS", 20)):
        monkeypatch.setattr(neighbours, name, value)
    full = []
    plain = neighbours.squared_distances
    monkeypatch.setattr(neighbours, "squared_distances", lambda a, b: full.append(len(a)) or plain(a, b))
    found = list(neighbours._close(rows, points, 5))
    d = between(rows, points)
    for near, row in zip(found, d):
        # All that are as near as the fifth, but for rounding, and none that is farther.
        fifth = np.sort(row)[4]
        assert set(np.flatnonzero(row < fifth * (1 - 1e-9))) <= set(near.tolist()) and len(near) >= 5
        assert (row[near] <= fifth + 1e-3 * row.max()).all()
    assert len(found) == 40 and (shape != "even" or not full)


def test_meetings_are_compared_side_by_side():
    rng = np.random.default_rng(11)
    sizes = [3, 1, 5, 2]
    at = pa.chunked_array([["a"] * 3 + ["b"], [None] * 5 + ["c"] * 2])
    firsts = descent._firsts(at)
    assert firsts.tolist() == [0, 3, 4, 9]
    x, fresh = rng.normal(size=(11, 4)) + 100, rng.integers(0, 2, 11).astype(bool)
    reach = [None if i % 4 == 0 else float(rng.uniform(0, 8)) for i in range(11)]
    table = pa.table([at, list(range(11)), fresh, pa.array(reach, pa.float64()), x.tolist()], names=["at", "id", "fresh", "reach", "point"])
    found = descent._compared(table, firsts, 4).to_pydict()
    d2 = between(x, x) ** 2
    meeting = np.repeat(np.arange(4), sizes)
    want = {
        (i, j) for i in range(11) for j in range(11)
        if i != j and meeting[i] == meeting[j] and (fresh[i] or fresh[j]) and (reach[i] is None or d2[i, j] <= reach[i])
    }
    assert set(zip(found["id"], found["other"])) == want and len(found["id"]) == len(want)
    np.testing.assert_allclose(found["d2"], [d2[i, j] for i, j in zip(found["id"], found["other"])])
