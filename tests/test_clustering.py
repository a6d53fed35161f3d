"""K-means and cluster quality against brute force."""

from collections import Counter
from math import comb, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import column
from eigenlake.operators import cluster_metrics as cm, clustering, kmeans
from eigenlake.operators.clean import MatrixShape


def blobs(n=60, width=4):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(-2, 0.4, (n // 2, width)), rng.normal(2, 0.4, (n // 2, width))])
    return x, [0] * (n // 2) + [1] * (n // 2)


def distances(x):
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))


def brute_silhouette(x, labels):
    d, labels = distances(x), np.asarray(labels)
    out = []
    for i, own in enumerate(labels):
        same = (labels == own) & (np.arange(len(x)) != i)
        if not same.any():
            out.append(0.0)
            continue
        a = d[i, same].mean()
        b = min(d[i, labels == c].mean() for c in set(labels) - {own})
        out.append((b - a) / max(a, b))
    return np.array(out)


def brute_internal(x, labels):
    labels = np.asarray(labels)
    ids = sorted(set(labels))
    centres = np.array([x[labels == c].mean(0) for c in ids])
    own = np.sqrt(((x - centres[labels]) ** 2).sum(1))
    within = (own**2).sum()
    between = sum((labels == c).sum() * ((centres[c] - x.mean(0)) ** 2).sum() for c in ids)
    s = [own[labels == c].mean() for c in ids]
    gap = distances(centres)
    db = np.mean([max((s[i] + s[j]) / gap[i, j] for j in ids if j != i) for i in ids])
    k = len(ids)
    return {"inertia": within, "calinski_harabasz": between * (len(x) - k) / (within * (k - 1)), "davies_bouldin": db}


def brute_agreement(ref, labels):
    n = len(ref)
    pairs, a, b = Counter(zip(ref, labels)), Counter(ref), Counter(labels)
    t, ta, tb = (sum(comb(v, 2) for v in c.values()) for c in (pairs, a, b))
    expected = ta * tb / comb(n, 2)
    rand = (t - expected) / ((ta + tb) / 2 - expected)
    mutual = sum(v / n * log(v * n / (a[i] * b[j])) for (i, j), v in pairs.items())
    entropy = [-sum(v / n * log(v / n) for v in c.values()) for c in (a, b)]
    return rand, mutual / (sum(entropy) / 2)


@pytest.fixture
def labelled(matrix_frame):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(70, 3)) + 50.0
    first = [int(v) for v in rng.integers(0, 4, 69)] + [4]
    second = [int(v) for v in rng.integers(0, 2, 70)]
    ref = [str(v) for v in rng.integers(0, 3, 70)]
    df = matrix_frame(x, one=first, two=second, ref=ref).withColumn("labels", F.array("one", "two")).cache()
    return x, first, second, ref, df


def test_metrics_of_two_labellings_at_once(labelled):
    x, first, second, ref, df = labelled
    found = cm.evaluate_labellings(df, "row_id", [5, 2], MatrixShape(70, 3), reference="ref")
    for metrics, labels in zip(found, (first, second)):
        expected = brute_internal(x, labels)
        expected["silhouette"] = brute_silhouette(x, labels).mean()
        rand, information = brute_agreement(ref, labels)
        expected |= {"adjusted_rand_index": rand, "normalized_mutual_information": information}
        assert metrics.keys() == expected.keys()
        for name, value in expected.items():
            assert metrics[name] == pytest.approx(value, abs=1e-7), name


def test_silhouette_in_blocks_equals_in_place(labelled):
    x, first, second, _, df = labelled
    shape = MatrixShape(70, 3)
    whole = column(cm.silhouette_scores(df, "row_id", [5, 2], shape), "scores")
    blocks = column(cm.silhouette_scores(df, "row_id", [5, 2], shape, block_bytes=900), "scores")
    np.testing.assert_allclose(whole[:, 0], brute_silhouette(x, first), atol=1e-7)
    np.testing.assert_allclose(blocks, whole, atol=1e-7)


def test_silhouette_is_sampled_on_request_only(labelled):
    x, first, second, _, df = labelled
    values = cm.silhouette(df, "row_id", [5, 2], MatrixShape(70, 3), sample=20)
    from eigenlake.operators.sample import sample_rows

    rows = [r["row_id"] for r in sample_rows(df, "row_id", max_samples=20).collect()]
    assert values[0] == pytest.approx(brute_silhouette(x, first)[rows].mean(), abs=1e-7)
    exact = cm.silhouette(df, "row_id", [5, 2], MatrixShape(70, 3))
    assert exact == pytest.approx([brute_silhouette(x, first).mean(), brute_silhouette(x, second).mean()], abs=1e-7)


def test_squared_silhouette(labelled):
    x, _, second, _, df = labelled
    d, labels = distances(x) ** 2, np.array(second)
    value = cm.silhouette_squared(df.withColumn("cluster", F.col("two")))
    expected = []
    for i, own in enumerate(labels):
        a = d[i, labels == own].sum() / ((labels == own).sum() - 1)
        b = d[i, labels != own].mean()
        expected.append((b - a) / max(a, b))
    assert value == pytest.approx(np.mean(expected), abs=1e-6)


def test_agreement_edge_rules(spark):
    same = spark.createDataFrame([(0, "a", 0, 5)], "run int, reference string, cluster int, n bigint")
    row = cm.agreement(same).first()
    assert row["adjusted_rand_index"] == 1.0 and row["normalized_mutual_information"] == 1.0
    independent = spark.createDataFrame([(0, r, c, 3) for r in "ab" for c in (0, 1)], same.schema)
    assert cm.agreement(independent).first()["normalized_mutual_information"] == pytest.approx(0.0, abs=1e-12)


def test_coincident_centres_and_zero_dispersion(matrix_frame):
    x = [[0.0], [0.0], [0.0], [0.0]]
    df = matrix_frame(x, one=[0, 0, 1, 1]).withColumn("labels", F.array("one"))
    found = cm.internal_metrics(df, [2], MatrixShape(4, 1))[0]
    assert found == {"inertia": 0.0, "calinski_harabasz": 1.0, "davies_bouldin": 0.0}


def test_kmeans_finds_blobs_and_scores_them(matrix_frame):
    x, ref = blobs()
    df = matrix_frame(x, ref=ref).cache()
    result = clustering.evaluate_kmeans(df, "row_id", n_clusters=2, reference="ref", n_init=4)
    assert result.metrics["silhouette"] > 0.5 and result.metrics["adjusted_rand_index"] == pytest.approx(1.0)
    labels = column(result.assignments, "cluster")
    assert result.metrics["inertia"] == pytest.approx(brute_internal(x, labels)["inertia"])
    again = clustering.evaluate_kmeans(df, "row_id", n_clusters=2, reference="ref", n_init=4)
    np.testing.assert_allclose(again.model.centers, result.model.centers)
    for k in (1, 60):
        with pytest.raises(ValueError, match="n_clusters"):
            clustering.evaluate_kmeans(df, "row_id", n_clusters=k)


def test_lloyd_steps_match_numpy(matrix_frame):
    x = np.random.default_rng(4).normal(size=(90, 3)) + 7
    centres = x[:5].copy()
    model = kmeans.fit_kmeans(matrix_frame(x), "row_id", ks=[5], init=centres, max_iter=4, tol=0.0)[5]
    for _ in range(4):
        label = ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        centres = np.array([x[label == c].mean(0) for c in range(5)])
    np.testing.assert_allclose(model.centers, centres, atol=1e-10)
    assert model.inertia == pytest.approx(((x[:, None] - centres[None]) ** 2).sum(-1).min(1).sum())


def test_many_runs_sum_the_same_through_the_tree(matrix_frame, monkeypatch):
    from eigenlake.functions import blocks

    x = np.random.default_rng(5).normal(size=(80, 3))
    df = matrix_frame(x, partitions=9)
    direct = kmeans.fit_kmeans(df, "row_id", ks=[2, 3], n_init=3)
    monkeypatch.setattr(blocks, "DIRECT_TASKS", 1)
    monkeypatch.setattr(blocks, "FOLD_TASKS", 2)
    monkeypatch.setattr(blocks, "FINAL_TASKS", 2)
    folded = kmeans.fit_kmeans(df, "row_id", ks=[2, 3], n_init=3)
    for k in (2, 3):
        assert folded[k].inertia == pytest.approx(direct[k].inertia)


def test_more_clusters_than_distinct_rows(matrix_frame):
    df = matrix_frame([[0.0], [0.0], [0.0], [1.0], [1.0]])
    model = kmeans.fit_kmeans(df, "row_id", ks=[4], n_init=2)[4]
    assert model.inertia == pytest.approx(0.0)
    with pytest.raises(ValueError, match="fewer than two"):
        kmeans.fit_kmeans(matrix_frame([[1.0]] * 5), "row_id", ks=[2], n_init=2)


def test_nearest_centre_forms_agree(matrix_frame, monkeypatch):
    rng = np.random.default_rng(6)
    x, centres = rng.normal(size=(50, 4)), rng.normal(size=(3, 4))
    df = matrix_frame(x)
    models = [kmeans.KMeansModel(centres, 0.0, 1), kmeans.KMeansModel(centres[:2], 0.0, 1)]
    fast = column(kmeans.label_all(df, models, "features"), "labels")
    monkeypatch.setattr(kmeans, "EXPRESSION_TERMS", 0)
    np.testing.assert_array_equal(fast, column(kmeans.label_all(df, models, "features"), "labels"))
    np.testing.assert_array_equal(fast[:, 0], ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1))


def test_sweep(matrix_frame):
    rng = np.random.default_rng(7)
    x = np.vstack([rng.normal(-2, 0.5, (35, 3)), rng.normal(2, 0.5, (35, 3))])
    df = matrix_frame(x, ref=[0] * 35 + [1] * 35).withColumn("reduced", F.slice("features", 1, 2)).cache()
    sweep = clustering.clustering_sweep(df, "row_id", {"features": 3, "reduced": 2}, "ref", max_clusters=4, n_init=3).collect()
    assert {(r["representation"], r["k"]) for r in sweep} == {(n, k) for n in ("features", "reduced") for k in (2, 3, 4)}
    assert len(sweep) == 6 * 6
    with pytest.raises(ValueError, match="Not enough"):
        clustering.clustering_sweep(df.limit(2), "row_id", {"features": 3}, "ref")
    with pytest.raises(ValueError, match="At least one"):
        clustering.clustering_sweep(df, "row_id", {}, "ref")


def test_separability(matrix_frame):
    x, ref = blobs()
    df = matrix_frame(x, kind=["red" if r else "white" for r in ref]).withColumn("pca_2d", F.slice("features", 1, 2))
    df = df.withColumn("kind", F.when(F.col("row_id") != 0, F.col("kind"))).cache()
    options = dict(rows=60, train_rows=48, width=4, n_init=3)
    counts, metrics = clustering.separability(df, "row_id", "kind", {"features": 4, "pca_2d": 2}, **options)
    assert {r["class"]: r["n"] for r in counts.collect()} == {"red": 30, "white": 29, "<missing>": 1}
    assert {r["k"] for r in metrics.collect()} == {3}
    assert clustering.separability(df, "row_id", "none", {"features": 4}, **options) is None
    assert clustering.separability(df.withColumn("kind", F.lit("x")), "row_id", "kind", {"features": 4}, **options) is None
    assert clustering.separability(df, "row_id", "kind", {"features": 4}, **{**options, "train_rows": 1}) is None


def test_group_views_and_fallback_labels(matrix_frame):
    x, ref = blobs()
    df = matrix_frame(x, kind=["a"] * 59 + ["single"]).withColumn("kind", F.when(F.col("row_id") > 1, F.col("kind")))
    rows = cm.group_views(df, "kind", ["row_id"]).collect()
    assert len(rows) == 57 and {r["kind"] for r in rows} == {"a"}
    labels = clustering.fallback_labels(df, "row_id", "features", MatrixShape(60, 4), None, n_init=2)
    assert {r["label"] for r in labels.collect()} == set(range(6))


def test_rare_clusters_are_found_from_all_rows(matrix_frame):
    random = np.random.default_rng(0)
    places = [[90, 0], [0, 90], [-90, 0], [0, -90]]
    x = np.vstack([random.normal(size=(12_000, 2)), *[p + random.normal(size=(6, 2)) for p in places]])
    label = np.concatenate([np.zeros(12_000, int), np.repeat([1, 2, 3, 4], 6)])
    given = sum(((x[label == k] - x[label == k].mean(axis=0)) ** 2).sum() for k in range(5))
    for seed in (1, 2):
        model = kmeans.fit_kmeans(matrix_frame(x, partitions=4), "row_id", ks=[5], n_init=5, seed=seed)[5]
        assert model.inertia <= 1.02 * given


def test_too_many_classes_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(clustering, "MAX_CLASSES", 3)
    df = spark.createDataFrame([(i, str(i % 4)) for i in range(12)], "row_id long, kind string")
    with pytest.raises(ValueError, match="4 classes"):
        clustering.separable_classes(df, "kind", rows=12, train_rows=9, width=2)
