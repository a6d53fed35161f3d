"""End-to-end jobs, saved-state scoring in batch and on a stream, and the entry contract."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from conftest import column
from eigenlake import session
from eigenlake.plans import jobs
from eigenlake.sources.sinks import write_bundle
from eigenlake.sources.tables import read_table
from eigenlake.streaming.scoring import score_stream
from test_graphs_and_tables import series_frame
from test_sources import png


@pytest.fixture
def wine(spark, tmp_path):
    rng = np.random.default_rng(16)
    n = 90
    kind = np.arange(n) % 2
    x = rng.normal(size=(n, 4)) * [3, 2, 1, 0.3] + kind[:, None] * [6, 0, 0, 0]
    lines = ["a;b;c;d;quality;wine_type"]
    for i in range(n):
        cells = [f"{v:.6f}" for v in x[i]]
        if i % 10 == 0:
            cells[1] = ""
        lines.append(";".join([*cells, str(3 + i % 3), "red" if kind[i] else "white"]))
    lines.append(lines[-1])
    lines.append("1;1;1;1;bad;red")
    path = tmp_path / "wine.csv"
    path.write_text("\n".join(lines))
    return read_table(spark, str(path))


def test_prepare_splits_and_fits_on_train(wine):
    prepared = jobs.prepare(wine)
    assert (prepared.rows, prepared.train_rows, prepared.width) == (90, 72, 4)
    x = column(prepared.train, "features")
    assert x.shape == (72, 4)
    np.testing.assert_allclose(x.mean(0), 0, atol=1e-12)
    np.testing.assert_allclose(x.std(0), 1)


def metric(result, section, name):
    rows = result.tables["metrics"].where((F.col("section") == section) & (F.col("metric") == name)).collect()
    return rows[0]["value"]


@pytest.mark.parametrize("method", ["pca", "svd"])
def test_train_writes_a_reusable_bundle(spark, tmp_path, wine, method):
    result = jobs.train(wine, method=method, n_clusters=2, n_init=3)
    assert metric(result, "run", "test_rows") == 18
    assert metric(result, "model", "variance_retained") >= 0.95
    assert metric(result, "reconstruction", "mse") < 0.1
    reduced = result.tables["reduced"]
    k = result.models[method].count
    assert reduced.columns == ["row_id", "quality", "wine_type", *[f"component_{i + 1}" for i in range(k)]]
    path = result.write(spark, str(tmp_path), method)
    new = wine.drop("quality").orderBy("a").limit(7)
    scored = jobs.transform(spark, new, model_path=f"{path}/{method}_model", preprocessor_path=f"{path}/preprocessor")
    direct = jobs.score(new, result.preprocessor, result.models[method])
    assert scored.columns == ["wine_type", *[f"component_{i + 1}" for i in range(k)]]
    before, after = (np.array(sorted(r[1:] for r in df.collect())) for df in (direct, scored))
    assert before.shape == (7, k)
    np.testing.assert_allclose(before, after, atol=1e-12)
    stored = spark.read.parquet(f"{path}/reduced").orderBy("row_id").collect()
    fresh = reduced.orderBy("row_id").collect()
    assert [r["row_id"] for r in stored] == [r["row_id"] for r in fresh]
    np.testing.assert_allclose([r["component_1"] for r in stored], [r["component_1"] for r in fresh])


def test_compare(wine):
    result = jobs.compare(wine, group_col="wine_type", n_clusters=3, n_init=2, max_clusters=4)
    tables = result.tables
    assert all(abs(r["cosine"] - 1) < 1e-8 for r in tables["component_alignment"].collect())
    assert tables["variance_overlap"].first()["overlap"] and tables["train_mse_overlap"].first()["overlap"]
    sweep = tables["clustering_sweep"].collect()
    assert {(r["representation"], r["k"]) for r in sweep} == {(n, k) for n in ("original", "pca", "svd") for k in (2, 3, 4)}
    same = [r["value"] for r in sweep if r["representation"] == "pca" and r["k"] == 3 and r["metric"] == "inertia"]
    assert same == [metric(result, "clustering_pca", "inertia")]
    assert {r["class"] for r in tables["class_counts"].collect()} == {"red", "white"}
    assert {r["representation"] for r in tables["separability"].collect()} == {"features", "pca_2d", "svd_2d"}
    assert tables["pca_group_clusters"].count() == 90
    assert tables["sweep_curve"].count() == 9
    curve = tables["reconstruction_curve"].where("method = 'pca'").orderBy("k").collect()
    assert [r["k"] for r in curve] == [1, 2, 3, 4] and curve[-1]["train_mse"] == pytest.approx(0, abs=1e-12)
    for table in tables.values():
        table.count()


def test_train_without_target_or_test_rows(wine):
    result = jobs.train(wine.drop("quality"), method="pca", target=None, train_fraction=1.0, n_clusters=2, n_init=2, n_components=2)
    names = {(r["section"], r["metric"]) for r in result.tables["metrics"].collect()}
    assert ("reconstruction", "test_mse") not in names and ("clustering_reduced", "adjusted_rand_index") not in names
    assert "target_distribution" not in result.tables
    labels = {r["label"] for r in result.tables["embedding_2d"].collect()}
    assert labels == {0, 1} and "embedding_3d" not in result.tables
    assert {r["threshold"] for r in result.tables["cumulative_variance"].collect()} == {None}


def test_batch_and_stream_scores_agree(spark, tmp_path, wine):
    result = jobs.train(wine, method="svd", n_clusters=2, n_init=2)
    model, state = result.models["svd"], result.preprocessor
    wine.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(wine.schema).parquet(str(tmp_path / "in"))
    query = score_stream(
        source, state, model, output_path=str(tmp_path / "out"), checkpoint_path=str(tmp_path / "chk"),
        keep=["wine_type"], available_now=True,
    )
    query.awaitTermination(120)
    batch = jobs.score(wine, state, model, keep=["wine_type"])
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(tuple, batch.collect()))


def test_scoring_is_one_narrow_stage(wine):
    result = jobs.train(wine, method="pca", n_clusters=2, n_init=2)
    plan = jobs.score(wine, result.preprocessor, result.models["pca"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_graph_jobs(wine):
    near = jobs.knn_graph(wine, max_samples=40, n_neighbors=3)
    assert near["edges"].count() == 120 and near["labels"].count() == 40
    joint = jobs.affinity_graph(wine.drop("quality"), target=None, max_samples=30, perplexity=5.0)
    assert joint["edges"].agg(F.sum("weight")).first()[0] == pytest.approx(1.0, abs=1e-9)
    assert {r["parameter"] for r in joint["parameters"].collect()} == {"sample_size", "perplexity", "random_state"}
    with pytest.raises(ValueError, match="at least 3"):
        jobs.knn_graph(wine, max_samples=2)
    with pytest.raises(ValueError, match="perplexity"):
        jobs.affinity_graph(wine, max_samples=20, perplexity=30.0)


def test_image_and_series_jobs(spark, tmp_path):
    for name in ("one", "two"):
        (tmp_path / f"{name}.png").write_bytes(png(np.random.default_rng(len(name)).integers(0, 256, (24, 20, 3), dtype=np.uint8)))
    rows, metrics = jobs.compress_image_files(spark, str(tmp_path), ranks=[2, 5])
    assert metrics.count() == 4 and rows.count() == 2 * 2 * 3 * 24
    frame = series_frame(spark).withColumn("clean", F.lit(0.5))
    tables = jobs.denoise_series(frame, rank=2, window=20, reference="clean")
    assert tables["denoised"].count() == 170 and tables["noisy_errors"].count() == 2


def test_job_names_and_options():
    assert jobs.job("compare") is jobs.compare
    with pytest.raises(ValueError):
        jobs.job("plot")
    assert [jobs.parse_target(v) for v in ("none", "NULL", "-", "quality", None)] == [None, None, None, "quality", None]


def test_staging_in_a_shared_folder(tmp_path, wine, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path / "shared"))
    staged = session.stage(wine, "wine")
    assert staged.inputFiles() and all(str(tmp_path / "shared") in f for f in staged.inputFiles())
    assert not staged.is_cached
    assert sorted(map(str, staged.collect())) == sorted(map(str, wine.collect()))
    result = jobs.train(wine, method="pca", n_clusters=2, n_init=2)
    assert metric(result, "run", "train_rows") == 72


def test_entry_contract(spark):
    names = set(contract.queries())
    assert set(contract.oracle_sql()) <= names
    result = contract.entry(spark)
    assert result.count() == 1473 and "component_1" in result.columns


def test_graph_bundle(spark, tmp_path, matrix_frame):
    frame = matrix_frame(np.random.default_rng(1).normal(size=(30, 3))).select(
        "row_id", *[F.col("features")[i].alias(f"c{i}") for i in range(3)]
    )
    graph = jobs.knn_graph(frame, target=None, row_id="row_id", n_neighbors=3, max_samples=None)
    path = write_bundle(spark, graph, str(tmp_path), "umap")
    assert spark.read.parquet(f"{path}/edges").count() == 90
    found = {r["parameter"]: r["value"] for r in spark.read.json(f"{path}/parameters_json").collect()}
    assert found["sample_size"] == 30
