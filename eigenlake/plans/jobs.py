"""End-to-end jobs: train, compare, score, neighbour graphs, image and series reduction."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from eigenlake.functions.blocks import task_count
from eigenlake.operators import explore
from eigenlake.operators.affinity import affinity_edges, check_perplexity, joint_affinities, neighbour_affinities
from eigenlake.operators.clean import Dataset, MatrixShape, dataset_report, load_dataset
from eigenlake.operators.cluster_metrics import group_views
from eigenlake.operators.clustering import (
    CLASS_COLUMN,
    class_label,
    cluster_representations,
    fallback_labels,
    separable_classes,
    sweep_table,
)
from eigenlake.operators.diagnostics import (
    component_alignment,
    reconstruction_curve,
    reconstruction_report,
    top_component_features,
)
from eigenlake.operators.kmeans import KMeansRequest, label_all
from eigenlake.operators.layout import lay_out
from eigenlake.operators.lowrank import compress_images
from eigenlake.operators.neighbours import nearest_neighbours, position_table
from eigenlake.operators.preprocess import Preprocessor
from eigenlake.operators.sample import sample_rows, split_rows, train_size
from eigenlake.operators.series import denoise, series_errors
from eigenlake.operators.spectral import SpectralModel, build_reducer
from eigenlake.session import release, spread, stage
from eigenlake.sources.images import read_image_planes
from eigenlake.sources.models import load_model, load_preprocessor, save_model, save_preprocessor
from eigenlake.sources.sinks import coordinates, write_bundle

METRIC_SCHEMA = "section string, metric string, value double"


@dataclass(frozen=True)
class Prepared:
    """The cleaned table, the fitted state and the staged matrix frame."""

    data: Dataset
    preprocessor: Preprocessor
    frame: DataFrame
    rows: int
    train_rows: int

    @property
    def width(self) -> int:
        return len(self.data.features)

    @property
    def train(self) -> DataFrame:
        return self.frame.where(F.col("split") == "train")

    @property
    def train_shape(self) -> MatrixShape:
        return MatrixShape(self.train_rows, self.width)


def prepare(
    df: DataFrame,
    *,
    target: str | None = "quality",
    train_fraction: float = 0.8,
    seed: int = 42,
    row_id: str | None = None,
    exclude: Sequence[str] = (),
    drop_duplicates: bool = True,
    approximate_median: bool = False,
) -> Prepared:
    """Load, split, fit the preprocessor on training rows and standardise all rows."""
    data = load_dataset(
        df, target=target, row_id=row_id, exclude=exclude, drop_duplicates=drop_duplicates
    )
    rows, size = data.rows, train_size(data.rows, train_fraction)
    split = split_rows(data.frame, data.row_id, fraction=train_fraction, seed=seed, rows=rows)
    state = Preprocessor.fit(
        split.where(F.col("split") == "train"),
        data.features,
        booleans=data.booleans,
        approximate_median=approximate_median,
        rows=size,
    )
    keep = [data.row_id, "split", *([target] if target else []), *data.passthrough]
    matrix = spread(state.transform(split, keep), data.row_id, rows, task_count(data.frame))
    frame = stage(matrix, "matrix")
    return Prepared(data, state, frame, rows, size)


@dataclass
class JobResult:
    """Fitted models, report tables by name, and the coordinate tables."""

    preprocessor: Preprocessor
    models: dict[str, SpectralModel]
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def write(self, spark: SparkSession, root: str, kind: str) -> str:
        """Write everything to a new run directory and return its path."""
        path = write_bundle(spark, self.tables, root, kind)
        save_preprocessor(spark, self.preprocessor, f"{path}/preprocessor")
        for name, model in self.models.items():
            save_model(spark, model, f"{path}/{name}_model", self.preprocessor.features)
        return path


def _metric_rows(section: str, metrics: dict[str, float]) -> list[tuple]:
    return [(section, name, float(value)) for name, value in metrics.items() if value is not None]


def _shared_tables(prepared: Prepared) -> dict[str, DataFrame]:
    """Report and figure tables that do not depend on a reducer."""
    data = prepared.data
    raw = data.frame.select(*data.numeric_features())
    tables = {
        "dataset_report": dataset_report(data),
        "feature_histograms": explore.feature_histograms(raw, data.features),
        "feature_correlation": explore.correlation_matrix(raw, data.features),
    }
    if any(not flat for flat in prepared.preprocessor.constant):
        tables["feature_density"] = explore.feature_density(raw, data.features)
    if data.target is not None:
        tables["target_distribution"] = explore.target_distribution(data.frame, data.target)
    return tables


def _reduce(frame: DataFrame, model: SpectralModel) -> DataFrame:
    """Add the coordinates of one method as a column of its name."""
    return model.transform(frame, "features", model.method, check=False)


def _reconstruction(frame: DataFrame, model: SpectralModel, width: int) -> dict[str, float]:
    rebuilt = model.inverse_transform(frame, model.method, check=False)
    return reconstruction_report(rebuilt, width).first().asDict()


def _embedding_tables(prepared, frame, model, cluster_column, prefix="") -> dict[str, DataFrame]:
    label = prepared.data.target or cluster_column
    tables = {}
    for dimensions in (2, 3):
        if model.count >= dimensions:
            tables[f"{prefix}embedding_{dimensions}d"] = explore.embedding_points(
                frame, dimensions, label, [prepared.data.row_id], model.method
            )
    return tables


def _run_facts(prepared: Prepared, train_fraction: float, seed: int) -> list[tuple]:
    return _metric_rows(
        "run",
        {
            "train_fraction": train_fraction,
            "train_rows": prepared.train_rows,
            "test_rows": prepared.rows - prepared.train_rows,
            "random_state": seed,
            "constant_features": len(prepared.preprocessor.constant_features),
        },
    )


def train(
    df: DataFrame,
    *,
    method: str,
    target: str | None = "quality",
    n_components: int | None = None,
    variance_threshold: float = 0.95,
    n_clusters: int = 6,
    train_fraction: float = 0.8,
    seed: int = 42,
    row_id: str | None = None,
    exclude: Sequence[str] = (),
    n_init: int = 20,
    silhouette_sample: int | None = None,
    **fit_options,
) -> JobResult:
    """Fit one reducer, evaluate it and return a reusable model with its report tables.

    ``fit_options`` (``start_rows``, ``max_iter``, ``tol``) go to the K-means fits.
    """
    fit = build_reducer(method)
    spark = df.sparkSession
    prepared = prepare(
        df, target=target, train_fraction=train_fraction, seed=seed, row_id=row_id, exclude=exclude
    )
    model = fit(
        prepared.train,
        n_components=n_components,
        variance_threshold=variance_threshold,
        shape=prepared.train_shape,
    )
    reduced = stage(_reduce(prepared.frame, model), "reduced")
    key = prepared.data.row_id
    requests = [
        KMeansRequest("features", prepared.width, (n_clusters,)),
        KMeansRequest(method, model.count, (n_clusters,)),
    ]
    (_, [before]), ([after_model], [after]) = cluster_representations(
        reduced, key, requests, prepared.rows, references=[target, target],
        seed=seed, n_init=n_init, silhouette_sample=silhouette_sample, **fit_options,
    )
    metrics = [
        *_run_facts(prepared, train_fraction, seed),
        *_metric_rows("model", {"selected_components": model.count, "variance_retained": model.retained}),
        *_metric_rows("reconstruction", _reconstruction(reduced, model, prepared.width)),
        *_metric_rows("clustering_original", before),
        *_metric_rows("clustering_reduced", after),
    ]
    components = model.components_table(spark, prepared.data.features)
    labelled = label_all(reduced, [after_model], method).withColumn("cluster", F.col("labels")[0])
    threshold = variance_threshold if n_components is None else None
    result = JobResult(prepared.preprocessor, {method: model}, _shared_tables(prepared))
    result.tables |= {
        "metrics": spark.createDataFrame(metrics, METRIC_SCHEMA),
        "component_interpretation": top_component_features(components),
        "cumulative_variance": explore.variance_curves({method: model.spectrum_table(spark)}, threshold),
        "component_loadings": explore.loadings_table(components, prepared.data.features),
        "reduced": coordinates(
            reduced, model.count, method, [key, *([target] if target else []), *prepared.data.passthrough]
        ),
        **_embedding_tables(prepared, labelled, model, "cluster"),
    }
    release(prepared.frame)
    return result


def compare(
    df: DataFrame,
    *,
    target: str | None = "quality",
    group_col: str | None = None,
    n_components: int | None = None,
    variance_threshold: float = 0.95,
    n_clusters: int = 6,
    train_fraction: float = 0.8,
    seed: int = 42,
    row_id: str | None = None,
    exclude: Sequence[str] = (),
    n_init: int = 20,
    silhouette_sample: int | None = None,
    max_clusters: int = 10,
    **fit_options,
) -> JobResult:
    """Fit PCA and SVD on the same split and state and compare every outcome.

    Each method is fitted once with its full basis: the retained model, the two leading
    directions and the whole reconstruction curve are prefixes of it. The main clustering
    and the sweep share their K-means passes. ``fit_options`` (``start_rows``, ``max_iter``, ``tol``) go to these.
    """
    spark = df.sparkSession
    prepared = prepare(
        df, target=target, train_fraction=train_fraction, seed=seed, row_id=row_id, exclude=exclude
    )
    key, width, rows = prepared.data.row_id, prepared.width, prepared.rows
    models = {
        name: build_reducer(name)(
            prepared.train,
            n_components=n_components,
            variance_threshold=variance_threshold,
            shape=prepared.train_shape,
        )
        for name in ("pca", "svd")
    }
    frame = prepared.frame
    for model in models.values():
        frame = _reduce(frame, model)
    classes = None
    if group_col is not None:
        classes = separable_classes(
            prepared.frame, group_col, rows=rows, train_rows=prepared.train_rows, width=width
        )
    if classes is not None:
        frame = class_label(frame, group_col)
        for name, model in models.items():
            frame = model.with_count(2).transform(frame, "features", f"{name}_2d", check=False)
    frame = stage(frame, "compared")

    sweep_ks = list(range(2, min(max_clusters, rows - 1) + 1)) if target is not None else []
    ks = tuple(sorted({n_clusters, *sweep_ks}))
    shown = {"features": "original", "pca": "pca", "svd": "svd"}
    widths = {"features": width, **{name: m.count for name, m in models.items()}}
    requests = [KMeansRequest(name, widths[name], ks) for name in shown]
    references = [target] * len(requests)
    if classes is not None:
        planar = {"features": width, "pca_2d": 2, "svd_2d": 2}
        requests += [KMeansRequest(name, size, (classes[1],)) for name, size in planar.items()]
        references += [CLASS_COLUMN] * len(planar)
    alike = {"svd": "pca"} if models["svd"].same_distances(models["pca"]) else {}
    if classes is not None and models["svd"].with_count(2).same_distances(models["pca"].with_count(2)):
        alike["svd_2d"] = "pca_2d"
    found = cluster_representations(
        frame, key, requests, rows, references=references, alike=alike, seed=seed, n_init=n_init, silhouette_sample=silhouette_sample,
        **fit_options,
    )
    metrics = _run_facts(prepared, train_fraction, seed)
    sweep, clusters = [], {}
    for (name, label), (fitted, values) in zip(shown.items(), found):
        place = ks.index(n_clusters)
        clusters[name] = fitted[place]
        metrics += _metric_rows(f"clustering_{label}", values[place])
        swept = [i for i, k in enumerate(ks) if k in sweep_ks]
        sweep.append((label, [ks[i] for i in swept], [values[i] for i in swept]))
    for name, model in models.items():
        metrics += _metric_rows(name, {"selected_components": model.count, "variance_retained": model.retained})
        metrics += _metric_rows(f"reconstruction_{name}", _reconstruction(frame, model, width))

    components = {name: m.components_table(spark, prepared.data.features) for name, m in models.items()}
    spectra = {name: m.spectrum_table(spark) for name, m in models.items()}
    curve = reconstruction_curve(frame, list(models.values()))
    threshold = variance_threshold if n_components is None else None
    result = JobResult(prepared.preprocessor, models, _shared_tables(prepared))
    tables = result.tables
    tables["component_alignment"] = component_alignment(components["pca"], components["svd"])
    tables["variance_comparison"] = explore.variance_curves(spectra, threshold)
    tables["variance_overlap"] = explore.curves_overlap(spectra["pca"], spectra["svd"], "component")
    tables["reconstruction_curve"] = curve
    for column in ("train_mse", "test_mse"):
        tables[f"{column}_overlap"] = explore.curves_overlap(
            curve.where("method = 'pca'"), curve.where("method = 'svd'"), "k", column
        )
    if sweep_ks:
        tables["clustering_sweep"] = sweep_table(frame, sweep)
        tables["sweep_curve"] = explore.metric_curve(tables["clustering_sweep"], "adjusted_rand_index")
    for name, model in models.items():
        labelled = label_all(frame, [clusters[name]], name).withColumn("cluster", F.col("labels")[0])
        tables[f"{name}_interpretation"] = top_component_features(components[name])
        tables[f"{name}_loadings"] = explore.loadings_table(components[name], prepared.data.features)
        tables |= _embedding_tables(prepared, labelled, model, "cluster", f"{name}_")
        if group_col is not None and group_col in frame.columns and model.count >= 2:
            points = labelled.withColumns({"x": F.col(name)[0], "y": F.col(name)[1]})
            tables[f"{name}_group_clusters"] = group_views(points, group_col, [key, "x", "y", "cluster"])
    if classes is not None:
        tables["class_counts"] = classes[0]
        scored = [(r.column, r.ks, m) for r, (_, m) in zip(requests[len(shown):], found[len(shown):])]
        tables["separability"] = sweep_table(frame, scored)
    tables["metrics"] = spark.createDataFrame(metrics, METRIC_SCHEMA)
    release(prepared.frame)
    return result


def score(df: DataFrame, preprocessor: Preprocessor, model: SpectralModel, keep: Sequence[str] | None = None) -> DataFrame:
    """Saved state applied to new rows, batch or streaming: ``keep`` columns (all other
    columns by default) and ``component_1 .. component_k``. One narrow stage, no refit."""
    kept = [c for c in df.columns if c not in preprocessor.features] if keep is None else list(keep)
    standard = preprocessor.transform(df, kept)
    return coordinates(model.transform(standard, check=False), model.count, "reduced", kept)


def transform(spark: SparkSession, df: DataFrame, *, model_path: str, preprocessor_path: str, keep=None) -> DataFrame:
    """``score`` with state loaded from a run directory; a batch without rows is an error."""
    if not df.isStreaming and df.isEmpty():
        raise ValueError("Dataset is empty")
    return score(df, load_preprocessor(spark, preprocessor_path), load_model(spark, model_path), keep)


def _bounded_sample(df, target, max_samples, seed, row_id, exclude):
    """All rows standardised by their own statistics, then an exact-size sample of them (None: all)."""
    if max_samples is not None and max_samples < 3:
        raise ValueError("max_samples must be at least 3")
    prepared = prepare(df, target=target, train_fraction=1.0, seed=seed, row_id=row_id, exclude=exclude)
    key = prepared.data.row_id
    if max_samples is None or max_samples >= prepared.rows:
        return prepared.frame.drop("split"), key, MatrixShape(prepared.rows, prepared.width)
    sample = sample_rows(prepared.frame, key, max_samples=max_samples, seed=seed, rows=prepared.rows)
    return stage(sample.drop("split"), "sample"), key, MatrixShape(max_samples, prepared.width)


def affinity_graph(
    df: DataFrame,
    *,
    target: str | None = "quality",
    max_samples: int | None = 1000,
    perplexity: float = 30.0,
    seed: int = 42,
    row_id: str | None = None,
    exclude: Sequence[str] = (),
    layout_steps: int = 0,
) -> dict[str, DataFrame]:
    """Perplexity-calibrated affinities of a bounded sample, or of all rows of a small table: edges, labels, parameters, and
    with ``layout_steps`` two-dimensional coordinates."""
    sample, key, shape = _bounded_sample(df, target, max_samples, seed, row_id, exclude)
    check_perplexity(perplexity, shape.rows)
    joint = joint_affinities(sample, key, shape, perplexity)
    parameters = [("sample_size", float(shape.rows)), ("perplexity", float(perplexity)), ("random_state", float(seed))]
    edges = affinity_edges(joint, key, position_table(sample, key, shape))
    return _graph_tables(sample, key, shape, target, seed, edges, edges, parameters, layout_steps)


def _graph_tables(sample, key, shape, target, seed, edges, weighted, parameters, layout_steps) -> dict[str, DataFrame]:
    tables = {"edges": edges, "labels": fallback_labels(sample, key, "features", shape, target, seed=seed)}
    if layout_steps:
        laid = lay_out(weighted, sample.select(f"`{key}`"), key, shape.rows, steps=layout_steps, seed=seed)
        tables["coordinates"] = laid.points
        parameters = [*parameters, *[(f"layout_{name}", float(value)) for name, value in laid.parameters.items()]]
    tables["parameters"] = sample.sparkSession.createDataFrame(parameters, "parameter string, value double")
    return tables


def knn_graph(
    df: DataFrame,
    *,
    target: str | None = "quality",
    max_samples: int | None = 5000,
    n_neighbors: int = 15,
    seed: int = 42,
    row_id: str | None = None,
    exclude: Sequence[str] = (),
    layout_steps: int = 0,
) -> dict[str, DataFrame]:
    """Exact nearest-neighbour graph of a sample or (``max_samples=None``) of all rows: edges, labels, parameters, and with
    ``layout_steps`` two-dimensional coordinates, from affinities over the graph at a third of its neighbours as perplexity."""
    sample, key, shape = _bounded_sample(df, target, max_samples, seed, row_id, exclude)
    parameters = [("sample_size", float(shape.rows)), ("n_neighbors", float(n_neighbors)), ("random_state", float(seed))]
    edges = nearest_neighbours(sample, key, n_neighbors, shape)
    if layout_steps:
        edges = stage(edges, "edges")
    weighted = neighbour_affinities(edges, key, max(1.5, n_neighbors / 3)) if layout_steps else None
    return _graph_tables(sample, key, shape, target, seed, edges, weighted, parameters, layout_steps)


def compress_image_files(spark: SparkSession, path: str, ranks: Sequence[int] = (5, 20, 50, 100)) -> tuple[DataFrame, DataFrame]:
    """Rank sweep over a file or folder of images: (rebuilt rows, metrics)."""
    return compress_images(stage(read_image_planes(spark, path), "planes"), ranks)


def denoise_series(series: DataFrame, *, rank: int = 4, window: int | None = None, reference: str | None = None) -> dict[str, DataFrame]:
    """Denoise many series; with a reference column also the errors before and after."""
    cleaned = denoise(series.select("series_id", "t", "value"), rank=rank, window=window)
    tables = {"denoised": cleaned}
    if reference is not None:
        joined = cleaned.join(series.select("series_id", "t", F.col(reference).alias("reference")), ["series_id", "t"])
        for name, column in (("noisy_errors", "value"), ("denoised_errors", "denoised")):
            tables[name] = series_errors(joined, "reference", column)
    return tables


JOBS = {
    "train": train,
    "compare": compare,
    "transform": transform,
    "nonlinear": affinity_graph,
    "umap": knn_graph,
    "bonus-image": compress_image_files,
    "bonus-signal": denoise_series,
}


def job(name: str):
    """The job function behind a command name."""
    if name not in JOBS:
        raise ValueError(f"Unsupported command: {name}")
    return JOBS[name]


def parse_target(value: str | None) -> str | None:
    """``none``, ``null`` and ``-`` mean that there is no target."""
    return None if value is None or value.strip().lower() in {"none", "null", "-"} else value
