"""Clustering evaluation of one or several representations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from eigenlake.operators.clean import MatrixShape, check_matrix
from eigenlake.operators.cluster_metrics import class_counts, evaluate_labellings
from eigenlake.operators.kmeans import (
    KMeansModel,
    KMeansRequest,
    fit_kmeans,
    fit_kmeans_together,
    label_all,
    nearest_centre,
)
from eigenlake.session import stage

SWEEP_SCHEMA = "representation string, k int, metric string, value double"


@dataclass(frozen=True)
class ClusterResult:
    """Assignments ``(row_id, cluster)`` and the metrics of one clustering."""

    assignments: DataFrame
    metrics: dict[str, float]
    model: KMeansModel


def cluster_representations(
    df: DataFrame,
    row_id: str,
    requests: Sequence[KMeansRequest],
    rows: int,
    *,
    references: Sequence[str | None],
    alike: Mapping[str, str] | None = None,
    seed: int = 42,
    n_init: int = 20,
    silhouette_sample: int | None = None,
    **fit_options,
) -> list[tuple[list[KMeansModel], list[dict[str, float]]]]:
    """Fit all requests in shared passes, then score each: (models, metrics) per request.

    The labellings of one column are scored together, whatever request they come from: distances are computed once per column.
    ``alike`` names for a column another one that has the same distances between all rows; those of both are then computed once.
    """
    fitted = fit_kmeans_together(df, row_id, requests, rows, seed=seed, n_init=n_init, **fit_options)
    out: list = [None] * len(requests)
    distances = [(alike or {}).get(request.column, request.column) for request in requests]
    for name in dict.fromkeys(distances):
        own = sorted((i for i, other in enumerate(distances) if other == name), key=lambda i: requests[i].column != name)
        models = [fitted[i][k] for i in own for k in requests[i].ks]
        named = [references[i] for i in own for _ in requests[i].ks]
        columns = [requests[i].column for i in own for _ in requests[i].ks]
        kept = dict.fromkeys([row_id, *columns, *[name for name in named if name is not None]])
        labelled = df.select(*[f"`{c}`" for c in kept])
        for column in dict.fromkeys(columns):
            labelled = label_all(labelled, [model for model, other in zip(models, columns) if other == column], column, f"labels_{column}")
        place = {column: iter(range(len(columns))) for column in columns}
        every = F.array(*[F.col(f"`labels_{column}`")[next(place[column])] for column in columns])
        metrics = evaluate_labellings(
            stage(labelled.withColumn("labels", every).drop(*[f"labels_{column}" for column in place]), "labels"),
            row_id,
            [len(model.centers) for model in models],
            MatrixShape(rows, requests[own[0]].width),
            column=columns,
            reference=named,
            silhouette_sample=silhouette_sample,
            seed=seed,
        )
        for i in own:
            count = len(requests[i].ks)
            out[i] = (models[:count], metrics[:count])
            models, metrics = models[count:], metrics[count:]
    return out


def evaluate_kmeans(
    df: DataFrame,
    row_id: str,
    column: str = "features",
    *,
    n_clusters: int = 6,
    reference: str | None = None,
    seed: int = 42,
    n_init: int = 20,
    silhouette_sample: int | None = None,
    shape: MatrixShape | None = None,
    **fit_options,
) -> ClusterResult:
    """Fit, label and score one k. The frame should be staged: it is scanned repeatedly.

    ``fit_options`` (``init``, ``max_iter``, ``tol``) go to the fit.
    """
    shape = shape or check_matrix(df, column)
    request = KMeansRequest(column, shape.width, (n_clusters,))
    [(models, metrics)] = cluster_representations(
        df, row_id, [request], shape.rows, references=[reference], seed=seed, n_init=n_init,
        silhouette_sample=silhouette_sample, **fit_options,
    )
    label = nearest_centre(F.col(column), models[0].centers)
    return ClusterResult(df.select(f"`{row_id}`", label.alias("cluster")), metrics[0], models[0])


def clustering_sweep(
    df: DataFrame,
    row_id: str,
    representations: Mapping[str, int],
    reference: str,
    *,
    min_clusters: int = 2,
    max_clusters: int = 10,
    rows: int | None = None,
    seed: int = 42,
    n_init: int = 20,
    silhouette_sample: int | None = None,
    **fit_options,
) -> DataFrame:
    """Metrics for every k and representation: ``(representation, k, metric, value)``.

    ``representations`` maps a vector column of the one frame to its width, so all of them
    cover the same rows. Per representation all k and restarts share their passes. ``fit_options`` go to the fit.
    """
    if not representations:
        raise ValueError("A sweep takes vector columns; name them. At least one is needed")
    size = df.count() if rows is None else rows
    upper = min(max_clusters, size - 1)
    if upper < min_clusters:
        raise ValueError(f"Not enough rows ({size}) for {min_clusters} clusters")
    ks = tuple(range(min_clusters, upper + 1))
    requests = [KMeansRequest(name, width, ks) for name, width in representations.items()]
    found = cluster_representations(
        df, row_id, requests, size, references=[reference] * len(requests),
        seed=seed, n_init=n_init, silhouette_sample=silhouette_sample, **fit_options,
    )
    return sweep_table(df, [(r.column, r.ks, metrics) for r, (_, metrics) in zip(requests, found)])


def sweep_table(df: DataFrame, results) -> DataFrame:
    """Long table of (representation, cluster counts, metrics per count) results."""
    out = [
        (name, k, key, float(value))
        for name, ks, metrics in results
        for k, found in zip(ks, metrics)
        for key, value in found.items()
    ]
    return df.sparkSession.createDataFrame(out, SWEEP_SCHEMA)


CLASS_COLUMN = "class_label"


def class_label(df: DataFrame, group: str) -> DataFrame:
    """Add the class of every row as text, a missing class as ``<missing>``."""
    return df.withColumn(CLASS_COLUMN, F.coalesce(F.col(f"`{group}`").cast("string"), F.lit("<missing>")))


# More classes than this are refused: their centres go to every task.
MAX_CLASSES = 1_000


def separable_classes(df: DataFrame, group: str, *, rows: int, train_rows: int, width: int) -> tuple[DataFrame, int] | None:
    """Class counts and their number, or None when separability cannot be measured: the
    column is absent, has fewer than two classes, or the training data is too small. More than ``MAX_CLASSES``
    classes are an error."""
    if group not in df.columns or min(train_rows, width) < 2:
        return None
    counts = class_counts(df, group)
    classes = counts.count()
    if not 2 <= classes <= rows - 1:
        return None
    if classes > MAX_CLASSES:
        raise ValueError(f"column {group} has {classes} classes; separability takes {MAX_CLASSES} at most")
    return counts, classes


def separability(
    df: DataFrame,
    row_id: str,
    group: str,
    representations: Mapping[str, int],
    *,
    rows: int,
    train_rows: int,
    width: int,
    seed: int = 42,
    n_init: int = 20,
    silhouette_sample: int | None = None,
    **fit_options,
) -> tuple[DataFrame, DataFrame] | None:
    """Does a class column survive the reduction? K-means with one cluster per class on each
    representation, scored against the classes: (class counts, metrics) or None."""
    found = separable_classes(df, group, rows=rows, train_rows=train_rows, width=width)
    if found is None:
        return None
    counts, classes = found
    requests = [KMeansRequest(name, size, (classes,)) for name, size in representations.items()]
    scored = cluster_representations(
        class_label(df, group), row_id, requests, rows, references=[CLASS_COLUMN] * len(requests),
        seed=seed, n_init=n_init, silhouette_sample=silhouette_sample, **fit_options,
    )
    return counts, sweep_table(df, [(r.column, r.ks, m) for r, (_, m) in zip(requests, scored)])


def fallback_labels(
    df: DataFrame, row_id: str, column: str, shape: MatrixShape, target: str | None, *, seed: int = 42, n_init: int = 20,
    **fit_options,
) -> DataFrame:
    """``(row_id, label)`` of a sample: its target, else K-means with at most six clusters."""
    if target is not None:
        return df.select(f"`{row_id}`", F.col(f"`{target}`").alias("label"))
    k = min(6, shape.rows - 1)
    model = fit_kmeans(df, row_id, column, ks=[k], seed=seed, n_init=n_init, shape=shape, **fit_options)[k]
    return label_all(df, [model], column).select(f"`{row_id}`", F.col("labels")[0].cast("double").alias("label"))
