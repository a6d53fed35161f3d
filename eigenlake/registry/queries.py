"""The registered queries: each reads the given tables and has its SQL twin where one exists."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from eigenlake.functions.numeric import finite_value, tidy, tidy_many
from eigenlake.operators import affinity, clean, cluster_metrics, clustering, descent, diagnostics, explore
from eigenlake.operators import kmeans, krylov, lowrank, mergeable, neighbours, series
from eigenlake.operators.clean import MatrixShape
from eigenlake.operators.moments import column_means, covariance, gram_cells
from eigenlake.operators.preprocess import Preprocessor
from eigenlake.operators.sample import sample_rows, split_rows
from eigenlake.operators.spectral import build_reducer, choose_component_count, fit_pca, fit_svd, fit_transform
from eigenlake.plans import jobs
from eigenlake.registry import fixtures as fx, oracle as sql
from eigenlake.registry.oracle import D, r, with_steps
from eigenlake.session import fresh_path, stage
from eigenlake.sources.images import normalise_pixels
from eigenlake.sources.models import load_model, load_preprocessor, save_model, save_preprocessor
from eigenlake.sources.sinks import coordinates
from eigenlake.sources.tables import combine_labelled

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

F1_NAMES = list(fx.FEATURES)
DIRTY_NAMES = list(sql.DIRTY_FEATURES)


def query(name: str, oracle: str | None = None):
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: tidy(F.col(c), digits) for c in columns})


def spread(column: str, width: int, prefix: str, digits: int = 6) -> list:
    """Entries of an array column as rounded columns."""
    return [tidy(F.col(column)[i], digits).alias(f"{prefix}{i + 1}") for i in range(width)]


def spread_sql(column: str, width: int, prefix: str, digits: int = 6) -> str:
    return ", ".join(f"{r(f'{column}[{i + 1}]', digits)} AS {prefix}{i + 1}" for i in range(width))


def profile(spark: SparkSession, sf_dir: str) -> jobs.Prepared:
    return jobs.prepare(
        fx.order_profile(spark, sf_dir), target="target", row_id="row_id", drop_duplicates=False
    )


def fitted_profile(spark: SparkSession, sf_dir: str, method: str = "pca", **options):
    prepared = profile(spark, sf_dir)
    return prepared, build_reducer(method)(prepared.train, shape=prepared.train_shape, **options)


def dirty_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_rows(stage(fx.dirty_profile(spark, sf_dir), "dirty"), "row_id")


def dirty_state(frame: DataFrame) -> Preprocessor:
    return Preprocessor.fit(frame.where(F.col("split") == "train"), DIRTY_NAMES)


def labelled_vectors(spark: SparkSession, sf_dir: str):
    """Embeddings with their label as the only labelling, staged, and their shape."""
    frame = stage(
        fx.vectors(spark, sf_dir).withColumn("labels", F.array("label")).withColumn("ref", F.col("row_id") % 4),
        "vectors",
    )
    shape = clean.check_matrix(frame)
    classes = frame.agg(F.max("label")).first()[0] + 1
    return frame, shape, classes


# --- sources, cleaning, splitting ------------------------------------------------------


@query(
    "labelled_union",
    """SELECT 'customer' AS party, c_custkey AS id, c_nationkey AS nation, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_nationkey, s_acctbal FROM supplier""",
)
def labelled_union(spark, sf_dir):
    customer = fx.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")
    )
    supplier = fx.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")
    )
    return combine_labelled({"customer": customer, "supplier": supplier}, "party")


@query("row_dedupe", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def row_dedupe(spark, sf_dir):
    return clean.drop_duplicate_rows(fx.table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment"))


@query(
    "numbered_copies",
    """SELECT c_nationkey, c_mktsegment, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment) AS copy_no
    FROM customer""",
)
def numbered_copies(spark, sf_dir):
    source = fx.table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment")
    keyed = clean.key_rows(source, "row_id", unique=False)
    return keyed.select("c_nationkey", "c_mktsegment", F.split("row_id", "#")[1].cast("bigint").alias("copy_no"))


@query(
    "target_filter",
    with_steps([sql.EVENT_CELLS], "SELECT event_id, value FROM ev WHERE value IS NOT NULL AND isfinite(value)"),
)
def target_filter(spark, sf_dir):
    return clean.filter_target(fx.event_cells(spark, sf_dir), "value").select("event_id", "value")


@query(
    "feature_discovery",
    with_steps(
        [sql.EVENT_CELLS],
        """SELECT pos, feature FROM (
          SELECT 1::BIGINT AS pos, 'user_id' AS feature, count(user_id) AS n FROM ev
          UNION ALL SELECT 2, 'event_type', count(TRY_CAST(event_type AS DOUBLE)) FROM ev
          UNION ALL SELECT 3, 'value', count(value) FROM ev
          UNION ALL SELECT 4, 'five', count(five) FROM ev
          UNION ALL SELECT 5, 'num_text', count(TRY_CAST(num_text AS DOUBLE)) FROM ev) WHERE n > 0""",
    ),
)
def feature_discovery(spark, sf_dir):
    cells = fx.event_cells(spark, sf_dir)
    found, _, _ = clean.discover_features(cells, exclude=["event_id"])
    order = [c for c in cells.columns if c not in ("event_id", "ts")]
    return spark.createDataFrame([(order.index(f) + 1, f) for f in found], "pos bigint, feature string")


@query(
    "mixed_text_scores",
    """WITH e AS (SELECT event_id AS row_id, CASE WHEN event_id % 5 < 2 THEN NULL ELSE (event_id % 97)::DOUBLE END AS x,
        (event_id % 2 = 0)::INTEGER::DOUBLE AS b FROM events),
    i AS (SELECT row_id, coalesce(x, (SELECT median(x) FROM e)) AS x, b FROM e),
    s AS (SELECT avg(x) AS mx, stddev_pop(x) AS sx, avg(b) AS mb, stddev_pop(b) AS sb FROM i)
    SELECT row_id, round((x - mx) / sx, 6) + 0.0 AS mixed, round((b - mb) / sb, 6) + 0.0 AS flag FROM i, s""",
)
def mixed_text_scores(spark, sf_dir):
    """True/false words are missing cells in a column of numbers and 0/1 in a column of their own, also after saving."""
    key = F.col("event_id")
    word = F.when(key % 5 == 0, "true").when(key % 5 == 1, "False").otherwise((key % 97).cast("string"))
    frame = fx.table(spark, sf_dir, "events").select(
        key.alias("row_id"), word.alias("mixed"), F.when(key % 2 == 0, " True").otherwise("false").alias("flag")
    )
    data = clean.load_dataset(frame, target=None, row_id="row_id")
    path = fresh_path(spark, "preprocessor")
    save_preprocessor(spark, Preprocessor.fit(data.frame, data.features, booleans=data.booleans), path)
    scored = load_preprocessor(spark, path).transform(frame, ["row_id"])
    return rounded(scored.select("row_id", F.col("features")[0].alias("mixed"), F.col("features")[1].alias("flag")), ["mixed", "flag"])


@query(
    "finite_coercion",
    with_steps(
        [sql.EVENT_CELLS],
        "SELECT event_id, CASE WHEN isfinite(value) THEN value END AS value, TRY_CAST(num_text AS DOUBLE) AS number FROM ev",
    ),
)
def finite_coercion(spark, sf_dir):
    cells = fx.event_cells(spark, sf_dir)
    types = cells.schema
    return cells.select(
        "event_id",
        finite_value(F.col("value"), types["value"].dataType).alias("value"),
        finite_value(F.col("num_text"), types["num_text"].dataType).alias("number"),
    )


@query(
    "dataset_report",
    with_steps(
        [sql.EVENT_CELLS],
        """SELECT 'rows' AS metric, NULL::VARCHAR AS feature, count(*) AS value FROM ev
        UNION ALL SELECT 'features', NULL, 4
        UNION ALL SELECT 'missing_values', 'user_id', count(*) - count(user_id) FROM ev
        UNION ALL SELECT 'missing_values', 'value', count(*) - count(CASE WHEN isfinite(value) THEN 1 END) FROM ev
        UNION ALL SELECT 'missing_values', 'five', count(*) - count(five) FROM ev
        UNION ALL SELECT 'missing_values', 'num_text', count(*) - count(TRY_CAST(num_text AS DOUBLE)) FROM ev
        UNION ALL SELECT 'duplicate_rows_after_cleaning', NULL, (SELECT count(*) FROM ev) -
          (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type, value, five, num_text FROM ev))""",
    ),
)
def dataset_report(spark, sf_dir):
    cells = fx.event_cells(spark, sf_dir).drop("ts", "event_id")
    data = clean.load_dataset(cells, target=None, drop_duplicates=False)
    return clean.dataset_report(data)


@query(
    "exact_split",
    with_steps([sql.F1, sql.SPLIT], "SELECT row_id, CASE WHEN is_train THEN 'train' ELSE 'test' END AS split FROM sp"),
)
def exact_split(spark, sf_dir):
    return split_rows(stage(fx.order_profile(spark, sf_dir), "profile"), "row_id").select("row_id", "split")


@query(
    "exact_sample",
    "SELECT o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (ORDER BY md5('42:' || o_orderkey::VARCHAR)) <= 1000",
)
def exact_sample(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sample_rows(orders, "o_orderkey", max_samples=1000)


# --- preprocessing ---------------------------------------------------------------------

MEAN, SCALE = "mean", "scale"
DIRTY_STEPS = [sql.F1, sql.DIRTY, sql.DIRTY_SPLIT, sql.MEDIANS, sql.IMPUTED, sql.STATE]


def _state_value(feature: str, part: str) -> str:
    return f"(SELECT {part} FROM state WHERE feature = '{feature}')"


@query(
    "preprocessor_state",
    with_steps(
        DIRTY_STEPS,
        f"SELECT pos, feature, {r('median', 4)} AS median, {r('mean', 4)} AS mean, {r('scale', 4)} AS scale, is_constant, false AS is_boolean FROM state",
    ),
)
def preprocessor_state(spark, sf_dir):
    state = dirty_state(dirty_split(spark, sf_dir))
    return rounded(state.state_table(spark), ["median", "mean", "scale"], 4)


@query(
    "median_impute",
    with_steps(DIRTY_STEPS, "SELECT row_id, " + ", ".join(f"{r(f)} AS {f}" for f in DIRTY_NAMES) + " FROM imp"),
)
def median_impute(spark, sf_dir):
    frame = dirty_split(spark, sf_dir)
    state = dirty_state(frame)
    restored = state.inverse_transform(state.transform(frame, ["row_id"]))
    return restored.select(
        "row_id", *[tidy(F.col("restored")[i]).alias(f) for i, f in enumerate(DIRTY_NAMES)]
    )


@query(
    "standardise",
    with_steps(
        DIRTY_STEPS,
        "SELECT row_id, is_train, "
        + ", ".join(
            f"{r(f'({f} - {_state_value(f, MEAN)}) / {_state_value(f, SCALE)}')} AS z_{f}"
            for f in DIRTY_NAMES
        )
        + " FROM imp",
    ),
)
def standardise(spark, sf_dir):
    frame = dirty_split(spark, sf_dir)
    matrix = dirty_state(frame).transform(frame, ["row_id", "split"])
    return matrix.select(
        "row_id",
        (F.col("split") == "train").alias("is_train"),
        *[tidy(F.col("features")[i]).alias(f"z_{f}") for i, f in enumerate(DIRTY_NAMES)],
    )


@query(
    "matrix_check",
    with_steps([sql.V], "SELECT count(*) AS row_count, max(len(f))::INTEGER AS width FROM v"),
)
def matrix_check(spark, sf_dir):
    shape = clean.check_matrix(fx.vectors(spark, sf_dir))
    return spark.createDataFrame([(shape.rows, shape.width)], "row_count bigint, width int")


@query(
    "group_views",
    with_steps(
        [sql.F1],
        "SELECT flag, row_id, target FROM f1 WHERE flag IN (SELECT flag FROM f1 GROUP BY flag HAVING count(*) >= 2)",
    ),
)
def group_views(spark, sf_dir):
    return cluster_metrics.group_views(fx.order_profile(spark, sf_dir), "flag", ["row_id", "target"])


# --- spectral reduction ----------------------------------------------------------------


@query("column_means", with_steps([sql.V, sql.CELLS], f"SELECT k::INTEGER AS pos, {r('avg(x)')} AS mean FROM cells GROUP BY k"))
def means(spark, sf_dir):
    mean = column_means(fx.vectors(spark, sf_dir), "features", fx.VECTOR_WIDTH)
    return spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(mean)], "pos int, mean double").withColumn(
        "mean", tidy(F.col("mean"))
    )


def _covariance_table(spark, matrix):
    width = len(matrix)
    cells = [(i + 1, j + 1, float(matrix[i, j])) for i in range(width) for j in range(width)]
    return rounded(spark.createDataFrame(cells, "i int, j int, value double"), ["value"])


@query(
    "sample_covariance",
    with_steps([sql.F1, sql.SPLIT, sql.STATS, sql.Z, sql.COV], f"SELECT i::INTEGER AS i, j::INTEGER AS j, {r('v')} AS value FROM cov"),
)
def sample_covariance(spark, sf_dir):
    prepared = profile(spark, sf_dir)
    return _covariance_table(spark, covariance(prepared.train, "features", prepared.width)[1])


@query(
    "wide_covariance",
    with_steps(
        [sql.V],
        f"""SELECT i::INTEGER AS i, j::INTEGER AS j, {r('covar_samp(f[i], f[j])')} AS value
        FROM v, range(1, {fx.VECTOR_WIDTH + 1}) a(i), range(1, {fx.VECTOR_WIDTH + 1}) b(j) GROUP BY i, j""",
    ),
)
def wide_covariance(spark, sf_dir):
    return _covariance_table(spark, covariance(stage(fx.vectors(spark, sf_dir), "v"), "features", fx.VECTOR_WIDTH)[1])


@query(
    "gram_matrix",
    with_steps(
        [sql.V],
        f"""SELECT i::INTEGER - 1 AS i, j::INTEGER - 1 AS j, {r('sum(f[i] * f[j])')} AS value
        FROM v, range(1, {fx.VECTOR_WIDTH + 1}) a(i), range(1, {fx.VECTOR_WIDTH + 1}) b(j) WHERE i <= j GROUP BY i, j""",
    ),
)
def gram_matrix(spark, sf_dir):
    cells = gram_cells(fx.vectors(spark, sf_dir).select("features"), fx.VECTOR_WIDTH)
    return rounded(cells.where("i >= 0"), ["value"])


SPECTRUM_SQL = (
    f"SELECT component, {r('variance')} AS variance, {r('ratio')} AS ratio, {r('cumulative')} AS cumulative"
)


@query("pca_spectrum", with_steps([*sql.SPECTRAL], SPECTRUM_SQL + " FROM spec"))
def pca_spectrum(spark, sf_dir):
    _, model = fitted_profile(spark, sf_dir)
    return rounded(model.spectrum_table(spark).drop("singular_value"), ["variance", "ratio", "cumulative"])


@query(
    "svd_spectrum",
    with_steps(
        [*sql.SPECTRAL],
        SPECTRUM_SQL
        + f", {r('sqrt(variance * ((SELECT count(*) FROM sp WHERE is_train) - 1))', 4)} AS singular_value FROM spec",
    ),
)
def svd_spectrum(spark, sf_dir):
    _, model = fitted_profile(spark, sf_dir, "svd")
    table = rounded(model.spectrum_table(spark), ["variance", "ratio", "cumulative"])
    return rounded(table, ["singular_value"], 4)


WIDE_SPECTRUM_SQL = with_steps(
    [sql.V, f"wc AS (SELECT i, j, covar_samp(f[i], f[j]) AS c FROM v, range(1, {fx.VECTOR_WIDTH + 1}) a(i), range(1, {fx.VECTOR_WIDTH + 1}) b(j) GROUP BY i, j)"],
    f"SELECT {r('sum(CASE WHEN i = j THEN c END)')} AS total_variance, {r('sum(c * c)')} AS squared_norm, {fx.VECTOR_WIDTH}::BIGINT AS components FROM wc",
)


def _wide_spectrum(spark, sf_dir, fit):
    model = fit(stage(fx.vectors(spark, sf_dir), "v"))
    return rounded(
        model.spectrum_table(spark).agg(
            F.sum("variance").alias("total_variance"),
            F.sum(F.col("variance") * F.col("variance")).alias("squared_norm"),
            F.count("component").alias("components"),
        ),
        ["total_variance", "squared_norm"],
    )


@query("wide_pca_spectrum", WIDE_SPECTRUM_SQL)
def wide_pca_spectrum(spark, sf_dir):
    return _wide_spectrum(spark, sf_dir, fit_pca)


@query("wide_svd_spectrum", WIDE_SPECTRUM_SQL)
def wide_svd_spectrum(spark, sf_dir):
    return _wide_spectrum(spark, sf_dir, fit_svd)


THRESHOLDS = (0.5, 0.75, 0.9, 0.95, 0.99)


@query(
    "component_choice",
    with_steps(
        [*sql.SPECTRAL],
        "SELECT threshold, coalesce(min(component) FILTER (cumulative >= threshold), "
        f"{D})::INTEGER AS chosen FROM spec, (SELECT unnest([0.5, 0.75, 0.9, 0.95, 0.99]::DOUBLE[]) AS threshold) GROUP BY threshold",
    ),
)
def component_choice(spark, sf_dir):
    _, model = fitted_profile(spark, sf_dir)
    rows = [
        (t, choose_component_count(model.cumulative, max_components=model.width, variance_threshold=t))
        for t in THRESHOLDS
    ]
    return spark.createDataFrame(rows, "threshold double, chosen int")


COMPONENTS_SQL = with_steps(
    [*sql.SPECTRAL, sql.NAMES, sql.LOADINGS],
    f"SELECT component, pos, feature, {r('loading')} AS loading FROM load, pick WHERE component <= k",
)


@query("pca_components", COMPONENTS_SQL)
def pca_components(spark, sf_dir):
    _, model = fitted_profile(spark, sf_dir)
    return rounded(model.components_table(spark, F1_NAMES), ["loading"])


@query("svd_components", COMPONENTS_SQL)
def svd_components(spark, sf_dir):
    _, model = fitted_profile(spark, sf_dir, "svd")
    return rounded(model.components_table(spark, F1_NAMES), ["loading"])


SCORE_STEPS = [*sql.SPECTRAL, sql.SCORES]
FULL_SCORES_SQL = with_steps(SCORE_STEPS, f"SELECT row_id, {spread_sql('z', D, 'component_')} FROM sc")


@query("pca_scores", FULL_SCORES_SQL)
def pca_scores(spark, sf_dir):
    prepared, model = fitted_profile(spark, sf_dir, n_components=D)
    return model.transform(prepared.frame).select("row_id", *spread("reduced", D, "component_"))


@query("svd_scores", FULL_SCORES_SQL)
def svd_scores(spark, sf_dir):
    prepared, model = fitted_profile(spark, sf_dir, "svd", n_components=D)
    return model.transform(prepared.frame).select("row_id", *spread("reduced", D, "component_"))


def _saved_and_loaded(spark, sf_dir, method):
    """Scores of a model that was written and read back under its stored type."""
    prepared, model = fitted_profile(spark, sf_dir, method, n_components=D)
    path = fresh_path(spark, method)
    save_model(spark, model, path, prepared.data.features)
    loaded = load_model(spark, path, expected=method)
    return loaded.transform(prepared.frame).select("row_id", *spread("reduced", D, "component_"))


@query("saved_pca_scores", FULL_SCORES_SQL)
def saved_pca_scores(spark, sf_dir):
    return _saved_and_loaded(spark, sf_dir, "pca")


@query("merged_pca_scores", FULL_SCORES_SQL)
def merged_pca_scores(spark, sf_dir):
    """Scores of a model from the saved moments of two parts of the training rows."""
    prepared = profile(spark, sf_dir)
    saved = []
    for part in range(2):
        saved.append(fresh_path(spark, "moments"))
        mergeable.measure(prepared.train.where(F.col("row_id") % 2 == part)).save(spark, saved[-1])
    model = mergeable.merge([mergeable.load_moments(spark, path) for path in saved]).model("pca", n_components=D)
    return model.transform(prepared.frame).select("row_id", *spread("reduced", D, "component_"))


@query(
    "leading_spectrum",
    with_steps([*sql.SPECTRAL], f"SELECT component, {r('variance')} AS variance, {r('ratio')} AS ratio FROM spec WHERE component <= 3"),
)
def leading_spectrum(spark, sf_dir):
    """The three leading directions by passes of narrow blocks."""
    found = krylov.fit_leading(profile(spark, sf_dir).train, 3, D)
    rows = [(i + 1, float(v), float(s)) for i, (v, s) in enumerate(zip(found.variance, found.ratio))]
    return rounded(spark.createDataFrame(rows, "component int, variance double, ratio double"), ["variance", "ratio"])


@query("saved_svd_scores", FULL_SCORES_SQL)
def saved_svd_scores(spark, sf_dir):
    return _saved_and_loaded(spark, sf_dir, "svd")


@query(
    "fit_transform_train",
    with_steps(SCORE_STEPS, f"SELECT row_id, {spread_sql('z', 2, 'component_')} FROM sc WHERE is_train"),
)
def fit_transform_train(spark, sf_dir):
    _, reduced = fit_transform(profile(spark, sf_dir).train, "pca", n_components=2)
    return reduced.select("row_id", *spread("reduced", 2, "component_"))


@query(
    "reduced_coordinates",
    with_steps(
        [*SCORE_STEPS],
        f"SELECT row_id, target::DOUBLE AS target, flag, {spread_sql('z', 4, 'component_')} FROM sc",
    ),
)
def reduced_coordinates(spark, sf_dir):
    prepared, model = fitted_profile(spark, sf_dir)
    reduced = coordinates(model.transform(prepared.frame), model.count, "reduced", ["row_id", "target", "flag"])
    return rounded(reduced, [f"component_{i + 1}" for i in range(model.count)])


SCORE_NEW_SQL = with_steps(
    [
        *sql.SPECTRAL,
        "vs AS (SELECT list(v ORDER BY component) AS vs FROM eig)",
        """new AS (SELECT row_id, n, CASE WHEN row_id % 7 <> 0 THEN qty END AS qty, CASE WHEN row_id % 11 <> 0 THEN price END AS price,
          max_price, disc FROM f1)""",
        "nz AS (SELECT row_id, [" + ", ".join(f"(coalesce({f}, d_{f}) - m_{f}) / s_{f}" for f in F1_NAMES) + "] AS f FROM new, st)",
    ],
    "SELECT row_id, " + ", ".join(
        r(f"list_dot_product(list_transform(range(1, {D + 1}), lambda i: f[i] - mu[i]), vs[{c}])") + f" AS component_{c}" for c in range(1, 5)
    ) + " FROM nz, mu, vs",
)


@query("score_new_rows", SCORE_NEW_SQL)
def score_new_rows(spark, sf_dir):
    prepared, model = fitted_profile(spark, sf_dir)
    new = fx.order_profile(spark, sf_dir).withColumns(
        {
            "qty": F.when(F.col("row_id") % 7 != 0, F.col("qty")),
            "price": F.when(F.col("row_id") % 11 == 0, F.lit(float("inf"))).otherwise(F.col("price")),
        }
    )
    scored = jobs.score(new, prepared.preprocessor, model, keep=["row_id"])
    return rounded(scored, [f"component_{i + 1}" for i in range(model.count)])


@query("scored_from_run_directory", SCORE_NEW_SQL)
def scored_from_run_directory(spark, sf_dir):
    """New rows scored from the bundle of a training job (``transform``)."""
    prepared, model = fitted_profile(spark, sf_dir)
    result = jobs.JobResult(prepared.preprocessor, {"pca": model})
    path = result.write(spark, fresh_path(spark, "bundle"), "train")
    new = fx.order_profile(spark, sf_dir).withColumns(
        {
            "qty": F.when(F.col("row_id") % 7 != 0, F.col("qty")),
            "price": F.when(F.col("row_id") % 11 == 0, F.lit(float("inf"))).otherwise(F.col("price")),
        }
    )
    scored = jobs.transform(
        spark, new, model_path=f"{path}/pca_model", preprocessor_path=f"{path}/preprocessor", keep=["row_id"]
    )
    return rounded(scored, [f"component_{i + 1}" for i in range(model.count)])


@query(
    "full_reconstruction",
    with_steps([sql.F1, sql.SPLIT, sql.STATS, sql.Z], f"SELECT row_id, {spread_sql('f', D, 'x')} FROM z"),
)
def full_reconstruction(spark, sf_dir):
    prepared, model = fitted_profile(spark, sf_dir, n_components=D)
    rebuilt = model.inverse_transform(model.transform(prepared.frame))
    return rebuilt.select("row_id", *spread("reconstructed", D, "x"))


@query(
    "prefix_reconstruction",
    with_steps([*SCORE_STEPS, sql.rebuilt_step("2")], f"SELECT row_id, {spread_sql('r', D, 'x')} FROM rb"),
)
def prefix_reconstruction(spark, sf_dir):
    prepared, model = fitted_profile(spark, sf_dir)
    return model.reconstruct_prefix(prepared.frame, 2).select("row_id", *spread("reconstructed", D, "x"))


# --- diagnostics -----------------------------------------------------------------------

RESIDUALS = [*SCORE_STEPS, "pk AS (SELECT k FROM pick)", sql.rebuilt_step("(SELECT k FROM pk)"),
             "res AS (SELECT is_train, list_sum(list_transform(range(1, 6), lambda i: (f[i] - r[i]) ** 2)) AS r2, list_dot_product(f, f) AS x2 FROM rb)"]


def _mse(where: str = "true") -> str:
    return f"(SELECT sum(r2) / (count(*) * {D}) FROM res WHERE {where})"


def _rel(where: str = "true") -> str:
    return f"(SELECT sqrt(sum(r2)) / sqrt(sum(x2)) FROM res WHERE {where})"


@query(
    "reconstruction_error",
    with_steps(RESIDUALS, f"SELECT {r(_mse())} AS mse, {r(_rel())} AS relative_frobenius_error"),
)
def reconstruction_error(spark, sf_dir):
    prepared, model = fitted_profile(spark, sf_dir)
    rebuilt = model.inverse_transform(model.transform(prepared.frame))
    return rounded(diagnostics.reconstruction_metrics(rebuilt, D), ["mse", "relative_frobenius_error"])


@query(
    "reconstruction_report",
    with_steps(
        RESIDUALS,
        f"""SELECT {r(_mse())} AS mse, {r(_rel())} AS relative_frobenius_error,
        {r(_mse('is_train'))} AS train_mse, {r(_rel('is_train'))} AS train_relative_frobenius_error,
        {r(_mse('NOT is_train'))} AS test_mse, {r(_rel('NOT is_train'))} AS test_relative_frobenius_error,
        {r(_mse('NOT is_train') + ' - ' + _mse('is_train'))} AS test_minus_train_mse,
        {r(_mse('NOT is_train') + ' / ' + _mse('is_train'))} AS test_to_train_mse_ratio""",
    ),
)
def reconstruction_report(spark, sf_dir):
    prepared, model = fitted_profile(spark, sf_dir, "svd")
    rebuilt = model.inverse_transform(model.transform(prepared.frame))
    report = diagnostics.reconstruction_report(rebuilt, D)
    return rounded(report, report.columns)


@query(
    "variance_retained",
    with_steps([*sql.SPECTRAL], f"SELECT {r('sum(ratio)')} AS variance_retained FROM spec, pick WHERE component <= k"),
)
def variance_retained(spark, sf_dir):
    _, model = fitted_profile(spark, sf_dir)
    return rounded(diagnostics.variance_retained(model.spectrum_table(spark), model.count), ["variance_retained"])


CURVE_STEP = f"""curve AS (SELECT m.method, k::INTEGER AS k,
    sum(CASE WHEN is_train THEN tail END) / (count(CASE WHEN is_train THEN 1 END) * {D}) AS train_mse,
    sum(CASE WHEN NOT is_train THEN tail END) / (count(CASE WHEN NOT is_train THEN 1 END) * {D}) AS test_mse
  FROM (SELECT is_train, k, list_sum(list_transform(range(1, {D + 1}), lambda c: CASE WHEN c > k THEN z[c] * z[c] ELSE 0.0 END)) AS tail
    FROM sc, range(1, {D + 1}) t(k)), (VALUES ('pca'), ('svd')) m(method) GROUP BY m.method, k)"""


@query(
    "reconstruction_curve",
    with_steps([*SCORE_STEPS, CURVE_STEP], f"SELECT method, k, {r('train_mse')} AS train_mse, {r('test_mse')} AS test_mse FROM curve"),
)
def reconstruction_curve(spark, sf_dir):
    prepared = profile(spark, sf_dir)
    models = [fit_pca(prepared.train, shape=prepared.train_shape), fit_svd(prepared.train, shape=prepared.train_shape)]
    return rounded(diagnostics.reconstruction_curve(prepared.frame, models), ["train_mse", "test_mse"])


@query(
    "component_alignment",
    with_steps([*sql.SPECTRAL], f"SELECT component, {r('abs(list_dot_product(v, v)) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(v, v)))')} AS cosine FROM eig, pick WHERE component <= k"),
)
def component_alignment(spark, sf_dir):
    prepared = profile(spark, sf_dir)
    left = fit_pca(prepared.train, shape=prepared.train_shape).components_table(spark)
    right = fit_svd(prepared.train, shape=prepared.train_shape).components_table(spark)
    return rounded(diagnostics.component_alignment(left, right), ["cosine"])


# A second basis, of the rows that do not train, under names of its own.
OTHER_BASIS = [
    sql.COV.replace("cov AS", "cov_b AS", 1).replace("WHERE is_train", "WHERE NOT is_train"),
    sql.MATRIX.replace("cm1 AS", "cm1_b AS", 1).replace("FROM cov ", "FROM cov_b "),
    re.sub(r"\b(it\d+|cm\d+|e\d+|eig|spec|pick)\b", r"\1_b", sql.EIGEN),
]


@query(
    "alignment_of_two_fits",
    with_steps(
        [*sql.SPECTRAL, *OTHER_BASIS],
        f"""SELECT a.component, {r('list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v)))')} AS cosine
        FROM eig a JOIN eig_b b USING (component)""",
    ),
)
def alignment_of_two_fits(spark, sf_dir):
    """Components of the training rows against those of the test rows."""
    prepared = profile(spark, sf_dir)
    left = fit_pca(prepared.train, n_components=D, shape=prepared.train_shape).components_table(spark)
    test = prepared.frame.where(F.col("split") == "test")
    right = fit_svd(test, n_components=D, shape=MatrixShape(prepared.rows - prepared.train_rows, D)).components_table(spark)
    return rounded(diagnostics.component_alignment(left, right), ["cosine"])


@query(
    "top_component_features",
    with_steps(
        [*sql.SPECTRAL, sql.NAMES, sql.LOADINGS],
        f"""SELECT component, rank::INTEGER AS rank, feature, {r('loading')} AS loading FROM (
          SELECT *, row_number() OVER (PARTITION BY component ORDER BY abs(loading) DESC, pos DESC) AS rank FROM load), pick
        WHERE rank <= 3 AND component <= k""",
    ),
)
def top_component_features(spark, sf_dir):
    _, model = fitted_profile(spark, sf_dir)
    return rounded(diagnostics.top_component_features(model.components_table(spark, F1_NAMES), 3), ["loading"])


# --- clustering ------------------------------------------------------------------------


@query(
    "nearest_centroid",
    with_steps(
        [sql.V, "init AS (SELECT label, arg_min(f, row_id) AS c FROM v GROUP BY label)"],
        """SELECT v.row_id, (arg_min(init.label, [list_distance(f, c), init.label]))::INTEGER AS cluster
        FROM v, init GROUP BY v.row_id""",
    ),
)
def nearest_centroid(spark, sf_dir):
    frame = fx.vectors(spark, sf_dir)
    return frame.select("row_id", kmeans.nearest_centre(F.col("features"), _first_per_label(frame)).alias("cluster"))


def _first_per_label(frame: DataFrame) -> np.ndarray:
    first = frame.groupBy("label").agg(F.min_by("features", "row_id").alias("c")).orderBy("label").collect()
    return np.array([row["c"] for row in first])


def _lloyd_sql(steps: int) -> str:
    parts = [sql.V, "c0 AS (SELECT label, arg_min(f, row_id) AS c FROM v GROUP BY label)"]
    for s in range(steps + 1):
        parts.append(
            f"a{s} AS (SELECT v.row_id, any_value(f) AS f, (arg_min(c{s}.label, [list_distance(f, c), c{s}.label]))::INTEGER AS label, min(list_distance(f, c)) AS d FROM v, c{s} GROUP BY v.row_id)"
        )
        if s < steps:
            parts.append(
                f"c{s + 1} AS (SELECT label, list(m ORDER BY k) AS c FROM (SELECT label, k, avg(f[k]) AS m FROM a{s}, range(1, {fx.VECTOR_WIDTH + 1}) r(k) GROUP BY label, k) GROUP BY label)"
            )
    return with_steps(parts, f"SELECT label AS cluster, count(*) AS row_count, {r('sum(d * d)', 4)} AS inertia FROM a{steps} GROUP BY label")


@query("lloyd_steps", _lloyd_sql(3))
def lloyd_steps(spark, sf_dir):
    frame = stage(fx.vectors(spark, sf_dir), "v")
    start = _first_per_label(frame)
    model = kmeans.fit_kmeans(frame, "row_id", ks=[len(start)], init=start, max_iter=3, tol=0.0)[len(start)]
    labelled = frame.withColumn("cluster", kmeans.nearest_centre(F.col("features"), model.centers))
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in model.centers])[F.col("cluster")]
    square = F.aggregate(F.zip_with("features", centres, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    return labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("row_count"), tidy(F.sum(square), 4).alias("inertia"))


@query(
    "kmeans_fit",
    with_steps(
        [sql.V],
        "SELECT count(DISTINCT label)::INTEGER AS k, count(*) AS row_count, true AS beats_label_partition, true AS centres_are_means FROM v",
    ),
)
def kmeans_fit(spark, sf_dir):
    frame, shape, classes = labelled_vectors(spark, sf_dir)
    model = kmeans.fit_kmeans(frame, "row_id", ks=[classes], shape=shape)[classes]
    found = kmeans.label_all(frame, [model], "features", "found")
    given = cluster_metrics.internal_metrics(frame, [classes], shape)[0]["inertia"]
    reached = cluster_metrics.internal_metrics(found, [classes], shape, labels="found")[0]["inertia"]
    return found.agg(
        (F.max(F.col("found")[0]) + 1).alias("k"),
        F.count(F.lit(1)).alias("row_count"),
        F.lit(model.inertia <= given).alias("beats_label_partition"),
        F.lit(abs(reached - model.inertia) <= 1e-3 * model.inertia).alias("centres_are_means"),
    )


def _started_metrics_sql(steps: int) -> str:
    """All metrics of the labels that so many steps from the given centres reach."""
    lloyd = _lloyd_sql(steps).removeprefix("WITH RECURSIVE ").rsplit("\nSELECT", 1)[0]
    lloyd = lloyd.replace(sql.V, sql.V.replace("v AS", "raw_v AS", 1)).replace("FROM v,", "FROM raw_v,").replace("FROM v ", "FROM raw_v ").replace("SELECT v.row_id", "SELECT raw_v.row_id").replace("GROUP BY v.row_id", "GROUP BY raw_v.row_id")
    parts = [
        lloyd, f"v AS (SELECT row_id, f, label FROM a{steps})", sql.CELLS, sql.CENTROIDS, sql.OWN, sql.PAIRS, sql.SILHOUETTE, *MARGINS[1:],
        "gm AS (SELECT list(m ORDER BY k) AS g FROM (SELECT k, avg(x) AS m FROM cells GROUP BY k))",
        "bw AS (SELECT sum(n * list_distance(c, g) ** 2) AS b, count(*) AS k FROM cen, gm)",
        "k2 AS (SELECT label, s, c FROM (SELECT label, avg(d) AS s FROM own GROUP BY label) JOIN cen USING (label))",
        """q AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM ct) AS t, (SELECT sum(n * (n - 1) / 2) FROM ra) AS a,
          (SELECT sum(n * (n - 1) / 2) FROM ca) AS b, (SELECT n * (n - 1) / 2 FROM tt) AS p,
          (SELECT -sum(n / t * ln(n / t)) FROM ra, (SELECT n AS t FROM tt)) AS hr,
          (SELECT -sum(n / t * ln(n / t)) FROM ca, (SELECT n AS t FROM tt)) AS hc,
          (SELECT sum(ct.n / t * ln(ct.n * t / (ra.n * ca.n))) FROM ct JOIN ra USING (reference) JOIN ca USING (cluster), (SELECT n AS t FROM tt)) AS mi)""",
    ]
    found = {
        "inertia": "SELECT sum(d * d) AS value FROM own",
        "calinski_harabasz": "SELECT any_value(b) * (count(*) - any_value(k)) / (sum(d * d) * (any_value(k) - 1)) AS value FROM own, bw",
        "davies_bouldin": "SELECT avg(m) AS value FROM (SELECT a.label, max((a.s + b.s) / list_distance(a.c, b.c)) AS m FROM k2 a, k2 b WHERE a.label <> b.label GROUP BY a.label)",
        "silhouette": "SELECT avg(s) AS value FROM sil",
        "adjusted_rand_index": "SELECT (t - a * b / p) / ((a + b) / 2 - a * b / p) AS value FROM q",
        "normalized_mutual_information": "SELECT mi / ((hr + hc) / 2) AS value FROM q",
    }
    rows = " UNION ALL ".join(f"SELECT '{name}' AS metric, {r('value', 4)} AS value FROM ({text})" for name, text in found.items())
    return with_steps(parts, rows)


def kmeans_metrics_from_start(spark, sf_dir):
    """``evaluate_kmeans`` from stated centres in a stated number of steps."""
    frame = stage(fx.vectors(spark, sf_dir).withColumn("ref", F.col("row_id") % 4), "v")
    start = _first_per_label(frame)
    found = clustering.evaluate_kmeans(
        frame, "row_id", n_clusters=len(start), reference="ref", init=start, max_iter=2, tol=0.0
    )
    return rounded(spark.createDataFrame(list(found.metrics.items()), "metric string, value double"), ["value"], 4)


@query("inertia", with_steps([sql.V, sql.CELLS, sql.CENTROIDS, sql.OWN], f"SELECT {r('sum(d * d)', 4)} AS value FROM own"))
def inertia(spark, sf_dir):
    return _internal(spark, sf_dir, "inertia")


def _internal(spark, sf_dir, name):
    frame, shape, classes = labelled_vectors(spark, sf_dir)
    value = cluster_metrics.internal_metrics(frame, [classes], shape)[0][name]
    return rounded(spark.createDataFrame([(value,)], "value double"), ["value"], 4)


@query(
    "calinski_harabasz",
    with_steps(
        [sql.V, sql.CELLS, sql.CENTROIDS, sql.OWN,
         "gm AS (SELECT list(m ORDER BY k) AS g FROM (SELECT k, avg(x) AS m FROM cells GROUP BY k))",
         "bw AS (SELECT sum(n * list_distance(c, g) ** 2) AS b, count(*) AS k FROM cen, gm)"],
        f"SELECT {r('any_value(b) * (count(*) - any_value(k)) / (sum(d * d) * (any_value(k) - 1))', 4)} AS value FROM own, bw",
    ),
)
def calinski_harabasz(spark, sf_dir):
    return _internal(spark, sf_dir, "calinski_harabasz")


@query(
    "davies_bouldin",
    with_steps(
        [sql.V, sql.CELLS, sql.CENTROIDS, sql.OWN, "sd AS (SELECT label, avg(d) AS s FROM own GROUP BY label)",
         "k2 AS (SELECT label, s, c FROM sd JOIN cen USING (label))"],
        f"SELECT {r('avg(m)', 4)} AS value FROM (SELECT a.label, max((a.s + b.s) / list_distance(a.c, b.c)) AS m FROM k2 a, k2 b WHERE a.label <> b.label GROUP BY a.label)",
    ),
)
def davies_bouldin(spark, sf_dir):
    return _internal(spark, sf_dir, "davies_bouldin")


@query("silhouette_scores", with_steps([sql.V, sql.PAIRS, sql.SILHOUETTE], f"SELECT row_id, {r('s')} AS score FROM sil"))
def silhouette_scores(spark, sf_dir):
    frame, shape, classes = labelled_vectors(spark, sf_dir)
    scored = cluster_metrics.silhouette_scores(frame, "row_id", [classes], shape)
    return scored.select("row_id", tidy(F.col("scores")[0]).alias("score"))


@query("silhouette", with_steps([sql.V, sql.PAIRS, sql.SILHOUETTE], f"SELECT {r('avg(s)')} AS silhouette FROM sil"))
def silhouette(spark, sf_dir):
    frame, shape, classes = labelled_vectors(spark, sf_dir)
    scored = cluster_metrics.silhouette_scores(frame, "row_id", [classes], shape)
    return scored.agg(tidy(F.avg(F.col("scores")[0])).alias("silhouette"))


@query(
    "silhouette_squared",
    with_steps(
        [sql.V, "pairs AS (SELECT a.row_id AS i, b.row_id AS j, a.label AS li, b.label AS lj, list_distance(a.f, b.f) ** 2 AS d FROM v a, v b WHERE a.row_id <> b.row_id)", sql.SILHOUETTE],
        f"SELECT {r('avg(s)')} AS silhouette_squared FROM sil",
    ),
)
def silhouette_squared(spark, sf_dir):
    frame = fx.vectors(spark, sf_dir).withColumnRenamed("label", "cluster")
    value = cluster_metrics.silhouette_squared(frame)
    return rounded(spark.createDataFrame([(value,)], "silhouette_squared double"), ["silhouette_squared"])


MARGINS = [sql.V, sql.CONTINGENCY,
           "ra AS (SELECT reference, sum(n) AS n FROM ct GROUP BY 1)",
           "ca AS (SELECT cluster, sum(n) AS n FROM ct GROUP BY 1)",
           "tt AS (SELECT sum(n) AS n FROM ct)"]


query("kmeans_metrics_from_start", _started_metrics_sql(2))(kmeans_metrics_from_start)


def _agreement(spark, sf_dir, metric):
    frame, _, _ = labelled_vectors(spark, sf_dir)
    table = cluster_metrics.agreement(cluster_metrics.contingency(frame, "ref"))
    return rounded(table.select(metric), [metric])


@query(
    "adjusted_rand_index",
    with_steps(
        [*MARGINS, """q AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM ct) AS t, (SELECT sum(n * (n - 1) / 2) FROM ra) AS a,
          (SELECT sum(n * (n - 1) / 2) FROM ca) AS b, (SELECT n * (n - 1) / 2 FROM tt) AS p)"""],
        f"SELECT {r('(t - a * b / p) / ((a + b) / 2 - a * b / p)')} AS adjusted_rand_index FROM q",
    ),
)
def adjusted_rand_index(spark, sf_dir):
    return _agreement(spark, sf_dir, "adjusted_rand_index")


@query(
    "normalized_mutual_information",
    with_steps(
        [*MARGINS, """q AS (SELECT (SELECT -sum(n / t * ln(n / t)) FROM ra, (SELECT n AS t FROM tt)) AS hr,
          (SELECT -sum(n / t * ln(n / t)) FROM ca, (SELECT n AS t FROM tt)) AS hc,
          (SELECT sum(ct.n / t * ln(ct.n * t / (ra.n * ca.n))) FROM ct JOIN ra USING (reference) JOIN ca USING (cluster), (SELECT n AS t FROM tt)) AS mi)"""],
        f"SELECT {r('mi / ((hr + hc) / 2)')} AS normalized_mutual_information FROM q",
    ),
)
def normalized_mutual_information(spark, sf_dir):
    return _agreement(spark, sf_dir, "normalized_mutual_information")


@query("class_counts", with_steps([sql.F1], "SELECT coalesce(flag, '<missing>') AS class, count(*) AS n FROM f1 GROUP BY 1"))
def class_counts(spark, sf_dir):
    return cluster_metrics.class_counts(fx.order_profile(spark, sf_dir), "flag")


@query("evaluate_kmeans")
def evaluate_kmeans(spark, sf_dir):
    frame, shape, _ = labelled_vectors(spark, sf_dir)
    found = clustering.evaluate_kmeans(frame, "row_id", n_clusters=6, reference="ref", shape=shape)
    rows = [(name, float(value)) for name, value in sorted(found.metrics.items())]
    return rounded(spark.createDataFrame(rows, "metric string, value double"), ["value"], 4)


@query("clustering_sweep")
def clustering_sweep(spark, sf_dir):
    frame, shape, _ = labelled_vectors(spark, sf_dir)
    model = fit_pca(frame, n_components=8)
    both = stage(model.transform(frame), "both")
    sweep = clustering.clustering_sweep(both, "row_id", {"features": shape.width, "reduced": 8}, "ref", rows=shape.rows)
    return rounded(sweep, ["value"], 4)


@query("separability")
def separability(spark, sf_dir):
    prepared, model = fitted_profile(spark, sf_dir, n_components=2)
    frame = stage(model.transform(prepared.frame, output="pca_2d"), "planar")
    _, metrics = clustering.separability(
        frame, "row_id", "flag", {"features": D, "pca_2d": 2},
        rows=prepared.rows, train_rows=prepared.train_rows, width=D,
    )
    return rounded(metrics, ["value"], 4)


# The embeddings and their first half as two representations, and starts at the first vector of each label.
HALF = fx.VECTOR_WIDTH // 2
TWO_REPRESENTATIONS = [
    sql.V,
    f"""pts AS MATERIALIZED (SELECT 'features' AS rep, row_id, f, row_id % 4 AS ref FROM v
      UNION ALL SELECT 'half', row_id, f[1:{HALF}], row_id % 4 FROM v)""",
    "sta AS (SELECT row_number() OVER (ORDER BY label) - 1 AS place, row_id FROM (SELECT label, min(row_id) AS row_id FROM v GROUP BY label))",
]
STEPS = {"max_iter": 2, "tol": 0.0}


def _two_representations(spark, sf_dir):
    frame, shape, _ = labelled_vectors(spark, sf_dir)
    both = stage(frame.withColumn("half", F.slice("features", 1, HALF)), "both")
    starts = [r["row_id"] for r in frame.groupBy("label").agg(F.min("row_id").alias("row_id")).orderBy("label").collect()]
    return both, shape, {"features": shape.width, "half": HALF}, starts


SWEEP_SQL = with_steps(
    [*TWO_REPRESENTATIONS, sql.started_clustering("pts", list(range(2, 11)), 2, "sta")],
    f"SELECT rep AS representation, k::INTEGER AS k, metric, {r('value', 4)} AS value FROM met",
)


@query("sweep_from_starts", SWEEP_SQL)
def sweep_from_starts(spark, sf_dir):
    """``clustering_sweep`` from stated rows in a stated number of steps."""
    both, shape, widths, starts = _two_representations(spark, sf_dir)
    return rounded(clustering.clustering_sweep(both, "row_id", widths, "ref", rows=shape.rows, start_rows=starts, **STEPS), ["value"], 4)


@query(
    "curve_from_starts",
    with_steps(
        [*TWO_REPRESENTATIONS, sql.started_clustering("pts", list(range(2, 11)), 2, "sta")],
        f"SELECT rep AS representation, k::INTEGER AS k, {r('value', 4)} AS value FROM met WHERE metric = 'adjusted_rand_index'",
    ),
)
def curve_from_starts(spark, sf_dir):
    """``metric_curve`` of the sweep from stated rows."""
    return explore.metric_curve(sweep_from_starts(spark, sf_dir), "adjusted_rand_index")


@query(
    "separability_from_starts",
    with_steps(
        [*TWO_REPRESENTATIONS, sql.started_clustering("pts", [4], 2, "sta")],
        f"SELECT rep AS representation, k::INTEGER AS k, metric, {r('value', 4)} AS value FROM met",
    ),
)
def separability_from_starts(spark, sf_dir):
    both, shape, widths, starts = _two_representations(spark, sf_dir)
    _, metrics = clustering.separability(
        both.withColumn("kind", F.col("ref").cast("string")), "row_id", "kind", widths,
        rows=shape.rows, train_rows=shape.rows, width=shape.width, start_rows=starts, **STEPS,
    )
    return rounded(metrics, ["value"], 4)


@query(
    "cluster_labels_from_starts",
    with_steps(
        [*TWO_REPRESENTATIONS, sql.started_clustering("pts", [6], 2, "sta")],
        "SELECT row_id, label::DOUBLE AS label FROM a2 WHERE rep = 'features'",
    ),
)
def cluster_labels_from_starts(spark, sf_dir):
    """The K-means branch of ``fallback_labels`` from stated rows."""
    both, shape, _, starts = _two_representations(spark, sf_dir)
    return clustering.fallback_labels(both, "row_id", "features", shape, None, start_rows=starts, **STEPS)


@query("silhouette_by_grid", with_steps([sql.V, sql.PAIRS, sql.SILHOUETTE], f"SELECT row_id, {r('s')} AS score FROM sil"))
def silhouette_by_grid(spark, sf_dir):
    """The silhouette of a table in many blocks."""
    frame, shape, classes = labelled_vectors(spark, sf_dir)
    scored = cluster_metrics.silhouette_scores(frame, "row_id", [classes], shape, block_bytes=100 * 8 * fx.VECTOR_WIDTH)
    return scored.select("row_id", tidy(F.col("scores")[0]).alias("score"))


# --- exploratory tables ----------------------------------------------------------------


@query("target_distribution", with_steps([sql.F1], "SELECT target, count(*) AS n FROM f1 GROUP BY 1"))
def target_distribution(spark, sf_dir):
    return explore.target_distribution(fx.order_profile(spark, sf_dir), "target")


def _raw_dirty(spark, sf_dir):
    """Finite raw features of the dirty profile, missing cells as NULL."""
    frame = fx.dirty_profile(spark, sf_dir)
    return stage(
        frame.select(*[finite_value(F.col(f), frame.schema[f].dataType).alias(f) for f in DIRTY_NAMES]), "raw"
    )


BINS = 20
LONG_DIRTY = "lg AS (" + " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS x FROM dirty WHERE {f} IS NOT NULL" for f in DIRTY_NAMES) + ")"
RANGES = "rg AS (SELECT feature, min(x) AS lo, max(x) AS hi, count(*) AS n, stddev_samp(x) AS s FROM lg GROUP BY 1)"


@query(
    "feature_histograms",
    with_steps(
        [sql.F1, sql.DIRTY, LONG_DIRTY, RANGES,
         f"st AS (SELECT *, (hi - lo) / {BINS} AS w FROM rg)",
         f"b AS (SELECT feature, CASE WHEN w > 0 THEN least(floor((x - lo) / w), {BINS - 1}) ELSE 0 END::INTEGER AS bin, count(*) AS n FROM lg JOIN st USING (feature) GROUP BY ALL)",
         f"e AS (SELECT feature, lo, w, bin::INTEGER AS bin FROM st, range({BINS}) t(bin) WHERE w > 0 OR bin = 0)"],
        f"SELECT feature, bin, {r('lo + bin * w', 4)} AS low, {r('lo + (bin + 1) * w', 4)} AS high, coalesce(n, 0) AS n FROM e LEFT JOIN b USING (feature, bin)",
    ),
)
def feature_histograms(spark, sf_dir):
    return rounded(explore.feature_histograms(_raw_dirty(spark, sf_dir), DIRTY_NAMES, BINS), ["low", "high"], 4)


GRID = 50


@query(
    "feature_density",
    with_steps(
        [sql.F1, sql.DIRTY, LONG_DIRTY, RANGES,
         f"g AS (SELECT feature, p::INTEGER AS point, lo + p * (hi - lo) / {GRID - 1} AS gx, n, s * n ** -0.2 AS h FROM rg, range({GRID}) t(p) WHERE s > 0)"],
        f"SELECT feature, point, {r('gx', 4)} AS x, {r('sum(exp(-0.5 * ((gx - x) / h) ** 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi()))')} AS density FROM g JOIN lg USING (feature) GROUP BY feature, point, gx",
    ),
)
def feature_density(spark, sf_dir):
    table = explore.feature_density(_raw_dirty(spark, sf_dir), DIRTY_NAMES, GRID)
    return rounded(rounded(table, ["x"], 4), ["density"])


@query(
    "correlation_matrix",
    with_steps(
        [sql.F1, sql.DIRTY],
        " UNION ALL ".join(
            f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, (SELECT CASE WHEN isnan(c) THEN NULL ELSE {r('c')} END FROM (SELECT corr({a}, {b}) AS c FROM dirty)) AS correlation"
            for a in DIRTY_NAMES
            for b in DIRTY_NAMES
        ),
    ),
)
def correlation_matrix(spark, sf_dir):
    return rounded(explore.correlation_matrix(_raw_dirty(spark, sf_dir), DIRTY_NAMES), ["correlation"])


@query(
    "variance_curves",
    with_steps(
        [*sql.SPECTRAL],
        f"SELECT method, component AS k, {r('cumulative')} AS cumulative, 0.95::DOUBLE AS threshold FROM spec, (VALUES ('PCA'), ('SVD')) m(method)",
    ),
)
def variance_curves(spark, sf_dir):
    prepared = profile(spark, sf_dir)
    spectra = {"PCA": fit_pca(prepared.train, shape=prepared.train_shape).spectrum_table(spark), "SVD": fit_svd(prepared.train, shape=prepared.train_shape).spectrum_table(spark)}
    return rounded(explore.variance_curves(spectra, 0.95), ["cumulative"])


@query(
    "curve_overlap",
    with_steps(
        [*sql.SPECTRAL],
        f"""SELECT bool_and(abs(a.cumulative - b.cumulative) <= 1e-10) AS overlap, count(*) AS points,
        {r('max(abs(a.cumulative - b.cumulative))')} AS gap, {r('sum(a.cumulative)')} AS left_sum, {r('sum(b.cumulative)')} AS right_sum
        FROM spec a FULL JOIN spec b USING (component)""",
    ),
)
def curve_overlap(spark, sf_dir):
    prepared = profile(spark, sf_dir)
    pca, svd = (fit(prepared.train, shape=prepared.train_shape).spectrum_table(spark) for fit in (fit_pca, fit_svd))
    return rounded(explore.curves_overlap(pca, svd, "component"), ["gap", "left_sum", "right_sum"])


@query(
    "embedding_points_2d",
    with_steps(SCORE_STEPS, f"SELECT row_id, {r('z[1]')} AS x, {r('z[2]')} AS y, target::DOUBLE AS label FROM sc"),
)
def embedding_points_2d(spark, sf_dir):
    prepared, model = fitted_profile(spark, sf_dir)
    points = explore.embedding_points(model.transform(prepared.frame), 2, "target", ["row_id"])
    return rounded(points, ["x", "y"])


@query(
    "embedding_points_3d",
    with_steps(SCORE_STEPS, f"SELECT row_id, {r('z[1]')} AS x, {r('z[2]')} AS y, {r('z[3]')} AS z, target::DOUBLE AS label FROM sc"),
)
def embedding_points_3d(spark, sf_dir):
    prepared, model = fitted_profile(spark, sf_dir, "svd")
    points = explore.embedding_points(model.transform(prepared.frame), 3, "target", ["row_id"])
    return rounded(points, ["x", "y", "z"])


@query(
    "loadings_table",
    with_steps(
        [*sql.SPECTRAL],
        "SELECT component, " + ", ".join(f"{r(f'v[{i + 1}]')} AS {f}" for i, f in enumerate(F1_NAMES)) + " FROM eig, pick WHERE component <= k",
    ),
)
def loadings_table(spark, sf_dir):
    _, model = fitted_profile(spark, sf_dir)
    return rounded(explore.loadings_table(model.components_table(spark, F1_NAMES), F1_NAMES), F1_NAMES)


@query("metric_curve")
def metric_curve(spark, sf_dir):
    frame, shape, _ = labelled_vectors(spark, sf_dir)
    sweep = clustering.clustering_sweep(frame, "row_id", {"features": shape.width}, "ref", rows=shape.rows)
    return rounded(explore.metric_curve(sweep, "adjusted_rand_index"), ["value"], 4)


# --- neighbour graph -------------------------------------------------------------------


def _all_vectors(spark, sf_dir):
    """All embeddings, staged, and their shape; dense work on them is bounded by its own check."""
    frame = stage(fx.vectors(spark, sf_dir), "vectors")
    return frame, MatrixShape(frame.count(), fx.VECTOR_WIDTH)


@query(
    "pairwise_distances",
    with_steps([sql.V], f"SELECT a.row_id AS i, {r('sum(list_distance(a.f, b.f) ** 2)', 4)} AS total, {r('max(list_distance(a.f, b.f) ** 2)')} AS farthest FROM v a, v b GROUP BY a.row_id"),
)
def pairwise_distances(spark, sf_dir):
    sample, shape = _all_vectors(spark, sf_dir)
    table = neighbours.pairwise_distances(sample, "row_id", shape)
    return table.select(
        F.col("row_id").alias("i"),
        tidy(F.aggregate("distances", F.lit(0.0), lambda s, x: s + x), 4).alias("total"),
        tidy(F.array_max("distances")).alias("farthest"),
    )


NEIGHBOURS = 15


@query(
    "nearest_neighbours",
    with_steps(
        [sql.V, sql.PAIRS],
        f"SELECT i AS row_id, j AS neighbour, rank::INTEGER AS rank, {r('d')} AS distance FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY d, j) AS rank FROM pairs) WHERE rank <= {NEIGHBOURS}",
    ),
)
def nearest_neighbours(spark, sf_dir):
    frame = stage(fx.vectors(spark, sf_dir), "v")
    return rounded(neighbours.nearest_neighbours(frame, "row_id", NEIGHBOURS, clean.check_matrix(frame)), ["distance"])


PRUNED_NEIGHBOURS = 5


@query(
    "pruned_neighbours",
    with_steps(
        ["v AS (SELECT c_custkey AS row_id, [c_acctbal::DOUBLE / 100, c_nationkey::DOUBLE * 100] AS f, 0 AS label FROM customer)", sql.PAIRS],
        f"SELECT i AS row_id, j AS neighbour, rank::INTEGER AS rank, {r('d')} AS distance FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY d, j) AS rank FROM pairs) WHERE rank <= {PRUNED_NEIGHBOURS}",
    ),
)
def pruned_neighbours(spark, sf_dir):
    """Neighbours of a table in many blocks, joined cell by cell."""
    customers = fx.table(spark, sf_dir, "customer")
    points = F.array(F.col("c_acctbal").cast("double") / 100, F.col("c_nationkey").cast("double") * 100)
    frame = stage(customers.select(F.col("c_custkey").alias("row_id"), points.alias("features")), "customers")
    shape = clean.check_matrix(frame)
    return rounded(neighbours.nearest_neighbours(frame, "row_id", PRUNED_NEIGHBOURS, shape, block_bytes=3200), ["distance"])


@query(
    "neighbour_descent",
    with_steps([sql.V], f"SELECT count(*) * {NEIGHBOURS} AS edges, count(*) AS row_count, true AS recall_reached, true AS stated_recall_holds FROM v"),
)
def neighbour_descent(spark, sf_dir):
    """The recall that the descent states against the one over all rows."""
    frame = stage(fx.vectors(spark, sf_dir), "v")
    shape = clean.check_matrix(frame)
    found = descent.descend(frame, "row_id", NEIGHBOURS, shape)
    edges = stage(found.edges.select("row_id", "neighbour"), "descent")
    exact = neighbours.nearest_neighbours(frame, "row_id", NEIGHBOURS, shape).select("row_id", "neighbour")
    hits = edges.join(exact, ["row_id", "neighbour"]).count() / (NEIGHBOURS * shape.rows)
    return edges.agg(
        F.count("*").alias("edges"),
        F.count_distinct("row_id").alias("row_count"),
        F.lit(hits >= 0.9).alias("recall_reached"),
        F.lit(abs(hits - found.parameters["recall"]) < 0.05).alias("stated_recall_holds"),
    )


@query(
    "perplexity_calibration",
    with_steps([sql.V, sql.CALIBRATION], f"SELECT row_id, {r('beta', 4)} AS beta, {r('entropy', 4)} AS entropy FROM cal"),
)
def perplexity_calibration(spark, sf_dir):
    sample, shape = _all_vectors(spark, sf_dir)
    table = affinity.calibrated_rows(sample, "row_id", shape, sql.PERPLEXITY)
    return rounded(table.select("row_id", "beta", "entropy"), ["beta", "entropy"], 4)


@query(
    "joint_affinities",
    with_steps(
        [sql.V, sql.CALIBRATION, sql.JOINT],
        f"SELECT i AS row_id, {r('sum(w)', 8)} AS mass, {r('max(w)', 8)} AS strongest FROM joint GROUP BY i",
    ),
)
def joint_affinities(spark, sf_dir):
    sample, shape = _all_vectors(spark, sf_dir)
    joint = affinity.joint_affinities(sample, "row_id", shape, sql.PERPLEXITY)
    return joint.select(
        "row_id",
        tidy(F.aggregate("weights", F.lit(0.0), lambda s, x: s + x), 8).alias("mass"),
        tidy(F.array_max("weights"), 8).alias("strongest"),
    )


@query(
    "kl_divergence",
    with_steps(
        [sql.V, sql.CALIBRATION, sql.JOINT,
         "y AS (SELECT row_id, [f[1] * 10, f[2] * 10] AS y FROM v)",
         "stu AS (SELECT a.row_id AS i, b.row_id AS j, CASE WHEN a.row_id = b.row_id THEN 0.0 ELSE 1.0 / (1.0 + list_distance(a.y, b.y) ** 2) END AS s FROM y a, y b)",
         "q AS (SELECT i, j, greatest(s / (SELECT sum(s) FROM stu), 1e-12) AS q FROM stu)"],
        f"SELECT {r('sum(w * ln(w / q))')} AS kl_divergence FROM (SELECT i, j, greatest(w, 1e-12) AS w FROM joint) JOIN q USING (i, j)",
    ),
)
def kl_divergence(spark, sf_dir):
    sample, shape = _all_vectors(spark, sf_dir)
    joint = affinity.joint_affinities(sample, "row_id", shape, sql.PERPLEXITY)
    embedding = sample.select("row_id", F.array(F.col("features")[0] * 10, F.col("features")[1] * 10).alias("embedding"))
    value = affinity.kl_divergence(joint, embedding, "row_id", shape.rows, 2, ids=sample)
    return rounded(spark.createDataFrame([(value,)], "kl_divergence double"), ["kl_divergence"])


@query(
    "neighbour_affinities",
    with_steps(
        [sql.V, sql.PAIRS, sql.NEIGHBOUR_CALIBRATION, sql.NEIGHBOUR_WEIGHTS],
        f"SELECT i, j, {r('sum(p) / (2 * (SELECT count(*) FROM v))', 8)} AS weight FROM (SELECT i, j, p FROM np UNION ALL SELECT j, i, p FROM np) GROUP BY i, j",
    ),
)
def neighbour_affinities(spark, sf_dir):
    frame = stage(fx.vectors(spark, sf_dir), "v")
    edges = stage(neighbours.nearest_neighbours(frame, "row_id", NEIGHBOURS, clean.check_matrix(frame)), "edges")
    return rounded(affinity.neighbour_affinities(edges, "row_id", sql.NEIGHBOUR_PERPLEXITY), ["weight"], 8)


@query("fallback_labels", with_steps([sql.V], "SELECT row_id, label FROM v"))
def fallback_labels(spark, sf_dir):
    frame = fx.vectors(spark, sf_dir)
    return clustering.fallback_labels(frame, "row_id", "features", clean.check_matrix(frame), "label")


@query("fallback_cluster_labels")
def fallback_cluster_labels(spark, sf_dir):
    frame = stage(fx.vectors(spark, sf_dir), "v")
    return clustering.fallback_labels(frame, "row_id", "features", clean.check_matrix(frame), None)


# --- low-rank planes and series --------------------------------------------------------


@query(
    "pixel_normalisation",
    with_steps(
        [sql.V],
        f"SELECT row_id, {r('list_sum(list_transform(f, lambda x: floor(abs(x) * 255) / 255.0))')} AS total FROM v",
    ),
)
def pixel_normalisation(spark, sf_dir):
    levels = fx.vectors(spark, sf_dir).select(
        "row_id", F.transform("features", lambda x: F.floor(F.abs(x) * 255).cast("int")).alias("pixels")
    )
    scaled = normalise_pixels(levels, "uint8")
    return scaled.select("row_id", tidy(F.aggregate("pixels", F.lit(0.0), lambda s, x: s + x)).alias("total"))


PLANES = """pl AS (SELECT (label % 5)::VARCHAR AS image_id, (floor(label / 5))::INTEGER AS channel, row_id AS row_idx, f FROM v)"""


@query(
    "plane_energy",
    with_steps([sql.V, PLANES], f"SELECT image_id, channel, {r('sum(list_dot_product(f, f))')} AS energy FROM pl GROUP BY 1, 2"),
)
def plane_energy(spark, sf_dir):
    planes = fx.vector_planes(spark, sf_dir)
    cells = lowrank.plane_grams(planes.select("image_id", "channel", "pixels"))
    return cells.groupBy("image_id", "channel").agg(tidy(F.sum(F.when(F.col("i") == F.col("j"), F.col("value")))).alias("energy"))


def _plane_rank1() -> str:
    w = fx.VECTOR_WIDTH
    return f"""pg AS (SELECT image_id, channel, list(r ORDER BY i) AS m FROM (
    SELECT image_id, channel, i, list(v ORDER BY j) AS r FROM (
      SELECT image_id, channel, i, j, sum(f[i] * f[j]) AS v FROM pl, range(1, {w + 1}) a(i), range(1, {w + 1}) b(j) GROUP BY ALL)
    GROUP BY image_id, channel, i) GROUP BY image_id, channel),
pit(s, image_id, channel, v) AS (
  SELECT 0, image_id, channel, m[1] FROM pg
  UNION ALL
  SELECT s + 1, image_id, channel, list_transform(q, lambda x: x / sqrt(list_dot_product(q, q)))
  FROM (SELECT s, image_id, channel, list_transform(m, lambda r: list_dot_product(r, v)) AS q FROM pit JOIN pg USING (image_id, channel) WHERE s < 3000)),
pv AS (SELECT image_id, channel, v FROM pit WHERE s = 3000),
lim AS (SELECT image_id, min(list_min(f)) AS lo, max(list_max(f)) AS hi FROM pl GROUP BY image_id),
rec AS (SELECT image_id, channel, row_idx, f, list_transform(v, lambda x: least(greatest(x * score, lo), hi)) AS g FROM (
  SELECT pl.*, v, lo, hi, list_dot_product(f, v) AS score FROM pl JOIN pv USING (image_id, channel) JOIN lim USING (image_id)))"""


@query(
    "rank_one_planes",
    with_steps(
        [sql.V, PLANES, _plane_rank1(),
         """im AS (SELECT image_id, sum(list_distance(f, g) ** 2) / sum(len(f)) AS mse, count(DISTINCT channel) AS c, sum(len(f)) AS cells, count(*) AS rows, max(len(f)) AS w FROM rec GROUP BY image_id)"""],
        f"SELECT image_id, 1::INTEGER AS rank, {r('mse')} AS mse, {r('20 * log10((hi - lo) / sqrt(mse))', 4)} AS psnr_db, {r('cells / (1 * (rows / c + w + 1) * c)')} AS storage_ratio_estimate FROM im JOIN lim USING (image_id)",
    ),
)
def rank_one_planes(spark, sf_dir):
    planes = stage(fx.vector_planes(spark, sf_dir), "planes")
    _, metrics = lowrank.compress_images(planes, [1])
    return rounded(rounded(metrics, ["mse", "storage_ratio_estimate"]), ["psnr_db"], 4)


LEADING_RANKS, SQUARINGS = (1, 2, 3), 14


def _plane_leading() -> str:
    """The leading directions of every plane: its Gram matrix squared again and again leaves the first, which is then taken out."""
    w = fx.VECTOR_WIDTH
    parts = [f"""lg1 AS MATERIALIZED (SELECT image_id, channel, list(r ORDER BY i) AS m FROM (
      SELECT image_id, channel, i, list(v ORDER BY j) AS r FROM (
        SELECT image_id, channel, i, j, sum(f[i] * f[j]) AS v FROM pl, range(1, {w + 1}) a(i), range(1, {w + 1}) b(j) GROUP BY ALL)
      GROUP BY image_id, channel, i) GROUP BY image_id, channel)"""]
    trace = f"list_sum(list_transform(range(1, {w + 1}), lambda i: m[i][i]))"
    for c in LEADING_RANKS:
        parts.append(f"""lq{c}(s, image_id, channel, m) AS (
          SELECT 0, image_id, channel, list_transform(m, lambda r: list_transform(r, lambda x: x / {trace})) FROM lg{c}
          UNION ALL
          SELECT s + 1, image_id, channel, list_transform(m, lambda r: list_transform(r, lambda x: x / {trace}))
          FROM (SELECT s, image_id, channel, list_transform(m, lambda r: list_transform(m, lambda q: list_dot_product(r, q))) AS m
            FROM lq{c} WHERE s < {SQUARINGS}))""")
        # Of what is left all rows point one way; the one with the largest share is the clearest.
        parts.append(f"""lv{c} AS MATERIALIZED (SELECT image_id, channel, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM (
          SELECT image_id, channel, m[list_position(d, list_max(d))] AS v FROM (
            SELECT image_id, channel, m, list_transform(range(1, {w + 1}), lambda i: m[i][i]) AS d FROM lq{c} WHERE s = {SQUARINGS})))""")
        if c < len(LEADING_RANKS):
            parts.append(f"""lg{c + 1} AS MATERIALIZED (SELECT image_id, channel, list_transform(range(1, {w + 1}), lambda i:
              list_transform(range(1, {w + 1}), lambda j: m[i][j] - lam * v[i] * v[j])) AS m FROM (
                SELECT image_id, channel, m, v, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS lam
                FROM lg{c} JOIN lv{c} USING (image_id, channel)))""")
    every = " UNION ALL ".join(f"SELECT {c} AS c, * FROM lv{c}" for c in LEADING_RANKS)
    parts += [
        f"lvs AS (SELECT image_id, channel, list(v ORDER BY c) AS vs FROM ({every}) GROUP BY image_id, channel)",
        "lim AS (SELECT image_id, min(list_min(f)) AS lo, max(list_max(f)) AS hi FROM pl GROUP BY image_id)",
        f"""rec AS (SELECT image_id, channel, row_idx, rank, f, list_transform(range(1, {w + 1}), lambda i: least(greatest(
            list_sum(list_transform(range(1, rank + 1), lambda c: list_dot_product(f, vs[c]) * vs[c][i])), lo), hi)) AS g
          FROM pl JOIN lvs USING (image_id, channel) JOIN lim USING (image_id), (SELECT unnest({list(LEADING_RANKS)}) AS rank))""",
        """im AS (SELECT image_id, rank, sum(list_distance(f, g) ** 2) / sum(len(f)) AS mse, count(DISTINCT channel) AS c,
            sum(len(f)) AS cells, count(*) AS rows, max(len(f)) AS w FROM rec GROUP BY image_id, rank)""",
    ]
    return ",\n".join(parts)


@query(
    "rank_sweep_leading",
    with_steps(
        [sql.V, PLANES, _plane_leading()],
        f"SELECT image_id, rank::INTEGER AS rank, {r('mse')} AS mse, {r('20 * log10((hi - lo) / sqrt(mse))', 4)} AS psnr_db, {r('cells / (rank * (rows / c + w + 1) * c)')} AS storage_ratio_estimate FROM im JOIN lim USING (image_id)",
    ),
)
def rank_sweep_leading(spark, sf_dir):
    planes = stage(fx.vector_planes(spark, sf_dir), "planes")
    _, metrics = lowrank.compress_images(planes, list(LEADING_RANKS))
    return rounded(rounded(metrics, ["mse", "storage_ratio_estimate"]), ["psnr_db"], 4)


@query("rank_sweep")
def rank_sweep(spark, sf_dir):
    planes = stage(fx.vector_planes(spark, sf_dir), "planes")
    _, metrics = lowrank.compress_images(planes, [5, 10, 20, 30])
    return rounded(metrics, ["mse", "psnr_db", "storage_ratio_estimate"], 4)


@query(
    "series_trajectory",
    with_steps([sql.SERIES, sql.WINDOWS], f"SELECT series_id, t, {spread_sql('w', fx.SERIES_WINDOW, 'w')} FROM win"),
)
def series_trajectory(spark, sf_dir):
    windows = series.trajectory(stage(fx.hourly_series(spark, sf_dir), "series"), fx.SERIES_WINDOW)
    return windows.select("series_id", "t", *spread("window", fx.SERIES_WINDOW, "w"))


@query(
    "diagonal_average",
    with_steps(
        [sql.SERIES, sql.WINDOWS],
        f"SELECT series_id, t + p - 1 AS t, {r('avg(w[p] * p)')} AS value FROM win, range(1, {fx.SERIES_WINDOW + 1}) a(p) GROUP BY series_id, t + p - 1",
    ),
)
def diagonal_average(spark, sf_dir):
    windows = series.trajectory(stage(fx.hourly_series(spark, sf_dir), "series"), fx.SERIES_WINDOW)
    weighted = windows.withColumn("window", F.transform("window", lambda x, i: x * (i + 1)))
    return rounded(series.diagonal_average(weighted), ["value"])


@query(
    "series_denoise",
    with_steps([sql.SERIES, sql.WINDOWS, sql.DENOISED], f"SELECT series_id, t, value, {r('denoised')} AS denoised FROM ser JOIN den USING (series_id, t)"),
)
def series_denoise(spark, sf_dir):
    source = stage(fx.hourly_series(spark, sf_dir), "series")
    return rounded(series.denoise(source, rank=1, window=fx.SERIES_WINDOW), ["denoised"])


@query(
    "series_denoise_blocked",
    with_steps([sql.SERIES, sql.WINDOWS, sql.DENOISED], f"SELECT series_id, t, value, {r('denoised')} AS denoised FROM ser JOIN den USING (series_id, t)"),
)
def series_denoise_blocked(spark, sf_dir):
    source = stage(fx.hourly_series(spark, sf_dir), "series")
    return rounded(series.denoise(source, rank=1, window=fx.SERIES_WINDOW, block_starts=100), ["denoised"])


@query(
    "series_full_rank",
    with_steps([sql.SERIES], f"SELECT series_id, t, {r('value')} AS denoised FROM ser"),
)
def series_full_rank(spark, sf_dir):
    source = stage(fx.hourly_series(spark, sf_dir), "series")
    return rounded(series.denoise(source, rank=fx.SERIES_WINDOW, window=fx.SERIES_WINDOW).drop("value"), ["denoised"])


@query(
    "trajectory_energy",
    with_steps([sql.SERIES, sql.WINDOWS], f"SELECT series_id, {r('sum(list_dot_product(w, w))', 4)} AS energy FROM win GROUP BY 1"),
)
def trajectory_energy(spark, sf_dir):
    source = stage(fx.hourly_series(spark, sf_dir), "series")
    cut = series.blocked(source, series.check_series(source, 4, fx.SERIES_WINDOW), 100)
    return series.trajectory_bases(cut, 4, 100).select("series_id", tidy(F.col("energy"), 4).alias("energy"))


@query(
    "series_errors",
    with_steps(
        [sql.SERIES, sql.WINDOWS, sql.DENOISED],
        f"SELECT series_id, {r('avg((value - denoised) ** 2)')} AS mse, {r('10 * log10(sum(value ** 2) / sum((value - denoised) ** 2))')} AS snr_db FROM ser JOIN den USING (series_id, t) GROUP BY 1",
    ),
)
def series_errors(spark, sf_dir):
    source = stage(fx.hourly_series(spark, sf_dir), "series")
    cleaned = series.denoise(source, rank=1, window=fx.SERIES_WINDOW)
    return rounded(series.series_errors(cleaned, "value", "denoised"), ["mse", "snr_db"])


# --- end-to-end jobs -------------------------------------------------------------------


@query("train_job")
def train_job(spark, sf_dir):
    result = jobs.train(fx.order_profile(spark, sf_dir), method="pca", target="target", row_id="row_id")
    return rounded(result.tables["metrics"], ["value"], 4)


@query("compare_job")
def compare_job(spark, sf_dir):
    result = jobs.compare(
        fx.order_profile(spark, sf_dir), target="target", group_col="flag", row_id="row_id"
    )
    return rounded(result.tables["metrics"], ["value"], 4)


# The same jobs on the customer profile, K-means from stated rows in stated steps: every number of them in SQL.
CUSTOMER_RESIDUALS = [sql.CUSTOMERS if step is sql.F1 else step for step in RESIDUALS]
CUSTOMER_STARTS = "sta AS (SELECT row_number() OVER (ORDER BY row_id) - 1 AS place, row_id FROM f1)"
REPORT_SQL = {
    "mse": _mse(), "relative_frobenius_error": _rel(), "train_mse": _mse("is_train"), "train_relative_frobenius_error": _rel("is_train"),
    "test_mse": _mse("NOT is_train"), "test_relative_frobenius_error": _rel("NOT is_train"),
    "test_minus_train_mse": _mse("NOT is_train") + " - " + _mse("is_train"),
    "test_to_train_mse_ratio": _mse("NOT is_train") + " / " + _mse("is_train"),
}
RUN_SQL = {
    "train_fraction": "0.8", "train_rows": "(SELECT count(*) FROM sp WHERE is_train)", "test_rows": "(SELECT count(*) FROM sp WHERE NOT is_train)",
    "random_state": "42", "constant_features": "0",
}
MODEL_SQL = {"selected_components": "(SELECT k FROM pk)", "variance_retained": "(SELECT sum(ratio) FROM spec, pk WHERE component <= k)"}


def _sections(found: dict[str, dict[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, 0 AS k, '{name}' AS metric, {r(f'({text})::DOUBLE', 4)} AS value"
        for section, values in found.items()
        for name, text in values.items()
    )


def _customer_starts(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "customer").select("c_custkey").orderBy("c_custkey").limit(10).collect()
    return {"start_rows": [row[0] for row in rows], **STEPS}


@query(
    "train_from_starts",
    with_steps(
        [*CUSTOMER_RESIDUALS, CUSTOMER_STARTS,
         """pts AS MATERIALIZED (SELECT 'clustering_original' AS rep, row_id, f, target AS ref FROM z
            UNION ALL SELECT 'clustering_reduced', row_id, z[1:(SELECT k FROM pk)], target FROM sc)""",
         sql.started_clustering("pts", [6], 2, "sta")],
        _sections({"run": RUN_SQL, "model": MODEL_SQL, "reconstruction": REPORT_SQL})
        + f" UNION ALL SELECT rep, 0, metric, {r('value', 4)} FROM met",
    ),
)
def train_from_starts(spark, sf_dir):
    result = jobs.train(
        fx.customer_profile(spark, sf_dir), method="pca", target="target", row_id="row_id", **_customer_starts(spark, sf_dir)
    )
    return rounded(result.tables["metrics"].select("section", F.lit(0).alias("k"), "metric", "value"), ["value"], 4)


@query(
    "compare_from_starts",
    with_steps(
        [*CUSTOMER_RESIDUALS, CUSTOMER_STARTS,
         """pts AS MATERIALIZED (SELECT 'original' AS rep, row_id, f, target AS ref FROM z
            UNION ALL SELECT 'pca', row_id, z[1:(SELECT k FROM pk)], target FROM sc)""",
         """flat AS MATERIALIZED (SELECT 'features' AS rep, row_id, f, flag AS ref FROM z
            UNION ALL SELECT 'pca_2d', row_id, z[1:2], flag FROM sc)""",
         sql.started_clustering("pts", list(range(2, 11)), 2, "sta"),
         sql.started_clustering("flat", [5], 2, "sta", "g"),
         "swept AS (SELECT * FROM met UNION ALL SELECT 'svd', k, metric, value FROM met WHERE rep = 'pca')",
         "apart AS (SELECT * FROM gmet UNION ALL SELECT 'svd_2d', k, metric, value FROM gmet WHERE rep = 'pca_2d')"],
        _sections({"run": RUN_SQL, "pca": MODEL_SQL, "svd": MODEL_SQL, "reconstruction_pca": REPORT_SQL, "reconstruction_svd": REPORT_SQL})
        + f""" UNION ALL SELECT 'clustering_' || rep, 0, metric, {r('value', 4)} FROM swept WHERE k = 6
          UNION ALL SELECT 'sweep_' || rep, k, metric, {r('value', 4)} FROM swept
          UNION ALL SELECT 'separability_' || rep, k, metric, {r('value', 4)} FROM apart""",
    ),
)
def compare_from_starts(spark, sf_dir):
    tables = jobs.compare(
        fx.customer_profile(spark, sf_dir), target="target", group_col="flag", row_id="row_id", **_customer_starts(spark, sf_dir)
    ).tables
    out = tables["metrics"].select("section", F.lit(0).alias("k"), "metric", "value")
    for name, prefix in (("clustering_sweep", "sweep_"), ("separability", "separability_")):
        section = F.concat(F.lit(prefix), F.col("representation")).alias("section")
        out = out.union(tables[name].select(section, "k", "metric", "value"))
    return rounded(out, ["value"], 4)


def _vector_columns(spark, sf_dir):
    """Embeddings as one numeric column per dimension, with their label as target."""
    columns = [F.col("features")[i].alias(f"f{i + 1}") for i in range(fx.VECTOR_WIDTH)]
    return fx.vectors(spark, sf_dir).select("row_id", F.col("label").cast("double").alias("label"), *columns)


# The embeddings standardised per dimension, under the name that the graph steps read.
STANDARD_V = [
    sql.V.replace("v AS", "raw_v AS", 1),
    f"raw_cells AS (SELECT row_id, label, k, f[k] AS x FROM raw_v, range(1, {fx.VECTOR_WIDTH + 1}) r(k))",
    "dims AS (SELECT k, avg(x) AS m, stddev_pop(x) AS s FROM raw_cells GROUP BY k)",
    "v AS MATERIALIZED (SELECT row_id, label, list((x - m) / s ORDER BY k) AS f FROM raw_cells JOIN dims USING (k) GROUP BY row_id, label)",
]


@query(
    "affinity_graph_job",
    with_steps(
        [*STANDARD_V, sql.CALIBRATION, sql.JOINT], f"SELECT i, j, {r('w', 8)} AS weight FROM joint WHERE i <> j"
    ),
)
def affinity_graph_job(spark, sf_dir):
    graph = jobs.affinity_graph(_vector_columns(spark, sf_dir), target="label", row_id="row_id", max_samples=None)
    return graph["edges"].withColumn("weight", tidy_many(F.col("weight"), 8))


@query(
    "knn_graph_job",
    with_steps(
        [*STANDARD_V, sql.PAIRS],
        f"SELECT i AS row_id, j AS neighbour, rank::INTEGER AS rank, {r('d')} AS distance FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY d, j) AS rank FROM pairs) WHERE rank <= {NEIGHBOURS}",
    ),
)
def knn_graph_job(spark, sf_dir):
    graph = jobs.knn_graph(_vector_columns(spark, sf_dir), target="label", row_id="row_id", max_samples=None)
    return rounded(graph["edges"], ["distance"])
