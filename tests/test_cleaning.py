"""Cleaning, exact sampling, exact medians, preprocessing."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eigenlake.operators import clean, sample
from eigenlake.operators.preprocess import Preprocessor
from eigenlake.operators.quantile import medians


def test_load_dataset_cleans_and_discovers(spark):
    rows = [
        (" x", "5", 1.0, "red", float("inf")),
        (" x", "5", 1.0, "red", float("inf")),
        ("7", "bad", 2.0, "white", float("inf")),
        ("8.5", "6", float("nan"), "white", float("inf")),
    ]
    df = spark.createDataFrame(rows, "a string, quality string, b double, kind string, allinf double")
    data = clean.load_dataset(df, target="quality")
    assert data.rows == 2 and data.features == ("a", "b", "allinf") and data.passthrough == ["kind"]
    report = {(r["metric"], r["feature"]): r["value"] for r in clean.dataset_report(data).collect()}
    assert report[("rows", None)] == 2 and report[("features", None)] == 3
    assert report[("missing_values", "a")] == 1 and report[("missing_values", "b")] == 1
    assert report[("missing_values", "allinf")] == 2
    assert report[("duplicate_rows_after_cleaning", None)] == 0
    with pytest.raises(ValueError, match="no finite values"):
        Preprocessor.fit(data.frame, data.features)


def test_content_key_is_unique_and_stable(spark):
    df = spark.createDataFrame([(i % 5, str(i % 3)) for i in range(30)], "a int, b string")
    keys = [
        {r["row_id"] for r in clean.load_dataset(d, target=None).frame.collect()}
        for d in (df, df.repartition(7).orderBy(F.rand(1)))
    ]
    assert len(keys[0]) == 15 and keys[0] == keys[1]


def test_copies_are_numbered_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(clean, "COPIES_PER_CHUNK", 4)
    df = spark.createDataFrame([(1,)] * 11 + [(2,)] * 4 + [(3,)], "a int")
    rows = clean.key_rows(df, "row_id", unique=False).collect()
    assert len(rows) == 16 == len({r["row_id"] for r in rows})
    data = clean.load_dataset(df, target=None, drop_duplicates=False)
    report = {r["metric"]: r["value"] for r in clean.dataset_report(data).collect() if r["feature"] is None}
    assert report["duplicate_rows_after_cleaning"] == 13


def test_dataset_errors(spark):
    df = spark.createDataFrame([("x", "y")], "a string, b string")
    with pytest.raises(ValueError, match="missing"):
        clean.load_dataset(df, target="nope")
    with pytest.raises(ValueError, match="No rows remain"):
        clean.load_dataset(df, target="a")
    with pytest.raises(ValueError, match="usable numerical"):
        clean.load_dataset(df, target=None)
    with pytest.raises(ValueError, match="duplicate"):
        clean.trim_header(df.toDF("a", " a"))


def test_boolean_words_and_timestamps(spark):
    df = spark.sql("SELECT * FROM VALUES (timestamp'2024-01-01', 'True', true, 1), (timestamp'2024-01-02', 'False', false, 2) AS t(ts, word, flag, n)")
    data = clean.load_dataset(df, target=None)
    assert data.features == ("word", "flag", "n")
    got = sorted(tuple(r) for r in data.frame.select(*data.numeric_features()).collect())
    assert got == [(0.0, 0.0, 2.0), (1.0, 1.0, 1.0)]


@pytest.mark.parametrize(
    "rows, message",
    [([[1.0], [1.0, 2.0]], "2D"), ([[1.0]], "at least 2"), ([[1.0], [float("nan")]], "NaN"), ([[], []], "at least one feature"), ([[1.0], None], "2D")],
)
def test_matrix_check(spark, rows, message):
    df = spark.createDataFrame([(r,) for r in rows], "features array<double>")
    with pytest.raises(ValueError, match=message):
        clean.check_matrix(df)


def order(ids, seed=42):
    return sorted(ids, key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())


@pytest.mark.parametrize("bucket_rows", [5, 20_000])
def test_split_and_sample_are_exact(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(sample, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(sample, "PREFIX_DIGITS", 1)
    df = spark.range(1003).withColumnRenamed("id", "row_id")
    train = {r["row_id"] for r in sample.split_rows(df, "row_id").where("split = 'train'").collect()}
    assert train == set(order(range(1003))[:802])
    picked = {r["row_id"] for r in sample.sample_rows(df, "row_id", max_samples=50, seed=7).collect()}
    assert picked == set(order(range(1003), 7)[:50])
    assert sample.sample_rows(df, "row_id", max_samples=5000).count() == 1003


def test_split_arguments(spark):
    assert sample.train_size(5, 0.5) == 2 and sample.train_size(7, 0.5) == 4
    assert sample.train_size(3, 0.99) == 2 and sample.train_size(10, 1.0) == 10
    for rows, fraction in ((2, 0.8), (10, 0.4), (10, 1.1)):
        with pytest.raises(ValueError):
            sample.train_size(rows, fraction)
    df = spark.range(20).withColumnRenamed("id", "row_id")
    assert sample.split_rows(df, "row_id", fraction=1.0).where("split = 'test'").count() == 0
    with pytest.raises(ValueError, match="at least 3"):
        sample.sample_rows(df, "row_id", max_samples=2)


def test_repeated_row_ids_are_rejected(spark, monkeypatch):
    monkeypatch.setattr(sample, "BUCKET_ROWS", 10)
    df = spark.range(200).select((F.col("id") % 2).alias("row_id"))
    with pytest.raises(ValueError, match="uniquely"):
        sample.split_rows(df, "row_id", fraction=0.7)


@pytest.mark.parametrize("name", ["normal", "ties", "two_values", "outliers", "constant", "even_gap"])
def test_bracketed_median_is_exact(spark, name):
    rng = np.random.default_rng(5)
    values = {
        "normal": rng.normal(size=4001),
        "ties": np.where(rng.random(4000) < 0.4, 0.0, rng.normal(size=4000)),
        "two_values": np.repeat([1.0, 3.0], 1000),
        "outliers": np.concatenate([rng.normal(size=3000), [1e300, -1e300]]),
        "constant": np.full(1000, 2.5),
        "even_gap": np.concatenate([np.arange(500), np.arange(1000, 1500)]).astype(float),
    }[name]
    df = spark.createDataFrame([(float(v), None) for v in values], "x double, empty double").repartition(4)
    # A coarse sketch and a tiny bracket force several narrowing rounds.
    got = medians(df, ["x", "empty"], builtin_rows=10, bracket_rows=20, accuracy=50)
    assert got == [float(np.median(values)), None]
    assert medians(df, ["x", "empty"]) == got


def test_impute_and_constant_feature(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 5.0), (4.0, 5.0)], "a double, b double")
    state = Preprocessor.fit(df, ["a", "b"])
    assert state.medians == (2.0, 5.0) and state.constant_features == ["b"] and state.scales[1] == 1.0
    got = np.array([r["features"] for r in state.transform(df).collect()])
    imputed = np.array([1.0, 2.0, 2.0, 4.0])
    np.testing.assert_allclose(got[:, 0], (imputed - imputed.mean()) / imputed.std())
    assert not got[:, 1].any()
    back = np.array([r["restored"] for r in state.inverse_transform(state.transform(df)).collect()])
    np.testing.assert_allclose(back[:, 0], imputed)


def test_schema_and_argument_errors(spark):
    df = spark.createDataFrame([(1, 2), (2, 3)], "a int, b int")
    state = Preprocessor.fit(df, ["a", "b"])
    with pytest.raises(ValueError, match=r"\['b'\]"):
        state.transform(df.select("a"))
    with pytest.raises(ValueError, match="At least one"):
        Preprocessor.fit(df, [])
    with pytest.raises(ValueError, match="unique"):
        Preprocessor.fit(df, ["a", "a"])
    extra = state.transform(df.withColumn("c", F.lit(9)).select("c", "b", "a"), ["c"])
    assert extra.columns == ["c", "features"]
    wrong = spark.createDataFrame([([1.0],)], "features array<double>")
    with pytest.raises(Exception, match="2 features"):
        state.inverse_transform(wrong).collect()
