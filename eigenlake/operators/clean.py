"""Header checks, row dedupe, target filter, feature discovery and the data report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from eigenlake.functions.numeric import (
    BOOLEAN_PATTERN,
    NUMERIC_TYPES,
    finite_value,
    is_finite,
    numeric_value,
)
from eigenlake.session import stage

COPIES_PER_CHUNK = 10_000


@dataclass(frozen=True)
class Dataset:
    """One frame and the role of each column; roles are never split by position."""

    frame: DataFrame
    row_id: str
    features: tuple[str, ...]
    target: str | None
    booleans: tuple[str, ...] = ()
    rows: int = 0
    key_added: bool = False

    @property
    def passthrough(self) -> list[str]:
        known = {self.row_id, *self.features, self.target}
        return [name for name in self.frame.columns if name not in known]

    def numeric_features(self) -> list[Column]:
        """Feature columns as DOUBLE with every kind of missing value as NULL."""
        fields = self.frame.schema
        return [
            finite_value(F.col(f"`{name}`"), fields[name].dataType, name in self.booleans).alias(name)
            for name in self.features
        ]


def trim_header(df: DataFrame) -> DataFrame:
    """Strip column names; two names that become equal are an error."""
    names = [name.strip() for name in df.columns]
    if len(set(names)) != len(names):
        raise ValueError("Dataset contains duplicate column names")
    return df.toDF(*names)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates over all columns. Partial aggregation removes copies before the
    shuffle, so one row repeated many times does not load a single task."""
    return df.dropDuplicates()


def filter_target(df: DataFrame, target: str) -> DataFrame:
    """Replace the target by its DOUBLE value and keep rows where it is finite."""
    if target not in df.columns:
        raise ValueError(f"The target '{target}' is missing from the table's columns")
    value = numeric_value(F.col(f"`{target}`"), df.schema[target].dataType)
    return df.withColumn(target, value).where(is_finite(F.col(f"`{target}`")))


def discover_features(
    df: DataFrame, exclude: Sequence[str] = ()
) -> tuple[tuple[str, ...], tuple[str, ...], int]:
    """Columns with at least one numeric cell, in source order, from one pass.

    Infinite cells count here and become missing later. Text columns made only of
    true/false words count as 0/1 features; date and time columns do not.
    Returns (features, those of them that are true/false text, row count).
    """
    aggregates = [F.count(F.lit(1)).alias("rows")]
    candidates = []
    for field in df.schema:
        if field.name in exclude or not isinstance(
            field.dataType, (*NUMERIC_TYPES, T.StringType)
        ):
            continue
        column = F.col(f"`{field.name}`")
        number = numeric_value(column, field.dataType)
        place = len(candidates)
        aggregates.append(F.count(F.when(number.isNotNull() & ~F.isnan(number), 1)).alias(f"n{place}"))
        if isinstance(field.dataType, T.StringType):
            words = F.count(F.when(F.trim(column).rlike(BOOLEAN_PATTERN), 1))
            aggregates.append(((words > 0) & (words == F.count(column))).alias(f"b{place}"))
        else:
            aggregates.append(F.lit(False).alias(f"b{place}"))
        candidates.append(field.name)
    found = df.agg(*aggregates).first()
    if found["rows"] == 0:
        raise ValueError("No rows remain: the target is nowhere a finite number")
    booleans = tuple(n for i, n in enumerate(candidates) if found[f"b{i}"])
    features = tuple(n for i, n in enumerate(candidates) if found[f"n{i}"] > 0 or n in booleans)
    if not features:
        raise ValueError("No usable numerical column besides the target and the excluded ones")
    return features, booleans, found["rows"]


def content_key(df: DataFrame) -> Column:
    """Identity of a row from its own content; the same under any plan or partitioning.
    Adding zero makes negative zero the same value as zero, as it is in a comparison."""
    cells = [
        (F.col(f"`{f.name}`") + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else F.col(f"`{f.name}`")
        for f in df.schema
    ]
    return F.md5(F.to_json(F.struct(*cells), {"ignoreNullFields": "false"}))


def key_rows(df: DataFrame, name: str, unique: bool) -> DataFrame:
    """Add a stable row id. Rows that may repeat are counted first and numbered within
    their copies; a row with very many copies is unfolded in chunks spread over tasks."""
    if unique:
        return df.withColumn(name, content_key(df))
    columns = df.columns
    counted = df.withColumn(name, content_key(df)).groupBy(name, *[f"`{c}`" for c in columns]).agg(
        F.count(F.lit(1)).alias("__copies")
    )
    chunks = counted.withColumn(
        "__chunk",
        F.explode(F.sequence(F.lit(0), ((F.col("__copies") - 1) / COPIES_PER_CHUNK).cast("long"))),
    ).repartition(name, "__chunk")
    first = F.col("__chunk") * COPIES_PER_CHUNK + 1
    last = F.least(F.col("__copies"), (F.col("__chunk") + 1) * COPIES_PER_CHUNK)
    numbered = chunks.withColumn("__copy", F.explode(F.sequence(first, last)))
    return numbered.withColumn(name, F.concat_ws("#", name, "__copy")).select(
        *[f"`{c}`" for c in columns], name
    )


def load_dataset(
    df: DataFrame,
    *,
    target: str | None = "quality",
    drop_duplicates: bool = True,
    row_id: str | None = None,
    exclude: Sequence[str] = (),
) -> Dataset:
    """Dedupe, validate the target and find the numeric features of a table.

    The cleaned frame is staged before features are discovered, so the dedupe runs once.
    ``row_id`` names an existing unique column; without it a content key is added.
    ``exclude`` keeps columns (such as group codes) as passthrough only.
    """
    frame = trim_header(df)
    if drop_duplicates:
        frame = drop_duplicate_rows(frame)
    key = row_id or "row_id"
    if row_id is None:
        frame = key_rows(frame, key, unique=drop_duplicates)
    elif row_id not in frame.columns:
        raise ValueError(f"Row id column '{row_id}' is missing")
    if target is not None:
        frame = filter_target(frame, target)
    frame = stage(frame, "cleaned")
    features, booleans, rows = discover_features(
        frame, exclude=[key, *exclude, *([target] if target else [])]
    )
    return Dataset(frame, key, features, target, booleans, rows, row_id is None)


def dataset_report(data: Dataset) -> DataFrame:
    """Rows, feature count, missing cells per feature and remaining duplicate rows, as
    ``(metric, feature, value)``."""
    # Copies are counted by content key, so the shuffle carries keys instead of rows.
    rows = data.frame.drop(data.row_id) if data.key_added else data.frame
    counted = data.frame.select(*data.numeric_features()).agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.sum(F.col(f"`{name}`").isNull().cast("long")).alias(f"m{i}")
            for i, name in enumerate(data.features)
        ],
    )
    def line(metric: str, feature: str | None, value: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            F.lit(feature).cast("string").alias("feature"),
            F.coalesce(value, F.lit(0)).cast("long").alias("value"),
        )

    lines = [line("rows", None, F.col("rows")), line("features", None, F.lit(len(data.features)))]
    lines += [line("missing_values", name, F.col(f"m{i}")) for i, name in enumerate(data.features)]
    missing = counted.select(F.explode(F.array(*lines)).alias("line")).select("line.*")
    copies = (
        rows.groupBy(content_key(rows).alias("__key"))
        .agg(F.count(F.lit(1)).alias("__copies"))
        .agg(F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("value"))
        .select(
            F.lit("duplicate_rows_after_cleaning").alias("metric"),
            F.lit(None).cast("string").alias("feature"),
            "value",
        )
    )
    return missing.unionByName(copies)


@dataclass(frozen=True)
class MatrixShape:
    rows: int
    width: int


def check_matrix(
    df: DataFrame, column: str = "features", *, min_rows: int = 2, name: str = "X"
) -> MatrixShape:
    """One aggregate that proves a vector column is a finite rectangular matrix."""
    vector = F.col(column)
    found = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(vector).alias("present"),
        F.min(F.size(vector)).alias("low"),
        F.max(F.size(vector)).alias("high"),
        F.coalesce(
            F.sum(F.exists(vector, lambda x: ~F.coalesce(is_finite(x), F.lit(False))).cast("long")),
            F.lit(0),
        ).alias("bad"),
    ).first()
    if found["rows"] < min_rows:
        raise ValueError(f"{name} has {found['rows']} rows where at least {min_rows} are needed")
    if found["present"] != found["rows"] or found["low"] != found["high"]:
        raise ValueError(f"{name} is no 2D matrix: vectors are null or differ in length")
    if found["low"] == 0:
        raise ValueError(f"{name} has empty vectors where at least one feature is needed")
    if found["bad"]:
        raise ValueError(f"{name} has {found['bad']} rows with nulls, NaN or infinities")
    return MatrixShape(found["rows"], found["low"])
