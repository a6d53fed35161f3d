"""Delimited-text tables: separator detection, header checks, typing, labelled unions."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from eigenlake.functions.numeric import (
    BOOLEAN_PATTERN,
    INFINITY_PATTERN,
    INTEGER_PATTERN,
    NUMBER_PATTERN,
    numeric_value,
)
from eigenlake.operators.clean import trim_header
from eigenlake.sources.records import block_facts, file_lines, split_records
from eigenlake.sources.storage import matching_files, path_exists

HEADER_LINES = 50

# Separators tried first, and the cell texts that mean a missing value.
SEPARATORS = [",", ";", "\t", "|"]
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def detect_separator(lines: list[str]) -> str:
    """The separator that gives every sampled line the same number (> 1) of fields.

    The usual ones come first; if none of them does, any other character of the header may be it, unless it
    is part of names and numbers.
    """
    others = dict.fromkeys(c for c in lines[0] if not c.isalnum() and c not in "\"'.+-_\r" and c not in SEPARATORS)
    for candidates in (SEPARATORS, others):
        best, fields = ",", 1
        for separator in candidates:
            counts = {len(row) for row in csv.reader(lines, delimiter=separator) if row}
            if len(counts) == 1 and max(counts) > fields:
                best, fields = separator, max(counts)
        if fields > 1:
            break
    return best


def check_header(lines: list[str], separator: str) -> list[str]:
    """Stripped header names; duplicates are an error (Spark would rename them silently)."""
    names = [name.strip() for name in next(csv.reader(lines[:1], delimiter=separator))]
    if len(set(names)) != len(names):
        raise ValueError("Dataset contains duplicate column names")
    return names


def read_table(
    spark: SparkSession, path: str | Sequence[str], *, sep: str | None = None, multi_line: bool | None = None
) -> DataFrame:
    """A CSV-like table with typed columns (BIGINT, DOUBLE, BOOLEAN or STRING), or a parquet
    table when the paths end in ``.parquet``.

    ``path`` is a file, a folder, a glob or a list of these. Every file has its own header: columns go by name,
    in the order of their first appearance over the files in name order, and are missing in files that lack them;
    a file that shares no column with the first is an error. ``sep`` is detected on the first file's lines unless given.
    Quoted line breaks are looked for in all lines unless ``multi_line`` says whether there are any; files that hold them
    are read by as many tasks as others.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if paths and all(p.rstrip("/").endswith(".parquet") for p in paths):
        absent = [p for p in paths if not path_exists(spark, p)]
        if absent:
            raise FileNotFoundError(f"Dataset not found: {absent}")
        frame = spark.read.parquet(*paths)
        if not frame.take(1):
            raise ValueError("Dataset is empty")
        return trim_header(frame)
    files = []
    for name in paths:
        found = matching_files(spark, name)
        if not found and not path_exists(spark, name):
            raise FileNotFoundError(f"Dataset not found: {name}")
        files += found
    if not files:
        raise ValueError("Dataset is empty")
    lines = file_lines(spark, files)
    facts = block_facts(lines).toArrow().to_pylist()
    headers = {fact["path"]: fact["first_line"] for fact in facts if not fact["block"] and fact["first_line"] is not None}
    if not headers:
        raise ValueError("Dataset is empty")
    order = sorted(headers)
    sample = [row["value"].lstrip("\ufeff") for row in spark.read.text(unquote(order[0])).take(HEADER_LINES)]
    separator = sep or detect_separator([line for line in sample if line.strip()])
    # Files by header: each group is read by its own names.
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in order:
        line = headers[path].lstrip("\ufeff").rstrip("\r").split("\r")[0]
        groups.setdefault(tuple(check_header([line], separator)), []).append(unquote(path))
    first = next(iter(groups))
    strangers = [paths[0] for names, paths in groups.items() if not set(names) & set(first)]
    if strangers:
        raise ValueError(f"No column in common with {order[0]}: {strangers}")
    if multi_line is None:
        multi_line = any(fact["breaks"] for fact in facts)
    # Lines that end with a carriage return alone are no lines to a split reader.
    returns = any("\r" in line.rstrip("\r") for line in headers.values())
    parts = []
    for names, paths in groups.items():
        plain = [f"c{i}" for i in range(len(names))]
        options = {"sep": separator, "mode": "FAILFAST", "escape": '"'}
        schema = ", ".join(f"{name} string" for name in plain)
        if multi_line and not returns:
            records = split_records(lines if len(groups) == 1 else file_lines(spark, paths), separator)
            part = records.select(F.from_csv("value", schema, options).alias("row")).select("row.*")
        else:
            part = spark.read.options(header=True, enforceSchema=True, multiLine=multi_line, **options).schema(schema).csv(paths)
        parts.append(part.toDF(*names))
    raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = raw.columns
    present = raw.select(
        *[F.when(~F.trim(F.col(f"`{n}`")).isin(MISSING_CELLS), F.col(f"`{n}`")).alias(n) for n in names]
    )
    return _typed(present)


def _typed(df: DataFrame) -> DataFrame:
    # One pass decides each column's type from all its cells.
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(df.columns):
        cell = F.trim(F.col(f"`{name}`"))
        number = cell.rlike(NUMBER_PATTERN) | cell.rlike(INFINITY_PATTERN)
        aggregates += [
            F.count(cell).alias(f"all{i}"),
            F.count(F.when(cell.rlike(INTEGER_PATTERN), 1)).alias(f"int{i}"),
            F.count(F.when(number, 1)).alias(f"num{i}"),
            F.count(F.when(cell.rlike(BOOLEAN_PATTERN), 1)).alias(f"bool{i}"),
        ]
    found = df.agg(*aggregates).first()
    if not found["rows"]:
        raise ValueError("Dataset is empty")
    columns = []
    for i, (name, dtype) in enumerate((f.name, f.dataType) for f in df.schema):
        value, cells = F.col(f"`{name}`"), found[f"all{i}"]
        if cells and found[f"int{i}"] == cells:
            value = F.trim(value).cast("bigint")
        elif found[f"num{i}"] == cells:
            value = numeric_value(value, dtype)
        elif found[f"bool{i}"] == cells:
            value = F.lower(F.trim(value)) == "true"
        columns.append(value.alias(name))
    return df.select(*columns)


def combine_labelled(sources: Mapping[str, DataFrame], label: str) -> DataFrame:
    """Union of tables by column name, each marked with its key; duplicates are kept."""
    marked = [df.withColumn(label, F.lit(value)) for value, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b), marked)
