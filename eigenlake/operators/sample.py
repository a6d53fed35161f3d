"""Exact-size seeded splits and samples by hash order, without a global sort or window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

PREFIX_DIGITS = 3
BUCKET_ROWS = 20_000


def hash_order(row_id: str, seed: int) -> Column:
    """The pseudo-random position of a row: the same value in any plan."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(f"`{row_id}`").cast("string")))


def hash_cutoff(df: DataFrame, row_id: str, count: int, seed: int) -> str:
    """The hash value with exactly ``count`` rows at or below it.

    Counts rows per hash prefix (at most 4096 numbers reach the driver), descends into
    the one bucket holding the cutoff until it is small, and reads that bucket only.
    """
    hashed = df.select(hash_order(row_id, seed).alias("h"))
    prefix, need = "", count
    while True:
        digits = len(prefix) + PREFIX_DIGITS
        inside = hashed.where(F.col("h").startswith(prefix)) if prefix else hashed
        buckets = sorted(
            (row["p"], row["n"])
            for row in inside.groupBy(F.substring("h", 1, digits).alias("p"))
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()
        )
        for prefix, rows in buckets:
            if need <= rows:
                break
            need -= rows
        else:
            raise ValueError("More rows requested than the table has")
        if rows <= BUCKET_ROWS:
            break
        if digits >= 32:
            raise ValueError(f"Column '{row_id}' does not identify rows uniquely")
    bucket = sorted(row["h"] for row in hashed.where(F.col("h").startswith(prefix)).collect())
    if need < len(bucket) and bucket[need] == bucket[need - 1]:
        raise ValueError(f"Column '{row_id}' does not identify rows uniquely")
    return bucket[need - 1]


def train_size(rows: int, fraction: float) -> int:
    """Rows that train: the share rounded half to even, at least 2 and at most ``rows - 1``; a fraction of 1 is all rows."""
    if rows < 3:
        raise ValueError(f"A table of {rows} rows is too small to split")
    if not 0.5 <= fraction <= 1:
        raise ValueError(f"A training share of {fraction} is not in 0.5 to 1")
    return rows if fraction == 1 else min(max(round(rows * fraction), 2), rows - 1)


def split_rows(
    df: DataFrame, row_id: str, *, fraction: float = 0.8, seed: int = 42, rows: int | None = None
) -> DataFrame:
    """Add ``split`` = 'train' | 'test' with the exact training count."""
    size = df.count() if rows is None else rows
    wanted = train_size(size, fraction)
    if wanted == size:
        return df.withColumn("split", F.lit("train"))
    cutoff = hash_cutoff(df, row_id, wanted, seed)
    return df.withColumn(
        "split", F.when(hash_order(row_id, seed) <= cutoff, "train").otherwise("test")
    )


def sample_rows(
    df: DataFrame, row_id: str, *, max_samples: int, seed: int = 42, rows: int | None = None
) -> DataFrame:
    """Exactly ``min(max_samples, n)`` rows, without replacement."""
    if max_samples < 3:
        raise ValueError(f"A sample has at least 3 rows, not {max_samples}")
    size = df.count() if rows is None else rows
    if size <= max_samples:
        return df
    return df.where(hash_order(row_id, seed) <= hash_cutoff(df, row_id, max_samples, seed))
