"""The inputs the registered queries derive from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FEATURES = ("n", "qty", "price", "max_price", "disc")
VECTOR_WIDTH = 64
SERIES_WINDOW = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One numeric profile per order, with a small reference label and a class column."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("row_id"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.sum("l_quantity").alias("qty"),
            F.sum("l_extendedprice").alias("price"),
            F.max("l_extendedprice").alias("max_price"),
            F.avg("l_discount").alias("disc"),
            (F.count(F.lit(1)) % 3).cast("int").alias("target"),
            F.max("l_returnflag").alias("flag"),
        )
    )


def customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One numeric profile per customer under the names of the order profile; few enough rows for all pairs in SQL."""
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.sum("o_totalprice").cast("double").alias("price"),
        F.max("o_totalprice").cast("double").alias("max_price"),
    )
    return table(spark, sf_dir, "customer").join(orders, "c_custkey", "left").select(
        F.col("c_custkey").alias("row_id"),
        F.coalesce("n", F.lit(0.0)).alias("n"),
        F.col("c_acctbal").cast("double").alias("qty"),
        F.coalesce("price", F.lit(0.0)).alias("price"),
        F.coalesce("max_price", F.lit(0.0)).alias("max_price"),
        F.col("c_nationkey").cast("double").alias("disc"),
        (F.col("c_custkey") % 3).cast("int").alias("target"),
        F.col("c_mktsegment").alias("flag"),
    )


def dirty_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order profile with missing and infinite cells and a constant column."""
    clean = order_profile(spark, sf_dir)
    return clean.select(
        "row_id",
        F.when(F.col("row_id") % 7 != 0, F.col("qty")).alias("qty"),
        F.when(F.col("row_id") % 11 == 0, F.lit(float("inf"))).otherwise(F.col("price")).alias("price"),
        F.when(F.col("row_id") % 13 == 0, F.lit(float("nan"))).otherwise(F.col("disc")).alias("disc"),
        F.lit(5.0).alias("five"),
        "target",
        "flag",
    )


def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with every kind of cell the cleaning has to handle."""
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        F.when(key % 7 == 0, F.lit(None).cast("double"))
        .when(key % 11 == 0, F.lit(float("inf")))
        .otherwise(F.col("value"))
        .alias("value"),
        F.lit(5.0).alias("five"),
        F.when(key % 13 == 0, F.lit("n.a.")).otherwise((key % 100).cast("string")).alias("num_text"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as DOUBLE vectors with their label."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("features"), "label"
    )


def vector_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings grouped by label as two-channel planes."""
    return vectors(spark, sf_dir).select(
        (F.col("label") % 5).cast("string").alias("image_id"),
        F.floor(F.col("label") / 5).cast("int").alias("channel"),
        F.col("row_id").alias("row_idx"),
        F.col("features").alias("pixels"),
    )


def hourly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour and type, hours without events as 0: ``(series_id, t, value)``."""
    hours = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series_id"), hour_index(F.col("ts")).alias("t")
    )
    counts = hours.groupBy("series_id", "t").agg(F.count(F.lit(1)).cast("double").alias("value"))
    low, high = counts.agg(F.min("t"), F.max("t")).first()
    calendar = counts.select("series_id").distinct().withColumn(
        "t", F.explode(F.sequence(F.lit(low), F.lit(high)))
    )
    return calendar.join(counts, ["series_id", "t"], "left").select(
        "series_id", "t", F.coalesce("value", F.lit(0.0)).alias("value")
    )


def hour_index(ts: Column) -> Column:
    return F.floor(F.unix_timestamp(ts.cast("timestamp")) / 3600).cast("bigint")
