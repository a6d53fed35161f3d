"""Session settings and the place where intermediate frames are kept."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests and the bench; a cluster job brings its own."""
    partitions = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("eigenlake")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str | None:
    """The folder all executors can reach, as named by the cluster; None if it names none."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, or in the warehouse, which a cluster shares as well."""
    folder = shared_folder(spark) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder.rstrip('/')}/eigenlake/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Keep a frame that several jobs read.

    With a shared folder the frame is written there as parquet and read back, which
    cuts the lineage (a lost executor costs nothing upstream) and keeps column pruning.
    Without one it is persisted in the session and recomputed from lineage when lost.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if folder is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    path = fresh_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


# Rows of a narrow per-key frame that may go to every task.
SMALL_ROWS = 50_000


def small_side(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A broadcast hint for a staged frame of few narrow rows, counted up to the bound; beyond it
    the join is left to the optimizer. Keeps rows of a hot key where they are."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


# Below this many rows the tasks' fixed costs outweigh more parallelism.
SPREAD_ROWS = 10_000


def spread(df: DataFrame, key: str, rows: int, tasks: int) -> DataFrame:
    """Enough tasks for all cores where a small table fell into fewer partitions than that.

    Repeated numeric passes are bound by the cores, not by bytes, which is what adaptive
    partition sizes look at. Tables with enough partitions are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if tasks < cores and rows >= SPREAD_ROWS else df


def release(*frames: DataFrame) -> None:
    """Drop the session cache of staged frames that no returned result depends on."""
    for frame in frames:
        frame.unpersist()
