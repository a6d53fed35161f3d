"""Written intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from eigenlake.session import shared_folder

# The folder of local sessions that name none, made once and deleted with the process.
_local: list[str] = []


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` if the cluster names one.

    Unset, a local session (tests) gets a temporary folder that goes with the process, and any
    other session the warehouse, which executors share as well. No setting is changed.
    """
    named = shared_folder(spark)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local["):
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="eigenlake-"))
            atexit.register(shutil.rmtree, _local[0], True)
        return f"file://{_local[0]}"
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


class Staging:
    """Tables written by one run of an operator; those no longer read are deleted at once."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.root, self.count = spark, f"{folder(spark)}/eigenlake/{label}-{uuid.uuid4().hex}", 0

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a frame and read it back: cuts its lineage, so a lost executor costs nothing upstream."""
        self.count += 1
        path = f"{self.root}/{self.count}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept.staged_path = path
        return kept

    def drop(self, *frames: DataFrame) -> None:
        """Delete staged frames that nothing reads any more."""
        for frame in frames:
            target = self.spark._jvm.org.apache.hadoop.fs.Path(frame.staged_path)
            target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
