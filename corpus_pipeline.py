"""A training corpus from raw documents: clean, deduplicated, decontaminated and mixed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eigenlake.llm.decontaminate import without_items
from eigenlake.llm.line_dedup import without_repeated_lines
from eigenlake.llm.minhash_dedup import without_near_duplicates
from eigenlake.llm.mixing import mix
from eigenlake.llm.staging import Staging
from eigenlake.llm.toxicity import fit_toxicity, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents predicted toxic by a model fitted on the labels outside the held-out fold."""
    return without_toxic(docs, fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated and nearly equal lines out of all documents but the first."""
    return without_repeated_lines(docs, least_words=1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by a shingle similarity of 0.8 or more.

    Two near copies have few lines in common once repeated lines are gone, so the texts as they came are compared too.
    """
    return without_near_duplicates(docs, texts=spark.read.parquet(f"{sf_dir}/documents.parquet"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents taken into the mix, with the words to take of each."""
    return mix(docs).where(F.col("taken") > 0)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# The model's fit, edit distances and window prints are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each on the written result of the one before."""
    staging = Staging(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staging.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
