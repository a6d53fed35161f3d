"""Connected components by alternating stars, for graphs of any size and any degree."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eigenlake.llm.staging import Staging

MAX_ROUNDS = 60


def connected(links: DataFrame, staging: Staging) -> DataFrame:
    """``(id, root)`` for every id of ``links(u, v)``; root is the smallest id of its component.

    Links may repeat and point either way; an id without links has no row. The smallest
    neighbour of every id is a written table, so the joins with it can be split at a hot id.
    """
    edges = staging.keep(_tidy(links), "edges")
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        larger = _star(both, F.col("v") > F.col("u"), staging)
        joined = staging.keep(_tidy(larger[0]), "large")
        staging.drop(edges, larger[1])
        # Links now lead from each id (u) to a smaller one (v).
        down = joined.select(F.col("v").alias("u"), F.col("u").alias("v"))
        smaller = _star(down, F.lit(True), staging)
        edges = staging.keep(_tidy(smaller[0].union(smaller[1].select("u", F.col("least").alias("v")))), "small")
        staging.drop(joined, smaller[1])
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError("connected components did not settle")
    found = edges.select(F.col("v").alias("id"), F.col("u").alias("root"))
    return found.union(edges.select("u", "u").distinct())


def _star(pointed: DataFrame, wanted, staging: Staging) -> tuple[DataFrame, DataFrame]:
    least = pointed.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    least = staging.keep(least, "least")
    moved = pointed.where(wanted).join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved, least


def _tidy(links: DataFrame) -> DataFrame:
    """Distinct links from the smaller id (u) to the larger (v)."""
    return (
        links.where(F.col("u") != F.col("v"))
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
