"""Mixing sources to target weights by weighted fair queueing.

The documents of a source are shuffled; each gets a virtual finish time, the words of its source
up to and including it divided by the source's target. Rows come out range-sorted by that time,
which keeps all sources near their targets at any moment of a training run. The targets add up to
the budget, so it is used up at virtual time 1; the order is cut there, and the document that
a source has in service at that moment is taken in part.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from eigenlake.llm.staging import Staging

# Documents of one source that are put in order together, on average.
TOGETHER = 2_000


ADDED = ("size", "source_size", "target", "finish", "taken")


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    pieces = F.split(text, r"[\x20\x09-\x0D]+")
    return F.coalesce(F.size(F.filter(pieces, lambda piece: piece != "")), F.lit(0)).cast("long")


def numbered(sources: DataFrame, staging: Staging) -> DataFrame:
    """``sources`` with ``rank``, their place by code point with null last, without a window over all of them."""
    order = F.col("source").asc_nulls_last()
    ordered = sources.repartitionByRange(order).sortWithinPartitions(order)
    ordered = staging.keep(ordered.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), "ordered")
    local = Window.partitionBy("part").orderBy("place")
    sizes = {row["part"]: row["n"] for row in ordered.groupBy("part").agg(F.count("*").alias("n")).collect()}
    before, ahead = [], 0
    for part in sorted(sizes):
        before.append((part, ahead))
        ahead += sizes[part]
    starts = ordered.sparkSession.createDataFrame(before, "part int, ahead long")
    ranked = ordered.withColumn("rank", F.row_number().over(local)).join(F.broadcast(starts), "part")
    return ranked.withColumn("rank", F.col("rank") + F.col("ahead")).drop("part", "place", "ahead")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: tuple[int, int], cap: int, staging: Staging) -> DataFrame:
    """Adds ``rank, weight, target`` to one row per source ``(source, source_size, ...)``.

    Sources in code point order, null last, take the weights in turn. Together they get
    ``share`` of all words in proportion to weight, none more than ``cap`` times its own size. The words per unit of weight
    rise until no further source reaches its cap; every step is one sum over the sources.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = numbered(sizes, staging).withColumn("weight", F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    ranked = staging.keep(ranked, "ranked")
    full = cap * F.col("source_size")
    budget = share[0] * (ranked.agg(F.sum("source_size")).first()[0] or 0) / share[1]
    level, capped = 0.0, -1
    while True:
        over = full < F.col("weight") * F.lit(level)
        caps, rest, count = ranked.agg(
            F.coalesce(F.sum(F.when(over, full)), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)), F.count_if(over)
        ).first()
        if count == capped or not rest:
            break
        level, capped = (budget - caps) / rest, count
    target = full.cast("double") if not rest else F.least(full.cast("double"), F.col("weight") * F.lit(level))
    return ranked.withColumn("target", target)


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: tuple[int, int] = (3, 2),
    cap: int = 2,
    seed: int = 17,
) -> DataFrame:
    """``docs(doc_id, text, source, ...)`` with ``size, source_size, target, finish, taken``.

    ``finish`` is the virtual time of a document's first pass, by which the rows are sorted;
    ``taken`` counts the words the mix takes of it by time 1, in at most ``cap`` passes over its
    source. A source's ``taken`` add up to its target, rounded down. Texts that are null or
    empty have size 0 and are never taken; null sources form one source; rows may repeat.
    Columns of the five added names, in any letter case, are replaced, all others stay as they are. Documents are
    shuffled by md5(seed:doc_id), so runs agree.
    """
    staging = Staging(docs.sparkSession, "mix")
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    # The user's columns travel under numbers, so that their names don't matter and those nobody reads are pruned.
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"given{i}") for i, c in enumerate(kept)],
        "doc_id",
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"),
        order.alias("order"),
        F.xxhash64("text").alias("tie"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("key"),
    )
    narrow = staging.keep(rows.select("source", "key", "size", "order"), "sizes")
    sources = narrow.groupBy("key", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    sources = staging.keep(source_targets(sources, weights, share, cap, staging), "sources")
    largest = sources.agg(F.max("rows")).first()[0]
    digits = min(8, max(2, math.ceil(math.log(max(1, (largest or 1) / TOGETHER), 16))))

    def bucketed(frame: DataFrame) -> DataFrame:
        return frame.withColumn("bucket", F.substring("order", 1, digits))

    sums = bucketed(narrow).groupBy("key", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("before", F.coalesce(F.sum("words").over(ahead), F.lit(0))).drop("words")
    starts = staging.keep(starts.join(sources.select("key", "source_size", "target"), "key"), "starts")
    within = Window.partitionBy("key", "bucket").orderBy("order", "doc_id", "size", "tie")
    within = within.rowsBetween(Window.unboundedPreceding, 0)

    placed = bucketed(rows.drop("source")).join(starts, ["key", "bucket"])
    placed = placed.withColumn("words", F.col("before") + F.sum("size").over(within))
    taken = F.lit(0)
    for turn in range(cap):
        left = F.floor("target") - (turn * F.col("source_size") + F.col("words") - F.col("size"))
        taken = taken + F.greatest(F.lit(0), F.least(F.col("size"), left))
    finish = F.when(F.col("target") > 0, F.col("words") / F.col("target"))
    placed = placed.withColumns({"finish": finish, "taken": taken.cast("long")})
    given = [F.col(f"given{i}").alias(c) for i, c in enumerate(kept)]
    return placed.orderBy("finish", "order", "tie").select(*given, *ADDED)
