"""Approximate nearest neighbours by neighbour descent, for tables beyond exact search.

A neighbour of a neighbour is likely a neighbour (Dong, Moses and Li, 2011). Every round brings a bounded number of
rows together at each row, compares them with one another, and tells each about rows that are nearer than those it knows.
The work of a round is linear in the rows, and rows known to very many others are met by a bounded draw of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from eigenlake.functions.arrow import sorted_groups, to_lists, to_matrix
from eigenlake.operators.clean import MatrixShape
from eigenlake.operators.neighbours import best_of, top_of
from eigenlake.operators.sample import sample_rows
from eigenlake.session import stage

# Rows of the groups whose exact neighbours start the descent, as a multiple of k, and such groupings.
START_ROWS, START_TURNS = 16, 2
# Rows whose exact neighbours measure the recall.
CHECKED_ROWS = 200


@dataclass(frozen=True)
class Descent:
    """``edges(row_id, neighbour, rank, distance)`` and how they came about."""

    edges: DataFrame
    parameters: dict[str, float]


def descend(
    df: DataFrame,
    row_id: str,
    k: int,
    shape: MatrixShape,
    column: str = "features",
    *,
    meet: int | None = None,
    stop: float = 0.001,
    max_rounds: int = 20,
    least_recall: float = 0.9,
    seed: int = 42,
) -> Descent:
    """The k nearest other rows of nearly all rows.

    A round lets every row meet up to ``meet`` (default ``k``) of its neighbours and as many rows that have it as
    neighbour, fresh ones first. Rounds end when fewer than ``stop`` of all entries change. The recall of the result, measured on rows in
    hash order against exact search, is among the parameters; below ``least_recall`` the descent goes on with twice as many
    rows to meet, up to ``max_rounds`` rounds in all.
    """
    if not 1 <= k < shape.rows:
        raise ValueError(f"n_neighbors is {k}, but a row has only {shape.rows - 1} others")
    meet = meet or k
    id_type = df.schema[row_id].dataType.simpleString()
    points = stage(df.select(F.col(f"`{row_id}`").alias("id"), F.col(column).alias("point")), "points")
    graph = stage(_start(points, k, shape, id_type, seed), "graph")
    rounds, changed, recall = 0, 1.0, 0.0
    while True:
        while rounds < max_rounds and changed >= stop:
            graph = stage(_round(points, graph, k, shape.width, id_type, meet, seed + rounds), "graph")
            changed = (graph.agg(F.sum("changed")).first()[0] or 0) / (shape.rows * k)
            rounds += 1
        recall = _recall(points, graph, k, shape, id_type, seed)
        if recall >= least_recall or rounds >= max_rounds:
            break
        meet, changed = 2 * meet, 1.0
        # All entries count as fresh again.
        graph = graph.withColumn("best", F.transform("best", lambda b: b.withField("fresh", F.lit(True))))
    edges = graph.select(F.col("id").alias(row_id), F.posexplode("best").alias("place", "b")).select(
        f"`{row_id}`", F.col("b.id").alias("neighbour"), (F.col("place") + 1).alias("rank"), F.sqrt("b.d2").alias("distance")
    )
    return Descent(edges, {"n_neighbors": k, "rounds": rounds, "meet": meet, "changed": changed, "recall": recall})


def _entry(id_type: str) -> str:
    return f"array<struct<d2:double,id:{id_type},fresh:boolean>>"


def _start(points: DataFrame, k: int, shape: MatrixShape, id_type: str, seed: int) -> DataFrame:
    """``id, best, changed``: the nearest rows within groups drawn by hash, of several such groupings."""
    groups = max(1, shape.rows // (START_ROWS * (k + 1)))
    turns = F.explode(F.sequence(F.lit(0), F.lit(START_TURNS - 1 if groups > 1 else 0))).alias("turn")
    dealt = points.select(turns, "id", "point")
    dealt = dealt.withColumn("group", F.pmod(F.xxhash64(F.lit(seed), "turn", "id"), F.lit(groups)).cast("int"))
    width = shape.width

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ["turn", "group"]):
            offsets, ids, d2 = top_of(table, table, k, width)
            yield pa.RecordBatch.from_arrays([table.column("id").combine_chunks(), _lists(offsets, d2, ids, np.ones(len(d2), bool))], names=["id", "best"])

    found = dealt.repartition("turn", "group").sortWithinPartitions("turn", "group").mapInArrow(search, f"id {id_type}, best {_entry(id_type)}")
    merged = F.array_sort(F.array_distinct(F.flatten(F.collect_list("best"))))
    return found.groupBy("id").agg(F.slice(merged, 1, k).alias("best")).withColumn("changed", F.size("best"))


def _lists(offsets: pa.Array, d2: pa.Array, ids: pa.Array, fresh: np.ndarray) -> pa.ListArray:
    entries = pa.StructArray.from_arrays([d2, ids, pa.array(fresh)], names=["d2", "id", "fresh"])
    return pa.ListArray.from_arrays(offsets, entries)


def _round(points: DataFrame, graph: DataFrame, k: int, width: int, id_type: str, meet: int, seed: int) -> DataFrame:
    links = graph.select("id", F.explode("best").alias("b")).select(F.col("id").alias("at"), F.col("b.id").alias("id"), F.col("b.fresh").alias("fresh"))
    back = links.select(F.col("id").alias("at"), F.col("at").alias("id"), "fresh")
    # A bounded draw at every row, however many have it as neighbour; fresh entries first.
    order = Window.partitionBy("at").orderBy(F.col("fresh").desc(), F.xxhash64(F.lit(seed), "at", "id"))

    def drawn(side: DataFrame) -> DataFrame:
        return side.withColumn("place", F.row_number().over(order)).where(F.col("place") <= meet).drop("place")

    met = drawn(links).union(drawn(back)).groupBy("at", "id").agg(F.max("fresh").alias("fresh"))
    own = graph.select(F.col("id").alias("at"), F.col("id").alias("id"), F.lit(True).alias("fresh"))
    # What a row knows so far bounds what it needs to hear of.
    reach = graph.select("id", F.when(F.size("best") == k, F.col("best")[k - 1]["d2"]).alias("reach"))
    seats = met.union(own).join(points.join(reach, "id"), "id").select("at", "id", "fresh", "reach", "point")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([*rest, batch])
                firsts = _firsts(table.column("at"))
                # The last row's meeting may go on.
                rest = table.slice(firsts[-1]).to_batches()
                if firsts[-1]:
                    yield _compared(table.slice(0, firsts[-1]), firsts[:-1], width)
        if rest:
            table = pa.Table.from_batches(rest)
            yield _compared(table, _firsts(table.column("at")), width)

    heard = seats.repartition("at").sortWithinPartitions("at").mapInArrow(compare, f"id {id_type}, other {id_type}, d2 double")
    heard = heard.groupBy("id").agg(F.collect_set(F.struct("d2", F.col("other").alias("id"))).alias("heard"))
    known = F.transform("best", lambda b: F.struct(b["d2"].alias("d2"), b["id"].alias("id")))
    # Entries that met in this round are no longer fresh; those that are new are.
    both = graph.select("id", "best").join(heard, "id", "left")
    best = F.slice(F.array_sort(F.array_union(known, F.coalesce("heard", F.array().cast(f"array<struct<d2:double,id:{id_type}>>")))), 1, k)
    marked = both.select("id", best.alias("now"), known.alias("known"))
    fresh = F.transform("now", lambda b: F.struct(b["d2"].alias("d2"), b["id"].alias("id"), (~F.array_contains("known", b)).alias("fresh")))
    return marked.select("id", fresh.alias("best"), (F.size("now") - F.size(F.array_intersect("now", "known"))).alias("changed"))


def _firsts(at: pa.ChunkedArray) -> np.ndarray:
    """Where each run of equal values begins."""
    codes = pc.fill_null(at.combine_chunks().dictionary_encode().indices, -1).to_numpy()
    return np.concatenate([[0], np.flatnonzero(codes[1:] != codes[:-1]) + 1])


def _compared(table: pa.Table, firsts: np.ndarray, width: int) -> pa.RecordBatch:
    """``id, other, d2`` of all pairs of every meeting that one of them needs to hear of; meetings begin at ``firsts``."""
    ids, fresh = table.column("id").combine_chunks(), table.column("fresh").to_numpy()
    reach = table.column("reach").to_numpy()
    reach = np.where(np.isnan(reach), np.inf, reach)
    rows = to_matrix(table.column("point"), width)
    sizes = np.diff(firsts, append=len(rows))
    # Meetings side by side, the short ones filled up.
    seat = np.arange(sizes.max())
    place = np.minimum(firsts[:, None] + seat, len(rows) - 1)
    taken = seat < sizes[:, None]
    own = rows[place]
    own -= own[:, :1]
    square = np.einsum("gij,gij->gi", own, own)
    d2 = square[:, :, None] + square[:, None, :] - 2.0 * (own @ own.transpose(0, 2, 1))
    wanted = (fresh[place][:, :, None] | fresh[place][:, None, :]) & (taken[:, :, None] & taken[:, None, :])
    # Rounding is in proportion to the coordinates that were multiplied.
    wanted &= d2 <= reach[place][:, :, None] * (1 + 1e-9) + 1e-12 * (square[:, :, None] + square[:, None, :])
    wanted[:, seat, seat] = False
    meeting, left, right = np.nonzero(wanted)
    left, right = place[meeting, left], place[meeting, right]
    exact = ((rows[left] - rows[right]) ** 2).sum(axis=1)
    return pa.RecordBatch.from_arrays([ids.take(pa.array(left)), ids.take(pa.array(right)), pa.array(exact)], names=["id", "other", "d2"])


def _recall(points: DataFrame, graph: DataFrame, k: int, shape: MatrixShape, id_type: str, seed: int) -> float:
    """Share of the k nearest rows that the graph has, over a bounded number of rows in hash order."""
    asked = sample_rows(points, "id", max_samples=max(3, CHECKED_ROWS), seed=seed, rows=shape.rows)
    exact = best_of(points, asked, k, shape.width, id_type)
    given = graph.select("id", F.col("best.id").alias("found"))
    hits = exact.join(given, "id").select(F.size(F.array_intersect("found", F.col("best.id"))).alias("hits"))
    return float(hits.agg(F.sum("hits") / (F.count("*") * k)).first()[0])
