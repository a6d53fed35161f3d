"""Near-equal embeddings through a pivot-permutation index.

Each vector is described by its nearest reference points in order (Chavez, Figueroa and Navarro,
2008; Amato and Savino, 2008). Inverted lists are kept for pairs of pivots, so two vectors meet
in a list exactly if they share at least two of their nearest pivots; a cosine in double
precision verifies them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eigenlake.llm.components import connected
from eigenlake.llm.groups import Forest, in_blocks, pairs, whole_groups
from eigenlake.llm.staging import Staging
from eigenlake.llm.text import mix

# Reference points and how many describe a vector. The points come from a sample of SAMPLE distinct vectors
# (by md5 of the id), thinned so that no two are alike: a large cluster must not fill the nearest places. Where
# thinning leaves fewer than LEAST_PIVOTS, the next limit is taken; the last one takes any vector.
PIVOTS = 256
SAMPLE = 4096
APART = (0.7, 0.8, 0.9, 0.95, 0.98, 0.995, float("inf"))
LEAST_PIVOTS = 32
NEAREST = 6
# Pivots are halved until this share of the near pairs of the sample meet in a list; two pivots compare all pairs.
# With fewer than LEAST_PAIRS near pairs, made neighbours of the sampled vectors are looked at as well.
SAMPLE_RECALL = 0.97
LEAST_PAIRS = 100
# Rows of one list that are compared with as many others in one task; pairs verified in one step.
BLOCK_ROWS = 256
PAIR_ROWS = 1 << 14


def list_keys(space: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Name of the inverted list of two pivots, the smaller first, within a label and dimension."""
    pair = first.astype(np.uint64) * np.uint64(PIVOTS) + second.astype(np.uint64) + np.uint64(1)
    return mix(space.astype(np.int64).view(np.uint64) ^ mix(pair))


def unit_rows(column: pa.Array) -> list[np.ndarray]:
    """Vectors of length one."""
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    out = []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        # Scaled first, so that squares neither overflow nor vanish.
        row = flat[a:b] / np.abs(flat[a:b]).max()
        out.append(row / np.sqrt((row * row).sum()))
    return out


def apart(units: list[np.ndarray], count: int, limit: float) -> np.ndarray:
    """Up to ``count`` of the vectors, in order, none with a cosine of ``limit`` or more to an earlier one."""
    width = max((len(u) for u in units), default=1)
    chosen = np.zeros((0, width))
    for unit in units:
        row = np.zeros(width)
        row[: len(unit)] = unit
        if len(chosen) < count and not (chosen @ row >= limit).any():
            chosen = np.vstack([chosen, row])
    return chosen


def nearest_pivots(rows: list[np.ndarray], pivots: np.ndarray) -> np.ndarray:
    """Numbers of the nearest pivots of each vector, ascending."""
    width = np.array([len(r) for r in rows])
    near = np.empty((len(rows), min(NEAREST, len(pivots))), np.int64)
    for size in np.unique(width):
        which = np.flatnonzero(width == size)
        # Vectors of another dimension see the pivots cut or padded with zeros.
        seen = np.zeros((len(pivots), size))
        seen[:, : min(size, pivots.shape[1])] = pivots[:, :size]
        likeness = np.stack([rows[i] for i in which]) @ seen.T
        near[which] = np.argsort(-likeness, axis=1, kind="stable")[:, : near.shape[1]]
    return np.sort(near, axis=1)


def sample_pairs(units: list[np.ndarray], threshold: float) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Vectors, and row numbers of pairs of them with a cosine of ``threshold`` or more.

    Where the sample holds few, a made neighbour at a random cosine from there to 1 is added for every vector.
    """
    width, left, right = np.array([len(u) for u in units]), [], []
    for size in np.unique(width):
        which = np.flatnonzero(width == size)
        block = np.stack([units[i] for i in which])
        for at in range(0, len(which), 512):
            a, b = np.nonzero(block[at : at + 512] @ block.T >= threshold)
            upper = a + at < b
            left.append(which[a[upper] + at])
            right.append(which[b[upper]])
    left, right = np.concatenate(left), np.concatenate(right)
    if len(left) >= LEAST_PAIRS:
        # An even choice of them is enough for a share.
        step = 1 + (len(left) >> 18)
        return units, left[::step], right[::step]
    rng, made = np.random.default_rng(11), []
    for unit in units:
        side = rng.normal(size=len(unit))
        side -= (side @ unit) * unit
        length = np.sqrt((side * side).sum())
        cosine = rng.uniform(min(threshold, 1.0), 1.0)
        made.append(cosine * unit + np.sqrt(1 - cosine * cosine) * side / length if length > 1e-9 else unit)
    own = np.arange(len(units))
    return [*units, *made], np.concatenate([left, own]), np.concatenate([right, own + len(units)])


def choose_pivots(units: list[np.ndarray], threshold: float, most: int) -> np.ndarray:
    """Two pivots at least (of two vectors or more), as many as let near pairs of the sample share two of them."""
    if len(units) < 2:
        return apart(units, 1, APART[-1])
    most = max(2, most)
    for limit in APART:
        points = apart(units, most, limit)
        if len(points) >= min(LEAST_PIVOTS, most, len(units)):
            break
    rows, left, right = sample_pairs(units, threshold)
    while len(points) > 2:
        near = nearest_pivots(rows, points)
        met = 0
        for at in range(0, len(left), PAIR_ROWS):
            a, b = near[left[at : at + PAIR_ROWS]], near[right[at : at + PAIR_ROWS]]
            shared = (a[:, :, None] == b[:, None, :]).sum(axis=(1, 2))
            met += int((shared >= 2).sum())
        if met >= SAMPLE_RECALL * len(left):
            break
        # So few pivots that any two vectors share two of them are no better than two pivots, with one list.
        half = len(points) // 2
        points = points[: half if half > 2 * NEAREST - 2 else 2]
    return points


def describe(pivots: np.ndarray):
    """Task function: nearest pivots of each vector, packed in ascending order, one byte each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = nearest_pivots(unit_rows(batch.column(2)), pivots)
            space = batch.column(1).to_numpy()
            packed = np.zeros(len(near), np.uint64)
            for i in range(near.shape[1]):
                packed |= near[:, i].astype(np.uint64) << np.uint64(8 * i)
            for i, j in combinations(range(near.shape[1]), 2):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list_keys(space, near[:, i], near[:, j]).view(np.int64)),
                        batch.column(0),
                        batch.column(1),
                        pa.array(packed.view(np.int64)),
                    ],
                    names=["list", "class_id", "space", "nearest"],
                )

    return run


def shared_pivots(left: np.ndarray, right: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of shared pivots and the two smallest of them."""
    total = np.zeros(len(left), np.int64)
    found = np.full((2, len(left)), -1, np.int64)
    for i in range(count):
        mine = (left >> np.uint64(8 * i)) & np.uint64(255)
        has = np.zeros(len(left), bool)
        for j in range(count):
            has |= mine == ((right >> np.uint64(8 * j)) & np.uint64(255))
        for place in (0, 1):
            chosen = has & (total == place)
            found[place, chosen] = mine[chosen]
        total += has
    return total, found[0], found[1]


def linked(threshold: float, count: int):
    """Task function over sorted lists: links of each class, and spanning links ``(u, v)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["list", "block_i", "block_j"]):
            ids, copies = table.column("class_id").to_numpy(), table.column("copies").to_numpy()
            space, name = table.column("space").to_numpy(), table.column("list").to_numpy().view(np.uint64)
            nearest = table.column("nearest").to_numpy().view(np.uint64)
            rows = unit_rows(table.column("vector").chunk(0))
            width = max(len(r) for r in rows)
            unit = np.zeros((len(rows), width))
            for i, row in enumerate(rows):
                unit[i, : len(row)] = row
            sums, forest, u, v = np.zeros(len(ids), np.int64), Forest(len(ids)), [], []
            for left, right in pairs(starts, table.column("side").to_numpy().astype(np.int64)):
                for at in range(0, len(left), PAIR_ROWS):
                    a, b = left[at : at + PAIR_ROWS], right[at : at + PAIR_ROWS]
                    total, first, second = shared_pivots(nearest[a], nearest[b], count)
                    # A pair counts in the list of its two smallest shared pivots only.
                    own = (total >= 2) & (space[a] == space[b]) & (ids[a] != ids[b])
                    own[own] = list_keys(space[a[own]], first[own], second[own]) == name[a[own]]
                    a, b = a[own], b[own]
                    close = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
                    a, b = a[close], b[close]
                    np.add.at(sums, a, copies[b])
                    np.add.at(sums, b, copies[a])
                    kept = forest.join(a, b)
                    u.append(ids[a[kept]])
                    v.append(ids[b[kept]])
            some = np.flatnonzero(sums)
            if len(some):
                u, v = np.concatenate(u), np.concatenate(v)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([ids[some], u])),
                        pa.array(np.concatenate([ids[some], v])),
                        pa.array(np.concatenate([sums[some], np.zeros(len(u), np.int64)])),
                    ],
                    names=["u", "v", "links"],
                )

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.93, pivots: int = PIVOTS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, embedding, label, ...)``.

    Vectors link where labels are equal and the cosine is at least ``threshold``. A vector that is null, empty, zero
    or holds null or non-finite components, or a row without label or vec_id, links with nothing; vectors of
    different length don't either. Rows that share vec_id, label and vector are one vector. Equal vectors are
    compared as one and counted as many. Other columns are not read.

    The index is approximate: a pair is missed if it shares fewer than two of its ``NEAREST``
    pivots; the pivots are chosen so that few pairs of a sample are, and tests measure the recall. Every pair that is reported has been verified.
    """
    staging = Staging(vectors.sparkSession, "vectors")
    vector = F.col("embedding").cast("array<double>")
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vector.isNotNull() & ~broken
    ) & F.exists(vector, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long"), vector.alias("vector"), "label", F.coalesce(usable, F.lit(False)).alias("usable"))
    prints = ["print_a", "print_b"]
    rows = rows.withColumns({"print_a": F.xxhash64("label", "vector"), "print_b": F.xxhash64(F.lit(1), "vector", "label")})
    classes = rows.where("usable").groupBy(*prints).agg(
        F.min("vec_id").alias("class_id"),
        F.count_distinct("vec_id").alias("copies"),
        F.first("vector").alias("vector"),
        F.xxhash64(F.first("label"), F.size(F.first("vector"))).alias("space"),
    )
    classes = staging.keep(classes, "classes")
    sample = classes.orderBy(F.md5(F.col("class_id").cast("string")), "space").limit(SAMPLE).select("vector").toArrow()
    units = unit_rows(sample.column(0).combine_chunks()) if sample.num_rows else []
    points = choose_pivots(units, threshold, min(pivots, PIVOTS))
    count = min(NEAREST, len(points))
    keyed = classes.select("class_id", "space", "vector").mapInArrow(
        describe(points), "list long, class_id long, space long, nearest long"
    )
    keyed = staging.keep(keyed, "lists")
    large = keyed.groupBy("list").agg(F.count("*").alias("rows")).where(F.col("rows") > BLOCK_ROWS)
    large = staging.keep(large, "large")
    wide = keyed.join(classes.select("class_id", "space", "copies", "vector"), ["class_id", "space"])
    wide = wide.join(large, "list", "left").withColumn("rows", F.coalesce("rows", F.lit(1)))
    dealt = in_blocks(wide, "class_id", F.ceil(F.col("rows") / BLOCK_ROWS))
    keys = ["list", "block_i", "block_j"]
    dealt = dealt.select(*keys, "side", "class_id", "copies", "space", "nearest", "vector")
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys, "side")
    found = staging.keep(dealt.mapInArrow(linked(threshold, count), "u long, v long, links long"), "found")
    sums = found.where("u = v").groupBy(F.col("u").alias("class_id")).agg(F.sum("links").alias("links"))
    sums = staging.keep(sums, "sums")
    roots = connected(found.where("u <> v").select("u", "v"), staging).withColumnRenamed("id", "class_id")
    named = classes.select(*prints, "class_id", "copies").join(sums, "class_id", "left").join(roots, "class_id", "left")
    named = staging.keep(named, "named")
    component = F.coalesce("root", "class_id", "vec_id")
    return (
        rows.select("vec_id", "usable", *prints)
        .join(named.withColumn("usable", F.lit(True)), [*prints, "usable"], "left")
        .select(
            "vec_id",
            (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.col("vec_id").eqNullSafe(component).alias("kept"),
        )
    )
