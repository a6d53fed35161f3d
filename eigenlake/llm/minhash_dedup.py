"""Near-duplicate documents by SetSketch registers of their word shingles.

A register holds the exponentially spaced, truncated minimum of one hash function over the
shingle set (Ertl, "SetSketch", 2021). Registers of two sets merge by maximum and agree more
often the more alike the sets are. Bands of registers find candidates, the joint likelihood of
all registers estimates their Jaccard similarity, and full sets confirm it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eigenlake.llm.components import connected
from eigenlake.llm.groups import Forest, in_blocks, pairs, whole_groups
from eigenlake.llm.staging import Staging
from eigenlake.llm.text import SpanHasher, bytes_of, distinct, mix, shingles, string_parts, words

# Rows and shingles of a block that is compared as a whole with another.
BLOCK_ROWS = 256
BLOCK_SHINGLES = 1 << 20
# Columns of a dense membership matrix held at once.
MATRIX_COLUMNS = 8192
# Smaller groups are compared pair by pair.
SMALL_GROUP = 8


@dataclass(frozen=True)
class Sketch:
    """Shape of the registers; the defaults find a link of similarity 0.85 with probability 1 - 1e-5."""

    bands: int = 16
    rows: int = 4
    registers: int = 128
    base: float = 1.001
    rate: float = 20.0
    limit: int = 65_534
    seed: int = 11
    masks: np.ndarray = field(init=False, compare=False)
    factors: np.ndarray = field(init=False, compare=False)

    def __post_init__(self) -> None:
        drawn = np.random.Generator(np.random.PCG64(self.seed)).integers(
            0, 2**64, (2, self.registers), dtype=np.uint64
        )
        object.__setattr__(self, "masks", drawn[0])
        object.__setattr__(self, "factors", drawn[1] | np.uint64(1))

    def of(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Registers of every set that is not empty, one row each."""
        starts = first[:-1][np.diff(first) > 0]
        least = np.empty((self.registers, len(starts)), np.uint64)
        for i in range(self.registers):
            least[i] = np.minimum.reduceat((hashes ^ self.masks[i]) * self.factors[i], starts)
        uniform = (least.T.astype(np.float64) + 0.5) / 2.0**64
        exponential = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / self.rate
        spaced = np.floor(1 - np.log(exponential) / math.log(self.base))
        return np.clip(spaced, 0, self.limit + 1).astype(np.uint16)

    def band_keys(self, registers: np.ndarray) -> np.ndarray:
        out = np.empty((len(registers), self.bands), np.uint64)
        for band in range(self.bands):
            key = np.full(len(registers), np.uint64(band + 1))
            for i in range(band * self.rows, (band + 1) * self.rows):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + registers[:, i])
            out[:, band] = key
        return out.view(np.int64)

    def similarity(self, left: np.ndarray, right: np.ndarray, sizes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Jaccard similarity of greatest likelihood given registers and set sizes, on a grid of hundredths."""
        more = (left > right).sum(axis=1)[:, None]
        less = (left < right).sum(axis=1)[:, None]
        equal = self.registers - more - less
        u = (sizes[0] / (sizes[0] + sizes[1]))[:, None]
        grid = np.arange(0, 1.0001, 0.01)[None, :]

        def passed(x: np.ndarray) -> np.ndarray:
            x = np.clip(x, 1e-12, 1.0)
            return -np.log1p(-x * (self.base - 1) / self.base) / math.log(self.base)

        up, down = passed(u - (1 - u) * grid), passed((1 - u) - u * grid)
        value = more * np.log(up) + less * np.log(down) + equal * np.log(np.clip(1 - up - down, 1e-12, 1.0))
        # Beyond the larger set's share a similarity is impossible.
        value[grid > np.minimum(u / (1 - u), (1 - u) / u) + 0.01] = -np.inf
        return grid[0][np.argmax(value, axis=1)]


def sketch_documents(docs: DataFrame, sketch: Sketch) -> DataFrame:
    """``doc_id, n_shingles, print_a, print_b, bands, registers`` of every whole text.

    The two prints are order-free 64-bit sums over the set: equal sets have equal prints.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            row = 0
            for part in string_parts(batch.column(1)):
                hashes, first = shingles(words(part, hasher))
                size = np.diff(first)
                sets = [distinct(hashes[first[i] : first[i + 1]]) for i in range(len(part))]
                count = np.array([len(s) for s in sets], np.int64)
                filled = np.flatnonzero(size)
                prints = np.zeros((2, len(part)), np.uint64)
                if len(filled):
                    flat = np.concatenate(sets)
                    starts = np.concatenate([[0], np.cumsum(count)])[:-1][filled]
                    prints[0, filled] = np.add.reduceat(mix(flat + np.uint64(1)), starts)
                    prints[1, filled] = np.add.reduceat(mix(flat + np.uint64(2)), starts)
                    registers = sketch.of(flat, np.concatenate([starts, [len(flat)]]))
                    keys = sketch.band_keys(registers)
                else:
                    registers = np.zeros((0, sketch.registers), np.uint16)
                    keys = np.zeros((0, sketch.bands), np.int64)
                has = size > 0
                ends = np.concatenate([[0], np.cumsum(has)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(part)),
                        pa.array(count),
                        pa.array(prints[0].view(np.int64)),
                        pa.array(prints[1].view(np.int64)),
                        pa.ListArray.from_arrays(ends * sketch.bands, pa.array(keys.ravel())),
                        binary_rows(registers, ends),
                    ],
                    names=["doc_id", "n_shingles", "print_a", "print_b", "bands", "registers"],
                )
                row += len(part)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run,
        "doc_id long, n_shingles long, print_a long, print_b long, bands array<long>, registers binary",
    )


def binary_rows(matrix: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary column of rows of a matrix; ``ends`` counts the rows taken so far."""
    width = matrix.shape[1] * matrix.itemsize
    buffers = [None, pa.py_buffer(ends * np.int32(width)), pa.py_buffer(np.ascontiguousarray(matrix))]
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, buffers)


def register_rows(column: pa.Array, width: int) -> np.ndarray:
    """The registers of a binary column, one row each."""
    first = np.frombuffer(column.buffers()[1], np.int32)[column.offset] // 2
    raw = np.frombuffer(column.buffers()[2], np.uint16)
    return raw[first : first + len(column) * width].reshape(len(column), width)


def near_duplicates(
    docs: DataFrame, threshold_percent: int = 80, sketch: Sketch | None = None, margin: float = 5.0
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text, ...)``.

    Documents link where ``100 * intersection >= threshold_percent * union`` of their distinct
    five-word shingles (``words`` of this package; fewer words are one shingle). A component is
    named by its smallest doc_id, which alone is kept. Texts that are null or hold no word link
    with nothing, neither do rows without doc_id (component_id null, kept true). Rows that share a
    doc_id are one document that has the links of all its texts. Other columns are not read.

    Equal sets become one representative before anything is compared. ``margin`` is how many
    standard deviations below the threshold an estimate may lie and still be confirmed exactly.
    """
    sketch = sketch or Sketch()
    staging = Staging(docs.sparkSession, "near-duplicates")
    found = staging.keep(sketch_documents(docs, sketch), "sketches")
    prints = ["print_a", "print_b", "n_shingles"]
    usable = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    copies = staging.keep(
        found.where(usable)
        .groupBy(*prints)
        .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies"),
        "copies",
    )
    single = found.join(copies, prints, "left").where(usable)
    single = single.where(F.coalesce("first_id", "doc_id") == F.col("doc_id"))
    alike = _alike(single, found, sketch, threshold_percent, margin, staging)
    links = staging.keep(_confirmed(docs, connected(alike, staging), found, threshold_percent, staging), "links")
    # Root of a component: the smallest doc_id, as representatives are the smallest of their copies.
    component = connected(links, staging).select(F.col("id").alias("first_id"), F.col("root"))
    return (
        found.select("doc_id", *prints)
        .join(copies, prints, "left")
        .withColumn("first_id", F.when(F.col("n_shingles") > 0, F.coalesce("first_id", "doc_id")))
        .join(component, "first_id", "left")
        .withColumn("component_id", F.coalesce("root", "first_id", "doc_id"))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def _alike(single, found, sketch: Sketch, percent: int, margin: float, staging: Staging) -> DataFrame:
    """Spanning links ``(u, v)`` of the candidates whose estimated similarity is near the threshold or above."""
    threshold = percent / 100
    bound = threshold - margin * math.sqrt(threshold * (1 - threshold) / sketch.registers)
    keyed = staging.keep(single.select("doc_id", F.explode("bands").alias("band")), "bands")
    shared = staging.keep(keyed.groupBy("band").agg(F.count("*").alias("members")).where("members > 1"), "shared")
    members = staging.keep(keyed.join(shared, "band"), "members")
    wide = members.join(found.select("doc_id", "n_shingles", "registers"), "doc_id")
    dealt = in_blocks(wide, "doc_id", F.ceil(F.col("members") / BLOCK_ROWS))
    keys = ["band", "block_i", "block_j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, keys):
            ids, size = table.column("doc_id").to_numpy(), table.column("n_shingles").to_numpy()
            registers = register_rows(table.column("registers").chunk(0), sketch.registers)
            forest, u, v = Forest(len(ids)), [], []
            for left, right in pairs(starts, table.column("side").to_numpy()):
                small, large = np.minimum(size[left], size[right]), np.maximum(size[left], size[right])
                near = (100 * small >= percent * large) & (ids[left] != ids[right])
                left, right = left[near], right[near]
                for at in range(0, len(left), 1 << 14):
                    a, b = left[at : at + (1 << 14)], right[at : at + (1 << 14)]
                    ra, rb = registers[a], registers[b]
                    likely = (ra == rb).sum(axis=1) >= (bound - 0.1) * sketch.registers
                    a, b, ra, rb = a[likely], b[likely], ra[likely], rb[likely]
                    close = sketch.similarity(ra, rb, (size[a], size[b])) >= bound
                    a, b = a[close], b[close]
                    kept = forest.join(a, b)
                    u.append(ids[a[kept]])
                    v.append(ids[b[kept]])
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])

    columns = [*keys, "side", "doc_id", "n_shingles", "registers"]
    return dealt.select(*columns).repartition(*keys).sortWithinPartitions(*keys, "side").mapInArrow(run, "u long, v long")


def _confirmed(docs, groups, found, percent: int, staging: Staging) -> DataFrame:
    """Spanning links of exactly confirmed pairs within each group of candidates."""
    groups = staging.keep(groups, "groups")
    sized = groups.join(found.select(F.col("doc_id").alias("id"), "n_shingles").distinct(), "id")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("n_shingles") / BLOCK_SHINGLES))
    large = staging.keep(sized.groupBy("root").agg(blocks.alias("blocks")).where("blocks > 1"), "large")
    members = staging.keep(
        groups.join(large, "root", "left").select(F.col("id").alias("doc_id"), "root", F.coalesce("blocks", F.lit(1)).alias("blocks")),
        "grouped",
    )
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(members, "doc_id")
    sets = texts.select("root", "blocks", "doc_id", "text").mapInArrow(_sets, "root long, blocks long, doc_id long, shingles binary")
    dealt = in_blocks(sets, "doc_id", F.col("blocks"))
    keys = ["root", "block_i", "block_j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, keys):
            ids, side = table.column("doc_id").to_numpy(), table.column("side").to_numpy()
            packed = table.column("shingles").chunk(0)
            u, v = [], []
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                sets = [np.frombuffer(packed[i].as_buffer(), np.uint64) for i in range(a, b)]
                left, right = linked(sets, side[a:b], percent)
                u.append(ids[a:b][left])
                v.append(ids[a:b][right])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])

    columns = [*keys, "side", "doc_id", "shingles"]
    return dealt.select(*columns).repartition(*keys).sortWithinPartitions(*keys, "side").mapInArrow(run, "u long, v long")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = SpanHasher()
    for batch in batches:
        row = 0
        for part in string_parts(batch.column(3)):
            hashes, first = shingles(words(part, hasher))
            packed = [distinct(hashes[first[i] : first[i + 1]]).tobytes() for i in range(len(part))]
            kept = [batch.column(i).slice(row, len(part)) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(packed, pa.binary())], names=["root", "blocks", "doc_id", "shingles"])
            row += len(part)


def linked(sets: list[np.ndarray], side: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links between the sets of one group, or between its two sides."""
    size = np.array([len(s) for s in sets], np.int64)
    forest, lefts, rights = Forest(len(sets)), [], []
    shared = None if len(sets) <= SMALL_GROUP else _intersections(sets, side)
    second = int((side == 0).sum())
    for left, right in pairs(np.array([0, len(sets)]), side):
        near = 100 * np.minimum(size[left], size[right]) >= percent * np.maximum(size[left], size[right])
        left, right = left[near], right[near]
        if shared is not None:
            common = shared[left, right - second if second < len(sets) else right]
            good = common * (100 + percent) >= percent * (size[left] + size[right])
            left, right = left[good], right[good]
            kept = forest.join(left, right)
            lefts.append(left[kept])
            rights.append(right[kept])
            continue
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            if forest.root(a) != forest.root(b):
                both = np.concatenate([sets[a], sets[b]])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                if common * (100 + percent) >= percent * (size[a] + size[b]):
                    forest.join(np.array([a]), np.array([b]))
                    lefts.append(np.array([a]))
                    rights.append(np.array([b]))
    none = np.zeros(0, np.int64)
    return (np.concatenate(lefts), np.concatenate(rights)) if lefts else (none, none)


def _intersections(sets: list[np.ndarray], side: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of side 0 with side 1, or with itself where there is one side."""
    cut = int((side == 0).sum())
    crossed = cut < len(sets)
    first, second = (sets[:cut], sets[cut:]) if crossed else (sets, sets)
    flat = [np.concatenate(part) for part in (first, second)]
    rows = [np.repeat(np.arange(len(part)), [len(s) for s in part]) for part in (first, second)]
    if crossed:
        vocabulary = np.intersect1d(distinct(flat[0]), distinct(flat[1]), assume_unique=True)
    else:
        ordered = np.sort(flat[0])
        vocabulary = distinct(ordered[1:][ordered[1:] == ordered[:-1]])
    out = np.zeros((len(first), len(second)), np.float64)
    if not len(vocabulary):
        return out.astype(np.int64)
    cells = []
    for values, row in zip(flat, rows, strict=True):
        at = np.searchsorted(vocabulary, values)
        at[at == len(vocabulary)] = 0
        hit = vocabulary[at] == values
        order = np.argsort(at[hit], kind="stable")
        cells.append((at[hit][order], row[hit][order]))
    for start in range(0, len(vocabulary), MATRIX_COLUMNS):
        dense = []
        for (at, row), part in zip(cells, (first, second), strict=True):
            a, b = np.searchsorted(at, [start, start + MATRIX_COLUMNS])
            matrix = np.zeros((len(part), min(MATRIX_COLUMNS, len(vocabulary) - start)), np.float32)
            matrix[row[a:b], at[a:b] - start] = 1
            dense.append(matrix)
        out += dense[0] @ dense[1].T
    return out.astype(np.int64)


def without_near_duplicates(docs: DataFrame, threshold_percent: int = 80, texts: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns, whatever their names.

    ``texts(doc_id, text)``, where given, holds other texts of the same documents, such as those before a
    cleaning step; of what is kept by the texts of ``docs``, one document of each group of these stays.
    """
    staging = Staging(docs.sparkSession, "dropped")
    kept = _without(docs, near_duplicates(docs, threshold_percent), staging)
    if texts is None:
        return kept
    ids = kept.select(F.col("doc_id").cast("long").alias("id")).distinct()
    others = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    others = staging.keep(others.join(ids, others["doc_id"] == ids["id"], "left_semi"), "texts")
    return _without(kept, near_duplicates(others, threshold_percent), staging)


def _without(docs: DataFrame, found: DataFrame, staging: Staging) -> DataFrame:
    dropped = staging.keep(found.where(~F.col("kept")).select(F.col("doc_id").alias("id")).distinct(), "ids")
    return docs.join(dropped, docs["doc_id"].cast("long") == dropped["id"], "left_anti")
