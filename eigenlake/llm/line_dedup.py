"""Near-equal lines across documents by a segment-partition edit join.

A line is cut into one segment more than the edits it may differ by; that many edits leave at least one of them whole, at a
place that the lengths bound (Li, Deng, Wang and Feng, "Pass-Join", 2011). Equal segments are
probed through hashed substring keys, and an edit distance that keeps the diagonals of the band
as bits (after Baeza-Yates and Navarro, 1999) confirms the pairs.

A text is read once: its lines and, packed by shard, the keys of their segments come from the same pass. Shards
of keys are met as arrays, and only the lines of the pairs found are fetched again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eigenlake.llm.components import connected
from eigenlake.llm.groups import in_blocks, pairs, whole_groups
from eigenlake.llm.staging import Staging
from eigenlake.llm.text import SpanHasher, bytes_of, code_points, mix, string_parts
from eigenlake.session import small_side

# Edits between lines that count as one: one for every so many code points of the shorter line, but no more than DISTANCE.
DISTANCE = 2
CHARS_PER_EDIT = 10
# Lines of fewer words are left alone unless the caller says otherwise.
LEAST_WORDS = 5
# Rows of one key that are compared in one task.
BLOCK_ROWS = 1024
# Text per shard of keys, and keys that a task holds before it packs them.
SHARD_BYTES = 8 << 20
PACKED_KEYS = 1 << 21
# Documents with candidate lines, a few numbers each, that are sent to every task at most.
WANTED_ROWS = 200_000

_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
# One of eight counters of four bits for the first byte of a code point, none for the others.
_LETTER = np.where(
    (np.arange(256) & 0xC0) == 0x80, 0, np.uint32(1) << (4 * (mix(np.arange(256, dtype=np.uint64)) & np.uint64(7))).astype(np.uint32)
).astype(np.uint32)
# First and last code points of scripts written without spaces, whose characters count as words: Thai and Lao,
# Myanmar, Khmer, kana and ideographs with their extensions.
_UNSPACED = np.array(
    [(0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x31F0, 0x31FF),
     (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x323AF)],
    np.uint32,
)
# A key of a segment: hash (its last bit tells a probe from an indexed segment), letters of the line, print of the line.
_KEY = np.dtype([("key", "<u4"), ("letters", "<u4"), ("line", "<u8")])


class Lines(NamedTuple):
    """Lines of several texts: row, line number, first and last byte, first code point and number of code points."""

    row: np.ndarray
    number: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    length: np.ndarray


def find_lines(part: pa.Array, least_words: int) -> tuple[np.ndarray, np.ndarray, Lines]:
    """Bytes, the byte where each code point begins (and the end), and the lines with enough words."""
    data, rows = bytes_of(part)
    begins = (data & 0xC0) != 0x80
    points = np.append(np.flatnonzero(begins), len(data))
    breaks = np.flatnonzero(data == 10)
    start = np.concatenate([rows[:-1], breaks + 1])
    row = np.concatenate([np.arange(len(part)), np.searchsorted(rows, breaks, "right") - 1])
    order = np.lexsort((start, row))
    start, row = start[order], row[order]
    last = np.append(row[1:] != row[:-1], True)[: len(row)]
    end = np.where(last, rows[row + 1], np.append(start[1:] - 1, 0)[: len(row)])
    number = np.arange(len(row)) - np.searchsorted(row, row)
    word = ~_SPACE[data]
    if least_words > 1:
        word[1:] &= _SPACE[data[:-1]]
        edges = rows[1:-1][rows[1:-1] < len(data)]
        word[edges] = ~_SPACE[data[edges]]
        if (data >= 0xE0).any():
            letters, _ = code_points(part)
            place = np.maximum(np.searchsorted(_UNSPACED[:, 0], letters, "right") - 1, 0)
            word[points[:-1][(letters >= _UNSPACED[place, 0]) & (letters <= _UNSPACED[place, 1])]] = True
    count = np.concatenate([[0], np.cumsum(word)])
    wanted = count[end] - count[start] >= least_words
    row, number, start, end = row[wanted], number[wanted], start[wanted], end[wanted]
    first = np.searchsorted(points, start)
    return data, points, Lines(row, number, start, end, first, np.searchsorted(points, end) - first)


def allowed_edits(length: np.ndarray, distance: int, chars_per_edit: int) -> np.ndarray:
    return np.minimum(distance, length // chars_per_edit)


def segment_keys(first: np.ndarray, length: np.ndarray, points: np.ndarray, hasher: SpanHasher, distance: int, chars_per_edit: int):
    """Yields ``which lines, key, role``: role 0 for a segment as it is indexed, 1 for a probed substring.

    The shorter line of a pair is the indexed one; its length says how many edits there may be.
    """
    for shorter in range(distance + 1):
        other = length - shorter
        edits = allowed_edits(other, distance, chars_per_edit)
        for most in range(max(1, shorter), distance + 1):
            lines = np.flatnonzero(edits == most)
            if not len(lines):
                continue
            parts = most + 1
            size_of, begin, whole = other[lines], first[lines], length[lines]
            base, longer = size_of // parts, size_of % parts
            for i in range(parts):
                before = base * i + np.maximum(0, i - (parts - longer))
                size = base + (i >= parts - longer)
                # Edits before and after the segment bound its shift.
                low = max(-i, shorter - (most - i))
                high = min(i, shorter + (most - i))
                where = mix((size_of * (distance + 1) + i).astype(np.uint64))
                for shift in range(low, high + 1):
                    at = before + shift
                    fits = np.flatnonzero((at >= 0) & (at + size <= whole))
                    left, right = points[(begin + at)[fits]], points[(begin + at + size)[fits]]
                    yield lines[fits], mix(hasher.spans(left, right) ^ where[fits]), int(bool(shorter or shift))


class _Packed:
    """Keys of many lines, handed out as one array per shard."""

    def __init__(self, shards: int) -> None:
        self.shards, self.shard, self.keys, self.count = shards, [], [], 0

    def take(self, data: np.ndarray, points: np.ndarray, lines: Lines, prints: np.ndarray, hasher: SpanHasher, distance: int, chars_per_edit: int) -> None:
        long = np.flatnonzero(lines.length >= chars_per_edit)
        prints, once = np.unique(prints[long], return_index=True)
        long = long[once]
        sums = np.concatenate([np.zeros(1, np.uint32), np.cumsum(_LETTER[data], dtype=np.uint32)])
        letters = sums[lines.end[long]] - sums[lines.start[long]]
        for which, key, role in segment_keys(lines.first[long], lines.length[long], points, hasher, distance, chars_per_edit):
            packed = np.empty(len(which), _KEY)
            packed["key"] = (key & np.uint64(0xFFFFFFFE)) | np.uint64(role)
            packed["letters"], packed["line"] = letters[which], prints[which]
            self.keys.append(packed)
            self.shard.append(((key >> np.uint64(32)) % np.uint64(self.shards)).astype(np.int32))
            self.count += len(which)

    def flush(self) -> tuple[np.ndarray, list[bytes]]:
        """The shards that have keys, and their keys."""
        if not self.count:
            return np.zeros(0, np.int32), []
        shard, keys = np.concatenate(self.shard), np.concatenate(self.keys)
        order = np.argsort(shard, kind="stable")
        shard, keys = shard[order], keys[order]
        starts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
        blobs = [keys[a:b].tobytes() for a, b in zip(starts, [*starts[1:], len(keys)], strict=True)]
        self.shard, self.keys, self.count = [], [], 0
        return shard[starts], blobs


def read_lines(docs: DataFrame, least_words: int, distance: int, chars_per_edit: int, shards: int) -> DataFrame:
    """The lines with enough words as ``doc_id, doc_print, line_no, line``, and their keys as ``shard, keys``.

    ``line`` is a 64-bit print: equal lines have equal ones; two others share one with a chance of 2^-64.
    """
    kind = dict(docs.dtypes)["doc_id"]
    names = ["doc_id", "doc_print", "line_no", "line", "shard", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, packed, id_type = SpanHasher(), _Packed(shards), None

        def full() -> pa.RecordBatch:
            shard, blobs = packed.flush()
            none = [pa.nulls(len(blobs), t) for t in (id_type, pa.int64(), pa.int32(), pa.int64())]
            return pa.RecordBatch.from_arrays([*none, pa.array(shard), pa.array(blobs, pa.binary())], names=names)

        for batch in batches:
            at, id_type = 0, batch.schema.field(0).type
            for part in string_parts(batch.column(2)):
                data, points, lines = find_lines(part, least_words)
                hasher.load(data)
                prints = hasher.spans(lines.start, lines.end)
                chosen = pa.array(lines.row + at)
                columns = [batch.column(0).take(chosen), batch.column(1).take(chosen)]
                columns += [pa.array(lines.number.astype(np.int32)), pa.array(prints.view(np.int64))]
                none = [pa.nulls(len(chosen), t) for t in (pa.int32(), pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, *none], names=names)
                packed.take(data, points, lines, prints, hasher, distance, chars_per_edit)
                if packed.count >= PACKED_KEYS:
                    yield full()
                at += len(part)
        if packed.count:
            yield full()

    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.xxhash64(text).alias("doc_print"), text.alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, doc_print long, line_no int, line long, shard int, keys binary")


_BIAS = np.uint32(0x88888888)
_NIBBLES = np.arange(0, 32, 4, dtype=np.uint32)


def near_letters(left: np.ndarray, right: np.ndarray, distance: int) -> np.ndarray:
    """Whether the letter sums differ as little as ``distance`` edits make them; counts may exceed four bits."""
    apart = (((left - right + _BIAS)[:, None] >> _NIBBLES) & np.uint32(15)).astype(np.int8) - 8
    return np.abs(apart).sum(axis=1) <= 2 * distance


def _alike(rows: np.ndarray, starts: np.ndarray, side: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of lines within the groups of ``rows`` that may be near each other."""
    line, letters, probe = rows["line"].view(np.int64), rows["letters"], rows["key"] & 1
    u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for left, right in pairs(starts, side):
        near = ((probe[left] & probe[right]) == 0) & (line[left] != line[right])
        left, right = left[near], right[near]
        near = near_letters(letters[left], letters[right], distance)
        u.append(np.minimum(line[left[near]], line[right[near]]))
        v.append(np.maximum(line[left[near]], line[right[near]]))
    found = np.unique(np.stack([np.concatenate(u), np.concatenate(v)]), axis=1)
    return found[0], found[1]


def candidate_pairs(keys: DataFrame, distance: int, staging: Staging) -> DataFrame:
    """Pairs ``(u, v)`` of prints of different lines that share a segment and have nearly the same letters."""
    names = ["u", "v", "shard", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["shard"]):
            for a, b in zip(starts[:-1].tolist(), [*starts[1:-1].tolist(), table.num_rows], strict=True):
                shard, blobs = table.column("shard")[a].as_py(), table.column("keys").slice(a, b - a).to_pylist()
                rows = np.frombuffer(b"".join(blobs), _KEY)
                rows = rows[np.argsort(rows["key"] >> 1, kind="stable")]
                key = rows["key"] >> 1
                starts_of = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                sizes = np.diff(np.append(starts_of, len(rows)))
                # Nearly all keys are alone.
                kept = np.repeat((sizes > 1) & (sizes <= BLOCK_ROWS), sizes)
                ends = np.concatenate([[0], np.cumsum(sizes[(sizes > 1) & (sizes <= BLOCK_ROWS)])])
                if len(ends) > 1:
                    u, v = _alike(rows[kept], ends, np.zeros(ends[-1], np.int64), distance)
                    none = [pa.nulls(len(u), pa.int32()), pa.nulls(len(u), pa.binary())]
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), *none], names=names)
                hot = np.unique(rows[np.repeat(sizes > BLOCK_ROWS, sizes)])
                if len(hot):
                    parts = [hot[i : i + BLOCK_ROWS].tobytes() for i in range(0, len(hot), BLOCK_ROWS)]
                    none = pa.nulls(len(parts), pa.int64())
                    shards = pa.array([shard] * len(parts), pa.int32())
                    yield pa.RecordBatch.from_arrays([none, none, shards, pa.array(parts, pa.binary())], names=names)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = np.frombuffer(blob, _KEY)
                key = (np.int64(shard) << 32) | (rows["key"] >> 1).astype(np.int64)
                columns = [key, rows["line"].view(np.int64), rows["letters"].view(np.int32), (rows["key"] & 1).astype(np.int8)]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["key", "line", "letters", "role"])

    dealt = keys.repartition("shard").sortWithinPartitions("shard")
    first = staging.keep(dealt.mapInArrow(run, "u long, v long, shard int, keys binary"), "first")
    # Keys of many lines come back here and are dealt out in blocks.
    later = first.where("keys is not null").select("shard", "keys").mapInArrow(unpack, "key long, line long, letters int, role byte")
    counts = staging.keep(later.groupBy("key").agg(F.count("*").alias("rows")), "hot")
    found = first.where("u is not null").select("u", "v")
    if counts.isEmpty():
        return found.distinct()
    blocks = in_blocks(later.join(counts, "key"), "line", F.ceil(F.col("rows") / BLOCK_ROWS))
    by = ["key", "block_i", "block_j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, by):
            rows = np.empty(table.num_rows, _KEY)
            rows["line"] = table.column("line").to_numpy().view(np.uint64)
            rows["letters"] = table.column("letters").to_numpy().view(np.uint32)
            rows["key"] = table.column("role").to_numpy()
            u, v = _alike(rows, starts, table.column("side").to_numpy().astype(np.int64), distance)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    spread = blocks.select(*by, "side", "line", "letters", "role").repartition(*by).sortWithinPartitions(*by, "side")
    return found.union(spread.mapInArrow(compare, "u long, v long")).distinct()


def within_distance(left: str, right: str, distance: int) -> bool:
    """Whether at most ``distance`` edits of code points lead from one text to the other.

    Bit-parallel over the diagonal band of width ``2 * distance + 1``; equal ends are cut off first.
    """
    if len(left) > len(right):
        left, right = right, left
    if len(right) - len(left) > distance:
        return False
    a, limit = 0, len(left)
    while a < limit and left[a] == right[a]:
        a += 1
    b = 0
    while b < limit - a and left[-1 - b] == right[-1 - b]:
        b += 1
    left, right = left[a : len(left) - b], right[a : len(right) - b]
    if not left:
        return len(right) <= distance
    width = 2 * distance + 1
    # Bit d of reach[e]: some e edits align the first i letters of left with the first i + d - distance of right.
    full = (1 << width) - 1
    reach = [0] * (distance + 1)
    reach[0] = 1 << distance
    for e in range(1, distance + 1):
        reach[e] = reach[e - 1] | (reach[e - 1] << 1) & full
    for i, letter in enumerate(left):
        equal = 0
        for d in range(width):
            j = i + d - distance
            if 0 <= j < len(right) and right[j] == letter:
                equal |= 1 << d
        before, fresh = reach, []
        for e in range(distance + 1):
            now = before[e] & equal
            if e:
                # A replaced letter stays on its diagonal, a deleted one falls to the one below.
                now |= before[e - 1] | (before[e - 1] >> 1)
                # An inserted letter follows edits already made in this row.
                now |= (fresh[e - 1] << 1) & full
            fresh.append(now)
        reach = fresh
        if not reach[distance]:
            return False
    end = distance + len(right) - len(left)
    return any(mask >> end & 1 for mask in reach)


def line_texts(docs: DataFrame, wanted: DataFrame, owners: DataFrame, staging: Staging) -> DataFrame:
    """``line, text`` of the lines whose print is in ``wanted(line)``, once each, from the documents that hold them first."""
    places = owners.join(wanted, "line", "left_semi").select(F.col("first.doc_print").alias("print"), F.col("first.line_no").alias("number"), "line")
    places = staging.keep(places.groupBy("print").agg(F.collect_set(F.struct("number", "line")).alias("places")), "places")
    text = F.col("text").cast("string")
    given = docs.select(F.xxhash64(text).alias("print"), text.alias("text"))
    # Rows of the same text have the same lines.
    held = given.join(small_side(places, WANTED_ROWS), "print").select(F.split("text", "\n", -1).alias("lines"), F.explode("places").alias("place"))
    return staging.keep(held.select("place.line", F.col("lines")[F.col("place.number")].alias("text")).dropDuplicates(["line"]), "texts")


def _confirm(distance: int, chars_per_edit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            good = [within_distance(a, b, min(distance, min(len(a), len(b)) // chars_per_edit)) for a, b in texts]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return run


def _shards(docs: DataFrame) -> int:
    # The size of what is scanned is an estimate; a wrong one makes shards of another size only.
    size = docs.select("text")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return max(16, min(1 << 22, math.ceil(int(str(size)) / SHARD_BYTES)))


def repeated_lines(
    docs: DataFrame, distance: int = DISTANCE, least_words: int = LEAST_WORDS, chars_per_edit: int = CHARS_PER_EDIT
) -> DataFrame:
    """Lines to take out: ``doc_id, doc_print, line_no, kept_doc_id, kept_line_no``.

    Lines (between line feeds) of at least ``least_words`` words (1: every line that is not blank; a character of
    a script without spaces is a word) belong together if they are equal or joined by steps of a few edits of code
    points: one for every ``chars_per_edit`` code points of the shorter line, ``distance`` at most. Of each class the
    first by doc_id (null last) and line number stays. Null and empty texts have no
    lines; rows that share doc_id and text are one document. ``doc_print`` is xxhash64 of the text.
    """
    staging = Staging(docs.sparkSession, "lines")
    read = staging.keep(read_lines(docs, least_words, distance, chars_per_edit, _shards(docs)), "read")
    lines = read.where("line is not null").drop("shard", "keys")
    place = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "doc_print", "line_no")
    owners = lines.groupBy("line").agg(F.min(place).alias("first"), F.count("*").alias("copies"))
    owners = staging.keep(owners, "owners")
    candidates = staging.keep(candidate_pairs(read.where("keys is not null").select("shard", "keys"), distance, staging), "candidates")
    wanted = candidates.select(F.col("u").alias("line")).union(candidates.select(F.col("v").alias("line"))).distinct()
    texts = line_texts(docs, wanted, owners, staging)
    both = candidates.join(texts.select(F.col("line").alias("u"), F.col("text").alias("left")), "u")
    both = both.join(texts.select(F.col("line").alias("v"), F.col("text").alias("right")), "v")
    links = both.select("u", "v", "left", "right").mapInArrow(_confirm(distance, chars_per_edit), "u long, v long")
    classes = staging.keep(connected(links, staging), "classes")
    merged = owners.join(classes.withColumnRenamed("id", "line"), "line").groupBy("root").agg(F.min("first").alias("kept"))
    merged = classes.join(staging.keep(merged, "merged"), "root").select(F.col("id").alias("line"), "kept")
    single = owners.where("copies > 1").join(merged.select("line"), "line", "left_anti")
    kept = staging.keep(merged.union(single.select("line", F.col("first").alias("kept"))), "kept")
    staging.drop(candidates, texts, owners)
    found = lines.join(kept, "line").where(place != F.col("kept"))
    return found.select(
        "doc_id", "doc_print", "line_no", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.line_no").alias("kept_line_no")
    )


def without_repeated_lines(
    docs: DataFrame, distance: int = DISTANCE, least_words: int = LEAST_WORDS, chars_per_edit: int = CHARS_PER_EDIT
) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``; other rows and columns stay as they are, whatever their names.

    A document that loses lines and keeps no word is left out.
    """
    staging = Staging(docs.sparkSession, "clean-lines")
    drops = repeated_lines(docs, distance, least_words, chars_per_edit).groupBy("doc_id", "doc_print")
    drops = drops.agg(F.collect_set("line_no").alias("drop")).withColumnsRenamed({"doc_id": "drop_id", "doc_print": "drop_print"})
    drops = staging.keep(drops, "drops")
    # The user's row travels as one struct, so that no name of its columns matters.
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col("row.text").cast("string")
    packed = packed.select("row", F.col("row.doc_id").alias("id"), F.xxhash64(text).alias("print"))
    marked = packed.join(drops, F.col("id").eqNullSafe(F.col("drop_id")) & (F.col("print") == F.col("drop_print")), "left")
    kept = F.filter(F.split(text, "\n", -1), lambda line, i: ~F.array_contains("drop", i))
    cleaned = F.when(F.col("drop").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    cleaned = marked.select("row", "drop", cleaned.alias("text"))
    cleaned = cleaned.where(F.col("drop").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return cleaned.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
