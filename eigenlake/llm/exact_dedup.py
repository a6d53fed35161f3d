"""Exact duplicates by Grace hashing: buckets are partitioned again until each fits a table of whole contents.

Every task first folds the copies of its own rows, so a text that a third of all rows repeat is sent once
per slice of input. What is left is dealt to buckets by hash (Kitsuregawa, Tanaka and Moto-oka, 1983). A bucket's table uses
open addressing and compares complete contents; texts for which it has no room are written to spill files,
which the next level deals out by another hash.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from eigenlake.llm.staging import Staging
from eigenlake.llm.text import string_parts

# Distinct text, and rows, that a task folds at once.
FOLD_BYTES = 16 << 20
FOLD_ROWS = 1 << 16
# Text dealt to one bucket on average, and what its table takes before texts are spilled.
BUCKET_BYTES = 32 << 20
TABLE_BYTES = 96 << 20


class ContentTable:
    """Numbers distinct contents in order of arrival; open addressing with linear probing."""

    def __init__(self, slots: int = 1024) -> None:
        self.slots = array("q", [-1]) * slots
        self.hashes, self.contents = array("q"), []
        self.bytes = 0

    def __len__(self) -> int:
        return len(self.contents)

    def find(self, hashed: int, content: bytes) -> tuple[int, int]:
        """The content's number or -1, and the slot where the search ended."""
        slots, hashes, mask = self.slots, self.hashes, len(self.slots) - 1
        slot = hashed & mask
        while (entry := slots[slot]) >= 0:
            if hashes[entry] == hashed and self.contents[entry] == content:
                return entry, slot
            slot = (slot + 1) & mask
        return -1, slot

    def add(self, hashed: int, content: bytes, slot: int) -> int:
        """Put a new content into the free slot that ``find`` has named."""
        entry = len(self.contents)
        self.slots[slot] = entry
        self.hashes.append(hashed)
        self.contents.append(content)
        self.bytes += len(content)
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return entry

    def _grow(self) -> None:
        mask = 4 * len(self.slots) - 1
        self.slots = array("q", [-1]) * (mask + 1)
        for entry, hashed in enumerate(self.hashes):
            slot = hashed & mask
            while self.slots[slot] >= 0:
                slot = (slot + 1) & mask
            self.slots[slot] = entry


def _better(left: tuple, right: tuple) -> bool:
    """Whether ``left`` stays rather than ``right``, both (doc_id, row): the larger doc_id, then the smaller row."""
    if left[0] != right[0]:
        return right[0] is None or (left[0] is not None and left[0] > right[0])
    return left[1] < right[1]


class _Fold:
    """Rows of one slice of input and the table of their distinct texts."""

    def __init__(self, first_record: int) -> None:
        self.first, self.table = first_record, ContentTable()
        self.rows, self.entry, self.opens, self.copies, self.best = [], array("q"), [], array("q"), []
        self.count = 0

    def take(self, part: pa.RecordBatch, row: int) -> None:
        contents = part.column("text").cast(pa.binary()).to_pylist()
        hashes, ids = part.column("hash").to_pylist(), part.column("doc_id").to_pylist()
        for hashed, content, doc_id in zip(hashes, contents, ids, strict=True):
            entry, slot = self.table.find(hashed, content)
            if entry < 0:
                entry = self.table.add(hashed, content, slot)
                self.opens.append(self.count)
                self.copies.append(0)
                self.best.append((doc_id, row))
            elif _better((doc_id, row), self.best[entry]):
                self.best[entry] = (doc_id, row)
            self.copies[entry] += 1
            self.entry.append(entry)
            self.count += 1
            row += 1
        self.rows.append(part.drop_columns(["text", "hash"]))

    @property
    def full(self) -> bool:
        return self.table.bytes >= FOLD_BYTES or self.count >= FOLD_ROWS

    def batch(self, first_row: int, schema: pa.Schema) -> pa.RecordBatch:
        """One row per input row; the first of every text carries the text and its totals."""
        place = np.full(self.count, -1, np.int64)
        place[self.opens] = np.arange(len(self.opens))
        take = pa.array(place, mask=place < 0)
        rows = pa.Table.from_batches(self.rows)
        best_id = pa.array([b[0] for b in self.best], schema.field("best_id").type)
        columns = {
            "row": pa.array(np.arange(first_row, first_row + self.count)),
            "record": pa.array(self.first + np.array(self.entry)),
            "text": pa.array(self.table.contents, pa.binary()).take(take),
            "hash": pa.array(np.array(self.table.hashes)).take(take),
            "copies": pa.array(np.array(self.copies)).take(take),
            "best_id": best_id.take(take),
            "best_row": pa.array(np.array([b[1] for b in self.best])).take(take),
        }
        arrays = [
            (columns[f.name] if f.name in columns else rows.column(f.name).combine_chunks()).cast(f.type)
            for f in schema
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _folded(docs: DataFrame, carried: bool) -> DataFrame:
    """All rows with ids of row and record, and one text per record: ``doc_id, [carried], row, record, text, ...``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    extra = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("carried")] if carried else []
    given = docs.select("doc_id", *extra, text.alias("text"), F.xxhash64(text).alias("hash"))
    kind = given.schema["doc_id"].dataType.simpleString()
    whole = f"struct<{given.schema['carried'].dataType.simpleString()[7:-1]}>" if carried else ""
    wanted = f"doc_id {kind}, " + (f"carried {whole}, " if carried else "")
    wanted += f"row long, record long, text string, hash long, copies long, best_id {kind}, best_row long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = record = TaskContext.get().partitionId() << 40
        fold = schema = None
        for batch in batches:
            if schema is None:
                own = {name: pa.int64() for name in ("row", "record", "hash", "copies", "best_row")}
                kinds = {f.name: f.type for f in batch.schema}
                order = ["doc_id", *(["carried"] if carried else []), "row", "record", "text", "hash", "copies", "best_id", "best_row"]
                kinds |= own | {"best_id": kinds["doc_id"]}
                schema = pa.schema([(name, kinds[name]) for name in order])
            at = 0
            for texts in string_parts(batch.column(batch.num_columns - 2)):
                fold = fold or _Fold(record)
                fold.take(batch.slice(at, len(texts)), row + fold.count)
                at += len(texts)
                if fold.full:
                    yield fold.batch(row, schema)
                    row, record, fold = row + fold.count, record + len(fold.table), None
        if fold is not None:
            yield fold.batch(row, schema)

    return given.mapInArrow(run, wanted)


_PENDING = ["record", "hash", "text", "copies", "best_id", "best_row"]


def _bucket_tables(pending: DataFrame, level: int, buckets: int, limit: int) -> DataFrame:
    """Every record's group where the bucket's table had room, else the record itself again, to be spilled."""
    kind = dict(pending.dtypes)["best_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, records, entries = ContentTable(), array("q"), array("q")
        copies, best, digests = array("q"), [], []
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("best_id").type
            at = 0
            for texts in string_parts(batch.column(2)):
                part = batch.slice(at, len(texts))
                at += len(texts)
                spilled = []
                contents = part.column("text").cast(pa.binary()).to_pylist()
                numbers = [part.column(name).to_pylist() for name in ("record", "hash", "copies", "best_id", "best_row")]
                for i, (content, record, hashed, count, doc_id, row) in enumerate(zip(contents, *numbers, strict=True)):
                    entry, slot = table.find(hashed, content)
                    if entry < 0:
                        if table.bytes + len(content) > limit and len(table):
                            spilled.append(i)
                            continue
                        entry = table.add(hashed, content, slot)
                        copies.append(0)
                        best.append((doc_id, row))
                        digests.append(hashlib.sha256(content).hexdigest())
                    elif _better((doc_id, row), best[entry]):
                        best[entry] = (doc_id, row)
                    copies[entry] += count
                    records.append(record)
                    entries.append(entry)
                if spilled:
                    again = part.take(pa.array(spilled))
                    none = [pa.nulls(len(spilled), t) for t in (pa.string(), pa.int64(), id_type, pa.int64())]
                    yield pa.RecordBatch.from_arrays([*again.columns, *none], names=[*_PENDING, "digest", "size", "keep_id", "keep_row"])
        if not len(records):
            return
        keep_id = pa.array([b[0] for b in best], id_type)
        found = [pa.array(digests), pa.array(np.array(copies)), keep_id, pa.array(np.array([b[1] for b in best]))]
        records, entries = np.array(records), np.array(entries)
        for first in range(0, len(records), 1 << 16):
            chosen = pa.array(entries[first : first + (1 << 16)])
            none = [pa.nulls(len(chosen), t) for t in (pa.int64(), pa.string(), pa.int64(), id_type, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(records[first : first + (1 << 16)]), *none, *[f.take(chosen) for f in found]],
                names=[*_PENDING, "digest", "size", "keep_id", "keep_row"],
            )

    schema = f"record long, hash long, text string, copies long, best_id {kind}, best_row long, "
    schema += f"digest string, size long, keep_id {kind}, keep_row long"
    dealt = pending.repartition(buckets, F.xxhash64("hash", F.lit(level)))
    return dealt.mapInArrow(run, schema)


def _classes(rows: DataFrame, staging: Staging, bucket_bytes: int, table_bytes: int) -> DataFrame:
    """``record, digest, size, keep_id, keep_row`` of every record, level by level."""
    pending, level, levels = rows.where("text is not null").select(*_PENDING), 0, []
    while True:
        size = pending.agg(F.sum(F.octet_length("text"))).first()[0]
        buckets = max(1, math.ceil((size or 0) / bucket_bytes))
        done = staging.keep(_bucket_tables(pending, level, buckets, table_bytes), f"level{level}")
        levels.append(done.where("digest is not null").select("record", "digest", "size", "keep_id", "keep_row"))
        pending, level = done.where("digest is null").select(*_PENDING), level + 1
        if pending.isEmpty():
            break
    found = levels[0]
    for more in levels[1:]:
        found = found.union(more)
    return found


def exact_groups(
    docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, table_bytes: int = TABLE_BYTES, carried: bool = False
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``docs(doc_id, text)``.

    Texts are equal when identical byte for byte; null counts as empty. Of equal texts the row with the largest
    doc_id stays (null is the smallest); of rows that share it, the first in the scan. Other columns are not
    read; ``carried`` keeps the whole row as a struct of that name. An empty table gives no rows.
    """
    staging = Staging(docs.sparkSession, "exact")
    rows = staging.keep(_folded(docs, carried), "rows")
    found = rows.drop("text", "hash", "copies", "best_id", "best_row").join(
        _classes(rows, staging, bucket_bytes, table_bytes), "record"
    )
    return found.select(
        "doc_id",
        "keep_id",
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
        *(["carried"] if carried else []),
    )


def without_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every text, all columns unchanged; see ``exact_groups`` for which stays."""
    return exact_groups(docs, carried=True).where("kept").select("carried.*")
