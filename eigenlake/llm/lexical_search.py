"""Ranked lexical search over bit-sliced Bloom signatures.

Documents of like size share a shard, a matrix of bits: a column per document, and rows (slices) that terms hash to
(after Goodwin et al., "BitFunnel", 2017). The slices of a term, met bit by bit, give every document that holds it and a few
more; further slices say whether it may occur at least 2, 3, 5, 9, ... times. Sums of the term weights over these
bitmaps are upper bounds of the scores. The documents of the highest bounds are scored exactly, which gives a
score that the best ten reach; then every document whose bound reaches it is scored exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from eigenlake.llm.staging import Staging
from eigenlake.llm.text import SpanHasher, bytes_of, mix, string_parts, word_spans
from eigenlake.session import small_side

TOP = 10
# Documents per item that are scored for the first threshold.
FIRST = 32
# Items searched in one pass over the shards, and their text.
ITEM_ROWS = 1024
ITEM_BYTES = 16 << 20
# Slices of a term, and the share of set bits that the number of slices aims at.
SLICES_OF_TERM = 3
DENSITY = 0.3
# Documents and postings sorted by size at once, documents of a shard and cells of its matrix.
SORT_ROWS, SORT_POSTINGS = 8192, 1 << 21
SHARD_ROWS, SHARD_CELLS = 2048, 1 << 24
# A layer of slices per number of occurrences that it reports.
LAYERS = np.array([1, 2, 3, 5, 9, 17, 33, 65, 129, 257])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Letters, digits and every byte of a code point beyond ASCII.
_TERM = np.array([chr(c).isalnum() if c < 128 else True for c in range(256)])


def terms_of(part: pa.Array, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the terms of every text, and the first term of each."""
    data, rows = bytes_of(part)
    data = _LOWER[data]
    start, end = word_spans(data, rows, inside=_TERM[data])
    hasher.load(data)
    return hasher.spans(start, end), np.searchsorted(start, rows)


def counted(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of every text as ``text, hash, occurrences``, ordered by text and hash."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return text[at], hashes[at], np.diff(np.append(at, len(text)))


def slice_numbers(hashes: np.ndarray, layer: int, slices: int) -> np.ndarray:
    """The slices of terms in a layer, one column per hash function."""
    mixed = [mix(hashes ^ mix(np.array([1 + k + 64 * layer], np.uint64))) for k in range(SLICES_OF_TERM)]
    return np.stack([(m % np.uint64(slices)).astype(np.int64) for m in mixed], axis=-1)


@dataclass(frozen=True)
class Weights:
    """The terms of a block of items, sorted, with their weights and the corpus totals."""

    # Sent to tasks as a plain tuple, see ``parts``.

    terms: np.ndarray
    weight: np.ndarray
    documents: int
    length: int
    # Item, term and repeats of every term of every item.
    item: np.ndarray
    term: np.ndarray
    repeats: np.ndarray

    @property
    def parts(self) -> tuple:
        return self.terms, self.weight, self.documents, self.length, self.item, self.term, self.repeats

    def norm(self, lengths: np.ndarray) -> np.ndarray:
        """A document's m from its number of terms."""
        return 100 - 75 + (75 * lengths * self.documents) // max(1, self.length)


def saturation(occurrences: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * occurrences) // (1000 * occurrences + 8 * norm)


class _Shards:
    """Gathers documents of one task and packs those of like size into shards."""

    def __init__(self) -> None:
        self.ids, self.prints, self.lengths, self.counts, self.most = [], [], [], [], []
        self.hashes, self.occurrences = [], []
        self.rows = self.postings = 0

    def take(self, part: pa.RecordBatch, first: np.ndarray, found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        text, hashes, occurrences = found
        sizes = np.bincount(text, minlength=len(part))
        holds = np.flatnonzero(sizes)
        self.ids.append(part.column(0).take(pa.array(holds)))
        self.prints.append(part.column(1).to_numpy()[holds])
        self.lengths.append(np.diff(first)[holds])
        self.counts.append(sizes[holds])
        if len(holds):
            self.most.append(np.maximum.reduceat(occurrences, np.searchsorted(text, holds)))
        self.hashes.append(hashes)
        self.occurrences.append(occurrences)
        self.rows, self.postings = self.rows + len(holds), self.postings + len(hashes)

    @property
    def full(self) -> bool:
        return self.rows >= SORT_ROWS or self.postings >= SORT_POSTINGS

    def batches(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        ids = pa.chunked_array(self.ids).combine_chunks()
        prints, lengths, counts, most = map(np.concatenate, (self.prints, self.lengths, self.counts, self.most))
        hashes, occurrences = np.concatenate(self.hashes), np.concatenate(self.occurrences)
        begin = np.cumsum(counts) - counts
        # What a document sets: a bit per hash function for each layer that a term reaches.
        layers = np.searchsorted(LAYERS, occurrences, "right")
        load = np.add.reduceat(layers, begin)
        order = np.argsort(load, kind="stable")
        first = 0
        while first < len(order):
            step = min(SHARD_ROWS, len(order) - first)
            while step > 8 and step * int(load[order[first + step - 1]]) > SHARD_CELLS * DENSITY / SLICES_OF_TERM:
                step //= 2
            chosen = order[first : first + step]
            first += step
            slices = max(64, math.ceil(load[chosen].mean() * SLICES_OF_TERM / DENSITY))
            bits = np.zeros((slices, step), bool)
            sizes = counts[chosen]
            at = np.arange(sizes.sum()) + np.repeat(begin[chosen] - (np.cumsum(sizes) - sizes), sizes)
            column = np.repeat(np.arange(step), sizes)
            for layer in range(int(layers[at].max())):
                reaches = layers[at] > layer
                where = slice_numbers(hashes[at[reaches]], layer, slices)
                bits[where, column[reaches, None]] = True
            packed = np.packbits(bits, axis=1).tobytes()
            lists = [ids.take(pa.array(chosen)), *[pa.array(v[chosen].astype(np.int64)) for v in (prints, lengths, most)]]
            row = [pa.ListArray.from_arrays(pa.array([0, step], pa.int32()), values) for values in lists]
            row += [pa.array([slices], pa.int32()), pa.array([packed], pa.binary())]
            yield pa.RecordBatch.from_arrays([*row, pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64())], names=names)


_NAMES = ["ids", "prints", "lengths", "most", "slices", "bits", "term", "amount"]
# Marks of the corpus totals among the counts of terms.
_DOCUMENTS, _LENGTH = -1, -2


def signatures(docs: DataFrame, terms: np.ndarray, build: bool = True) -> DataFrame:
    """Shards of the documents (without ``build``: none), and per task the documents that hold each of ``terms``.

    A row is a shard ``ids, prints, lengths, most, slices, bits`` or a count ``term, amount``, where ``term`` is the
    place in ``terms``, -1 for the number of documents with a term and -2 for the terms of all documents.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = docs.select("doc_id", F.xxhash64(text).alias("print"), text.alias("text"))
    kind = dict(given.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, hasher, shards = shared.value, SpanHasher(), _Shards()
        holders, documents, length, id_type = np.zeros(len(wanted) + 1, np.int64), 0, 0, None
        for batch in batches:
            id_type, at = batch.schema.field(0).type, 0
            for texts in string_parts(batch.column(2)):
                hashes, first = terms_of(texts, hasher)
                found = counted(hashes, first)
                place = np.searchsorted(wanted, found[1])
                place[wanted[np.minimum(place, len(wanted) - 1)] != found[1]] = len(wanted)
                holders += np.bincount(place, minlength=len(wanted) + 1)
                documents += int(np.count_nonzero(np.diff(first)))
                length += len(hashes)
                if build:
                    shards.take(batch.slice(at, len(texts)), first, found)
                    if shards.full:
                        yield from shards.batches(_NAMES)
                        shards = _Shards()
                at += len(texts)
        if id_type is None:
            return
        yield from shards.batches(_NAMES)
        known = np.flatnonzero(holders[:-1])
        term = pa.array(np.concatenate([known, [_DOCUMENTS, _LENGTH]]))
        amount = pa.array(np.concatenate([holders[known], [documents, length]]))
        types = [pa.list_(id_type), *[pa.list_(pa.int64())] * 3, pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([*[pa.nulls(len(term), t) for t in types], term, amount], names=_NAMES)

    schema = f"ids array<{kind}>, prints array<long>, lengths array<long>, most array<long>, slices int, bits binary, term long, amount long"
    return given.mapInArrow(run, schema)


def _weights(counts: DataFrame, terms: np.ndarray, items: tuple[np.ndarray, np.ndarray, np.ndarray], totals: tuple[int, int] | None) -> Weights:
    found = counts.groupBy("term").agg(F.sum("amount").alias("amount")).toArrow()
    term, amount = found.column("term").to_numpy(), found.column("amount").to_numpy()
    documents, length = totals or [int(amount[term == mark].sum()) for mark in (_DOCUMENTS, _LENGTH)]
    holders = np.zeros(len(terms), np.int64)
    holders[term[term >= 0]] = amount[term >= 0]
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in holders.tolist()], np.int64)
    return Weights(terms, weight, documents, length, *items)


def upper_bounds(shard: dict, weights: Weights, items: int) -> np.ndarray:
    """Bounds of the scores of all items (rows) for the documents of a shard (columns)."""
    rows, slices = len(shard["prints"]), shard["slices"]
    bits = np.frombuffer(shard["bits"], np.uint8).reshape(slices, -1)
    where = slice_numbers(weights.terms, 0, slices)
    held = bits[where[:, 0]]
    for k in range(1, SLICES_OF_TERM):
        held &= bits[where[:, k]]
    term, column = np.nonzero(np.unpackbits(held, axis=1, count=rows))
    layer, open_pairs = np.zeros(len(term), np.int64), np.arange(len(term))
    for number in range(1, len(LAYERS)):
        if not len(open_pairs):
            break
        where = slice_numbers(weights.terms, number, slices)[term[open_pairs]]
        place = column[open_pairs]
        cells = bits[where, (place >> 3)[:, None]] >> (7 - (place & 7)).astype(np.uint8)[:, None]
        open_pairs = open_pairs[(cells & 1).all(axis=1)]
        layer[open_pairs] = number
    norm = weights.norm(np.asarray(shard["lengths"]))
    most = np.asarray(shard["most"])
    # The occurrences that a layer allows: one less than the next layer reports, at most those of the commonest term.
    highest = np.minimum(np.append(LAYERS[1:] - 1, np.iinfo(np.int32).max)[:, None], most[None, :])
    part = weights.weight[term] * saturation(highest, norm[None, :])[layer, column]
    # Terms lie together, so an item's rows of the sum are the pairs of its terms.
    begin = np.searchsorted(term, np.arange(len(weights.terms) + 1))
    sizes = np.diff(begin)[weights.term]
    pair = np.arange(sizes.sum()) + np.repeat(begin[weights.term] - (np.cumsum(sizes) - sizes), sizes)
    cell = np.repeat(weights.item, sizes) * rows + column[pair]
    # Integers far below 2^53: sums of doubles are exact.
    total = np.bincount(cell, part[pair] * np.repeat(weights.repeats, sizes), items * rows)
    return total.astype(np.int64).reshape(items, rows)


def _candidates(shards: DataFrame, kind: str, weights: Weights, items: int, least: np.ndarray | None) -> DataFrame:
    """``item, doc_id, print, bound``: per task the ``FIRST`` highest bounds of every item, or all that reach ``least``."""
    shared = shards.sparkSession.sparkContext.broadcast((weights.parts, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, least = shared.value
        weights = Weights(*parts)
        held: list[pa.Table] = []
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column(0)[i].values
                shard = {name: batch.column(name)[i].values.to_numpy() for name in ("prints", "lengths", "most")}
                shard |= {"slices": batch.column("slices")[i].as_py(), "bits": batch.column("bits")[i].as_buffer()}
                bounds = upper_bounds(shard, weights, items)
                if least is None:
                    top = min(FIRST, bounds.shape[1])
                    column = np.argpartition(-bounds, top - 1, axis=1)[:, :top].ravel()
                    item = np.repeat(np.arange(items), top)
                    positive = bounds[item, column] > 0
                    item, column = item[positive], column[positive]
                else:
                    item, column = np.nonzero(bounds >= least[:, None])
                found = pa.table(
                    [pa.array(item), ids.take(pa.array(column)), pa.array(shard["prints"][column]), pa.array(bounds[item, column])],
                    names=["item", "doc_id", "print", "bound"],
                )
                if least is not None:
                    yield from found.to_batches()
                    continue
                held = [_highest(pa.concat_tables([*held, found]))]
        for table in held:
            yield from table.combine_chunks().to_batches()

    names = ["ids", "prints", "lengths", "most", "slices", "bits"]
    return shards.where("bits is not null").select(*names).mapInArrow(run, f"item long, doc_id {kind}, print long, bound long")


def _highest(table: pa.Table) -> pa.Table:
    item, bound = table.column("item").to_numpy(), table.column("bound").to_numpy()
    order = np.lexsort((-bound, item))
    rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
    return table.take(pa.array(order[rank < FIRST]))


def _scored(docs: DataFrame, pairs: DataFrame, weights: Weights, staging: Staging) -> DataFrame:
    """``item, doc_id, score`` of the documents and items in ``pairs``, counted in the whole texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = docs.select("doc_id", F.xxhash64(text).alias("print"), text.alias("text"))
    kind = dict(given.dtypes)["doc_id"]
    wanted = pairs.groupBy("doc_id", "print").agg(F.collect_set("item").alias("items"))
    wanted = staging.keep(wanted.withColumnsRenamed({"doc_id": "wanted_id", "print": "wanted_print"}), "wanted")
    same = F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.col("print") == F.col("wanted_print"))
    chosen = given.join(small_side(wanted), same).select("doc_id", "items", "text")
    shared = docs.sparkSession.sparkContext.broadcast(weights.parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, hasher = Weights(*shared.value), SpanHasher()
        begin = np.searchsorted(weights.item, np.arange(weights.item.max(initial=-1) + 2))
        for batch in batches:
            at = 0
            for texts in string_parts(batch.column(2)):
                hashes, first = terms_of(texts, hasher)
                text, found, occurrences = counted(hashes, first)
                edges = np.searchsorted(text, np.arange(len(texts) + 1))
                rows, items, scores = [], [], []
                norm = weights.norm(np.diff(first))
                for i in range(len(texts)):
                    mine = slice(edges[i], edges[i + 1])
                    if mine.start == mine.stop:
                        continue
                    part = np.zeros(len(weights.terms), np.int64)
                    place = np.searchsorted(weights.terms, found[mine])
                    known = np.flatnonzero(weights.terms[np.minimum(place, len(part) - 1)] == found[mine])
                    place = place[known]
                    part[place] = weights.weight[place] * saturation(occurrences[mine][known], norm[i])
                    for item in batch.column(1)[at + i].as_py():
                        own = slice(begin[item], begin[item + 1])
                        rows.append(at + i)
                        items.append(item)
                        scores.append(int((part[weights.term[own]] * weights.repeats[own]).sum()))
                ids = batch.column(0).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), ids, pa.array(scores, pa.int64())], names=["item", "doc_id", "score"])
                at += len(texts)

    return chosen.mapInArrow(run, f"item long, doc_id {kind}, score long").where("score > 0")


def _blocks(items: DataFrame) -> Iterator[list]:
    """The items, whole, a bounded number at a time; their places in the block are their numbers."""
    rows, size = [], 0
    for row in items.select("item_id", F.col("text").cast("string").alias("text")).toLocalIterator():
        rows.append(row)
        size += len(row.text or "")
        if len(rows) >= ITEM_ROWS or size >= ITEM_BYTES:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of the highest scores above 0 of every item.

    Terms are runs of ASCII letters, digits and all code points beyond ASCII with A-Z lower-cased; a null text has none.
    Equal scores go by ascending doc_id (null last); rows that share doc_id and text are documents of their own.
    Items are ranked row by row, so a repeated item_id has several rankings; items without terms, and empty
    tables, give no rows. Terms are told apart by 64-bit hashes. Other columns are not read.
    """
    spark, staging = docs.sparkSession, Staging(docs.sparkSession, "search")
    kinds = dict(items.dtypes)["item_id"], dict(docs.dtypes)["doc_id"]
    results, shards, totals = [], None, None
    for rows in _blocks(items):
        hashes, first = terms_of(pa.array([r.text or "" for r in rows], pa.string()), SpanHasher())
        item, found, repeats = counted(hashes, first)
        terms, term = np.unique(found, return_inverse=True)
        if not len(terms):
            continue
        counts = staging.keep(signatures(docs, terms, build=shards is None), "signatures")
        shards = counts if shards is None else shards
        weights = _weights(counts.where("term is not null"), terms, (item, term, repeats), totals)
        totals = (weights.documents, weights.length)
        highest = Window.partitionBy("item").orderBy(F.col("bound").desc())
        picked = _candidates(shards, kinds[1], weights, len(rows), None)
        picked = picked.withColumn("place", F.row_number().over(highest)).where(F.col("place") <= FIRST)
        scored = staging.keep(_scored(docs, picked, weights, staging), "first")
        # The score of the last place so far; an item with fewer documents has none to beat.
        reached = _ranked(scored, top).where(F.col("rank") == top).select("item", "score").toArrow()
        least = np.ones(len(rows), np.int64)
        least[reached.column("item").to_numpy()] = reached.column("score").to_numpy()
        every = _candidates(shards, kinds[1], weights, len(rows), least)
        best = _ranked(_scored(docs, every, weights, staging), top)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"item long, item_id {kinds[0]}")
        results.append(best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    out = results[0]
    for more in results[1:]:
        out = out.union(more)
    return out
