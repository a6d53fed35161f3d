"""Benchmark items inside documents: SimHash of item-sized windows, found by multi-index Hamming blocks.

Every item has a 64-bit SimHash of its weighted five-word shingles, and so has every window of
a document that is as long as some item. An item of fewer words is one shingle, met by equal runs of as many
words anywhere. Two prints within ``RADIUS`` bits differ by at most
``RADIUS // BLOCKS`` bits in at least one of ``BLOCKS`` bytes, so looking up bytes within that
distance finds them all. Candidates are confirmed by the exact weighted similarity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eigenlake.llm.rows import filter_by_text
from eigenlake.llm.text import SHINGLE_WORDS, SpanHasher, Words, shingles, string_parts, words

BLOCKS = 8
# Similarity 0.8 changes 9.7 bits of 64 on average, with a deviation of 2.9.
RADIUS = 20
# Items taken into one pass over the documents, by number and by bytes of text.
PASS_ITEMS = 8192
PASS_BYTES = 16 << 20
# Windows fingerprinted at once.
WINDOW_STEP = 4096
GATE_BITS = 20

_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_NEAR_BYTE = _ONES[np.arange(256)[:, None] ^ np.arange(256)[None, :]] <= RADIUS // BLOCKS


def simhash(hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Prints, as 8 bytes each, of the ranges of shingles ``low <= i < high``; repeats count."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    return np.packbits(2 * (sums[high] - sums[low]) > (high - low)[:, None], axis=1)


def weighted_similarity(left: np.ndarray, right: np.ndarray) -> float:
    """Weighted Jaccard similarity of two bags of shingles: sum of minima over sum of maxima."""
    values, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    a = np.bincount(place[: len(left)], minlength=len(values))
    b = np.bincount(place[len(left) :], minlength=len(values))
    return float(np.minimum(a, b).sum() / np.maximum(a, b).sum())


@dataclass(frozen=True)
class Sized:
    """The items of one number of words."""

    width: int
    number: np.ndarray
    prints: np.ndarray
    bags: list[np.ndarray]
    near: np.ndarray


@dataclass(frozen=True)
class ItemIndex:
    """A pass's items by size, and which sizes a shingle of a document can lead to."""

    gate: np.ndarray
    bitmap: np.ndarray
    first: np.ndarray
    sizes: np.ndarray
    sized: list[Sized]
    # Items of fewer words than a shingle: by number of words, their sorted shingles and item numbers.
    short: dict[int, tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def build(texts: pa.Array) -> ItemIndex:
        hasher, bags, widths = SpanHasher(), [], []
        for part in string_parts(texts):
            found = words(part, hasher, plain=True)
            hashes, first = shingles(found)
            for i, width in enumerate(found.counts.tolist()):
                own = hashes[first[i] : first[i + 1]]
                if 0 < width < SHINGLE_WORDS:
                    runs, at = shingles(found, width)
                    own = runs[at[i] : at[i + 1]]
                bags.append(own)
                widths.append(width)
        widths = np.array(widths, np.int64)
        sized, short = [], {}
        for width in range(1, SHINGLE_WORDS):
            number = np.flatnonzero(widths == width)
            if len(number):
                own = np.concatenate([bags[i] for i in number])
                order = np.argsort(own, kind="stable")
                short[width] = own[order], number[order]
        for width in np.unique(widths[widths >= SHINGLE_WORDS]):
            number = np.flatnonzero(widths == width)
            own = [bags[i] for i in number]
            each = np.full(len(own), len(own[0]))
            ends = np.cumsum(each)
            prints = simhash(np.concatenate(own), ends - each, ends)
            near = np.stack([_NEAR_BYTE[:, prints[:, block]] for block in range(BLOCKS)])
            sized.append(Sized(int(width), number, prints, own, near))
        links = [np.stack([bag, np.full(len(bag), k, np.uint64)]) for k, s in enumerate(sized) for bag in s.bags]
        pairs = np.unique(np.concatenate(links, axis=1), axis=1) if links else np.zeros((2, 0), np.uint64)
        gate, first = np.unique(pairs[0], return_index=True)
        bitmap = np.zeros(1 << GATE_BITS, bool)
        bitmap[(gate >> np.uint64(64 - GATE_BITS)).astype(np.int64)] = True
        return ItemIndex(gate, bitmap, np.concatenate([first, [pairs.shape[1]]]), pairs[1].astype(np.int64), sized, short)

    def matches(self, part: pa.Array, hasher: SpanHasher, percent: int) -> list[tuple[int, int, float, int, int, int]]:
        """``row, item, similarity, first word, words, differing bits`` of the best window per row and item."""
        found = words(part, hasher, plain=True)
        hashes, first = shingles(found)
        # A window without a shingle of an item of its size can't reach any similarity.
        out = [m for width in self.short for m in self._runs(found, width)]
        hit = np.flatnonzero(self.bitmap[(hashes >> np.uint64(64 - GATE_BITS)).astype(np.int64)])
        if not len(hit):
            return out
        at = np.minimum(np.searchsorted(self.gate, hashes[hit]), len(self.gate) - 1)
        same = self.gate[at] == hashes[hit]
        hit, at = hit[same], at[same]
        row = np.searchsorted(first, hit, "right") - 1
        for i in np.unique(row).tolist():
            chosen = row == i
            own = hashes[first[i] : first[i + 1]]
            out += [(i, *m) for m in self._row(own, int(found.counts[i]), hit[chosen] - first[i], at[chosen], percent)]
        return out

    def _runs(self, found: Words, width: int) -> Iterator[tuple[int, int, float, int, int, int]]:
        """The first equal run of every row and item of ``width`` words, fewer than a shingle has."""
        wanted, number = self.short[width]
        runs, first = shingles(found, width)
        # A text of fewer words is a run of its own length and equals none of this one.
        runs = np.where(np.repeat(found.counts >= width, np.diff(first)), runs, np.uint64(0))
        low, high = np.searchsorted(wanted, runs), np.searchsorted(wanted, runs, "right")
        hit = np.flatnonzero(high > low)
        row = np.searchsorted(first, hit, "right") - 1
        seen = set()
        for i, at in zip(row.tolist(), hit.tolist(), strict=True):
            for item in number[low[at] : high[at]].tolist():
                if (i, item) not in seen and found.counts[i] >= width:
                    seen.add((i, item))
                    yield i, item, 1.0, at - int(first[i]), width, 0

    def _row(self, own: np.ndarray, count: int, hit: np.ndarray, at: np.ndarray, percent: int):
        best: dict[int, tuple] = {}
        repeats = self.first[at + 1] - self.first[at]
        size = self.sizes[np.repeat(self.first[at] - np.cumsum(repeats) + repeats, repeats) + np.arange(repeats.sum())]
        place = np.repeat(hit, repeats)
        for k in np.unique(size).tolist():
            sized = self.sized[k]
            span = max(1, sized.width - SHINGLE_WORDS + 1)
            # Starts of windows that hold a gated shingle; a shorter text is one window.
            last = max(0, len(own) - span)
            marks = np.zeros(last + 2, np.int64)
            np.add.at(marks, np.clip(place[size == k] - span + 1, 0, last), 1)
            np.add.at(marks, np.minimum(place[size == k], last) + 1, -1)
            starts = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
            for a in range(0, len(starts), WINDOW_STEP):
                self._windows(own, starts[a : a + WINDOW_STEP], span, min(count, sized.width), sized, percent, best)
        return best.values()

    @staticmethod
    def _windows(own, starts, span, width, sized: Sized, percent, best) -> None:
        low, ends = starts - starts[0], np.minimum(starts + span, len(own))
        prints = simhash(own[starts[0] : ends[-1]], low, ends - starts[0])
        near = np.zeros((len(starts), len(sized.number)), bool)
        for block in range(BLOCKS):
            near |= sized.near[block][prints[:, block]]
        window, item = np.nonzero(near)
        bits = _ONES[prints[window] ^ sized.prints[item]].sum(axis=1)
        within = bits <= RADIUS
        # Nearest prints first, so that most later windows of an item can't be better.
        window, item, bits = window[within], item[within], bits[within]
        for j in np.argsort(bits, kind="stable").tolist():
            number, start = int(sized.number[item[j]]), int(starts[window[j]])
            known = best.get(number)
            if known is not None and known[1] == 1.0:
                continue
            value = weighted_similarity(own[start : ends[window[j]]], sized.bags[item[j]])
            if 100 * value >= percent - 1e-9 and (known is None or (value, -start) > (known[1], -known[2])):
                best[number] = (number, value, start, width, int(bits[j]))


def item_passes(items: DataFrame) -> Iterator[pa.Table]:
    """The items in bounded blocks, each small enough to send to every task."""
    items = items.select("item_id", F.lower(F.col("text").cast("string")).alias("text")).where("text is not null")
    count, size = items.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    passes = max(1, math.ceil(count / PASS_ITEMS), math.ceil((size or 0) / PASS_BYTES))
    for number in range(passes):
        yield items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == number).toArrow()


def contaminated(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, item_id, similarity, first_word, n_words, distance``: the best window per document row and item.

    ``docs(doc_id, text, ...)``, ``items(item_id, text, ...)``. Words are split at white space and
    ASCII punctuation and lower-cased. A window has as many words as the item (or is the whole of a
    shorter document) and matches if the weighted Jaccard similarity of its five-word shingles is
    at least ``percent``. An item of fewer than five words matches an equal run of words anywhere, a single word
    too, so such items belong into ``items`` only if that is wanted. Null or empty texts match nothing, equal
    items are all reported, repeated rows each. Other columns are not read.
    """
    parts = None
    kind = dict(docs.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    schema = f"doc_id {kind[0]}, item_id {kind[1]}, similarity double, first_word long, n_words long, distance long"
    rows = docs.select("doc_id", F.lower(F.col("text").cast("string")))
    for block in item_passes(items):
        part = rows.mapInArrow(_finder(block, percent), schema)
        parts = part if parts is None else parts.union(part)
    return parts


def _finder(block: pa.Table, percent: int):
    index, ids = ItemIndex.build(block.column("text")), block.column("item_id").combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            row, found = 0, []
            for part in string_parts(batch.column(1)):
                found += [(row + m[0], *m[1:]) for m in index.matches(part, hasher, percent)]
                row += len(part)
            if found:
                at, item, value, start, width, bits = map(list, zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at)),
                        ids.take(pa.array(item)),
                        pa.array(value),
                        pa.array(start, pa.int64()),
                        pa.array(width, pa.int64()),
                        pa.array(bits, pa.int64()),
                    ],
                    names=["doc_id", "item_id", "similarity", "first_word", "n_words", "distance"],
                )

    return run


def without_items(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; nothing is shuffled."""
    for block in item_passes(items):
        index = ItemIndex.build(block.column("text"))

        def task(index=index):
            hasher = SpanHasher()

            def clean(part: pa.Array) -> np.ndarray:
                mask = np.ones(len(part), bool)
                mask[[m[0] for m in index.matches(part, hasher, percent)]] = False
                return mask

            return clean

        docs = filter_by_text(docs, task)
    return docs
