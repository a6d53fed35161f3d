"""Words and word shingles of whole texts as 64-bit hashes, whole Arrow slices at a time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5
# Text taken at once: bounds the memory of a task whatever the number of rows in a batch.
SLICE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
# ASCII punctuation read as white space as well.
_PLAIN_SPACE = _SPACE | np.array([33 <= c < 127 and not chr(c).isalnum() for c in range(256)])
# Random 64-bit value per byte, and an odd base with its inverse, of the polynomial hash.
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(values: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (the published SplitMix64 constants)."""
    x = values ^ (values >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, count: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(max(1, count), np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class SpanHasher:
    """Hashes of many byte spans of one buffer through a single running sum."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def load(self, data: np.ndarray) -> None:
        """Take bytes, or code points as wider integers."""
        if len(self.up) < len(data):
            self.up, self.down = powers(_BASE, len(data)), powers(_INVERSE, len(data) + 1)
        symbols = _BYTE[data] if data.dtype == np.uint8 else mix(data.astype(np.uint64))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(symbols * self.up[: len(data)], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(value + (end - start).astype(np.uint64))


def string_parts(column: pa.Array | pa.ChunkedArray) -> Iterator[pa.Array]:
    """Zero-copy slices of a string column that hold about ``SLICE_BYTES`` each, or one row."""
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        first = 0
        ends = offsets_of(chunk)
        while first < len(chunk):
            last = int(np.searchsorted(ends, ends[first] + SLICE_BYTES, "right")) - 1
            last = min(max(last, first + 1), len(chunk))
            yield chunk.slice(first, last - first)
            first = last


def offsets_of(array: pa.Array) -> np.ndarray:
    """Byte offsets of a string array in its data buffer; nulls are empty."""
    kind = np.int64 if pa.types.is_large_string(array.type) else np.int32
    raw = np.frombuffer(array.buffers()[1], kind, len(array) + 1, array.offset * np.dtype(kind).itemsize)
    return raw.astype(np.int64)


def bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and the offsets of its rows in them."""
    ends = offsets_of(array)
    buffer = array.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def code_points(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of a string array and the offsets of its rows in them."""
    data, rows = bytes_of(array)
    count = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32), count[rows]


@dataclass(frozen=True)
class Words:
    """Words of several texts: hashes, byte spans and the first word of every text."""

    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def word_spans(
    data: np.ndarray, rows: np.ndarray, plain: bool = False, inside: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the words, or of the runs of ``inside``; a word ends with its text."""
    if inside is None:
        inside = ~(_PLAIN_SPACE if plain else _SPACE)[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = rows[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] |= inside[edges]
    closes[edges - 1] |= inside[edges - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def words(array: pa.Array, hasher: SpanHasher, plain: bool = False) -> Words:
    """Runs of ``[^\\x20\\x09-\\x0D]`` with A-Z lower-cased; ``plain`` also splits at ASCII punctuation."""
    data, rows = bytes_of(array)
    data = _LOWER[data]
    start, end = word_spans(data, rows, plain)
    hasher.load(data)
    return Words(hasher.spans(start, end), start, end, np.searchsorted(start, rows))


def shingles(found: Words, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """One hash per window of ``size`` words and the first window of every text.

    A text of fewer words is one shingle, one without words has none.
    """
    hashes, counts = found.hashes, found.counts
    total = len(hashes)
    # Reading past the end of a text is harmless: those windows are not taken.
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    windows = padded[:total].copy()
    for i in range(1, size):
        windows *= np.uint64(_BASE)
        windows += padded[i : total + i]
    mixed = mix(windows + np.uint64(size))
    taken = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(taken)])
    index = np.arange(first[-1]) + np.repeat(found.first[:-1] - first[:-1], taken)
    out = mixed[index]
    for width in range(1, size):
        rows = np.flatnonzero(counts == width)
        value = np.full(len(rows), np.uint64(width))
        for i in range(width):
            value = value * np.uint64(_BASE) + hashes[found.first[rows] + i]
        out[first[rows]] = mix(value)
    return out, first


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; a plain sort is faster than a hash table here."""
    ordered = np.sort(values)
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered
