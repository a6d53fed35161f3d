"""Token counts per section from one encoding of the whole document.

A document is encoded once by a byte-level BPE; its tokens are consecutive byte spans of the
text. Sections partition the same text, so joining the two lists of intervals is one merge over
their sorted bounds, and a token that crosses a bound is given out by a stated rule.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from eigenlake.llm.text import bytes_of, string_parts

# Pre-tokenization of the vocabulary (fixed value: the published pattern of byte-level BPE).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
RULES = ("first", "most", "share")


def read_vocabulary(spark: SparkSession, path: str) -> list[tuple[bytes, int]]:
    """Tokens and ranks of a vocabulary file, wherever Spark can read it or the driver has it."""
    location = path if "://" in path else f"file://{path}"
    lines = spark.read.text(location).collect()
    return [(base64.b64decode(token), int(rank)) for token, rank in (line[0].split() for line in lines)]


def section_bounds(text: bytes) -> np.ndarray:
    """Bounds of the sections of a text: its lines, each with the line feed that ends it."""
    feeds = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return np.unique(np.concatenate([[0], feeds, [len(text)]])) if text else np.array([0, 0])


def allot(token_end: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and how many of the tokens of a section's bytes cross its bounds.

    ``first`` gives a crossing token to the section of its first byte, ``most`` to that with most of
    its bytes (the first of equals), ``share`` to each in proportion to its bytes.
    """
    sections = len(bounds) - 1
    start = np.concatenate([[0], token_end[:-1]]).astype(np.int64)
    first = np.minimum(np.searchsorted(bounds, start, "right") - 1, sections - 1)
    last = np.minimum(np.searchsorted(bounds, token_end, "left") - 1, sections - 1)
    counts = np.bincount(first[first == last], minlength=sections).astype(float)
    crossed = np.zeros(sections, np.int64)
    for t in np.flatnonzero(first != last).tolist():
        held = np.arange(first[t], last[t] + 1)
        share = np.minimum(bounds[held + 1], token_end[t]) - np.maximum(bounds[held], start[t])
        crossed[held] += 1
        if rule == "first":
            counts[first[t]] += 1
        elif rule == "most":
            counts[held[np.argmax(share)]] += 1
        else:
            counts[held] += share / share.sum()
    return counts, crossed


def count_tokens(
    docs: DataFrame, vocabulary: str = VOCABULARY, rule: str = "most", fields: list[str] | None = None, pattern: str = PATTERN
) -> DataFrame:
    """``doc_id, section, start, n_chars, n_tokens, n_crossing, doc_tokens``, a row per section of every row of ``docs``.

    Sections are the lines of ``text``; with ``fields``, the document is those columns joined by
    line feeds and the sections are the columns, in order. ``start`` and ``n_chars`` count code points. Null texts and
    fields are empty; an empty document has one empty section without tokens. ``n_tokens`` of a
    document add up to ``doc_tokens`` under every rule. Other columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")
    kind = dict(docs.dtypes)["doc_id"]
    ranks = docs.sparkSession.sparkContext.broadcast(read_vocabulary(docs.sparkSession, vocabulary))
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in fields or ["text"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        table = dict(ranks.value)
        length = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            length[rank] = len(token)
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        for batch in batches:
            row = 0
            for part in string_parts(batch.column(1)):
                data, rows = bytes_of(part)
                out: list[list[np.ndarray]] = [[] for _ in range(7)]
                for i in range(len(part)):
                    text = data[rows[i] : rows[i + 1]].tobytes()
                    ends = np.cumsum(length[encoding.encode_to_numpy(text.decode())]) if text else np.zeros(0, np.int64)
                    if fields:
                        bounds = np.concatenate([[0], np.cumsum(batch.column(2)[row + i].values.to_numpy())])
                    else:
                        bounds = section_bounds(text)
                    counts, crossed = allot(ends, bounds, rule)
                    chars = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])[bounds]
                    size = len(counts)
                    values = [np.full(size, row + i), np.arange(size), chars[:-1], np.diff(chars), counts, crossed]
                    for column, value in zip(out, [*values, np.full(size, len(ends))], strict=True):
                        column.append(value)
                found = [np.concatenate(column) for column in out]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(found[0])),
                        pa.array(found[1], pa.int32()),
                        *[pa.array(f, pa.int64()) for f in found[2:4]],
                        pa.array(found[4], pa.float64()),
                        *[pa.array(f, pa.int64()) for f in found[5:]],
                    ],
                    names=["doc_id", "section", "start", "n_chars", "n_tokens", "n_crossing", "doc_tokens"],
                )
                row += len(part)

    # Byte lengths of the fields, each but the last with the line feed that follows it.
    lengths = F.array(*[F.octet_length(p) + (1 if i + 1 < len(parts) else 0) for i, p in enumerate(parts)])
    rows = docs.select("doc_id", F.concat_ws("\n", *parts), *([lengths] if fields else []))
    schema = f"doc_id {kind}, section int, start long, n_chars long, n_tokens double, n_crossing long, doc_tokens long"
    return rows.mapInArrow(run, schema)
