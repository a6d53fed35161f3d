"""Delimited text as whole records, read by many tasks although quoted values hold line breaks.

A line changes "inside a quoted value" to a state that depends on the state before it only, so a block of a file is a
function of two states. Blocks are composed along each file; then every task knows whether it starts inside a
record, and the few records that cross from block to block are put together from their parts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# Of a header line, so much is read.
HEADER_CHARS = 1 << 20
# What a task makes of its lines: a whole record, or the end, middle or start of one that crosses its borders.
WHOLE, END, MIDDLE, START = range(4)


def open_after(line: str, inside: bool, separator: str) -> bool:
    """Whether a quoted value is open after ``line``, given whether one is before it.

    A quote opens a value only as its first character; doubled quotes stay within it; after a closing
    quote anything up to the separator belongs to the value.
    """
    at = 0
    while True:
        if not inside and line[at : at + 1] == '"':
            inside, at = True, at + 1
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line[at + 1 : at + 2] == '"':
                at += 2
                continue
            inside = False
        at = line.find(separator, at)
        if at < 0:
            return False
        at += len(separator)


def file_lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """``path, block, value``: all lines with the file and the byte where their block starts."""
    lines = spark.read.option("lineSep", "\n").text(list(files))
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")


def block_facts(lines: DataFrame) -> DataFrame:
    """Per file and block: the start of the first line that is not blank, and whether a quoted value may hold a line break."""
    blank = F.trim(F.regexp_replace("value", "\r", "")).isin("", "\ufeff")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    # An odd number of quotes, or one in the middle of a value.
    breaks = (quotes % 2 == 1) | F.col("value").rlike(r'[\p{L}\p{N} ]"[\p{L}\p{N} ]')
    start = F.when(~blank, F.substring("value", 1, HEADER_CHARS))
    marked = lines.select("path", "block", F.monotonically_increasing_id().alias("line"), start.alias("start"), breaks.alias("breaks"))
    return marked.groupBy("path", "block").agg(
        F.min_by("start", F.when(F.col("start").isNotNull(), F.col("line"))).alias("first_line"), F.max("breaks").alias("breaks")
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """Lines of one block after the other; a block's lines may come in several arrays."""
    for batch in batches:
        if not batch.num_rows:
            continue
        path, block = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
        code = path.indices.to_numpy()
        cuts = np.flatnonzero((block[1:] != block[:-1]) | (code[1:] != code[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield (batch.column(0)[a].as_py(), int(block[a])), batch.column(2).slice(a, b - a)


Spans = dict[str, list[tuple[int, float]]]


def inner_starts(lines: DataFrame, separator: str) -> Spans:
    """Per file, spans ``(after, last)`` of the blocks that start within a quoted value. Two flags per block reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, states, found = None, [False, True], []
        for here, values in _runs(batches):
            if here != key:
                found += [(*key, *states)] if key else []
                key, states = here, [False, True]
            for line in values.to_pylist():
                if states[0] == states[1]:
                    states = [open_after(line, states[0], separator)] * 2
                else:
                    states = [open_after(line, state, separator) for state in states]
        found += [(*key, *states)] if key else []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=["path", "block", "outer", "inner"])

    # Lines without a quote change nothing.
    quoted = lines.where(F.contains("value", F.lit('"')))
    table = quoted.mapInArrow(run, "path string, block long, outer boolean, inner boolean").toArrow()
    rows = sorted(zip(*[column.to_pylist() for column in table.columns], strict=True))
    starts: Spans = {}
    for path, blocks in groupby(rows, key=lambda row: row[0]):
        inside, after = False, None
        for _, block, outer, inner in blocks:
            if inside:
                starts.setdefault(path, []).append((after, block))
            inside, after = (inner if inside else outer), block
        if inside:
            starts.setdefault(path, []).append((after, np.inf))
    return starts


def _is_inner(starts: Spans, path: str, block: int) -> bool:
    # Blocks without quotes between two others keep the state of the one before.
    return any(after < block <= last for after, last in starts.get(path, ()))


def _parts(lines: DataFrame, starts: Spans, separator: str, wanted: str) -> DataFrame:
    """``path, block, part, value``: the whole records of every block, or the parts of those that cross blocks."""
    spark = lines.sparkSession
    shared = spark.sparkContext.broadcast(starts)
    whole = wanted == "whole"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, key, inside, headed, held, part = shared.value, None, False, False, [], WHOLE

        def packed(kind: int, values: pa.Array) -> pa.RecordBatch:
            count = len(values)
            columns = [pa.array([key[0]] * count), pa.array([key[1]] * count, pa.int64()), pa.array([kind] * count, pa.int32()), values.cast(pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["path", "block", "part", "value"])

        def last() -> Iterator[pa.RecordBatch]:
            # What is open at the block's end goes on in the next one.
            if held and not whole:
                yield packed(MIDDLE if part == END else START, pa.array(["\n".join(held)]))

        for here, values in _runs(batches):
            if here != key:
                yield from last()
                key, inside, held = here, _is_inner(starts, *here), []
                headed, part = here[1] > 0, END if inside else WHOLE
            first = 0
            if not headed:
                blank = pc.is_in(pc.utf8_trim(values, " \r﻿"), pa.array([""]))
                filled = np.flatnonzero(~blank.to_numpy(zero_copy_only=False))
                if not len(filled):
                    continue
                first, headed = int(filled[0]) + 1, True
            values = values.slice(first)
            quoted = np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False))
            if not len(quoted) and not inside:
                if whole and len(values):
                    yield packed(WHOLE, values)
                continue
            # Where a record starts: after every line that leaves no value open.
            closed = np.full(len(values), not inside)
            state = inside
            for i, line in zip(quoted.tolist(), values.take(pa.array(quoted)).to_pylist(), strict=True):
                state = open_after(line, state, separator)
                closed[i:] = not state
            begins = np.flatnonzero(np.concatenate([[not inside], closed[:-1]])) if len(values) else np.zeros(0, np.int64)
            ends = np.flatnonzero(closed) + 1
            if inside:
                stop = int(ends[0]) if len(ends) else len(values)
                held += values.slice(0, stop).to_pylist()
                if len(ends):
                    if part == END and not whole:
                        yield packed(END, pa.array(["\n".join(held)]))
                    elif part == WHOLE and whole:
                        yield packed(WHOLE, pa.array(["\n".join(held)]))
                    held, part, ends = [], WHOLE, ends[1:]
            if len(ends) and whole:
                bounds = pa.array(np.concatenate([begins[: len(ends)], ends[-1:]]).astype(np.int32))
                rows = pa.ListArray.from_arrays(bounds, values.cast(pa.string()))
                yield packed(WHOLE, pc.binary_join(rows, "\n"))
            inside = state
            if inside and len(begins) > len(ends):
                held = values.slice(int(begins[len(ends)])).to_pylist()
        yield from last()

    return lines.mapInArrow(run, "path string, block long, part int, value string")


def split_records(lines: DataFrame, separator: str) -> DataFrame:
    """``path, value``: every record of the files as one text, headers left out.

    Equal to reading each file in one task; only a record that crosses blocks is exchanged.
    """
    starts = inner_starts(lines, separator)
    records = _parts(lines, starts, separator, "whole").select("path", "value")
    if starts:
        parts = _parts(lines, starts, separator, "parts")
        order = Window.partitionBy("path").orderBy("block", "part")
        numbered = parts.withColumn("record", F.sum((F.col("part") == START).cast("long")).over(order))
        texts = F.array_sort(F.collect_list(F.struct("block", "part", "value")))["value"]
        joined = numbered.groupBy("path", "record").agg(F.array_join(texts, "\n").alias("value"))
        records = records.union(joined.select("path", "value"))
    records = records.withColumn("value", F.regexp_replace("value", "\r$", ""))
    return records.where(F.trim("value") != "")
