"""Cheapest repairs of broken conversations by depth-first branch-and-bound.

A repaired conversation has role initials ``(s?(ua)+)?``. A search node is a row number and what has been
accepted so far; a branch keeps, reroles or deletes the row, or inserts a turn before it. The stack is explicit,
a suffix bound from a relaxed problem cuts branches that can't beat the incumbent, and a table of the best (cost, audit) per node
cuts worse prefixes. A long conversation is cut into pieces that are searched for every way in and out, in
different tasks, and chained; so neither its search nor its text is ever in one place as a whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eigenlake.llm.staging import Staging

# What has been accepted so far: nothing, a system turn, a turn of the user, a whole pair.
START, SYSTEM, USER, PAIR = range(4)
STATES = range(4)
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
FINE, TRUNCATED, REMOVED = range(3)
# Costs of the edits; an undeleted truncated row adds one.
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
# Rows searched at once; rows and bytes up to which a conversation is repaired in one piece.
SEARCH_ROWS = 128
WHOLE_ROWS = 4096
WHOLE_BYTES = 64 << 20

_NONE = math.inf
_SPACES = " \t\n\x0b\x0c\r"


def branches(state: int, initial: str | None, fault: int) -> list[tuple[str, int, int]]:
    """Edits of the next row, or inserts if ``initial`` is None, as (edit, cost, next state)."""
    awaited = USER if state != USER else PAIR
    if initial is None:
        return [(INSERT, COST[INSERT], awaited)]
    out = [(DELETE, COST[DELETE], state)]
    if fault != REMOVED:
        if initial == ("a" if state == USER else "u"):
            out.append((KEEP, COST[KEEP] + fault, awaited))
        elif state == START and initial == "s":
            out.append((KEEP, COST[KEEP] + fault, SYSTEM))
        out.append((REROLE, COST[REROLE] + fault, awaited))
    return out


def suffix_bounds(initials: list[str], faults: list[int], goal: int | None) -> list[tuple[float, float]]:
    """Lower bounds of what remains from every row on, without and with an open user turn.

    The relaxed problem forgets where a system turn may stand: it is free wherever a pair may begin.
    """
    if goal is None:
        last = (0, COST[INSERT])
    else:
        last = (COST[INSERT], 0) if goal == USER else (0, COST[INSERT])
    bounds = [last]
    for initial, fault in zip(reversed(initials), reversed(faults), strict=True):
        closed, opened = bounds[-1]
        if fault == REMOVED:
            bounds.append((closed + COST[DELETE], opened + COST[DELETE]))
            continue
        stay = closed + (fault if initial == "s" else COST[DELETE])
        least_closed = min(stay, opened + fault + (0 if initial == "u" else COST[REROLE]))
        least_opened = min(opened + COST[DELETE], closed + fault + (0 if initial == "a" else COST[REROLE]))
        step = COST[INSERT]
        bounds.append((min(least_closed, least_opened + step), min(least_opened, least_closed + step)))
    return bounds[::-1]


def search(initials: list[str], faults: list[int], entry: int = START, goal: int | None = None) -> tuple[float, str]:
    """The least (cost, audit) from ``entry`` to ``goal``; without a goal, to an end of a conversation.

    Ties go to the ASCII-least audit. At equal cost no prefix of one node begins another (two inserts between
    would cost more), so the least audit of a node is part of the least audit of all.
    """
    if goal in (START, SYSTEM) and entry not in (START, goal):
        return _NONE, ""
    rows = len(initials)
    bounds = suffix_bounds(initials, faults, goal)
    ends = (START, PAIR) if goal is None else (goal,)
    incumbent: tuple[float, str] = (_NONE, "")
    best: dict[tuple[int, int], tuple[float, str]] = {}
    stack: list[tuple[float, int, int, str]] = [(0, 0, entry, "")]
    while stack:
        cost, row, state, audit = stack.pop()
        total = cost + bounds[row][state == USER]
        if total > incumbent[0] or (total == incumbent[0] and audit > incumbent[1][: len(audit)]):
            continue
        known = best.get((row, state))
        if known is not None and known <= (cost, audit):
            continue
        best[row, state] = (cost, audit)
        if row == rows and state in ends:
            incumbent = min(incumbent, (cost, audit))
            continue
        steps = branches(state, None, FINE)
        if row < rows:
            steps += branches(state, initials[row], faults[row])
        found = []
        for edit, price, after in steps:
            at = row + (edit != INSERT)
            found.append((cost + price + bounds[at][after == USER], edit, cost + price, at, after))
        # The most promising branch is taken next, of equal ones the one with the least audit.
        for _, edit, spent, at, after in sorted(found, reverse=True):
            stack.append((spent, at, after, audit + edit))
    return incumbent


Ways = dict[tuple[int, int], tuple[float, str]]


def transfers(initials: list[str], faults: list[int], entries=STATES) -> Ways:
    """The least (cost, audit) of a run of rows for every way in and out."""
    found: Ways = {}
    for entry in entries:
        ways = {entry: (0, "")}
        for first in range(0, len(initials), SEARCH_ROWS):
            cut = slice(first, first + SEARCH_ROWS)
            after: dict[int, tuple[float, str]] = {}
            for state, (spent, audit) in ways.items():
                for goal in STATES:
                    cost, more = search(initials[cut], faults[cut], state, goal)
                    if cost < _NONE:
                        after[goal] = min(after.get(goal, (_NONE, "")), (spent + cost, audit + more))
            ways = after
        found |= {(entry, goal): way for goal, way in ways.items()}
    return found


def chain(pieces: list[Ways]) -> list[tuple[int, int]]:
    """The ways in and out of every piece in the cheapest repair of all."""
    best: dict[int, tuple[float, str, list[tuple[int, int]]]] = {START: (0, "", [])}
    for piece in pieces:
        after: dict[int, tuple[float, str, list[tuple[int, int]]]] = {}
        for (entry, goal), (cost, audit) in piece.items():
            if entry in best:
                spent, before, ways = best[entry]
                here = (spent + cost, before + audit, [*ways, (entry, goal)])
                after[goal] = min(after.get(goal, here), here)
        best = after
    return min(best[state] for state in (START, PAIR) if state in best)[2]


def repair(initials: list[str], faults: list[int]) -> tuple[int, str]:
    """The least (cost, audit) of a whole conversation."""
    if len(initials) <= SEARCH_ROWS:
        cost, audit = search(initials, faults)
    else:
        ways = transfers(initials, faults, [START])
        cost, audit = min(ways[START, goal] for goal in (START, PAIR) if (START, goal) in ways)
    return int(cost), audit


def edited(audit: str, state: int, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """``role, text, edit`` of the turns that repair rows ``(role, text)``."""
    for edit in audit:
        role, text = ("", "") if edit == INSERT else next(rows)
        if edit == DELETE:
            continue
        if edit != KEEP:
            role = "assistant" if state == USER else "user"
        state = SYSTEM if edit == KEEP and state == START and role[:1] == "s" else PAIR if state == USER else USER
        yield role, text, edit


BLANK, DUPLICATE = 2, 3


def find_faults(roles: list[str], texts: list[str]) -> list[int]:
    """0 none, 1 truncated, 2 blank, 3 duplicate of every row; the first of blank, duplicate, truncated that holds."""
    seen: set[tuple[str, str]] = set()
    out = []
    for role, text in zip(roles, texts, strict=True):
        last = text.rstrip(_SPACES)[-1:]
        if not last:
            out.append(BLANK)
        elif (role, text) in seen:
            out.append(DUPLICATE)
        else:
            out.append(int(last not in ".!?"))
        seen.add((role, text))
    return out


def illegal_pairs(initials: str | list[str]) -> int:
    """Neighbours whose initials do not follow each other in a sound conversation."""
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copy, dropped``: the rows with the stated damage by crc32 of ``conv_id:turn``.

    Nulls count as one space, but for conv_id and turn themselves. A dropped row stays as a mark without text.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    role, text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")]
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("kind"))
    text = F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.sequence(F.lit(0), (F.col("kind") == 3).cast("int"))).alias("copy"),
        (F.col("kind") == 0).alias("dropped"),
    )


def undamaged(conversations: DataFrame) -> DataFrame:
    """The rows as they are, in the form that the repair takes."""
    role, text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return conversations.select("conv_id", "turn", role, text, F.lit(0).alias("copy"), F.lit(False).alias("dropped"))


_REPORT = "cost long, audit string, gaps long, blank long, duplicate long, truncated long, illegal long"


def _order() -> list:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("copy")]


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, dict[str, list]]]:
    """The columns of one conversation after the other from a partition sorted by ``conv_id``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch.column("conv_id").dictionary_encode(null_encoding="encode").indices.to_numpy()
        cuts = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            part = batch.slice(a, b - a)
            if held and held[0].column("conv_id")[0].as_py() != part.column("conv_id")[0].as_py():
                yield _joined(held)
                held = []
            held.append(part)
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> tuple[object, dict[str, list]]:
    rows = pa.Table.from_batches(parts)
    return rows.column("conv_id")[0].as_py(), {c: rows.column(c).to_pylist() for c in ("turn", "role", "text", "dropped")}


def _report(rows: dict[str, list]) -> tuple[tuple, list[tuple[str, str, str]]]:
    keep = [i for i, dropped in enumerate(rows["dropped"]) if not dropped]
    roles, texts = [rows["role"][i] for i in keep], [rows["text"][i] for i in keep]
    turns = {rows["turn"][i] for i in keep} - {None}
    faults, initials = find_faults(roles, texts), [role[:1] for role in roles]
    cost, audit = repair(initials, [min(f, REMOVED) for f in faults])
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    counts = [faults.count(kind) for kind in (BLANK, DUPLICATE, TRUNCATED)]
    return (cost, audit, gaps, *counts, illegal_pairs(initials)), list(edited(audit, START, zip(roles, texts, strict=True)))


def _per_conversation(rows: DataFrame, emit: Callable, schema: str) -> DataFrame:
    """Rows made by ``emit(conv_id, columns)`` of every conversation, each of which lies in one task."""
    kind = dict(rows.dtypes)["conv_id"]
    names = ["conv_id", *[part.split()[0] for part in schema.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, first = [], next(batches, None)
        if first is None:
            return
        kinds = [first.schema.field("conv_id").type, *[pa.string() if p.endswith("string") else pa.int64() for p in schema.split(", ")]]

        def packed() -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def chained() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        for conv_id, columns in _conversations(chained()):
            out += [(conv_id, *row) for row in emit(conv_id, columns)]
            if len(out) >= 4096:
                yield packed()
                out = []
        if out:
            yield packed()

    ordered = rows.repartition("conv_id").sortWithinPartitions(*_order())
    return ordered.mapInArrow(run, f"conv_id {kind}, {schema}")


def _emit_report(conv_id, columns):
    report, turns = _report(columns)
    text = "\n".join(f"{role}:{text}" for role, text, _ in turns)
    yield (*report, hashlib.sha256(text.encode()).hexdigest())


def _emit_turns(conv_id, columns):
    for place, (role, text, edit) in enumerate(_report(columns)[1]):
        yield place, role, text, edit


class _Long:
    """Conversations beyond the bound of one task, cut into pieces along their order."""

    def __init__(self, rows: DataFrame, staging: Staging, piece_rows: int) -> None:
        self.kind = dict(rows.dtypes)["conv_id"]
        rows = staging.keep(rows.where("not dropped").drop("dropped").withColumn("row", F.monotonically_increasing_id()), "long")
        self.rows = staging.keep(self._ordered(self._marked(rows, staging), max(1, math.ceil(rows.count() / piece_rows))), "ordered")
        self.plans = staging.keep(self._plans(), "plans")

    def _marked(self, rows: DataFrame, staging: Staging) -> DataFrame:
        """Adds ``fault`` as ``find_faults`` has it."""
        last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*$", 1)
        rows = rows.withColumn("last", last).withColumn("print", F.sha2("text", 256))
        place = F.struct(F.col("turn").isNotNull(), "turn", "copy", "row")
        # Folded before the exchange, so that a turn repeated by a third of all rows is no hot key.
        again = rows.where("last <> ''").groupBy("conv_id", "role", "print").agg(F.min(place).alias("first"), F.count("*").alias("n"))
        again = staging.keep(again.where("n > 1").withColumnsRenamed({"conv_id": "c", "role": "r", "print": "p"}), "again")
        same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("print") == F.col("p"))
        fault = F.when(F.col("last") == "", BLANK).when(place > F.col("first"), DUPLICATE)
        fault = fault.when(~F.col("last").isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
        return rows.join(again, same, "left").withColumn("fault", fault).select("conv_id", "turn", "role", "text", "copy", "row", "fault")

    @staticmethod
    def _ordered(rows: DataFrame, ranges: int) -> DataFrame:
        """The rows in order, dealt to tasks by ranges of it: ``piece`` is the task, ``place`` ascends over all."""
        order = [*_order(), F.col("row")]
        ordered = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        return ordered.select(
            "conv_id", F.spark_partition_id().alias("piece"), F.monotonically_increasing_id().alias("place"), "turn", "role", "text", "fault"
        )

    def _plans(self) -> DataFrame:
        """``conv_id, piece, entry, cost, audit, illegal`` of the cheapest repairs."""
        letter = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise(".")
        fault = F.least("fault", F.lit(REMOVED)).cast("string")
        brief = self.rows.groupBy("conv_id", "piece").agg(
            F.array_sort(F.collect_list(F.struct("place", letter.alias("letter"), fault.alias("fault")))).alias("rows")
        )
        brief = brief.select("conv_id", "piece", F.array_join("rows.letter", "").alias("initials"), F.array_join("rows.fault", "").alias("faults"))
        names = ["conv_id", "piece", "initials", "entry", "goal", "cost", "audit"]

        def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, (initials, faults) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                    found = transfers(list(initials), [int(f) for f in faults])
                    same = batch.slice(i, 1).select([0, 1, 2]).take(pa.array([0] * len(found)))
                    entry, goal = zip(*found, strict=True)
                    cost, audit = zip(*found.values(), strict=True)
                    new = [pa.array(entry), pa.array(goal), pa.array([int(c) for c in cost]), pa.array(audit)]
                    yield pa.RecordBatch.from_arrays([*same.columns, *new], names=names)

        def link(table: pa.Table) -> pa.Table:
            pieces: dict[int, tuple[str, Ways]] = {}
            for piece, initials, entry, goal, cost, audit in zip(*[table.column(c).to_pylist() for c in names[1:]], strict=True):
                pieces.setdefault(piece, (initials, {}))[1][entry, goal] = (cost, audit)
            numbers = sorted(pieces)
            chosen = chain([pieces[n][1] for n in numbers])
            found = [(way[0], *pieces[n][1][way]) for n, way in zip(numbers, chosen, strict=True)]
            runs = [pieces[n][0] for n in numbers]
            illegal = [illegal_pairs(before[-1:] + run) for before, run in zip(["", *runs], runs, strict=False)]
            entry, cost, audit = zip(*found, strict=True)
            ids = table.column("conv_id").take(pa.array([0] * len(numbers)))
            return pa.table(
                [ids, pa.array(numbers, pa.int32()), pa.array(entry), pa.array(cost), pa.array(audit), pa.array(illegal)],
                names=["conv_id", "piece", "entry", "cost", "audit", "illegal"],
            )

        found = brief.mapInArrow(ways, f"conv_id {self.kind}, piece int, initials string, entry long, goal long, cost long, audit string")
        plan = f"conv_id {self.kind}, piece int, entry long, cost long, audit string, illegal long"
        return found.groupBy("conv_id").applyInArrow(link, plan)

    def turns(self) -> DataFrame:
        """``conv_id, piece, place, role, text, edit`` of the repaired turns, piece by piece."""

        def apply(rows: pa.Table, plan: pa.Table) -> pa.Table:
            rows = rows.sort_by("place")
            pairs = zip(rows.column("role").to_pylist(), rows.column("text").to_pylist(), strict=True)
            found = list(edited(plan.column("audit")[0].as_py(), plan.column("entry")[0].as_py(), pairs))
            none = pa.array([0] * len(found), pa.int64())
            return pa.table(
                [rows.column("conv_id").take(none), rows.column("piece").take(none), pa.array(range(len(found)), pa.int64())]
                + [pa.array([turn[i] for turn in found], pa.string()) for i in range(3)],
                names=["conv_id", "piece", "place", "role", "text", "edit"],
            )

        both = self.rows.groupBy("conv_id", "piece").cogroup(self.plans.groupBy("conv_id", "piece"))
        return both.applyInArrow(apply, f"conv_id {self.kind}, piece int, place long, role string, text string, edit string")

    def digests(self) -> DataFrame:
        """``conv_id, repaired_sha256``; the text streams through the hash, which allows no other way."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            digest, current, kind = None, None, None
            for batch in batches:
                kind = batch.schema.field(0).type
                for conv_id, role, text in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                    if digest is None or conv_id != current:
                        if digest is not None:
                            yield pa.RecordBatch.from_arrays([pa.array([current], kind), pa.array([digest.hexdigest()])], names=["conv_id", "repaired_sha256"])
                        digest, current = hashlib.sha256(), conv_id
                    else:
                        digest.update(b"\n")
                    digest.update(f"{role}:{text}".encode())
            if digest is not None:
                yield pa.RecordBatch.from_arrays([pa.array([current], kind), pa.array([digest.hexdigest()])], names=["conv_id", "repaired_sha256"])

        ordered = self.turns().repartition("conv_id").sortWithinPartitions("conv_id", "piece", "place")
        return ordered.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {self.kind}, repaired_sha256 string")

    def report(self) -> DataFrame:
        turn = F.col("turn").cast("long")
        kinds = {"blank": BLANK, "duplicate": DUPLICATE, "truncated": TRUNCATED}
        counted = self.rows.groupBy("conv_id").agg(
            F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
            *[F.count_if(F.col("fault") == kind).alias(name) for name, kind in kinds.items()],
        )
        audits = F.array_join(F.array_sort(F.collect_list(F.struct("piece", "audit")))["audit"], "").alias("audit")
        plans = self.plans.groupBy("conv_id").agg(F.sum("cost").alias("cost"), audits, F.sum("illegal").alias("illegal"))
        empty = F.lit(hashlib.sha256(b"").hexdigest())
        found = counted.join(plans.withColumnRenamed("conv_id", "p"), F.col("conv_id").eqNullSafe(F.col("p")))
        found = found.join(self.digests().withColumnRenamed("conv_id", "d"), F.col("conv_id").eqNullSafe(F.col("d")), "left")
        return found.select("conv_id", "cost", "audit", "gaps", *kinds, "illegal", F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


def _parted(rows: DataFrame, staging: Staging, whole_rows: int, whole_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of conversations that one task takes, and those of the others if there are any."""
    size = rows.where("not dropped").groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    long = size.where((F.col("n") > whole_rows) | (F.col("bytes") > whole_bytes)).select(F.col("conv_id").alias("long_id"))
    long = staging.keep(long, "long-ids")
    if long.isEmpty():
        return rows, None
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    return rows.join(long, same, "left_anti"), rows.join(long, same, "left_semi")


def repair_report(rows: DataFrame, whole_rows: int = WHOLE_ROWS, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """One row per conversation of ``damaged`` or ``undamaged`` rows: its faults, the cheapest repair and its digest.

    Rows are taken by turn (nulls first), those of one turn by role and text. Columns: conv_id (null is a
    conversation of its own), gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. A conversation
    without rows left has zeros, an empty audit and the hash of the empty text; an empty table gives no rows.
    Conversations beyond the bounds are repaired in pieces by several tasks, with the same result.
    """
    whole, long = _parted(rows, staging := Staging(rows.sparkSession, "repair"), whole_rows, whole_bytes)
    found = _per_conversation(whole, _emit_report, f"{_REPORT}, repaired_sha256 string")
    if long is not None:
        found = found.unionByName(_Long(long, staging, whole_rows).report())
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repaired_turns(rows: DataFrame, whole_rows: int = WHOLE_ROWS, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """``conv_id, piece, place, role, text, edit`` of the repaired turns; order within a conversation is (piece, place)."""
    whole, long = _parted(rows, staging := Staging(rows.sparkSession, "repair"), whole_rows, whole_bytes)
    found = _per_conversation(whole, _emit_turns, "place long, role string, text string, edit string")
    found = found.select("conv_id", F.lit(0).alias("piece"), "place", "role", "text", "edit")
    return found if long is None else found.unionByName(_Long(long, staging, whole_rows).turns())
