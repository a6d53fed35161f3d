from __future__ import annotations

import hashlib
import itertools
import random
import re
import sys
import zlib
from functools import cache
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from fixtures import sf_dir  # noqa: E402, F401

from eigenlake.llm import conversation_repair as cr  # noqa: E402
from eigenlake.llm.queries import ORACLES, QUERIES  # noqa: E402


def plain_repair(rows):
    """Cheapest (cost, audit, repaired rows) by exhaustive recursion over what is allowed."""

    def fits(letters):
        return re.fullmatch("(s?(ua)+)?", letters)

    @cache
    def best(at, letters, inserted=0):
        # Only the last letter and whether there is any matter for what may follow.
        options = []
        if at == len(rows) and fits(letters):
            options.append((0, "", ()))
        if at < len(rows):
            role, text, fault = rows[at]
            cost, audit, rest = best(at + 1, letters)
            options.append((cost + 3, "D" + audit, rest))
            if fault < 2:
                for edit, price, new in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")):
                    step = letters + new[:1]
                    if re.fullmatch("s?(ua)*u?", step) and new[:1] in list("sua"):
                        cost, audit, rest = best(at + 1, shorten(step))
                        options.append((cost + price + fault, edit + audit, ((new, text), *rest)))
        if inserted < 2:
            for new in ("user", "assistant"):
                step = letters + new[0]
                if re.fullmatch("s?(ua)*u?", step):
                    cost, audit, rest = best(at, shorten(step), inserted + 1)
                    options.append((cost + 2, "I" + audit, ((new, ""), *rest)))
        return min(options, key=lambda o: o[:2], default=(10**9, "", ()))

    def shorten(letters):
        return {"": "", "s": "s"}.get(letters, "u" if letters[-1] == "u" else "ua")

    return best(0, "")


def plain_report(rows, damage=True):
    groups = {}
    for conv_id, turn, role, text in rows:
        out = groups.setdefault(conv_id, [])
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        out += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    found = {}
    for conv_id, out in groups.items():
        out.sort(key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
        faults, seen = [], set()
        for _, role, text in out:
            ends = re.findall("[^\x20\x09-\x0d]", text)
            faults.append(2 if not ends else 3 if (role, text) in seen else int(ends[-1] not in ".!?"))
            seen.add((role, text))
        turns = {t for t, _, _ in out if t is not None}
        initials = [role[:1] for _, role, _ in out]
        cost, audit, rest = plain_repair(tuple((role, text, min(f, 2)) for (_, role, text), f in zip(out, faults)))
        found[conv_id] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            faults.count(2), faults.count(3), faults.count(1),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in rest).encode()).hexdigest(),
        )
    return found


def broken(seed, count=60, longest=9, ids=None):
    rng = random.Random(seed)
    rows = []
    for conv_id in [*range(count), None] if ids is None else ids:
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "u"])
            text = rng.choice(["Yes.", "No!", "cut", " ", "", None, f"text {rng.randrange(3)}?", "é.\n", "word " * 9])
            rows.append((conv_id, rng.choice([turn, turn, turn, None, turn * 2]), role, text))
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def reported(frame):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in frame.collect()}


def test_search_equals_exhaustive_search():
    rng = random.Random(4)
    for _ in range(1500):
        rows = tuple((rng.choice(["user", "assistant", "system", "tool"]), "", rng.choice([0, 0, 0, 1, 2])) for _ in range(rng.randrange(8)))
        assert cr.repair([r[0][:1] for r in rows], [r[2] for r in rows]) == plain_repair(rows)[:2]


def test_pieces_chain_to_the_whole(monkeypatch):
    rng = random.Random(5)
    for _ in range(150):
        initials = [rng.choice("usat") for _ in range(rng.randrange(1, 25))]
        faults = [rng.choice([0, 0, 1, 2]) for _ in initials]
        monkeypatch.setattr(cr, "SEARCH_ROWS", 128)
        whole = cr.repair(initials, faults)
        monkeypatch.setattr(cr, "SEARCH_ROWS", 4)
        assert cr.repair(initials, faults) == whole
        cuts = sorted({0, len(initials), *[rng.randrange(len(initials)) for _ in range(3)]})
        pieces = [cr.transfers(initials[a:b], faults[a:b]) for a, b in itertools.pairwise(cuts)]
        ways = [piece[way] for piece, way in zip(pieces, cr.chain(pieces))]
        assert (sum(w[0] for w in ways), "".join(w[1] for w in ways)) == whole


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = broken(seed)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert reported(cr.repair_report(cr.damaged(frame))) == plain_report(rows)
    assert reported(cr.repair_report(cr.undamaged(frame))) == plain_report(rows, damage=False)


def test_long_conversations_are_repaired_in_pieces(spark):
    # Conversation 1 holds a third of all rows; pieces of 6 rows.
    rows = broken(3, 20) + broken(8, longest=12, ids=[1] * 12)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = reported(cr.repair_report(cr.damaged(frame), whole_rows=6))
    assert found == reported(cr.repair_report(cr.damaged(frame)))
    by_bytes = cr.repair_report(cr.damaged(frame), whole_bytes=40)
    assert reported(by_bytes) == found
    turns = cr.repaired_turns(cr.damaged(frame), whole_rows=6).orderBy("piece", "place").collect()
    whole = cr.repaired_turns(cr.damaged(frame)).orderBy("place").collect()
    for conv_id in found:
        mine = [(t.role, t.text, t.edit) for t in turns if t.conv_id == conv_id]
        assert mine == [(t.role, t.text, t.edit) for t in whole if t.conv_id == conv_id]
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t, _ in mine).encode()).hexdigest() == found[conv_id][-1]


def test_empty_dropped_and_very_long(spark):
    assert cr.repair_report(cr.damaged(spark.createDataFrame([], SCHEMA))).collect() == []
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "gone"), (5000, 1, "user", "word " * 400_000 + "."), (5000, 1, "user", "word " * 400_000 + ".")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as place", "2 as fault", "'x' as copy", "'y' as dropped")
    found = reported(cr.repair_report(cr.damaged(frame)))
    assert found == plain_report(rows)
    assert found[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
