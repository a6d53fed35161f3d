from __future__ import annotations

import hashlib
import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
from fixtures import texts  # noqa: E402, F401

from eigenlake.llm import exact_dedup  # noqa: E402
from eigenlake.llm.exact_dedup import ContentTable, exact_groups, without_exact_copies  # noqa: E402


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max(ids, key=lambda i: (i is not None, i or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        first = ids.index(keep)
        out += [(i, keep, len(ids), at == first, digest) for at, i in enumerate(ids)]
    return sorted(out, key=str)


def found(frame):
    return sorted([tuple(r) for r in frame.collect()], key=str)


def corpus(count=400, seed=2):
    rng = random.Random(seed)
    pool = ["", None, " ", "a", "A", "a ", "ü", "ü", "long " * 50_000] + [f"text {i}" for i in range(60)]
    # One text holds a third of all rows.
    return [(i, "hot" if rng.random() < 1 / 3 else rng.choice(pool)) for i in range(count)]


def test_equals_brute_force(texts):
    rows = corpus()
    assert found(exact_groups(texts(rows))) == expected(rows)


def test_buckets_without_room_are_dealt_again(texts, monkeypatch):
    # Folds of a few rows, tables of a few texts: several levels of spilled buckets.
    monkeypatch.setattr(exact_dedup, "FOLD_ROWS", 7)
    rows = [r for r in corpus(150) if len(r[1] or "") < 100]
    assert found(exact_groups(texts(rows), bucket_bytes=100, table_bytes=40)) == expected(rows)


def test_equal_hashes_do_not_make_texts_equal():
    table = ContentTable(slots=4)
    numbers = []
    for content in [b"a", b"b", b"a", b"", b"c", b"b"] + [b"%d" % i for i in range(50)] + [b"49"]:
        entry, slot = table.find(5, content)
        numbers.append(entry if entry >= 0 else table.add(5, content, slot))
    assert numbers[:6] == [0, 1, 0, 2, 3, 1] and numbers[-1] == numbers[-2] and len(table) == 54


def test_null_ids_repeated_rows_and_empty_table(texts):
    rows = [(None, "x"), (None, "x"), (7, "y"), (7, "y"), (3, "x")]
    assert found(exact_groups(texts(rows, partitions=1))) == expected(rows)
    assert sum(r.kept for r in exact_groups(texts(rows)).collect()) == 2
    assert exact_groups(texts([])).collect() == []


def test_user_columns_stay(spark):
    frame = spark.createDataFrame(
        [(1, "t", 5, {"a": 1}), (2, "t", 6, None), (3, None, None, None)], "doc_id int, text string, record int, row map<string,int>"
    )
    kept = without_exact_copies(frame)
    assert kept.schema.simpleString() == frame.schema.simpleString()
    assert sorted(tuple(r) for r in kept.collect()) == [(2, "t", 6, None), (3, None, None, None)]
    named = frame.withColumnsRenamed({"record": "keep_id", "row": "carried"})
    assert without_exact_copies(named).columns == named.columns
