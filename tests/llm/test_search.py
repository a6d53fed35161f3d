from __future__ import annotations

import math
import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from fixtures import texts  # noqa: E402, F401

from eigenlake.llm import lexical_search as ls  # noqa: E402
from eigenlake.llm.text import SpanHasher  # noqa: E402


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(brute.FOLD))


def ranking(docs, items, top=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    total = sum(1 for _, c in counts if c)
    length = sum(sum(c.values()) for _, c in counts)
    holders = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c in counts:
            if not c:
                continue
            m = 100 - 75 + 75 * sum(c.values()) * total // length
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * holders[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scores)[:top], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=str)


def corpus(count=300, seed=6):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 500}" for _ in range(2000)] + ["Straße", "ÉTÉ", "x1", "日本語"]
    docs = []
    for i in range(count):
        text = rng.choice([" ", ", ", "-", "\x7f", "\x00"]).join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 4, 30, 200])))
        docs.append((i, text.upper() if rng.random() < 0.1 else text))
    docs += [(1000, None), (1001, ""), (1002, "!?"), (1003, "w1 " * 40_000), (None, "w1 w2 w3"), (3, docs[7][1]), (7, docs[7][1]), (7, docs[7][1])]
    items = [(f"q{i}", " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 5, 40])))) for i in range(20)]
    items += [("none", None), ("empty", " "), ("absent", "neverseen"), ("q0", "w1 w1 w2"), (None, "straße été")]
    return docs, items


@pytest.fixture
def asked(spark):
    def build(items):
        return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id string, text string, doc_id string")

    return build


def found(frame):
    return sorted([tuple(r) for r in frame.collect()], key=str)


def test_equals_brute_force(texts, asked):
    docs, items = corpus()
    assert found(ls.search(texts(docs), asked(items))) == ranking(docs, items)


def test_small_shards_and_blocks_of_items(texts, asked, monkeypatch):
    monkeypatch.setattr(ls, "SORT_ROWS", 16)
    monkeypatch.setattr(ls, "SHARD_ROWS", 5)
    monkeypatch.setattr(ls, "ITEM_ROWS", 9)
    # Few slices, so that many documents only seem to hold a term; a first threshold from few documents.
    monkeypatch.setattr(ls, "DENSITY", 0.95)
    monkeypatch.setattr(ls, "FIRST", 2)
    docs, items = corpus(120, 9)
    assert found(ls.search(texts(docs), asked(items), top=3)) == ranking(docs, items, 3)


def test_bounds_are_never_below_scores():
    docs, items = corpus(200, 3)
    docs = [(i, t) for i, t in docs if terms(t)]
    part = pa.array([t for _, t in docs])
    hashes, first = ls.terms_of(part, SpanHasher())
    shards = ls._Shards()
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(docs))), pa.array(range(len(docs)))], names=["doc_id", "print"])
    shards.take(batch, first, ls.counted(hashes, first))
    item, asked_terms, repeats = ls.counted(*ls.terms_of(pa.array([t or "" for _, t in items]), SpanHasher()))
    unique, term = np.unique(asked_terms, return_inverse=True)
    weights = ls.Weights(unique, np.arange(1, len(unique) + 1), len(docs), len(hashes), item, term, repeats)
    seen = 0
    for shard in shards.batches(ls._NAMES):
        row = {name: shard.column(name)[0].values.to_numpy() for name in ("ids", "prints", "lengths", "most")}
        row |= {"slices": shard.column("slices")[0].as_py(), "bits": shard.column("bits")[0].as_buffer()}
        bounds = ls.upper_bounds(row, weights, len(items))
        for column, doc in enumerate(row["ids"]):
            mine = slice(first[doc], first[doc + 1])
            value, count = np.unique(hashes[mine], return_counts=True)
            part = np.zeros(len(unique), np.int64)
            place = np.searchsorted(unique, value)
            hit = np.flatnonzero(unique[np.minimum(place, len(unique) - 1)] == value)
            part[place[hit]] = weights.weight[place[hit]] * ls.saturation(count[hit], weights.norm(np.array(mine.stop - mine.start)))
            exact = np.bincount(item, part[term] * repeats, len(items))
            assert (bounds[:, column] >= exact).all()
            seen += 1
    assert seen == len(docs)


def test_empty_tables(texts, asked):
    assert ls.search(texts([]), asked([("a", "b")])).collect() == []
    assert ls.search(texts([(1, "b")]), asked([])).collect() == []
    assert ls.search(texts([(1, "b")]), asked([("a", " ")])).columns == ["item_id", "rank", "doc_id", "score"]
