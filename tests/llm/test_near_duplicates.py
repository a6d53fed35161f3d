from __future__ import annotations

import random
import sys
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from fixtures import texts  # noqa: E402, F401

from eigenlake.llm import groups, minhash_dedup  # noqa: E402
from eigenlake.llm.components import connected  # noqa: E402
from eigenlake.llm.minhash_dedup import Sketch, linked, near_duplicates, without_near_duplicates  # noqa: E402
from eigenlake.llm.staging import Staging  # noqa: E402

EDGES = [(100, None), (101, ""), (102, " \n\t"), (103, "one two"), (104, "ONE  two"), (105, "one two three"), (None, "no id"), (None, "no id")]


def corpus(seed=3, families=6, size=9):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünï", "ß"]
    rows = []
    for family in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([12, 60, 150]))]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(5)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(text)))
    return rows


def expected(rows, percent):
    sets = {i: set(brute.shingles(brute.words(t))) for i, t in rows if i is not None}
    links = [
        (a, b)
        for a, b in combinations(sorted(sets), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return sets, brute.classes(sets, links)


@pytest.mark.parametrize("percent", [80, 85])
def test_equals_brute_force(texts, percent, monkeypatch):
    # Small blocks: groups are cut and compared block by block.
    monkeypatch.setattr(minhash_dedup, "BLOCK_ROWS", 4)
    rows = corpus() + EDGES
    found = near_duplicates(texts(rows), percent).collect()
    sets, root = expected(rows, percent)
    assert len(found) == len(rows)
    for row in found:
        if row.doc_id is None:
            assert (row.n_shingles, row.component_id, row.kept) == (1, None, True)
        else:
            assert (row.n_shingles, row.component_id) == (len(sets[row.doc_id]), root[row.doc_id])
            assert row.kept == (row.doc_id == row.component_id)


def test_repeated_rows_and_empty_table(texts):
    rows = [(1, "a b c d e f g h"), (1, "a b c d e f g h"), (2, "A B C D E F G H")]
    assert sorted((r.doc_id, r.component_id) for r in near_duplicates(texts(rows)).collect()) == [(1, 1), (1, 1), (2, 1)]
    assert near_duplicates(texts([])).collect() == []
    kept = without_near_duplicates(texts(rows))
    assert kept.columns == texts(rows).columns and {r.doc_id for r in kept.collect()} == {1}


def test_other_texts_and_columns_of_any_name(spark, texts):
    rows = corpus(families=2, size=4)
    given = texts(rows)
    left = [(i, f"what is left of {i} has words of its own {i} {i} {i}") for i, _ in rows]
    odd = texts(left).selectExpr("*", "doc_id as _dropped_id", "doc_id as id", "text as d")
    assert without_near_duplicates(odd).count() == len(rows)
    _, root = expected(rows, 80)
    kept = without_near_duplicates(odd, texts=given)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == set(root.values())
    assert {r.doc_id for r in without_near_duplicates(odd.where("doc_id % 2 = 1"), texts=given).collect()} <= {i for i, _ in rows if i % 2}


def test_registers_merge_and_estimate():
    sketch = Sketch()
    rng = np.random.default_rng(5)
    for shared, own in ((900, 50), (500, 250), (0, 500)):
        both = rng.integers(0, 2**63, shared + 2 * own, dtype=np.uint64)
        left, right = both[: shared + own], np.concatenate([both[:shared], both[shared + own :]])
        flat = np.concatenate([left, right, both])
        registers = sketch.of(flat, np.array([0, len(left), len(left) + len(right), len(flat)]))
        assert (np.maximum(registers[0], registers[1]) == registers[2]).all()
        sizes = np.array([len(left)]), np.array([len(right)])
        estimate = sketch.similarity(registers[:1], registers[1:2], sizes)[0]
        assert abs(estimate - shared / (shared + 2 * own)) < 0.15


def test_matrix_and_pairwise_comparison_agree():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 50).astype(np.uint64)) for _ in range(20)]
    exact = {
        (a, b) for a, b in combinations(range(20), 2) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 45 * len(np.union1d(sets[a], sets[b]))
    }
    left, right = linked(sets, np.zeros(20, np.int64), 45)
    assert set(zip(left.tolist(), right.tolist())) <= exact
    assert brute.classes(range(20), zip(left.tolist(), right.tolist())) == brute.classes(range(20), exact)
    side = np.array([0] * 12 + [1] * 8)
    left, right = linked(sets, side, 45)
    crossed = {(a, b) for a, b in exact if a < 12 <= b}
    assert brute.classes(range(20), zip(left.tolist(), right.tolist())) == brute.classes(range(20), crossed)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(300, 301), (301, 302), (302, 300), (5, 5)]
    rng.shuffle(links)
    frame = spark.createDataFrame([(a, b) if rng.random() < 0.5 else (b, a) for a, b in links], "u long, v long")
    found = {r.id: r.root for r in connected(frame, Staging(spark, "test")).collect()}
    ids = {i for link in links for i in link}
    assert found == brute.classes(ids, links)
    empty = spark.createDataFrame([], "u long, v long")
    assert connected(empty, Staging(spark, "test")).collect() == []


def test_pairs_within_and_between_blocks(monkeypatch):
    monkeypatch.setattr(groups, "PAIR_STEP", 3)
    starts, side = np.array([0, 4, 5, 9]), np.array([0, 0, 0, 0, 0, 0, 0, 1, 1])
    found = [(a, b) for left, right in groups.pairs(starts, side) for a, b in zip(left.tolist(), right.tolist())]
    assert sorted(found) == [*combinations(range(4), 2), (5, 7), (5, 8), (6, 7), (6, 8)]
