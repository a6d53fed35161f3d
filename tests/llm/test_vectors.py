from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from eigenlake.llm import embedding_dedup  # noqa: E402
from eigenlake.llm.embedding_dedup import near_vectors  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, list int"


def clusters(seed=0, width=32):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(40):
        centre = rng.normal(size=width)
        for _ in range(rng.integers(1, 12)):
            rows.append(centre + rng.normal(size=width) * rng.choice([0.05, 0.2, 0.35]))
    return np.array(rows, dtype=np.float32)


def test_recall_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 5)
    points = clusters()
    labels = np.arange(len(points)) % 2 // 1
    rows = [(i, [float(x) for x in p], int(labels[i]), "x", 1) for i, p in enumerate(points)]
    found = {r.vec_id: r for r in near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    unit = points.astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.93) & (labels[:, None] == labels[None, :]) & ~np.eye(len(points), dtype=bool)
    reported = np.array([found[i].n_links for i in range(len(points))])
    assert (reported <= linked.sum(axis=1)).all()
    assert reported.sum() >= 0.97 * linked.sum() > 50
    root = brute.classes(range(len(points)), zip(*map(list, np.nonzero(linked))))
    same = np.mean([found[i].component_id == root[i] for i in range(len(points))])
    assert same > 0.97
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_odd_vectors(spark):
    one, nan = [1.0, 0.0, 0.0], float("nan")
    rows = [
        (1, one, 1, "", 0), (2, [2.0, 0.0, 0.0], 1, "", 0), (3, one, 1, "", 0), (3, one, 1, "", 0), (4, one, 2, "", 0),
        (5, one, None, "", 0), (6, one, None, "", 0), (7, None, 1, "", 0), (8, [0.0, 0.0, 0.0], 1, "", 0),
        (9, [1.0, None, 0.0], 1, "", 0), (10, [nan, 1.0, 0.0], 1, "", 0), (11, [float("inf"), 0.0, 0.0], 1, "", 0),
        (12, [], 1, "", 0), (13, [1.0, 0.0], 1, "", 0), (None, one, 1, "", 0), (14, [0.0, 1.0, 0.0], 1, "", 0),
    ]
    found = near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    links = {r.vec_id: (r.n_links, r.component_id) for r in found}
    assert links[1] == (2, 1) and links[2] == (2, 1) and links[3] == (2, 1)
    assert all(links[i] == (0, i) for i in range(4, 15)) and links[None] == (0, None)
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def links_of(spark, points):
    rows = [(i, [float(x) for x in p], 1, "x", 1) for i, p in enumerate(points)]
    found = {r.vec_id: r.n_links for r in near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    unit = np.asarray(points, dtype=np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.93) & ~np.eye(len(unit), dtype=bool)
    return np.array([found[i] for i in range(len(unit))]), linked.sum(axis=1)


def test_two_near_vectors(spark):
    reported, linked = links_of(spark, [[1.0, 0.0, 0.0], [0.995, 0.0998749, 0.0]])
    assert reported.tolist() == linked.tolist() == [1, 1]


@pytest.mark.parametrize("spread", [0.01, 0.03, 0.06])
def test_recall_in_a_narrow_cone(spark, spread):
    rng = np.random.default_rng(5)
    centre = np.ones(32) / np.sqrt(32)
    base = centre + rng.normal(size=(200, 32)) * spread
    points = np.concatenate([base, base[:60] + rng.normal(size=(60, 32)) * 0.02])
    reported, linked = links_of(spark, points)
    assert (reported <= linked).all() and reported.sum() >= 0.9 * linked.sum() > 50
