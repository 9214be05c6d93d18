"""Trees of groups in several blocks, made from a first tree and one look at the block pairs."""

import numpy as np
import pytest

from feedloom.operators import mst, seeded
from feedloom.operators.blocks import box_squares, squared_distances
from feedloom.operators.components import find_roots
from feedloom.session import cut


def _points(spark, groups):
    rows = [(grp, f"p{(i * 7919) % 100_003:06d}", [float(v) for v in p]) for grp, x in groups.items() for i, p in enumerate(x)]
    return cut(spark.createDataFrame(rows, "grp string, pid string, xs array<double>"))


def _edges(points, k, rows=None):
    return sorted((r.grp, min(r.u, r.v), max(r.u, r.v), r.w) for r in mst.spanning_trees(points, k, rows)[0].collect())


@pytest.mark.parametrize("dim, k", [(3, 12), (12, 4), (8, 0)])
def test_same_tree_as_in_one_task_without_rounds(spark, monkeypatch, dim, k):
    rng = np.random.default_rng(dim)
    blobs = np.concatenate([rng.normal(size=(70, dim)) * 0.1 + np.eye(dim)[i % dim] * (i + 1) for i in range(4)])
    groups = {"blobs": blobs, "ties": rng.integers(0, 4, size=(200, dim)), "line": np.outer(np.arange(150.0) ** 2, np.ones(dim)), "small": rng.normal(size=(10, dim))}
    points = _points(spark, groups)
    want = _edges(points, k)
    monkeypatch.setattr(mst, "_part_trees", None)  # rounds would fail
    monkeypatch.setattr(seeded, "NEAR_BLOCKS", 2)
    monkeypatch.setattr(seeded, "LIST", 3)
    assert _edges(points, k, rows=32) == want


def test_a_poor_first_tree_changes_nothing(spark, monkeypatch):
    points = _points(spark, {"a": np.random.default_rng(9).normal(size=(160, 2))})
    want = _edges(points, 3)
    monkeypatch.setattr(mst, "_part_trees", None)
    monkeypatch.setattr(seeded, "NEAR_BLOCKS", 0)
    monkeypatch.setattr(seeded, "LIST", 1)
    monkeypatch.setattr(seeded, "ANCHORS", 1)
    assert _edges(points, 3, rows=24) == want


@pytest.mark.parametrize("seed", range(5))
def test_least_forest(seed):
    rng = np.random.default_rng(seed)
    n, m = 40, [10, 39, 60, 200, 400][seed]
    u, v = rng.integers(0, n, m), rng.integers(0, n, m)
    want, parent = [], list(range(n))
    for e, (a, b) in enumerate(zip(u, v)):
        if parent[a] != parent[b]:
            want.append(e)
            parent = [parent[a] if p == parent[b] else p for p in parent]
    kept, comp = seeded.least_forest(n, u, v)
    assert kept.tolist() == want
    roots = find_roots(u.tolist(), v.tolist())
    assert len(set(zip(comp.tolist(), parent))) == len(set(comp.tolist())) == len(set(parent)) and all(comp[x] == comp[r] for x, r in roots.items())


def test_no_point_is_nearer_than_the_box():
    rng = np.random.default_rng(1)
    for dim in (1, 3, 9):
        a, b = rng.normal(size=(50, dim)) * 3, rng.normal(size=(30, dim))
        assert (box_squares(a, b)[:, None] <= squared_distances(a, b)).all()
