"""Rough distances by a matrix product must decide like measured ones, to the last bit, ties and copies included."""

import numpy as np
import pytest

from feedloom.operators import blocks, counting, hierarchy, knn, linkage, mst, silhouettes


@pytest.fixture(scope="module", params=["spread", "grid", "far", "short"])
def sides(request):
    rng = np.random.default_rng(3)
    if request.param == "spread":
        a, b = rng.normal(size=(200, 20)), rng.normal(size=(300, 20))
    elif request.param == "short":
        a, b = rng.normal(size=(200, 5)), rng.normal(size=(300, 5))
    elif request.param == "grid":  # many equal distances
        a, b = np.round(rng.normal(size=(200, 12))), np.round(rng.normal(size=(300, 12)))
    else:  # near points far from the origin: rough distances say little
        a, b = 1e6 + 1e-4 * rng.normal(size=(200, 20)), 1e6 + 1e-4 * rng.normal(size=(300, 20))
    b[:40] = a[:40]
    return a, b


def test_rough_squares(sides):
    a, b = sides
    exact = blocks.squared_distances(a, b)
    rough, off = blocks.rough_squares(a, b)
    assert off.all() and (np.abs(rough - exact) <= off[:, None]).all()
    rows, cols = np.nonzero(exact >= 0)
    assert (blocks.squares_at(a, b, rows, cols) == exact.ravel()).all()
    b[0, 0], before = np.inf, b[0, 0]
    rough, off = blocks.rough_squares(a, b)
    b[0, 0] = before
    assert not off.any() and (rough[:, 1:] == exact[:, 1:]).all()


@pytest.mark.parametrize("k, capped", [(3, False), (3, True), (400, False)])
def test_nearest(sides, k, capped):
    a, b = sides
    exact = blocks.squared_distances(a, b)
    cap = np.sqrt(np.sort(exact, axis=1)[:, 4]) if capped else None
    got = [np.concatenate(part) for part in zip(*knn._nearest(a, b, k, own=False, cap=cap))]
    want = []
    for i, d in enumerate(exact):
        order = np.argsort(d, kind="stable")[:k]
        want += [(i, j, np.sqrt(d[j])) for j in order if cap is None or d[j] <= cap[i] ** 2 * (1 + 1e-9)]
    assert [*zip(*got)] == want
    alone = [np.concatenate(part) for part in zip(*knn._nearest(b, b, 2, own=True))]
    assert (alone[0] != alone[1]).all() and len(alone[0]) == 2 * len(b)


@pytest.mark.parametrize("squared, ties", [(False, False), (True, True)])
def test_counts(sides, squared, ties):
    a, b = sides
    exact = blocks.squared_distances(a, b)
    ends = np.sort(exact if squared else np.sqrt(exact), axis=1)[:, [0, 3, 30, 200]]  # radii at which points lie
    ends[::7, 1] = -1.0
    rng = np.random.default_rng(8)
    below = rng.integers(0, 300, ends.shape) if ties else None
    rough, off = blocks.rough_squares(a, b)
    for weights in (np.ones(300, np.int64), rng.integers(1, 9, 300)):
        want = counting._weights_within(exact if squared else np.sqrt(exact), ends, weights, below)
        assert (counting._weights_about(a, b, rough, off, ends, weights, squared, below) == want).all()


def test_least_edges_and_merges(sides):
    a, b = sides
    rng = np.random.default_rng(2)
    ca, cb, same = rng.random(200) * 2, rng.random(300) * 2, rng.random((200, 300)) < 0.3
    same[5] = True
    d = np.maximum(np.sqrt(blocks.squared_distances(a, b)), np.maximum(ca[:, None], cb[None, :]))
    d[same] = np.inf
    for cores in ((ca, cb), (np.zeros(200), np.zeros(300))):
        d = np.maximum(np.sqrt(blocks.squared_distances(a, b)), np.maximum(cores[0][:, None], cores[1][None, :]))
        d[same] = np.inf
        column, weight = mst._least(a, b, *cores, same)
        assert (column == d.argmin(axis=1)).all() and (weight == d.min(axis=1)).all()
    wa, wb = rng.integers(1, 9, 200).astype(float), rng.integers(1, 9, 300).astype(float)
    d = blocks.squared_distances(a, b) * (2 * wa[:, None] * wb / (wa[:, None] + wb))
    at, best = hierarchy._least_ward(a, b, wa, wb, None)
    assert (at == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    own = np.arange(200) + 7
    d[np.arange(200), own] = np.inf
    at, best = hierarchy._least_ward(a, b, wa, wb, own)
    assert (at == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()


def test_near_and_summed(sides):
    a, b = sides
    d = np.sqrt(blocks.squared_distances(a, b))
    for eps in (0.0, float(d[50, 60]), float(np.median(d))):
        assert (np.concatenate([close for _, close in linkage._near(a, b, eps)]) == (d <= eps)).all()
    assert np.allclose(silhouettes._distances(a, b), d, rtol=1e-9, atol=1e-9) and (silhouettes._distances(a, b)[np.arange(40), np.arange(40)] == 0).all()
