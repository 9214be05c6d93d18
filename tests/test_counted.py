"""Counting within radii: the columns between the radii of a row are sorted where they are many."""

import time

import numpy as np
import pytest

from feedloom.operators import counting
from feedloom.operators.blocks import rough_squares, squared_distances


def _case(seed, dim, m, n, weighted, squared, ties, digits=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x = x if digits is None else np.round(x, digits)  # rounded coordinates have many equal distances
    a, b = x[:60], x[20:]
    radii = np.take_along_axis(squared_distances(a, x), rng.integers(0, n, (len(a), m)), axis=1)
    radii = np.where(rng.random(radii.shape) < 0.1, -1.0, radii if squared else np.sqrt(radii))
    weights = rng.integers(1, 4, len(b)) if weighted else np.ones(len(b), np.int64)
    return a, b, radii, weights, rng.integers(0, len(b) + 1, (len(a), m)) if ties else None


@pytest.mark.parametrize("seed", range(12))
def test_counts_are_those_of_measured_distances(seed):
    squared = seed % 3 == 0
    a, b, radii, weights, below = _case(seed, [2, 5, 20][seed % 3], 1 + 3 * seed, 1200, seed % 2 == 0, squared, seed % 4 == 0, [None, 1, 0][seed // 4])
    d, off = rough_squares(a, b)
    exact = squared_distances(a, b)
    told = counting._weights_within(exact if squared else np.sqrt(exact), radii, weights, below)
    assert (counting._weights_about(a, b, d, off, radii, weights, squared, below) == told).all()


def test_time_hardly_grows_with_the_radii():
    def seconds(m):
        a, b, radii, weights, below = _case(1, 16, m, 4096, False, True, True)
        d, off = rough_squares(a, b)
        spent = []
        for _ in range(5):
            start = time.thread_time()
            counting._weights_about(a, b, d, off, radii, weights, True, below)
            spent.append(time.thread_time() - start)
        return min(spent)

    assert seconds(64) < 4 * seconds(4)
