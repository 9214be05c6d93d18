"""Average and complete linkage up to a threshold in groups above one block, against the whole distance matrix."""

import numpy as np
import pytest

from feedloom.operators import linkage
from tests.test_linkages import make, parts


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(23)
    tight = [c + rng.uniform(-0.2, 0.2, size=(50, 3)) for c in ((0, 0, 0), (6, 0, 0))]  # one cluster each, more points than a block takes
    loose = [c + np.cumsum(rng.uniform(0, 0.6, size=(20, 3)), axis=0) for c in ((0, 20, 0), (30, 0, 0), (0, 0, 40))]  # links, but several clusters
    x = np.concatenate([*tight, *loose, rng.uniform(60, 90, size=(15, 3))])
    x[10:20] = x[10]  # copies
    return make(spark, {"a": x, "b": x[100:118] * 1.5, "c": np.ones((1, 3))})


@pytest.mark.parametrize("method", ["average", "complete"])
def test_large_groups(points, method):
    want = parts(linkage.agglomerative(points, distance_threshold=0.9, method=method))
    assert parts(linkage.agglomerative(points, distance_threshold=0.9, rows=24, method=method)) == want
    assert frozenset(range(50)) in want["a"] and len(want["a"]) > 20


def test_least_ids(points):
    rows = linkage.agglomerative(points, distance_threshold=0.9, rows=24, method="average").collect()
    members = {}
    for r in rows:
        members.setdefault((r.grp, r.comp), []).append(r.pid)
    assert len(rows) == 194 and all(comp == min(pids) for (_, comp), pids in members.items())


def test_wide_parts_are_refused(spark):
    line = make(spark, {"a": np.arange(60.0)[:, None] * np.ones((1, 3))})
    with pytest.raises(ValueError, match="at most 24"):
        linkage.agglomerative(line, distance_threshold=2.0, rows=24, method="average")
