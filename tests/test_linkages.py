"""Ward, average and complete linkage against merging by the definition, one pair at a time."""

import numpy as np
import pytest

from feedloom.operators import hierarchy, linkage
from feedloom.session import cut


def brute(x, method):
    """Partitions after every merge: {number of clusters: set of frozensets}, and the heights."""
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    clusters, heights, stages = [[i] for i in range(len(x))], [], {len(x): {frozenset([i]) for i in range(len(x))}}

    def between(a, b):
        if method == "ward":
            gap = ((x[a].mean(axis=0) - x[b].mean(axis=0)) ** 2).sum()
            return np.sqrt(2 * len(a) * len(b) / (len(a) + len(b)) * gap)
        part = d[np.ix_(a, b)]
        return part.mean() if method == "average" else part.max()

    table = np.array([[between(a, b) if a is not b else np.inf for b in clusters] for a in clusters])
    while len(clusters) > 1:
        i, j = np.unravel_index(table.argmin(), table.shape)
        heights.append(table[i, j])
        clusters[i] = clusters[i] + clusters[j]
        del clusters[j]
        table = np.delete(np.delete(table, j, 0), j, 1)
        i -= j < i
        for n in range(len(clusters)):
            table[i, n] = table[n, i] = between(clusters[i], clusters[n]) if n != i else np.inf
        stages[len(clusters)] = {frozenset(c) for c in clusters}
    return stages, np.array(heights)


def make(spark, groups):
    rows = [(g, f"{g}{i:04d}", [float(v) for v in p]) for g, x in groups.items() for i, p in enumerate(x)]
    return cut(spark.createDataFrame(rows, "grp string, pid string, xs array<double>"))


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(41)
    x = np.concatenate([c + rng.normal(size=(45, 3)) * s for c, s in (((0, 0, 0), 1.0), ((5, 0, 0), 0.4), ((0, 6, 0), 0.8), ((3, 3, 3), 0.2))])
    x[100:120] = x[100]  # copies
    return {"a": np.concatenate([x, rng.uniform(-3, 8, size=(20, 3))]), "b": rng.normal(size=(30, 3)), "c": np.ones((1, 3))}


def parts(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.grp, {}).setdefault(r.comp, set()).add(int(r.pid[1:]))
    return {g: {frozenset(m) for m in c.values()} for g, c in out.items()}


@pytest.mark.parametrize("method, rows", [("ward", None), ("ward", 24), ("average", None), ("complete", None)])
def test_linkage_by_definition(spark, groups, method, rows):
    points = make(spark, groups)
    for n in (1, 4, 9) if rows is None else (9,):
        got = parts(linkage.agglomerative(points, n_clusters=n, rows=rows, method=method))
        for g in "ab":
            assert got[g] == brute(groups[g], method)[0][n], (g, n)
        assert got["c"] == {frozenset([0])}
    if rows is not None:
        return
    stages, heights = brute(groups["a"], method)
    height = (heights[-3] + heights[-4]) / 2
    assert parts(linkage.agglomerative(points, distance_threshold=float(height), rows=rows, method=method))["a"] == stages[4]


def test_refusals(spark, groups):
    points = make(spark, groups)
    with pytest.raises(ValueError, match="at most 24"):
        linkage.agglomerative(points, n_clusters=2, rows=24, method="average")
    with pytest.raises(ValueError, match="unknown linkage"):
        linkage.agglomerative(points, n_clusters=2, method="median")
    assert linkage.agglomerative(points.limit(0), n_clusters=2, method="ward").count() == 0


def test_chain_heights():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 5))
    for method in hierarchy.METHODS:
        got = sorted(w for _, _, w in hierarchy.chain_merges(x, np.ones(60, int), method))
        assert np.allclose(got, np.sort(brute(x, method)[1]))


@pytest.mark.parametrize("n, dim", [(300, 3), (260, 20)])
def test_chains_over_centres_give_the_tree_of_the_matrix(n, dim):
    rng = np.random.default_rng(n)
    x, weights = rng.normal(size=(n, dim)), rng.integers(1, 4, n)
    want, got = hierarchy.chain_merges(x, weights, "ward"), hierarchy.centre_merges(x, weights)
    assert sorted(m[:2] for m in got) == sorted(m[:2] for m in want)
    assert np.allclose(sorted(m[2] for m in got), sorted(m[2] for m in want))


def test_chains_over_centres_of_a_grid():
    """Many equal distances: every cluster is merged once, along a tree."""
    x = np.array([(i % 8, i // 8) for i in range(64)], float)
    merges = hierarchy.centre_merges(x, np.ones(64, int))
    assert len({gone for _, gone, _ in merges}) == 63 and len(hierarchy.centre_merges(x[:1], np.ones(1, int))) == 0
    assert sum(h * h for _, _, h in merges) / 2 == pytest.approx(((x - x.mean(axis=0)) ** 2).sum())


def test_groups_above_a_block_are_merged_in_one_task(spark, monkeypatch):
    """Ward's linkage needs no rounds where the centres of a group fit a task."""
    rng = np.random.default_rng(5)
    points = make(spark, {"a": np.concatenate([c + rng.normal(size=(40, 3)) * 0.1 for c in ((0, 0, 0), (5, 0, 0), (0, 5, 0))])})
    want = parts(linkage.agglomerative(points, n_clusters=3, method="ward"))
    monkeypatch.setattr(hierarchy, "block_rows", lambda dim, limit=None: limit or 24)
    monkeypatch.setattr(hierarchy, "_ward_rounds", None)
    assert parts(linkage.agglomerative(points, n_clusters=3, method="ward")) == want
    assert {len(c) for c in want["a"]} == {40}
