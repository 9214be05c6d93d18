"""Neighbours, trees and clusters against small brute-force versions, in one block and in many."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.operators import adaptive, components, density, kmeans, knn, linkage, mst, quality, reduce
from feedloom.session import cut

K = 4


def brute_mst(x, core):
    m = np.maximum(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), np.maximum(core[:, None], core[None]))
    i, j = np.triu_indices(len(x), 1)
    parent, weights = list(range(len(x))), []

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for e in np.argsort(m[i, j], kind="stable"):
        a, b = root(i[e]), root(j[e])
        if a != b:
            parent[a] = b
            weights.append(m[i[e], j[e]])
    return np.sort(weights)


def brute_density(x, core, least):
    """Top-down condensed tree on the full distance graph, by the definition: remove edges from the
    longest, keep parts of at least `least` points, choose clusters by excess of mass."""
    m = np.maximum(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), np.maximum(core[:, None], core[None]))
    np.fill_diagonal(m, 0)

    def parts(members, below):
        left, out = set(members), []
        while left:
            stack, part = [left.pop()], []
            while stack:
                a = stack.pop()
                part.append(a)
                for b in [b for b in left if m[a, b] < below]:
                    left.remove(b)
                    stack.append(b)
            out.append(sorted(part))
        return out

    def grow(members, birth):
        """(stability, chosen clusters) of the cluster born at density `birth`."""
        exits, now = 0.0, members
        for w in sorted({m[a, b] for a in members for b in members if a < b}, reverse=True):
            split = parts(now, w)
            if len(split) == 1:
                continue
            big = [p for p in split if len(p) >= least]
            lam = 1 / w
            exits += sum(len(p) for p in split if len(p) < least) * (lam - birth)
            if len(big) == 1:
                now = big[0]
                continue
            exits += sum(len(p) for p in big) * (lam - birth)
            below = [grow(p, lam) for p in big]
            inner = sum(s for s, _ in below)
            if birth > 0 and exits >= inner:
                return exits, [members]
            return inner, [c for _, cs in below for c in cs]
        return exits, [members] if birth > 0 else []

    return {frozenset(c) for c in grow(list(range(len(x))), 0.0)[1]}


def make(spark, groups):
    rows = [(g, f"{g}{i:04d}", [float(v) for v in p]) for g, x in groups.items() for i, p in enumerate(x)]
    return cut(spark.createDataFrame(rows, "grp string, pid string, xs array<double>"))


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(11)
    blobs = np.concatenate([rng.normal(size=(40, 3)) * 0.3 + c for c in [(0, 0, 0), (4, 0, 0), (4, 1.6, 0)]] + [rng.uniform(-2, 6, size=(20, 3))])
    copies = rng.normal(size=(60, 3))
    copies[10:40] = copies[10]
    return {"a": blobs, "b": copies, "c": rng.normal(size=(3, 3))}


@pytest.fixture(scope="module")
def points(spark, groups):
    return make(spark, groups)


@pytest.fixture(scope="module")
def near(groups):
    """Per group: sorted (distance, id) lists."""
    out = {}
    for g, x in groups.items():
        d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
        for i in range(len(x)):
            out[f"{g}{i:04d}"] = sorted((d[i, j], f"{g}{j:04d}") for j in range(len(x)) if j != i)
    return out


@pytest.mark.parametrize("rows", [None, 20])
def test_neighbours_and_cores(points, near, rows):
    got = {}
    for r in knn.knn_graph(points, K, rows=rows).collect():
        got.setdefault(r.pid, []).append((r["rank"], r.nbr, r.dist))
    assert set(got) == set(near)
    for pid, listed in got.items():
        want = near[pid][:K]
        listed.sort()
        assert [n for _, n, _ in listed] == [n for _, n in want]
        assert np.allclose([d for _, _, d in listed], [d for d, _ in want])
    cores = {r.pid: r.core for r in knn.core_distances(points, K, rows=rows).collect()}
    assert all(abs(cores[p] - near[p][min(K, len(near[p])) - 1][0]) < 1e-9 for p in near)


@pytest.mark.parametrize("rows", [None, 48])
def test_spanning_trees(points, groups, near, rows):
    edges = mst.minimum_spanning_tree(points, K, rows=rows).collect()
    for g, x in groups.items():
        core = np.array([near[f"{g}{i:04d}"][min(K, len(x) - 1) - 1][0] for i in range(len(x))])
        got = np.sort([e.w for e in edges if e.grp == g])
        assert np.allclose(got, brute_mst(x, core))
        assert len(set(components.find_roots([e.u for e in edges if e.grp == g], [e.v for e in edges if e.grp == g]).values())) == 1


def labelled(points, least, local, rows=None):
    edges, nodes, distinct = mst.spanning_trees(points, K, rows)
    nodes = nodes.withColumn("min_cluster_size", F.lit(least)).withColumn("epsilon", F.lit(0.0))
    found = density.density_clusters(edges, nodes, local)
    members = points.join(distinct.select("grp", "rid", "xs"), ["grp", "xs"]).select("grp", "rid", "pid")
    return {r.pid: r for r in members.join(found, ["grp", "rid"]).collect()}


@pytest.mark.parametrize("local", [10**6, 0])
def test_density_clusters_by_definition(points, groups, near, local):
    got = labelled(points, 10, local)
    x = groups["a"]
    core = np.array([near[f"a{i:04d}"][K - 1][0] for i in range(len(x))])
    want = brute_density(x, core, 10)
    mine = {}
    for pid, r in got.items():
        if pid[0] == "a" and r.cluster >= 0:
            mine.setdefault(r.cluster, set()).add(int(pid[1:]))
    assert {frozenset(c) for c in mine.values()} == want and len(want) >= 2
    assert all(r.cluster == -1 and r.persistence is None for p, r in got.items() if p[0] == "c")
    assert all(0 <= r.probability <= 1 for r in got.values())
    sizes = [len(mine[c]) for c in sorted(mine)]
    assert sizes == sorted(sizes, reverse=True)


def test_both_condensing_paths_agree(points):
    one, other = labelled(points, 8, 10**6), labelled(points, 8, 0, rows=48)
    assert set(one) == set(other)
    for pid, r in one.items():
        s = other[pid]
        assert (r.cluster, r.weight) == (s.cluster, s.weight) and abs(r.probability - s.probability) < 1e-9
        assert (r.persistence is None) == (s.persistence is None)
        assert r.persistence is None or abs(r.persistence - s.persistence) < 1e-9


def test_epsilon_joins_close_clusters(spark):
    edges = [(0, 1, 0.05), (2, 3, 0.06), (0, 2, 1.0)]
    tree = density.LeafTree(4, edges)
    count, lam = np.full(tree.size, 0.0), np.zeros(tree.size)
    count[:4], lam[:4] = 10, 10 * 100.0
    first = ["a", "b", "c", "d"] + [None] * (tree.size - 4)
    fine, _, _ = tree.select(count, lam, np.full(tree.size, 100.0), first, 0.0)
    coarse, _, _ = tree.select(count, lam, np.full(tree.size, 100.0), first, 0.1)
    assert len(set(fine[:4])) == 4 and list(coarse[:4]) == [0, 0, 1, 1]


@pytest.mark.parametrize("local", [10**6, 0])
def test_components_of_a_long_chain_a_hub_and_a_loop(spark, local):
    chain = [("g", f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)]
    hub = [("g", "x000", f"x{i:03d}") for i in range(1, 80)]
    other = [("h", "n000", "n050"), ("h", "z", "z")]
    got = {(r.grp, r.node): r.comp for r in components.components(
        spark.createDataFrame(chain + hub + other, "grp string, u string, v string"), local).collect()}
    assert {got["g", f"n{i:03d}"] for i in range(61)} == {"n000"} and {got["g", f"x{i:03d}"] for i in range(80)} == {"x000"}
    assert got["h", "n050"] == "n000" and got["h", "z"] == "z" and len(got) == 61 + 80 + 3


@pytest.mark.parametrize("rows", [None, 48])
def test_dbscan(points, groups, near, rows):
    eps, least = 0.6, 5
    got = {r.pid: r for r in linkage.dbscan(points, eps, least, rows=rows).collect()}
    core = {p for p, n in near.items() if sum(d <= eps for d, _ in n) + 1 >= least}
    roots = components.find_roots(*map(list, zip(*[(p, q) for p in core for d, q in [(0, p), *near[p]] if d <= eps and q in core])))
    for pid in near:
        close = [(d, q) for d, q in near[pid] if d <= eps and q in core]
        want = roots[pid] if pid in core else roots[min(close)[1]] if close else None
        assert (got[pid].comp, got[pid].core) == (want, pid in core)


@pytest.mark.parametrize("rows", [None, 48])
def test_single_linkage(points, near, rows):
    cut_at = {r.pid: r.comp for r in linkage.agglomerative(points, distance_threshold=0.9, rows=rows).collect()}
    roots = components.find_roots(*map(list, zip(*[(p, q) for p in near for d, q in [(0, p), *near[p]] if d <= 0.9])))
    assert cut_at == roots


def test_single_linkage_into_parts(points):
    parts = linkage.numbered(cut(linkage.agglomerative(points, n_clusters=3))).collect()
    for g in "abc":
        assert {r.cluster for r in parts if r.grp == g} == {0, 1, 2}
    with pytest.raises(ValueError):
        linkage.agglomerative(points)


def test_reduction_is_the_principal_plane(spark):
    rng = np.random.default_rng(5)
    x = {g: rng.normal(size=(n, 6)) @ rng.normal(size=(6, 6)) for g, n in (("a", 50), ("b", 30))}
    x["a"][4] = 0
    got = {r.pid: np.array(r.xs) for r in reduce.reduce_vectors(make(spark, x), 2).collect()}
    assert "a0004" not in got and len(got) == 79
    for g, rows in x.items():
        keep = np.any(rows, axis=1)
        u = rows[keep] / np.linalg.norm(rows[keep], axis=1, keepdims=True)
        u = u - u.mean(axis=0)
        want = u @ np.linalg.svd(u, full_matrices=False)[2][:2].T
        mine = np.array([got[f"{g}{i:04d}"] for i in np.flatnonzero(keep)])
        assert np.allclose(np.abs(mine), np.abs(want), atol=1e-9)


def test_kmeans_on_separate_groups(spark):
    rng = np.random.default_rng(42)
    x = np.concatenate([rng.normal(size=(10, 2)) * 0.1 + c for c in [(0, 0), (5, 5), (10, 0)]])
    p = make(spark, {"g": x, "h": x * 2 + 1})
    found = kmeans.assign(p, kmeans.fit(p, 3, 2)).collect()
    for g in "gh":
        lists = [tuple(sorted(r.pid for r in found if r.grp == g and r.cluster == c)) for c in range(3)]
        assert sorted(len(m) for m in lists) == [10, 10, 10]
        assert all(len({int(p_[1:]) // 10 for p_ in m}) == 1 for m in lists)


def test_trust_of_the_identity_and_sampling(spark, points):
    rows = {r.grp: r for r in quality.trustworthiness(points, points, 5).collect()}
    assert rows["a"].trustworthiness == 1.0 and rows["a"].n == 140
    few = {r.grp: r.n for r in quality.trustworthiness(points, points, 5, sample=50).collect()}
    assert few == {"a": 50, "b": 50, "c": 3}
    a, b = [sorted(r.pid for r in quality.hash_sample(points.repartition(n), 20).collect()) for n in (2, 5)]
    assert a == b


# --- rules -----------------------------------------------------------------------------------

def rule(spark, column):
    return spark.range(1).select(column).head()[0]


@pytest.mark.parametrize("depth, n, components_, want", [
    (0, 1000, 8, 16), (0, 400, 8, 16), (3, 1000, 8, 16), (0, 100, 8, 16), (0, 10000, 3, 30), (0, 1000, 3, 15), (2, 1000, 3, 11), (0, 60, 2, 4)])
def test_neighbour_rule(spark, depth, n, components_, want):
    assert rule(spark, adaptive.neighbour_params(F.lit(depth), F.lit(n), components_))["n_neighbors"] == want


@pytest.mark.parametrize("depth, n, want", [
    (0, 50, (5, 3, 0.0)), (0, 400, (8, 4, 0.0)), (0, 1000, (20, 10, 0.0)), (0, 5000, (100, 50, 0.0)), (1, 5000, (60, 30, 0.0)),
    (2, 300, (8, 4, 0.1)), (2, 600, (10, 5, 0.0)), (0, 20, (4, 3, 0.0))])
def test_density_rule(spark, depth, n, want):
    assert tuple(rule(spark, adaptive.density_params(F.lit(depth), F.lit(n)))) == want


@pytest.mark.parametrize("depth, n, k, persistence, noise, want", [
    (0, 50, 0, None, None, True), (0, 49, 0, None, None, False), (1, 64, 0, None, None, False), (1, 65, 0, None, None, True),
    (3, 1000, 0, None, None, False), (1, 100, 5, 0.07, 0.1, False), (1, 100, 5, 0.08, 0.1, True), (1, 100, 11, 0.5, 0.1, False),
    (1, 100, 5, 0.5, 0.51, False), (1, 100, 5, 0.5, 0.5, True), (0, 100, 5, 0.05, 0.1, True)])
def test_recursion_rule(spark, depth, n, k, persistence, noise, want):
    value = lambda v: F.lit(v).cast("double")
    assert rule(spark, adaptive.should_recurse(F.lit(depth), F.lit(n), 3, F.lit(k), value(persistence), value(noise))) is want


def test_seeding_takes_the_same_passes_for_any_k(spark, monkeypatch):
    rng = np.random.default_rng(14)
    x = np.concatenate([c + 0.05 * rng.normal(size=(15, 4)) for c in rng.normal(size=(20, 4)) * 5])
    p = make(spark, {"g": x, "few": x[:3], "same": np.ones((9, 4))})
    passes = []
    plain = kmeans.assign
    monkeypatch.setattr(kmeans, "assign", lambda points, centres: passes.append(1) or plain(points, centres))
    counts = {}
    for k in (2, 20):
        passes.clear()
        starts = {r.grp: np.array(r.centres) for r in kmeans.oversampled_start(p, k).collect()}
        counts[k] = len(passes)
        assert len(starts["g"]) == k and len(starts["few"]) == min(k, 3) and len(starts["same"]) == 1
    assert counts[20] <= counts[2] + 2
    # every cluster has a start
    assert len({int(((x - c) ** 2).sum(axis=1).argmin()) // 15 for c in starts["g"]}) == 20
    again = {r.grp: np.array(r.centres) for r in kmeans.oversampled_start(p.repartition(5), 20).collect()}
    assert np.allclose(again["g"], starts["g"])
