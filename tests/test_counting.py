"""Counts within radii, core distances of any k, trustworthiness and quantiles, against brute force, in many small blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.operators import blocks, counting, knn, quality
from feedloom.operators import quantiles as quantile
from feedloom.plans import clustering
from feedloom.session import cut


def make(spark, groups):
    rows = [(g, f"{g}{i:04d}", [float(v) for v in p]) for g, x in groups.items() for i, p in enumerate(x)]
    return cut(spark.createDataFrame(rows, "grp string, pid string, xs array<double>"))


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(size=(150, 3)), rng.normal(size=(150, 3)) * 0.05 + 4, np.round(rng.normal(size=(100, 3)))])
    x[20:90] = x[20]
    grid = np.array([(i, j, 0.0) for i in range(12) for j in range(12)])  # many equal distances
    return {"a": x, "b": grid, "c": rng.normal(size=(40, 3)), "d": np.ones((1, 3))}


@pytest.fixture(scope="module")
def points(spark, groups):
    return make(spark, groups)


def distances(x):
    d = np.sqrt(blocks.squared_distances(x, x))
    np.fill_diagonal(d, np.inf)
    return np.sort(d, axis=1)


@pytest.mark.parametrize("k", [7, 250])
def test_cores_of_any_k(points, groups, k, monkeypatch):
    monkeypatch.setattr(counting, "LISTED", 8)
    got = {r.pid: r.core for r in knn.core_distances(points, k, rows=32).collect()}
    for g, x in groups.items():
        d = distances(x)
        for i in range(len(x)):
            want = d[i, min(k, len(x) - 1) - 1] if len(x) > 1 else 0.0
            assert abs(got[f"{g}{i:04d}"] - want) < 1e-12, (g, i)


def test_cores_in_many_dimensions(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([c + 0.1 * rng.normal(size=(60, 20)) for c in rng.normal(size=(5, 20))])
    for k in (3, 100):
        got = {r.pid: r.core for r in knn.core_distances(make(spark, {"g": x}), k, rows=25).collect()}
        d = distances(x)
        assert all(abs(got[f"g{i:04d}"] - d[i, k - 1]) < 1e-12 for i in range(len(x)))


def test_counts_of_weighted_points_with_ties(spark):
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(size=(120, 2)) * 2)
    x = np.unique(x, axis=0)
    weights = rng.integers(1, 5, len(x))
    rows = [("g", f"p{i:03d}", int(w), [float(v) for v in p]) for i, (p, w) in enumerate(zip(x, weights))]
    packed = blocks.pack(cut(spark.createDataFrame(rows, "grp string, rid string, weight long, xs array<double>")), 2, 10)
    places = F.sequence(F.lit(0), F.col("n") - 1)
    left = packed.select("*", places.alias("pos"), F.flatten(F.transform("ids", lambda _: F.array(F.lit(4.0), F.lit(9.0)))).alias("radii"),
                         F.flatten(F.transform("ids", lambda _: F.array(F.lit("p030"), F.lit("p010")))).alias("tied"), F.lit(2.0).alias("least"), F.lit(3.0).alias("bound"))
    left = cut(left)
    pairs = counting.block_pairs(left, packed, 2)
    got = counting.within(pairs, left, packed, 2, squared=True, ties=True).collect()
    ids = {(r.block, i): v for r in packed.collect() for i, v in enumerate(r.ids)}
    d = blocks.squared_distances(x, x)
    assert len(got) == len(x)
    for r in got:
        i = int(ids[r.block, r.pos][1:])
        for c, radius, tied in ((r.c0, 4.0, 30), (r.c1, 9.0, 10)):
            assert c == sum(weights[j] for j in range(len(x)) if j != i and (d[i, j] < radius or (d[i, j] == radius and j < tied)))


def brute_trust(full, flat, n_neighbors):
    """The definition: pids in order, ties of a distance by pid."""
    n = len(full)
    k = min(n_neighbors, max((n - 1) // 2, 1))
    lost = 0
    for i in range(n):
        far, near = (((x - x[i]) ** 2).sum(axis=1) for x in (full, flat))
        others = [j for j in range(n) if j != i]
        rank = {j: r for r, j in enumerate(sorted(others, key=lambda j: (far[j], j)), 1)}
        lost += sum(max(rank[j] - k, 0) for j in sorted(others, key=lambda j: (near[j], j))[:k])
    scale = n * k * (2 * n - 3 * k - 1)
    return 1.0 - 2.0 * lost / scale if scale > 0 else 1.0


@pytest.mark.parametrize("rows", [None, 24])
def test_trust(spark, rows):
    rng = np.random.default_rng(31)
    full = {"a": np.round(rng.normal(size=(130, 4)) * 4) / 4, "b": rng.integers(0, 3, size=(60, 4)).astype(float), "c": rng.normal(size=(3, 4)), "d": np.ones((1, 4))}
    full["a"][30:70] = full["a"][30]
    flat = {g: np.round((x[:, :2] + rng.integers(0, 2, size=(len(x), 2))) * 4) / 4 for g, x in full.items()}
    points, reduced = make(spark, full), make(spark, flat)
    k = F.when(F.col("grp") == "b", 9).otherwise(5)
    got = {r.grp: r for r in quality.trustworthiness(points, reduced, k, rows=rows).collect()}
    for g in full:
        assert abs(got[g].trustworthiness - brute_trust(full[g], flat[g], 9 if g == "b" else 5)) < 1e-12, g
        assert (got[g].n, got[g].n_group) == (len(full[g]),) * 2
    assert quality.trustworthiness(points.limit(0), reduced, 5).count() == 0


def test_relative_validity_of_trees(spark):
    edges = [("g", "a", "b", 1.0), ("g", "b", "c", 2.0), ("g", "c", "d", 5.0), ("g", "d", "e", 1.5), ("g", "e", "x", 7.0), ("g", "e", "f", 9.0),
             ("one", "a", "b", 1.0), ("one", "b", "x", 4.0), ("bare", "x", "y", 1.0), ("apart", "a", "x", 3.0), ("apart", "x", "b", 2.0)]
    marks = [("g", n, c, w) for n, c, w in (("a", 0, 1), ("b", 0, 2), ("c", 0, 1), ("d", 1, 1), ("e", 1, 1), ("x", -1, 3), ("f", 2, 1))]
    marks += [("one", "a", 0, 1), ("one", "b", 0, 1), ("one", "x", -1, 2), ("bare", "x", -1, 1), ("bare", "y", -1, 1), ("apart", "a", 0, 1), ("apart", "b", 1, 1), ("apart", "x", -1, 1)]
    got = {r.grp: r.relative_validity for r in quality.relative_validity(
        spark.createDataFrame(edges, "grp string, u string, v string, w double"), spark.createDataFrame(marks, "grp string, node string, cluster int, weight long")).collect()}
    g = (4 * (5 - 2) / 5 + 2 * (5 - 1.5) / 5 + 1 * (9 - 0) / 9) / 10
    assert got == {"g": pytest.approx(g), "one": pytest.approx(2 * (8 - 1) / 8 / 4), "bare": 0.0, "apart": pytest.approx(2 / 3)}


def test_validity_of_found_clusters(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([c + 0.2 * rng.normal(size=(40, 2)) for c in ((0, 0), (9, 0), (0, 9))])
    x[3:9] = x[3]
    points = make(spark, {"g": x})
    found, validity = clustering.measured_clusters(points, 4, 10)
    assert found.filter("cluster >= 0").select("cluster").distinct().count() == 3
    blurred = make(spark, {"g": x * 0.1 + rng.normal(size=x.shape)})
    _, worse = clustering.measured_clusters(blurred, 4, 10)
    assert 0.7 < validity.head().relative_validity <= 1 and worse.head().relative_validity < validity.head().relative_validity


@pytest.mark.parametrize("bins, left", [(4, 3), (1024, 10_000)])
def test_weighted_quantiles(spark, bins, left):
    rng = np.random.default_rng(4)
    rows = [("a", float(v), int(w)) for v, w in zip(rng.exponential(size=300) ** 3, rng.integers(1, 6, 300))] + [("b", 2.5, 1000)]
    rows += [("b", 2.5, 7), ("c", 1.0, 1), ("c", 4.0, 1), ("d", None, 3), ("e", -1.0, 10**9), ("e", 1.0, 10**9)]
    table = spark.createDataFrame(rows, "grp string, value double, weight long")
    for share in (0.0, 0.37, 0.5, 0.95, 1.0):
        got = {r.grp: r.value for r in quantile.weighted_quantile(table, share, bins, left).collect()}
        for g in "abc":
            listed = np.repeat([v for h, v, _ in rows if h == g], [w for h, _, w in rows if h == g])
            assert abs(got[g] - np.quantile(listed, share)) < 1e-9
        assert set(got) == set("abce") and got["e"] == (-1.0 if share < 0.5 else 0.0 if share == 0.5 else 1.0)
