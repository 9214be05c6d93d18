"""Euclidean silhouettes against all pairs, in one block and in many."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.operators import silhouettes


def brute(x, names):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i, own in enumerate(names):
        mates = (names == own) & (np.arange(len(x)) != i)
        others = [d[i, names == c].mean() for c in set(names) - {own}]
        a, b = (d[i, mates].mean() if mates.any() else None), (min(others) if others else None)
        out.append(0.0 if a is None or b is None or max(a, b) == 0 else (b - a) / max(a, b))
    return out


@pytest.mark.parametrize("rows, centres", [(None, 512), (7, 3)])
def test_silhouettes_of_all_pairs(spark, rows, centres):
    rng = np.random.default_rng(2)
    data, want = [], {}
    made = {
        "apart": (rng.normal(0, 0.2, (90, 3)) + np.repeat(rng.random((10, 3)) * 9, 9, axis=0), np.repeat(np.arange(10), 9)),
        "mixed": (rng.random((80, 3)), rng.integers(0, 5, 80)),                        # no cluster lies apart
        "lone": (rng.random((12, 3)), np.arange(12)),                                  # one point each
        "one": (rng.random((9, 3)), np.zeros(9, dtype=int)),                           # a single cluster
        "copies": (np.repeat(np.eye(3), 8, axis=0), np.arange(24) % 4),                # ties and equal points in several clusters
        "same": (np.zeros((6, 3)), np.arange(6) % 2),
    }
    for grp, (x, names) in made.items():
        for i, s in enumerate(brute(x, names)):
            data.append((grp, f"{grp}{i:03d}", int(names[i]), x[i].tolist(), "extra"))
            want[f"{grp}{i:03d}"] = s
    data += [("apart", "x0", None, [0.0] * 3, "e"), ("apart", "x1", 1, None, "e"), ("apart", "x2", 1, [math.nan, 0.0, 0.0], "e"),
             ("apart", "x3", 1, [math.inf, 0.0, 0.0], "e"), ("apart", "x4", 1, [1.0], "e"), ("apart", "x5", 1, [None, 1.0, 1.0], "e")]
    labelled = spark.createDataFrame(data, "grp string, pid string, cluster int, xs array<double>, n string")
    got = {r.pid: r.silhouette for r in silhouettes.euclidean_silhouette_points(labelled, 3, rows, centres).collect()}
    assert set(got) == set(want) and all(abs(got[p] - want[p]) < 1e-9 for p in want)
    scores = {(r.grp, r.cluster): (r.score, r.n) for r in silhouettes.euclidean_silhouette(labelled, 3, rows, centres).collect()}
    assert scores["apart", None][1] == 90 and abs(scores["apart", None][0] - np.mean([s for p, s in want.items() if p.startswith("apart")])) < 1e-9
    assert silhouettes.euclidean_silhouette(labelled.filter(F.lit(False)), 3).count() == 0


def test_clusters_apart_are_not_compared(spark, monkeypatch):
    rng = np.random.default_rng(3)
    data = [("g", f"p{i:03d}", str(i % 6), (100.0 * (i % 6) ** 2 + rng.random(2)).tolist()) for i in range(120)]
    labelled = spark.createDataFrame(data, "grp string, pid string, cluster string, xs array<double>")
    seen = []
    plain = silhouettes.cut
    monkeypatch.setattr(silhouettes, "cut", lambda df: seen.append(plain(df)) or seen[-1])
    silhouettes.euclidean_silhouette_points(labelled, 2, 16).collect()
    asked = [df for df in seen if "low" in df.columns]
    assert [df.count() for df in asked] == [120]  # one other cluster a point, out of five
