"""Blocks in many dimensions: pivots, the pairs they spare, and equal results in one block and in many."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.operators import blocks, knn, linkage, mst
from feedloom.session import cut

DIM = 64


@pytest.fixture(scope="module")
def blobs(spark):
    """Twelve clusters in 64 dimensions, one of them of copies only."""
    rng = np.random.default_rng(21)
    centres = rng.normal(size=(12, DIM))
    x = np.concatenate([c + 0.15 * rng.normal(size=(50, DIM)) for c in centres])
    x[50:100] = x[50]
    rows = [("g", f"p{i:04d}", [float(v) for v in p]) for i, p in enumerate(x)]
    return x, cut(spark.createDataFrame(rows, "grp string, pid string, xs array<double>"))


def all_pairs(packed):
    n = packed.count()
    return n * n


def test_fewer_than_half_of_the_block_pairs_are_left(blobs):
    _, points = blobs
    packed = blocks.pack(cut(blocks.distinct_points(points)), DIM, 30)
    by = blocks.bounds_of(packed, DIM)
    seekers = packed.select("grp", "block", "lo", "hi", F.lit(3.0).alias("bound"))
    pairs = blocks.descend(seekers, blocks.tree_levels(packed, by.width), low=by.gap("a_", "b_"), keep=F.lit(True))
    assert packed.count() >= 15 and pairs.count() < 0.5 * all_pairs(packed)


def test_intervals_hold(blobs):
    x, points = blobs
    packed = blocks.pack(cut(blocks.distinct_points(points)), DIM, 30)
    rows = packed.select(F.struct("*").alias("a")).crossJoin(packed.select(F.struct("*").alias("b")))
    flat = rows.select("a.ids", F.col("b.ids").alias("others"), *[F.col(f"{s}.{n}").alias(f"{s}_{n}") for s in "ab" for n in ("lo", "hi")])
    flat = flat.select("ids", "others", blocks.pivot_gap("a_", "b_").alias("gap"), blocks.pivot_span("a_", "b_").alias("span"))
    for r in flat.collect():
        a, b = x[[int(i[1:]) for i in r.ids]], x[[int(i[1:]) for i in r.others]]
        d = np.sqrt(blocks.squared_distances(a, b))
        assert r.gap <= d.min() and d.max() <= r.span


def test_same_results_in_many_blocks(blobs):
    x, points = blobs
    d = np.sqrt(blocks.squared_distances(x, x))
    np.fill_diagonal(d, np.inf)
    near = {}
    for r in knn.knn_graph(points, 5, rows=30).collect():
        near.setdefault(r.pid, {})[r["rank"]] = (r.nbr, r.dist)
    for i in range(len(x)):
        want = sorted((d[i, j], f"p{j:04d}") for j in range(len(x)) if j != i)[:5]
        assert [near[f"p{i:04d}"][n][0] for n in range(1, 6)] == [pid for _, pid in want]
    total = sum(e.w for e in mst.minimum_spanning_tree(points, 0, rows=70).collect())
    assert abs(total - sum(e.w for e in mst.minimum_spanning_tree(points, 0).collect())) < 1e-9
    one, many = ({r.pid: (r.comp, r.core) for r in linkage.dbscan(points, 1.5, 4, rows=rows).collect()} for rows in (None, 30))
    assert one == many and len({c for c, _ in one.values() if c}) == 12


def test_no_points_and_equal_points(spark, blobs):
    _, points = blobs
    assert knn.knn_graph(points.limit(0), 3).count() == 0
    same = points.withColumn("xs", F.array_repeat(F.lit(1.0), DIM))
    assert {r.dist for r in knn.knn_graph(same, 3, rows=30).collect()} == {0.0}
