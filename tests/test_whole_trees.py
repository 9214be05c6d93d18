"""Groups of short vectors above a block that one task makes a tree of, and the sample that pivots are fitted on."""

import numpy as np
from pyspark.sql import functions as F

from feedloom.operators import blocks, mst
from feedloom.session import cut


def make(spark, x):
    rows = [("a" if i % 3 else "b", f"p{i:04d}", [float(v) for v in p]) for i, p in enumerate(x)]
    return cut(spark.createDataFrame(rows, "grp string, pid string, xs array<double>"))


def edges(points, rows=None):
    return sorted((r.grp, min(r.u, r.v), max(r.u, r.v), round(r.w, 9)) for r in mst.minimum_spanning_tree(points, 4, rows).collect())


def test_short_vectors_take_no_rounds(spark, monkeypatch):
    x = np.random.default_rng(3).normal(size=(240, 3))
    x[50:60] = x[50]  # copies
    points = make(spark, x)
    want = edges(points, 48)
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 48)
    monkeypatch.setattr(blocks, "BLOCK_VALUES", 144)
    monkeypatch.setattr(mst, "_part_trees", None)  # rounds would fail
    assert edges(points) == want and len(want) == 238


def test_groups_above_the_bound_take_rounds(spark, monkeypatch):
    points = make(spark, np.random.default_rng(4).normal(size=(240, 3)))
    want = edges(points)
    monkeypatch.setattr(blocks, "block_rows", lambda dim, limit=None: limit or 48)
    monkeypatch.setattr(mst, "WHOLE_ROWS", 100)  # group b of 80 fits, a does not
    assert edges(points) == want


def test_pivots_are_chosen_from_rows_thinned_before(spark, monkeypatch):
    points = cut(spark.range(6000, numPartitions=4).select(
        F.col("id").cast("string").alias("rid"), F.array(F.col("id") % 17, F.col("id") % 23).cast("array<double>").alias("xs")))
    want = blocks.choose_pivots(points.orderBy(F.xxhash64("rid"), "rid").limit(200), 8, 200)
    asked, order = [], type(points).orderBy
    monkeypatch.setattr(type(points), "orderBy", lambda self, *by: (asked.append(self.count()), order(self, *by))[1])
    assert (blocks.choose_pivots(points, 8, 200) == want).all()
    assert max(asked) < 1200


def test_pivots_of_ids_that_repeat(spark):
    same = cut(spark.range(3000).select(F.lit("x").alias("rid"), F.array(F.col("id").cast("double")).alias("xs")))
    assert len(blocks.choose_pivots(same, 4, 100)) == 4
