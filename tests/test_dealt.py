"""Packed blocks are little data and much work: they are dealt to tasks by number, not by bytes."""

import numpy as np
from pyspark.sql import functions as F

from feedloom.operators import blocks, counting, knn
from feedloom.session import cut


def packed(spark, n):
    rows = spark.range(n, numPartitions=1).select(F.lit("g").alias("grp"), F.col("id").alias("block"), F.lit(1).alias("dim"), F.array(F.col("id").cast("double")).alias("xs"))
    return cut(rows)


def per_task(rows):
    return sorted(r["n"] for r in rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())


def test_blocks_are_dealt_evenly(spark):
    cores = spark.sparkContext.defaultParallelism
    n = 3 * blocks.TASKS_PER_CORE * cores
    rows = blocks.dealt(packed(spark, n))
    assert per_task(rows) == [3] * (blocks.TASKS_PER_CORE * cores)
    assert sorted(r.block for r in rows.collect()) == list(range(n))


def test_pairs_are_dealt_evenly_and_bounded(spark):
    left = packed(spark, 40)
    pairs = left.select("grp", "block").join(left.select("grp", F.col("block").alias("other")), "grp")
    rows = knn.pair_rows(pairs, left, left, ["dim", "xs"], ["xs"], 4)
    counts = per_task(rows)
    assert sum(counts) == 1600 and max(counts) <= 8 and len(counts) >= 200
    assert {(r.block, r.other) for r in rows.collect()} == {(i, j) for i in range(40) for j in range(40)}
    assert rows.filter("xs[0] <> block OR o_xs[0] <> other").count() == 0


def test_counts_of_short_vectors_meet_only_what_lies_between_the_radii():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 5, (40, 2)).astype(float), rng.integers(0, 5, (60, 2)).astype(float)
    radii = np.sort(rng.integers(0, 5, (40, 6)).astype(float), axis=1)
    radii[0] = -1
    weights, below = rng.integers(1, 4, 60), rng.integers(0, 60, (40, 6))
    d, off = blocks.rough_squares(a, b)
    for ties in (None, below):
        assert (counting._weights_about(a, b, d, off, radii, weights, False, ties) == counting._weights_within(np.sqrt(d), radii, weights, ties)).all()
        assert (counting._weights_about(a, b, d, off, radii, weights, True, ties) == counting._weights_within(d, radii, weights, ties)).all()
