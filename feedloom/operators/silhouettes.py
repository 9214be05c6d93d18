"""Silhouettes under Euclidean distance, exact and without all pairs of a group (C20).

A silhouette needs a point's mean distance to its own cluster and to the nearest other one.  Which one is nearest is
told from summaries as far as possible: the mean distance to a cluster is at least the distance to its centre and at most
the root of the mean squared distance, which the centre and the mean squared length give.  Distances to members are taken for
the own cluster and for the clusters whose least possible mean is within the smallest greatest one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.blocks import block_rows, coords, rough_squares, squares_at, values
from feedloom.operators.numbering import ranked
from feedloom.operators.quality import centroids
from feedloom.session import cut

CENTRES = 512     # centres that a block of points meets at once
STRIPE = 256      # rows whose distances are held at once
SHORT = 1e8       # squares of less than so many times their rounding error are measured again
ROUNDING = 1e-9   # bounds are taken so much wider, relative to the squared lengths


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances; short ones are summed by coordinate, so that equal points are exactly 0 apart."""
    out, off = rough_squares(a, b)
    if off.any():
        rows, cols = np.nonzero(out <= (SHORT * off)[:, None])
        out[rows, cols] = squares_at(a, b, rows, cols)
    return np.sqrt(out)


def _candidates(kind: pa.DataType):
    """For a block of points and some centres of other clusters: the clusters that may be nearest, with bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim, own = batch.column("dim")[i].as_py(), batch.column("cluster")[i].as_py()
                names = batch.column("names")[i].as_py()
                others = np.array([j for j, name in enumerate(names) if name != own], dtype=int)
                if not len(others):
                    continue
                x, centres = coords(batch, i, "xs", dim), coords(batch, i, "centres", dim)[others]
                squares = values(batch, i, "squares")[others]
                length = (x * x).sum(axis=1)[:, None]
                slack = ROUNDING * (length + squares)
                low = np.sqrt(np.maximum(length + (centres * centres).sum(axis=1) - 2.0 * x @ centres.T - slack, 0.0))
                high = np.sqrt(np.maximum(length + squares - 2.0 * x @ centres.T, 0.0) + slack)
                least = high.min(axis=1)
                at, to = np.nonzero(low <= least[:, None])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("grp")[i].as_py()] * len(at), pa.string()), pa.array([own] * len(at), kind),
                     pa.array([batch.column("block")[i].as_py()] * len(at), pa.int64()), pa.array(at.astype(np.int32)),
                     pa.array([names[others[j]] for j in to], kind), pa.array(low[at, to]), pa.array(least[at])],
                    ["grp", "cluster", "block", "at", "target", "low", "least"])

    return run


def _sums(kind: pa.DataType):
    """Summed distances of the points of a block that ask for them to the points of another block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column("dim")[i].as_py()
                x, there = coords(batch, i, "xs", dim), coords(batch, i, "o_xs", dim)
                asked = batch.column("who")[i]
                who = np.arange(len(x)) if not asked.is_valid else np.sort(asked.values.to_numpy(zero_copy_only=False))
                total = np.concatenate([_distances(x[who[s:s + STRIPE]], there).sum(axis=1) for s in range(0, len(who), STRIPE)])
                pids = batch.column("pids")[i].as_py()
                fixed = [pa.array([batch.column(c)[i].as_py()] * len(who), t) for c, t in (("grp", pa.string()), ("cluster", kind), ("target", kind))]
                yield pa.RecordBatch.from_arrays([*fixed, pa.array([pids[w] for w in who], pa.string()), pa.array(total)],
                                                 ["grp", "cluster", "target", "pid", "total"])

    return run


def euclidean_silhouette_points(labelled: DataFrame, dim: int, rows: int | None = None, centres: int = CENTRES) -> DataFrame:
    """C20: (grp, pid, cluster, silhouette) of every point of (grp, pid, xs, cluster) under Euclidean distance.

    0 for a cluster of one point and in a group of one cluster.  Rows without a cluster or with a vector that is null, not finite or not
    of `dim` parts take no part; ids are unique within a group.  A task holds two blocks of bounded size; `rows` and `centres` change no result.
    """
    kind = labelled.schema["cluster"].dataType
    arrow = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}[kind.simpleString()]
    points = labelled.select("grp", F.col("pid").cast("string").alias("pid"), "cluster", F.col("xs").cast("array<double>").alias("xs"))
    finite = F.forall("xs", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    points = cut(points.filter(F.col("cluster").isNotNull() & (F.size("xs") == dim) & finite))
    clusters = cut(ranked(centroids(points, dim), ["grp"], ["cluster"]).withColumn("blocks", F.ceil(F.col("n") / block_rows(dim, rows)).cast("int")))
    sizes = clusters.select("grp", "cluster", "n", "blocks")
    placed = points.join(sizes, ["grp", "cluster"]).withColumn("block", F.pmod(F.xxhash64("pid"), F.col("blocks")))
    packed = cut(placed.groupBy("grp", "cluster", "block").agg(F.sort_array(F.collect_list(F.struct("pid", "xs"))).alias("p")).select(
        "grp", "cluster", "block", F.lit(dim).alias("dim"), F.col("p.pid").alias("pids"), F.flatten("p.xs").alias("xs")))

    some = clusters.withColumn("part", F.floor((F.col("pos") - 1) / centres)).groupBy("grp", "part").agg(
        F.sort_array(F.collect_list(F.struct("pos", "cluster", "centre", "square"))).alias("c")).select(
        "grp", "part", F.col("c.cluster").alias("names"), F.flatten("c.centre").alias("centres"), F.col("c.square").alias("squares"))
    parts = clusters.groupBy("grp").agg(F.floor((F.count("*") - 1) / centres).alias("last"))
    met = packed.drop("pids").join(parts, "grp").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), "last"))).join(some, ["grp", "part"])
    name = kind.simpleString()
    wanted = cut(met.select("grp", "cluster", "block", "dim", "xs", "names", "centres", "squares").mapInArrow(
        _candidates(arrow), f"grp string, cluster {name}, block long, at int, target {name}, low double, least double"))
    if parts.filter("last > 0").head(1):  # the centres of a group came in several parts
        least = wanted.groupBy("grp", "cluster", "block", "at").agg(F.min("least").alias("bound"))
        wanted = wanted.join(least, ["grp", "cluster", "block", "at"]).filter("low <= bound")
    asked = wanted.groupBy("grp", "cluster", "block", "target").agg(F.collect_list("at").alias("who"))
    asked = asked.unionByName(packed.select("grp", "cluster", "block", F.col("cluster").alias("target"), F.lit(None).cast("array<int>").alias("who")))

    # a block meets the blocks of a cluster that it asks for one by one
    theirs = sizes.select("grp", F.col("cluster").alias("target"), "blocks")
    pairs = asked.join(theirs, ["grp", "target"]).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    there = packed.select("grp", F.col("cluster").alias("target"), F.col("block").alias("other"), F.col("xs").alias("o_xs"))
    both = pairs.join(packed, ["grp", "cluster", "block"]).join(there, ["grp", "target", "other"])
    sums = both.select("grp", "cluster", "target", "dim", "who", "pids", "xs", "o_xs").mapInArrow(
        _sums(arrow), f"grp string, cluster {name}, target {name}, pid string, total double")
    sums = sums.groupBy("grp", "cluster", "pid", "target").agg(F.sum("total").alias("total"))
    sums = sums.join(sizes.select("grp", F.col("cluster").alias("target"), "n"), ["grp", "target"])
    mine = F.col("target") == F.col("cluster")
    means = sums.groupBy("grp", "pid", "cluster").agg(
        F.max(F.when(mine, F.col("n"))).alias("n"), F.max(F.when(mine, F.try_divide(F.col("total"), F.col("n") - 1))).alias("inner"),
        F.min(F.when(~mine, F.col("total") / F.col("n"))).alias("outer"))
    score = F.when((F.col("n") == 1) | F.col("outer").isNull(), 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("outer") - F.col("inner"), F.greatest("outer", "inner")), F.lit(0.0)))
    return means.select("grp", "pid", "cluster", score.alias("silhouette"))


def euclidean_silhouette(labelled: DataFrame, dim: int, rows: int | None = None, centres: int = CENTRES) -> DataFrame:
    """C20: (grp, cluster, score, n), mean silhouette per cluster and, with a null cluster, of the whole group."""
    sums = cut(euclidean_silhouette_points(labelled, dim, rows, centres).groupBy("grp", "cluster").agg(
        F.sum("silhouette").alias("s"), F.count("*").alias("n")))
    whole = sums.groupBy("grp").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).withColumn("cluster", F.lit(None).cast(sums.schema["cluster"].dataType))
    return sums.unionByName(whole).select("grp", "cluster", (F.col("s") / F.col("n")).alias("score"), "n")
