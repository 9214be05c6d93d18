"""DBSCAN and agglomerative clusters inside groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.vectors import l2_distance
from feedloom.operators.blocks import (
    block_rows, bounds_of, coords, descend, distinct_points, pack, rough_squares, squared_distances, squares_at, tree_levels, values,
)
from feedloom.operators.components import components
from feedloom.operators.hierarchy import merge_tree
from feedloom.operators.knn import STRIPE, pair_rows, vector_size
from feedloom.operators.mst import point_edges, spanning_trees
from feedloom.operators.reports import first_per_group
from feedloom.session import cut


def _near(a: np.ndarray, b: np.ndarray, eps: float):
    """Which distances are within eps, in slices of rows; where rough distances cannot tell they are measured."""
    for start in range(0, len(a), STRIPE):
        part = a[start:start + STRIPE]
        d, off = rough_squares(part, b)
        if not off.any():
            yield start, np.sqrt(d) <= eps
            continue
        slack = off + 1e-14 * eps * eps
        close = d <= (eps * eps - slack)[:, None]
        rows, cols = np.nonzero((d <= (eps * eps + slack)[:, None]) & ~close)
        close[rows, cols] = np.sqrt(squares_at(part, b, rows, cols)) <= eps
        yield start, close


def _counts(eps: float):
    """Weighted number of points of the right block within eps of each point of the left one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column("dim")[i].as_py()
                a, b = coords(batch, i, "xs", dim), coords(batch, i, "o_xs", dim)
                weights = values(batch, i, "o_weights")
                n = np.concatenate([close @ weights for _, close in _near(a, b, eps)])
                m = len(a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("grp")[i].as_py()] * m), pa.array([batch.column("block")[i].as_py()] * m, pa.int64()),
                     pa.array(np.arange(m, dtype=np.int32)), pa.array(n.astype(np.int64))],
                    ["grp", "block", "pos", "n"],
                )

    return run


def _links(eps: float):
    """Within a block pair: a spanning forest of the close core points, and for every other
    point of the left block its nearest core point.  At most one row per point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim, grp = batch.column("dim")[i].as_py(), batch.column("grp")[i].as_py()
                a, b = coords(batch, i, "xs", dim), coords(batch, i, "o_xs", dim)
                ia, ib = values(batch, i, "ids"), values(batch, i, "o_ids")
                ka, kb = values(batch, i, "core"), values(batch, i, "o_core")
                u, v, w, kind = [], [], [], []
                touched = np.zeros((len(a), len(b)), dtype=bool)
                for start, close in _near(a, b, eps):
                    close = close & kb[None, :]
                    rows = np.arange(start, start + len(close))
                    border = np.flatnonzero(~ka[rows] & close.any(axis=1))
                    d = np.sqrt(squared_distances(a[rows[border]], b))
                    nearest = np.where(close[border], d, np.inf).argmin(axis=1)
                    u.extend(ia[rows[border]])
                    v.extend(ib[nearest])
                    w.extend(d[np.arange(len(border)), nearest])
                    kind.extend([False] * len(border))
                    touched[rows] = close & ka[rows, None]
                for x, y in _forest(touched):
                    u.append(ia[x])
                    v.append(ib[y])
                    w.append(0.0)
                    kind.append(True)
                if u:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([grp] * len(u)), pa.array(u, pa.string()), pa.array(v, pa.string()), pa.array(w, pa.float64()), pa.array(kind)],
                        ["grp", "u", "v", "w", "core"],
                    )

    return run


def _forest(touched: np.ndarray):
    """Edges of a spanning forest of a bipartite adjacency, breadth first."""
    seen_a, seen_b = np.zeros(touched.shape[0], dtype=bool), np.zeros(touched.shape[1], dtype=bool)
    for seed in np.flatnonzero(touched.any(axis=1)):
        if seen_a[seed]:
            continue
        seen_a[seed] = True
        queue = [(True, seed)]
        while queue:
            left, at = queue.pop()
            if left:
                for y in np.flatnonzero(touched[at] & ~seen_b):
                    seen_b[y] = True
                    yield at, y
                    queue.append((False, y))
            else:
                for x in np.flatnonzero(touched[:, at] & ~seen_a):
                    seen_a[x] = True
                    yield x, at
                    queue.append((True, x))


def dbscan(points: DataFrame, eps: float, min_samples: int = 5, rows: int | None = None) -> DataFrame:
    """(grp, pid, comp, core); `comp` is the least id of the cluster, null for noise.

    A point with `min_samples` points within `eps`, itself included, is core.  Close core
    points share a cluster; another point joins the cluster of its nearest core point
    within `eps`.  Block pairs farther apart than `eps` are never formed, and a pair emits a
    forest instead of all its close pairs.
    """
    dim = vector_size(points)
    distinct = cut(distinct_points(points))
    blocks = pack(distinct, dim, rows)
    pairs = blocks.filter("whole").select("grp", "block", F.col("block").alias("other"))
    parts = blocks.filter("NOT whole")
    if parts.head(1):
        by = bounds_of(parts, dim)
        seekers = parts.select("grp", "block", "lo", "hi", F.lit(float(eps)).alias("bound"))
        pairs = pairs.unionByName(descend(seekers, tree_levels(parts, by.width), low=by.gap("a_", "b_"), keep=F.lit(True)))
    pairs = cut(pairs)
    counted = pair_rows(pairs, blocks, blocks, ["dim", "xs"], ["xs", "weights"]).mapInArrow(
        _counts(eps), "grp string, block long, pos int, n long")
    flags = counted.groupBy("grp", "block", "pos").agg((F.sum("n") >= min_samples).alias("core")).groupBy("grp", "block").agg(
        F.sort_array(F.collect_list(F.struct("pos", "core")))["core"].alias("core"))
    flagged = cut(blocks.join(flags, ["grp", "block"]))
    links = cut(pair_rows(pairs, flagged, flagged, ["dim", "ids", "xs", "core"], ["ids", "xs", "core"]).mapInArrow(
        _links(eps), "grp string, u string, v string, w double, core boolean"))
    clusters = components(links.filter("core"), stored=True)
    cores = clusters.select("grp", F.col("node").alias("rid"), "comp", F.lit(True).alias("core"))
    border = links.filter("NOT core").groupBy("grp", "u").agg(F.min(F.struct("w", "v"))["v"].alias("v"))
    border = border.join(cores.select("grp", F.col("rid").alias("v"), "comp"), ["grp", "v"]).select(
        "grp", F.col("u").alias("rid"), "comp", F.lit(False).alias("core"))
    members = points.join(distinct.select("grp", "rid", "xs"), ["grp", "xs"]).select("grp", "pid", "rid")
    return members.join(cores.unionByName(border), ["grp", "rid"], "left").select(
        "grp", "pid", "comp", F.coalesce("core", F.lit(False)).alias("core"))


def agglomerative(points: DataFrame, distance_threshold: float | None = None, n_clusters: int | None = None,
                  rows: int | None = None, method: str = "single") -> DataFrame:
    """C17: (grp, pid, comp); `comp` is the least id of the cluster.

    The tree of merges is cut: merges above the threshold go, or the highest ones until `n_clusters` parts are left in
    each group.  For single linkage it is the Euclidean spanning tree; for ward, average and complete see `merge_tree`.
    Under average and complete linkage a threshold splits the groups that exceed a block first, see `_near_parts`.
    """
    if (distance_threshold is None) == (n_clusters is None):
        raise ValueError("give either distance_threshold or n_clusters")
    if method in ("average", "complete") and distance_threshold is not None and distance_threshold >= 0:
        large = cut(_large_groups(points, block_rows(vector_size(points), rows)))
        if large.head(1):
            joined = points.join(large, "grp", "left_semi")
            parts = _near_parts(joined, distance_threshold, rows)
            one = parts.filter("one").select("grp", "pid", "part")
            rest = cut(parts.filter("NOT one").select(F.to_json(F.struct("grp", "part")).alias("grp"), F.col("grp").alias("real"), "pid", "xs"))
            found = one.withColumnRenamed("part", "comp")
            if rest.head(1):
                names = rest.select("grp", "real").distinct()
                split = _cut_tree(rest.select("grp", "pid", "xs"), distance_threshold, None, rows, method)
                found = found.unionByName(split.join(names, "grp").select(F.col("real").alias("grp"), "pid", "comp"))
            return found.unionByName(_cut_tree(points.join(large, "grp", "left_anti"), distance_threshold, None, rows, method))
    return _cut_tree(points, distance_threshold, n_clusters, rows, method)


def _large_groups(points: DataFrame, limit: int) -> DataFrame:
    """(grp) of the groups with more different points than a block takes."""
    return points.groupBy("grp", "xs").agg(F.lit(1).alias("one")).groupBy("grp").agg(F.count("*").alias("n")).filter(F.col("n") > limit).select("grp")


def _near_parts(points: DataFrame, threshold: float, rows: int | None) -> DataFrame:
    """(grp, pid, xs, part, one): parts of a group that average or complete linkage up to the threshold never joins.

    Two clusters whose mean or greatest distance is within the threshold have a pair of points within it, so no merge
    leaves a component of the points that are linked within the threshold.  `part` is the least id of such a component.
    If all its points lie within half the threshold of their mean, all their distances are within the threshold and so is
    every height: the part is `one` cluster.
    """
    distinct = cut(distinct_points(points))
    near = dbscan(distinct.select("grp", F.col("rid").alias("pid"), "xs"), threshold * (1 + 1e-9), 1, rows)
    named = cut(distinct.select("grp", "rid", "xs").join(near.select("grp", F.col("pid").alias("rid"), F.col("comp").alias("part")), ["grp", "rid"]))
    dim = vector_size(points)
    centre = F.array(*[F.avg(F.col("xs")[i]) for i in range(dim)]).alias("centre")
    centres = named.groupBy("grp", "part").agg(centre)
    reach = named.join(centres, ["grp", "part"]).groupBy("grp", "part").agg(F.max(l2_distance(F.col("xs"), F.col("centre"))).alias("reach"))
    one = (2 * F.col("reach") <= threshold * (1 - 1e-9)).alias("one")
    parts = named.join(reach.select("grp", "part", one), ["grp", "part"]).select("grp", "xs", "part", "one")
    return cut(points.select("grp", "pid", "xs").join(parts, ["grp", "xs"]))


def _cut_tree(points: DataFrame, distance_threshold: float | None, n_clusters: int | None, rows: int | None, method: str) -> DataFrame:
    """(grp, pid, comp) from the tree of merges, cut at a height or a number of clusters."""
    if method == "single":
        edges, nodes, distinct = spanning_trees(points, 0, rows)
    else:
        distinct = cut(distinct_points(points))
        edges = merge_tree(distinct, method, vector_size(points), rows)
        nodes = distinct.select("grp", "rid", "weight", F.lit(0.0).alias("core"))
    tree = point_edges(edges, nodes, points, distinct)
    if distance_threshold is not None:
        kept = tree.filter(F.col("w") <= distance_threshold)
    else:
        longest = first_per_group(tree, "grp", [F.desc("w"), F.col("u"), F.col("v")], n_clusters - 1)
        kept = tree.join(longest.select("grp", "u", "v"), ["grp", "u", "v"], "left_anti")
    found = components(kept).withColumnRenamed("node", "pid")
    return points.select("grp", "pid").join(found, ["grp", "pid"], "left").withColumn("comp", F.coalesce("comp", "pid"))


def numbered(clusters: DataFrame) -> DataFrame:
    """Component names as numbers: by falling size, then least id; noise (null) is -1.

    The ranking runs on range-sorted parts plus the row counts of the parts before, since
    a group may have as many components as points.
    """
    sizes = clusters.filter(F.col("comp").isNotNull()).groupBy("grp", "comp").agg(F.count("*").alias("n"))
    order = [F.col("grp"), F.desc("n"), F.col("comp")]
    parts = cut(sizes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))
    inside = F.row_number().over(Window.partitionBy("grp", "part").orderBy(F.desc("n"), "comp"))
    before = parts.groupBy("grp", "part").agg(F.count("*").alias("c")).withColumn(
        "before", F.sum("c").over(Window.partitionBy("grp").orderBy("part")) - F.col("c"))
    names = parts.withColumn("inside", inside).join(before, ["grp", "part"]).select(
        "grp", "comp", (F.col("before") + F.col("inside") - 1).cast("int").alias("cluster"))
    return clusters.join(names, ["grp", "comp"], "left").withColumn("cluster", F.coalesce("cluster", F.lit(-1)))
