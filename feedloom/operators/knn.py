"""Exact nearest neighbours and core distances inside groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.blocks import (
    ROWS_PER_TASK, bounds_of, coords, dealt, descend, distinct_points, pack, rough_squares, squares_at, stripes, task_count, task_number, tree_levels, values,
)
from feedloom.operators.counting import STRIPE, narrowed_cores
from feedloom.operators.quantiles import weighted_quantile
from feedloom.session import cut

FOUND = "grp string, block long, pos int, rid string, nbr string, nbr_weight long, dist double"


def _nearest(queries: np.ndarray, targets: np.ndarray, k: int, own: bool, cap: np.ndarray | None = None):
    """Row, column and distance of the k nearest targets of every query row.

    Targets are sorted by id, so equal distances resolve to the smaller id.  `own` skips
    the diagonal.  `cap` keeps distances up to a bound per row.  Rough distances tell which
    targets may be among the k nearest; these are measured again.
    """
    for here in stripes(len(queries), len(targets)):
        part, start = queries[here], here.start
        d, off = rough_squares(part, targets)
        if own:
            d[np.arange(len(d)), np.arange(start, start + len(d))] = np.inf
        most = np.full(len(d), np.inf) if cap is None else (cap[here] ** 2) * (1 + 1e-9)
        mask = (d <= (most + off)[:, None]) & np.isfinite(d)
        if d.shape[1] > k and np.count_nonzero(mask) > 4 * k * len(d):
            edge = np.partition(d, k - 1, axis=1)[:, k - 1]
            mask &= d <= (edge + 2 * off)[:, None]
        rows, cols = np.nonzero(mask)
        exact = squares_at(part, targets, rows, cols)
        inside = exact <= most[rows]
        rows, cols, exact = rows[inside], cols[inside], exact[inside]
        order = np.lexsort((cols, exact, rows))
        rows, cols, exact = rows[order], cols[order], exact[order]
        first = np.searchsorted(rows, rows, side="left")
        top = np.arange(len(rows)) - first < k
        yield rows[top] + start, cols[top], np.sqrt(exact[top])


def _found(grp: str, block: int, ids, rows, nbrs, nbr_weights, cols, dist) -> pa.RecordBatch:
    m = len(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([grp] * m, pa.string()), pa.array(np.full(m, block, dtype=np.int64)), pa.array(rows.astype(np.int32)),
         pa.array(ids[rows], pa.string()), pa.array(nbrs[cols], pa.string()), pa.array(nbr_weights[cols].astype(np.int64)),
         pa.array(dist)],
        ["grp", "block", "pos", "rid", "nbr", "nbr_weight", "dist"],
    )


def _local(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = coords(batch, i, "xs", batch.column("dim")[i].as_py())
                ids, weights = values(batch, i, "ids"), values(batch, i, "weights")
                grp, block = batch.column("grp")[i].as_py(), batch.column("block")[i].as_py()
                for rows, cols, dist in _nearest(x, x, k, own=True):
                    yield _found(grp, block, ids, rows, ids, weights, cols, dist)

    return run


def _caps(k: int):
    """Per block: every point's k-th distance inside the block, infinite where there are fewer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            caps = []
            for i in range(batch.num_rows):
                x = coords(batch, i, "xs", batch.column("dim")[i].as_py())
                cap = np.full(len(x), np.inf)
                for rows, _, dist in _nearest(x, x, k, own=True):
                    if len(x) > k:
                        kth = np.flatnonzero(np.diff(np.append(rows, -1)))
                        cap[rows[kth]] = dist[kth]
                caps.append(cap)
            yield pa.RecordBatch.from_arrays(
                [batch.column("grp"), batch.column("block"), pa.array(caps, pa.list_(pa.float64()))], ["grp", "block", "caps"]
            )

    return run


def _across(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column("dim")[i].as_py()
                a, b = coords(batch, i, "xs", dim), coords(batch, i, "o_xs", dim)
                ids, nbrs = values(batch, i, "ids"), values(batch, i, "o_ids")
                grp, block = batch.column("grp")[i].as_py(), batch.column("block")[i].as_py()
                for rows, cols, dist in _nearest(a, b, k, own=False, cap=values(batch, i, "caps")):
                    yield _found(grp, block, ids, rows, nbrs, values(batch, i, "o_weights"), cols, dist)

    return run


def pair_rows(pairs: DataFrame, left: DataFrame, right: DataFrame, left_cols: list[str], right_cols: list[str],
              most: int = ROWS_PER_TASK) -> DataFrame:
    """One row per block pair with both packed sides; a row has bounded size.  Pairs are dealt evenly to tasks of `most` rows or fewer."""
    pairs = cut(pairs.select("grp", "block", "other"))
    tasks = task_count(pairs, pairs.count(), most)
    pairs = pairs.withColumn("task", task_number(tasks))
    a = left.select("grp", "block", *left_cols)
    b = right.select("grp", F.col("block").alias("other"), *[F.col(c).alias(f"o_{c}") for c in right_cols])
    return pairs.join(a, ["grp", "block"]).join(b, ["grp", "other"]).repartitionById(tasks, "task").drop("task")


def block_neighbours(blocks: DataFrame, k: int, dim: int) -> DataFrame:
    """(grp, block, pos, rid, nbr, nbr_weight, dist, rank): the k nearest distinct other points of each point."""
    base = blocks.select("grp", "block", "dim", "ids", "weights", "xs")
    found = dealt(base).mapInArrow(_local(k), FOUND)
    parts = blocks.filter("NOT whole")
    if parts.head(1):
        caps = dealt(parts.select("grp", "block", "dim", "xs")).mapInArrow(_caps(k), "grp string, block long, caps array<double>")
        capped = cut(parts.join(caps, ["grp", "block"]))
        seekers = capped.select("grp", "block", "lo", "hi", F.array_max("caps").alias("bound"))
        by = bounds_of(capped, dim)
        pairs = descend(
            seekers, tree_levels(capped, by.width), low=by.gap("a_", "b_"), keep=F.lit(True),
            high=by.span("a_", "b_"), usable=F.col("b_n") > k,
        ).filter(F.col("block") != F.col("other"))
        rows = pair_rows(pairs, capped, capped, ["dim", "ids", "xs", "caps"], ["ids", "weights", "xs"])
        found = found.unionByName(rows.mapInArrow(_across(k), FOUND))
        window = Window.partitionBy("grp", "rid").orderBy("dist", "nbr")
        return found.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
    # all groups fit one block: the rows of a point come out ranked already
    window = Window.partitionBy("grp", "rid").orderBy("dist", "nbr")
    return found.withColumn("rank", F.row_number().over(window))


def as_points(df: DataFrame, group: Column, vector: str = "vector") -> DataFrame:
    """(grp, pid, xs) rows from a table with feedback_id and a vector."""
    return df.select(group.cast("string").alias("grp"), F.col("feedback_id").alias("pid"), F.col(vector).cast("array<double>").alias("xs"))


def vector_size(points: DataFrame) -> int:
    """Length of the vectors, read from one row."""
    row = points.select(F.size("xs")).head()
    return row[0] if row else 1


def knn_graph(points: DataFrame, k: int, rows: int | None = None) -> DataFrame:
    """(grp, pid, nbr, dist, rank), the k nearest other points inside each group.

    Exact.  Copies of a vector are searched once: their neighbours are the other copies and
    then the neighbours of the vector, each with up to k of its own copies.
    """
    dim = vector_size(points)
    distinct = cut(distinct_points(points, keep=k + 1))
    near = block_neighbours(pack(distinct, dim, rows), k, dim)
    copies = distinct.select("grp", F.col("rid").alias("nbr"), "copies")
    own = distinct.select("grp", "rid", "copies", F.lit(0.0).alias("dist"))
    lists = near.select("grp", "rid", "nbr", "dist").join(copies, ["grp", "nbr"]).select("grp", "rid", "copies", "dist")
    flat = lists.unionByName(own).select("grp", "rid", F.explode("copies").alias("nbr"), "dist")
    top = Window.partitionBy("grp", "rid").orderBy("dist", "nbr")
    flat = flat.withColumn("r", F.row_number().over(top)).filter(F.col("r") <= k + 1)
    packed = flat.groupBy("grp", "rid").agg(F.sort_array(F.collect_list(F.struct("dist", "nbr"))).alias("near"))
    members = points.join(distinct.select("grp", "rid", "xs"), ["grp", "xs"]).select("grp", "rid", "pid")
    listed = members.join(packed, ["grp", "rid"]).select(
        "grp", "pid", F.slice(F.filter("near", lambda e: e["nbr"] != F.col("pid")), 1, k).alias("near")
    )
    return listed.select("grp", "pid", F.posexplode("near").alias("i", "e")).select(
        "grp", "pid", F.col("e.nbr").alias("nbr"), F.col("e.dist").alias("dist"), (F.col("i") + 1).alias("rank")
    )


def reach(dist: np.ndarray, weights: np.ndarray, spare: int, k: int) -> float:
    """Distance to the k-th other point from ascending distances; `spare` copies lie at zero.

    Where there are fewer than k others, the farthest decides.
    """
    if spare >= k or len(dist) == 0:
        return 0.0
    at = int(np.searchsorted(spare + np.cumsum(weights), k, side="left"))
    return float(dist[min(at, len(dist) - 1)])


def block_reach(x: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """Core distances when the block is the whole group."""
    core = np.zeros(len(x))
    if k > 0 and len(x) > 1:
        for rows, cols, dist in _nearest(x, x, k, own=True):
            starts = np.flatnonzero(np.diff(np.insert(rows, 0, -1)))
            stops = np.append(starts[1:], len(rows))
            for a, b in zip(starts, stops):
                core[rows[a]] = reach(dist[a:b], weights[cols[a:b]], int(weights[rows[a]]) - 1, k)
    return core


def _whole_cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cores = [
            block_reach(coords(batch, i, "xs", batch.column("dim")[i].as_py()), values(batch, i, "weights"),
                        batch.column("k")[i].as_py())
            for i in range(batch.num_rows)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("grp"), batch.column("block"), pa.array(cores, pa.list_(pa.float64()))], ["grp", "block", "cores"]
        )


def with_cores(blocks: DataFrame, dim: int) -> DataFrame:
    """Blocks (with `k`, the sample number of their group) plus `cores`, aligned with `ids`."""
    shape = "grp string, block long, cores array<double>"
    cores = dealt(blocks.filter("whole").select("grp", "block", "dim", "k", "xs", "weights")).mapInArrow(_whole_cores, shape)
    parts = blocks.filter("NOT whole")
    if parts.head(1):
        cores = cores.unionByName(narrowed_cores(parts, dim))
    return blocks.join(cores, ["grp", "block"])


def core_distances(points: DataFrame, min_samples: int, rows: int | None = None) -> DataFrame:
    """(grp, pid, core), the distance of every point to its `min_samples`-th other point."""
    dim = vector_size(points)
    distinct = cut(distinct_points(points))
    blocks = pack(distinct, dim, rows).withColumn("k", F.lit(min_samples))
    cored = with_cores(blocks, dim).select("grp", F.explode(F.arrays_zip("ids", "cores")).alias("p"))
    core = cored.select("grp", F.col("p.ids").alias("rid"), F.col("p.cores").alias("core"))
    members = points.join(distinct.select("grp", "rid", "xs"), ["grp", "xs"]).select("grp", "rid", "pid")
    return members.join(core, ["grp", "rid"]).select("grp", "pid", "core")


def estimate_eps(points: DataFrame, k: int = 4, percentile: float = 95.0) -> DataFrame:
    """Per group, an interpolated percentile of the distance to the k-th neighbour.

    The place is found by counting (see `weighted_quantile`), so no task holds all distances of a group.
    """
    kth = knn_graph(points, k).groupBy("grp", "pid").agg(F.max("dist").alias("value"))
    return weighted_quantile(kth.withColumn("weight", F.lit(1)), percentile / 100.0).withColumnRenamed("value", "eps")
