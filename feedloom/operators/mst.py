"""Minimum spanning trees under mutual reachability, one per group.

A group inside one block, or of up to `WHOLE_ROWS` short vectors, gets its tree in one task.  Larger groups take rounds: every
component finds its least outgoing edge among the block pairs that can hold it, all chosen
edges join the tree, and components merge.  Edges are ordered by (weight, lesser id,
greater id), so equal weights cannot close a cycle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.blocks import (
    BOX_DIMS, bounds_of, coords, dealt, descend, distinct_points, pack, rough_squares, squared_distances, squares_at, tree_levels, values,
)
from feedloom.operators.components import components
from feedloom.operators.knn import STRIPE, pair_rows, vector_size, with_cores
from feedloom.operators.seeded import SEEDED_ROWS, SEEDED_VALUES, seeded_trees
from feedloom.session import cut

TREE = "grp string, u string, v string, w double"
WHOLE_ROWS, WHOLE_VALUES = 32_768, 98_304  # short vectors, and their coordinates, that one task makes a tree of
CHOICE = "grp string, comp string, w double, lo string, hi string, other string"


def prim(x: np.ndarray, core: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tree edges (from, to, weight) of one block, distances row by row; ties in the order of (weight, lesser id, greater id)."""
    n = len(x)
    rank = np.argsort(np.argsort(ids))
    place, best, source = np.arange(n), np.full(n, np.inf), np.zeros(n, dtype=int)
    low, high = np.full(n, n), np.full(n, n)
    open_ = np.ones(n, dtype=bool)
    u, v, w = np.zeros(n - 1, dtype=int), np.zeros(n - 1, dtype=int), np.zeros(n - 1)
    at, left = 0, n
    for i in range(n - 1):
        open_[at] = False
        left -= 1
        point, reach, mine, here = x[at:at + 1], core[at], rank[at], place[at]
        if left < 0.75 * len(x):  # points that the tree has reached are dropped now and then
            x, core, rank, place, best, source, low, high = (a[open_] for a in (x, core, rank, place, best, source, low, high))
            open_ = np.ones(left, dtype=bool)
        step = np.maximum(np.sqrt(squared_distances(point, x)[0]), np.maximum(core, reach))
        lesser, greater = np.minimum(rank, mine), np.maximum(rank, mine)
        tied = (step == best) & ((lesser < low) | ((lesser == low) & (greater < high)))
        better = open_ & ((step < best) | tied)
        best[better], source[better] = step[better], here
        low[better], high[better] = lesser[better], greater[better]
        due = np.flatnonzero(open_ & (best == best[open_].min()))
        at = int(due[np.lexsort((high[due], low[due]))[0]])
        u[i], v[i], w[i] = source[at], place[at], best[at]
    return u, v, w


def _whole_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, core = values(batch, i, "ids"), values(batch, i, "cores")
            if len(ids) < 2:
                continue
            u, v, w = prim(coords(batch, i, "xs", batch.column("dim")[i].as_py()), core, ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column("grp")[i].as_py()] * len(w)), pa.array(ids[u], pa.string()), pa.array(ids[v], pa.string()), pa.array(w)],
                ["grp", "u", "v", "w"],
            )


def _least(a: np.ndarray, b: np.ndarray, ca: np.ndarray, cb: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the first nearest column that is not the `same`, and its mutual reachability distance, infinite where there is none.

    Rough distances leave few columns to be measured; where they leave many, all are.
    """
    d, off = rough_squares(a, b)
    if off.any():
        np.maximum(d, np.maximum(ca[:, None] ** 2, cb[None, :] ** 2), out=d)
        d[same] = np.inf
        least = d.min(axis=1)
        least[np.isinf(least)] = -np.inf
        rows, cols = np.nonzero(d <= (least * (1 + 1e-14) + 2 * off)[:, None])  # room for the roots and squares
        if len(rows) <= d.size // 16:
            exact = np.maximum(np.sqrt(squares_at(a, b, rows, cols)), np.maximum(ca[rows], cb[cols]))
            order = np.lexsort((cols, exact, rows))
            found, first = np.unique(rows[order], return_index=True)
            column, weight = np.zeros(len(a), dtype=int), np.full(len(a), np.inf)
            column[found], weight[found] = cols[order][first], exact[order][first]
            return column, weight
        d = squared_distances(a, b)
    d = np.maximum(np.sqrt(d), np.maximum(ca[:, None], cb[None, :]))
    d[same] = np.inf
    return d.argmin(axis=1), d.min(axis=1)


def _least_edges(across: bool):
    """Per component of the left block, the least edge to another component of the right block."""
    other = "o_" if across else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column("dim")[i].as_py()
                xa, xb = coords(batch, i, "xs", dim), coords(batch, i, f"{other}xs", dim)
                ca, cb = values(batch, i, "cores"), values(batch, i, f"{other}cores")
                ia, ib = values(batch, i, "ids"), values(batch, i, f"{other}ids")
                pa_, pb = values(batch, i, "comps"), values(batch, i, f"{other}comps")
                by_id = np.argsort(ib)  # of equal distances the first, that is the least id, is taken
                xb, cb, ib, pb = xb[by_id], cb[by_id], ib[by_id], pb[by_id]
                numbers = {c: j for j, c in enumerate(sorted(set(pa_) | set(pb)))}
                na, nb = np.array([numbers[c] for c in pa_]), np.array([numbers[c] for c in pb])
                weight, column = np.full(len(xa), np.inf), np.zeros(len(xa), dtype=int)
                for start in range(0, len(xa), STRIPE):
                    part = slice(start, start + STRIPE)
                    column[part], weight[part] = _least(xa[part], xb, ca[part], cb, na[part, None] == nb[None, :])
                rows = np.flatnonzero(np.isfinite(weight))
                if len(rows) == 0:
                    continue
                u, v = ia[rows], ib[column[rows]]
                low, high = np.where(u < v, u, v), np.where(u < v, v, u)
                order = np.lexsort((high, low, weight[rows], na[rows]))
                first = order[np.flatnonzero(np.diff(np.insert(na[rows][order], 0, -1)))]
                m = len(first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("grp")[i].as_py()] * m), pa.array(pa_[rows[first]], pa.string()), pa.array(weight[rows[first]]),
                     pa.array(low[first], pa.string()), pa.array(high[first], pa.string()),
                     pa.array(pb[column[rows[first]]], pa.string())],
                    ["grp", "comp", "w", "lo", "hi", "other"],
                )

    return run


def _part_trees(parts: DataFrame, dim: int) -> DataFrame:
    packed = cut(parts.select("grp", "block", "n", "dim", "ids", "xs", "cores", "lo", "hi",
                              F.array_min("cores").alias("core_lo"), F.array_max("cores").alias("core_hi")))
    comps = packed.select("grp", "block", F.col("ids").alias("comps"))
    extra = {"core_lo": F.min, "core_hi": F.max, "c_lo": F.min, "c_hi": F.max}
    tree, by = None, bounds_of(packed, dim)
    while True:
        now = cut(packed.join(comps, ["grp", "block"]).withColumn("c_lo", F.array_min("comps")).withColumn("c_hi", F.array_max("comps")))
        inside = cut(dealt(now.select("grp", "dim", "ids", "xs", "cores", "comps")).mapInArrow(_least_edges(False), CHOICE))
        known = inside.groupBy("grp", "comp").agg(F.min("w").alias("known"))
        bounds = now.select("grp", "block", F.explode(F.array_distinct("comps")).alias("comp")).join(
            known, ["grp", "comp"], "left"
        ).groupBy("grp", "block").agg(F.max(F.coalesce("known", F.lit(float("inf")))).alias("bound"))
        seekers = now.select("grp", "block", "lo", "hi", "core_lo", "core_hi", "c_lo", "c_hi",
                             F.when(F.col("c_lo") == F.col("c_hi"), F.col("c_lo")).alias("comp")).join(bounds, ["grp", "block"])
        same = (F.col("a_c_lo") == F.col("a_c_hi")) & (F.col("b_c_lo") == F.col("b_c_hi")) & (F.col("a_c_lo") == F.col("b_c_lo"))
        pairs = descend(
            seekers, tree_levels(now, by.width, extra),
            low=F.greatest(by.gap("a_", "b_"), F.col("a_core_lo"), F.col("b_core_lo")), keep=~same, bound_key="comp",
            high=F.greatest(by.span("a_", "b_"), F.col("a_core_hi"), F.col("b_core_hi")), usable=F.col("a_comp").isNotNull(),
        ).filter(F.col("block") != F.col("other"))
        cols = ["ids", "xs", "cores", "comps"]
        outside = pair_rows(pairs, now, now, ["dim", *cols], cols).mapInArrow(_least_edges(True), CHOICE)
        best = F.min(F.struct("w", "lo", "hi", "other")).alias("e")
        chosen = cut(inside.unionByName(outside).groupBy("grp", "comp").agg(best).select("grp", "comp", "e.*"))
        if not chosen.head(1):
            break
        added = chosen.select("grp", F.col("lo").alias("u"), F.col("hi").alias("v"), "w").distinct()
        tree = added if tree is None else tree.unionByName(added)
        merged = components(chosen.select("grp", F.col("comp").alias("u"), F.col("other").alias("v")), stored=True)
        merged = merged.select("grp", F.col("node").alias("comp"), F.col("comp").alias("root"))
        comps = now.select("grp", "block", F.posexplode("comps").alias("pos", "comp")).join(merged, ["grp", "comp"], "left").groupBy(
            "grp", "block"
        ).agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("root", "comp").alias("c"))))["c"].alias("comps"))
    return tree


def _seeded(parts: DataFrame, dim: int) -> DataFrame:
    return seeded_trees(parts, dim, TREE)


def spanning_trees(points: DataFrame, min_samples: Column | int, rows: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(edges, nodes, distinct): the tree over distinct points of each group.

    edges: (grp, u, v, w); nodes: (grp, rid, weight, core), a node of weight m standing for m
    copies whose mutual distance is `core`; distinct: (grp, rid, xs, weight, copies).
    `min_samples` may read the columns `grp` and `n_points` (points per group); 0 gives the
    plain Euclidean tree.
    """
    dim = vector_size(points)
    distinct = cut(distinct_points(points))
    per_group = distinct.groupBy("grp").agg(F.sum("weight").alias("n_points"))
    k = min_samples if isinstance(min_samples, Column) else F.lit(min_samples)
    most_whole = min(WHOLE_ROWS, WHOLE_VALUES // max(dim, 1)) if rows is None and dim <= BOX_DIMS else 0
    blocks = pack(distinct, dim, rows, most_whole=most_whole).join(per_group.select("grp", k.cast("int").alias("k")), "grp")
    cored = cut(with_cores(blocks, dim))
    edges = dealt(cored.filter("whole").select("grp", "dim", "ids", "xs", "cores")).mapInArrow(_whole_trees, TREE)
    parts = cored.filter("NOT whole")
    sizes = parts.groupBy("grp").agg(F.sum("n").alias("points"))
    held = F.col("points") <= min(SEEDED_ROWS, SEEDED_VALUES // max(dim, 1))
    for trees, groups in ((_seeded, sizes.filter(held)), (_part_trees, sizes.filter(~held))):
        if groups.head(1):
            edges = edges.unionByName(trees(parts.join(groups.select("grp"), "grp", "left_semi"), dim))
    nodes = cored.select("grp", F.explode(F.arrays_zip("ids", "weights", "cores")).alias("p")).select(
        "grp", F.col("p.ids").alias("rid"), F.col("p.weights").alias("weight"), F.col("p.cores").alias("core")
    )
    return cut(edges), nodes, distinct


def point_edges(edges: DataFrame, nodes: DataFrame, points: DataFrame, distinct: DataFrame) -> DataFrame:
    """The tree over all points: every further copy hangs on the first one at its core distance."""
    members = points.join(distinct.select("grp", "rid", "xs"), ["grp", "xs"]).filter(F.col("pid") != F.col("rid"))
    copies = members.select("grp", "rid", "pid").join(nodes, ["grp", "rid"]).select(
        "grp", F.col("rid").alias("u"), F.col("pid").alias("v"), F.col("core").alias("w")
    )
    return edges.unionByName(copies)


def minimum_spanning_tree(points: DataFrame, min_samples: Column | int, rows: int | None = None) -> DataFrame:
    """(grp, u, v, w) with n - 1 edges for a group of n points."""
    edges, nodes, distinct = spanning_trees(points, min_samples, rows)
    return point_edges(edges, nodes, points, distinct)


def mutual_reachability(pairs: DataFrame, cores: DataFrame) -> DataFrame:
    """Neighbour pairs (grp, pid, nbr, dist) with their mutual reachability distance."""
    a = cores.select("grp", "pid", F.col("core").alias("core_a"))
    b = cores.select("grp", F.col("pid").alias("nbr"), F.col("core").alias("core_b"))
    return pairs.join(a, ["grp", "pid"]).join(b, ["grp", "nbr"]).withColumn("mreach", F.greatest("dist", "core_a", "core_b"))
