"""Merge trees of Ward, average and complete linkage (C17).

A merge tree has one edge per merge: (grp, u, v, w), u and v being the least ids of the two clusters and w the height at
which they meet.  Cut like a spanning tree, it gives the clusters at a height or a number of clusters.

Groups that fit one block take nearest-neighbour chains over their distance matrix, in one task.  By Ward's linkage a cluster is its
centre and weight, so groups up to `CHAIN_ROWS` take these chains over their centres, without a matrix.  Larger groups are merged in
rounds until they are so small: all pairs of clusters that are each other's nearest merge at once, which gives the same tree as
one merge at a time.  A round compares blocks of centres and moves no members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.blocks import (
    block_rows, bounds_of, coords, dealt, descend, pack, rough_squares, squared_distances, squares_at, stripes, tree_levels, values,
)
from feedloom.operators.counting import STRIPE
from feedloom.operators.knn import pair_rows
from feedloom.session import cut

TREE = "grp string, u string, v string, w double"
METHODS = ("ward", "average", "complete")
CHAIN_ROWS, CHAIN_VALUES = 32_768, 2_097_152  # centres, and their coordinates, that one task takes chains over


def chain_merges(x: np.ndarray, weights: np.ndarray, method: str) -> list[tuple[int, int, float]]:
    """Merges (kept, gone, height) of one group by nearest-neighbour chains; of two clusters the lower place is kept.

    Ties go to the cluster before on the chain, then to the lower place.
    """
    n = len(x)
    weight = weights.astype(float).copy()
    d = squared_distances(x, x)
    if method == "ward":
        d *= 2 * weight[:, None] * weight[None, :] / (weight[:, None] + weight[None, :])
    else:
        d = np.sqrt(d)
    np.fill_diagonal(d, np.inf)
    merges, chain, open_ = [], [], np.ones(n, bool)
    for _ in range(n - 1):
        if not chain:
            chain = [int(np.flatnonzero(open_)[0])]
        while True:
            at = chain[-1]
            nearest = int(d[at].argmin())
            if len(chain) > 1 and d[at, chain[-2]] <= d[at, nearest]:
                nearest = chain[-2]
                break
            chain.append(nearest)
        i, j = sorted((chain.pop(), chain.pop()))
        height = d[i, j]
        merges.append((i, j, float(np.sqrt(height) if method == "ward" else height)))
        with np.errstate(invalid="ignore"):
            if method == "ward":
                row = ((weight + weight[i]) * d[i] + (weight + weight[j]) * d[j] - weight * height) / (weight + weight[i] + weight[j])
            elif method == "average":
                row = (weight[i] * d[i] + weight[j] * d[j]) / (weight[i] + weight[j])
            else:
                row = np.maximum(d[i], d[j])
        open_[j] = False
        row[~open_] = np.inf
        row[i] = np.inf
        d[i, :], d[:, i], d[j, :], d[:, j] = row, row, np.inf, np.inf
        weight[i] += weight[j]
    return merges


def chain_rows(dim: int, limit: int | None = None) -> int:
    return limit or max(block_rows(dim), min(CHAIN_ROWS, CHAIN_VALUES // max(dim, 1)))


def centre_merges(x: np.ndarray, weights: np.ndarray) -> list[tuple[int, int, float]]:
    """`chain_merges` of Ward's linkage from centres and weights; what is held grows with the points, not with their pairs.

    No merge brings clusters nearer to a third one, so the nearest cluster of a row stays known until one of the two merges.
    """
    x, weight = np.array(x, float), weights.astype(float)
    n, dim = x.shape
    square = np.einsum("ij,ij->i", x, x)
    near, far = np.zeros(n, int), np.zeros(n)
    for part in stripes(n, n):
        near[part], far[part] = _least_ward(x[part], x, weight[part], weight, np.arange(n)[part])
    place, open_ = np.arange(n), np.ones(n, bool)
    age, seen = np.zeros(n, int), np.zeros(n, int)  # merges of a row, and those of its nearest when that was found
    left, merges, chain = n, [], []

    def look(i: int) -> None:
        rise = 2 * weight[i] * weight / (weight[i] + weight)
        with np.errstate(over="ignore", invalid="ignore"):
            room = 32 * weight[i] * (dim + 8) * np.finfo(float).eps * (square[i] + square.max())
        if np.isfinite(room):
            d = ((x @ x[i]) * -2.0 + square + square[i]) * rise
        else:
            d, room = squared_distances(x[i:i + 1], x)[0] * rise, 0.0
        d[i] = np.inf
        d[~open_] = np.inf
        least = d.min()
        cols = np.flatnonzero((d <= least + 1e-14 * abs(least) + 2 * room) & open_)
        cols = cols[cols != i]
        exact = squares_at(x[i:i + 1], x, np.zeros(len(cols), int), cols) * rise[cols]
        first = int(exact.argmin())
        near[i], far[i], seen[i] = cols[first], exact[first], age[cols[first]]

    while left > 1:
        if left < 0.75 * len(x):  # rows of clusters that are gone are dropped now and then
            new = np.where(open_, np.cumsum(open_) - 1, -1)
            x, weight, square, place, age = x[open_], weight[open_], square[open_], place[open_], age[open_]
            near, far, seen = np.where(near < 0, -1, new[near])[open_], far[open_], seen[open_]
            chain, open_ = [int(new[c]) for c in chain], np.ones(left, bool)
        if not chain:
            chain = [int(open_.argmax())]
        while True:
            at = chain[-1]
            if near[at] < 0 or not open_[near[at]] or age[near[at]] != seen[at]:
                look(at)
            if len(chain) > 1:
                i, j = at, chain[-2]
                height = float((squares_at(x, x, np.array([i]), np.array([j])) * (2 * weight[i] * weight[j] / (weight[i] + weight[j])))[0])
                if height <= far[at]:
                    break
            chain.append(int(near[at]))
        i, j = sorted((chain.pop(), chain.pop()))
        merges.append((int(place[i]), int(place[j]), float(np.sqrt(height))))
        total = weight[i] + weight[j]
        x[i] = (x[i] * weight[i] + x[j] * weight[j]) / total
        square[i], weight[i] = x[i] @ x[i], total
        open_[j], near[i] = False, -1
        age[i] += 1
        left -= 1
    return merges


def _whole_trees(method: str, most: int):
    """Trees of whole groups; by Ward's linkage those above `most` points take no matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, weights = values(batch, i, "ids"), values(batch, i, "weights")
                x = coords(batch, i, "xs", batch.column("dim")[i].as_py())
                merges = centre_merges(x, weights) if method == "ward" and len(x) > most else chain_merges(x, weights, method)
                if merges:
                    u, v, w = zip(*merges)
                    yield pa.RecordBatch.from_arrays([pa.array([batch.column("grp")[i].as_py()] * len(w), pa.string()), pa.array(ids[list(u)], pa.string()),
                                                      pa.array(ids[list(v)], pa.string()), pa.array(w)], ["grp", "u", "v", "w"])

    return run


CHOICE = "grp string, rid string, lo_id string, hi_id string, d double"


def _least_ward(a: np.ndarray, b: np.ndarray, wa: np.ndarray, wb: np.ndarray, own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Per row its nearest column and their distance, `own` places left out; ids are sorted: the least of equally near ones.

    Rough distances leave few columns to be measured; where they leave many, all are.
    """
    def rise(x, y):
        return 2 * x * y / (x + y)

    d, off = rough_squares(a, b)
    if off.any():
        factor = rise(wa[:, None], wb)
        d *= factor
        room = factor.max(axis=1) * off
        if own is not None:
            d[np.arange(len(d)), own] = np.inf
        least = d.min(axis=1)
        least[np.isinf(least)] = -np.inf
        rows, cols = np.nonzero(d <= (least + 1e-14 * np.abs(least) + 2 * room)[:, None])
        if len(rows) <= d.size // 16:
            exact = squares_at(a, b, rows, cols) * rise(wa[rows], wb[cols])
            order = np.lexsort((cols, exact, rows))
            found, first = np.unique(rows[order], return_index=True)
            at, best = np.zeros(len(a), int), np.full(len(a), np.inf)
            at[found], best[found] = cols[order][first], exact[order][first]
            return at, best
        d = squared_distances(a, b)
    d = d * rise(wa[:, None], wb)
    if own is not None:
        d[np.arange(len(d)), own] = np.inf
    return d.argmin(axis=1), d.min(axis=1)


def _nearest_clusters(across: bool):
    """Per cluster of the left block its nearest one in the right block under Ward's distance, squared, ties by ids."""
    other = "o_" if across else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column("dim")[i].as_py()
                a, b = coords(batch, i, "xs", dim), coords(batch, i, f"{other}xs", dim)
                ia, ib = values(batch, i, "ids"), values(batch, i, f"{other}ids")
                wa, wb = values(batch, i, "weights").astype(float), values(batch, i, f"{other}weights").astype(float)
                best, at = np.full(len(a), np.inf), np.zeros(len(a), int)
                for start in range(0, len(a), STRIPE):
                    part = slice(start, start + STRIPE)
                    own = None if across else np.arange(start, min(start + STRIPE, len(a)))
                    at[part], best[part] = _least_ward(a[part], b, wa[part], wb, own)
                rows = np.flatnonzero(np.isfinite(best))
                u, v = ia[rows], ib[at[rows]]
                low, high = np.where(u < v, u, v), np.where(u < v, v, u)
                yield pa.RecordBatch.from_arrays([pa.array([batch.column("grp")[i].as_py()] * len(rows), pa.string()), pa.array(u, pa.string()),
                                                  pa.array(low, pa.string()), pa.array(high, pa.string()), pa.array(best[rows])], ["grp", "rid", "lo_id", "hi_id", "d"])

    return run


def _ward_rounds(points: DataFrame, dim: int, rows: int | None) -> DataFrame:
    """(grp, u, v, w) of groups of any size; `points` has (grp, rid, weight, xs)."""
    state, merged, limit = cut(points.select("grp", "rid", "weight", "xs")), [], chain_rows(dim, rows)
    while True:
        sizes = cut(state.groupBy("grp").agg(F.count("*").alias("n")))
        fits = sizes.filter(F.col("n") <= limit).select("grp")
        if fits.head(1):  # what is left of these groups is finished in a task each
            merged.append(_chained(state.join(fits, "grp", "left_semi"), "ward", dim, rows, limit))
            state = cut(state.join(fits, "grp", "left_anti"))
            if not state.head(1):
                break
        packed = cut(pack(state, dim, rows).withColumn("w_lo", F.array_min("weights").cast("double")))
        found = dealt(packed.select("grp", "dim", "ids", "weights", "xs")).mapInArrow(_nearest_clusters(False), CHOICE)
        parts = packed.filter("NOT whole")
        found = cut(found)
        places = parts.select("grp", "block", F.explode("ids").alias("rid"))
        # a cluster alone in its block has found nothing yet, so its block is open to all
        reach = places.join(found, ["grp", "rid"], "left").groupBy("grp", "block").agg(F.max(F.coalesce("d", F.lit(float("inf")))).alias("d"))
        by = bounds_of(parts, dim)
        seekers = parts.select("grp", "block", "lo", "hi", "w_lo").join(reach.select("grp", "block", F.sqrt("d").alias("bound")), ["grp", "block"])
        a, b = F.col("a_w_lo"), F.col("b_w_lo")
        low = by.gap("a_", "b_") * F.sqrt(2 * a * b / (a + b))
        pairs = descend(seekers, tree_levels(parts, by.width, {"w_lo": F.min}), low=low, keep=F.lit(True)).filter("block <> other")
        cols = ["ids", "weights", "xs"]
        found = found.unionByName(pair_rows(pairs, parts, parts, ["dim", *cols], cols).mapInArrow(_nearest_clusters(True), CHOICE))
        # a strict order of all pairs, so that the least pair of a group is always mutual
        nearest = cut(found.groupBy("grp", "rid").agg(F.min(F.struct("d", "lo_id", "hi_id")).alias("e")).select("grp", "rid", "e.*"))
        mutual = nearest.groupBy("grp", "lo_id", "hi_id").agg(F.count("*").alias("n"), F.min("d").alias("d")).filter("n = 2")
        mutual = cut(mutual.select("grp", F.col("lo_id").alias("u"), F.col("hi_id").alias("v"), F.sqrt("d").alias("w")))
        merged.append(mutual)
        to = mutual.select("grp", F.col("v").alias("rid"), F.col("u").alias("to"))
        moved = state.join(to, ["grp", "rid"], "left").withColumn("rid", F.coalesce("to", "rid"))
        # a merge joins two rows: their centres by weight
        pair = moved.groupBy("grp", "rid").agg(F.sum("weight").alias("total"), F.collect_list(F.struct("weight", "xs")).alias("p"))
        mean = F.when(F.size("p") == 1, F.col("p")[0]["xs"]).otherwise(F.zip_with(
            F.col("p")[0]["xs"], F.get(F.col("p"), F.lit(1))["xs"],
            lambda x, y: (x * F.col("p")[0]["weight"] + y * F.get(F.col("p"), F.lit(1))["weight"]) / F.col("total")))
        state = cut(pair.select("grp", "rid", F.col("total").alias("weight"), mean.alias("xs")))
    tree = merged[0]
    for more in merged[1:]:
        tree = tree.unionByName(more)
    return tree


def _chained(points: DataFrame, method: str, dim: int, rows: int | None, limit: int) -> DataFrame:
    """(grp, u, v, w) of groups of at most `limit` points, one task each."""
    whole = pack(points, dim, limit)
    return dealt(whole.select("grp", "dim", "ids", "weights", "xs")).mapInArrow(_whole_trees(method, block_rows(dim, rows)), TREE)


def merge_tree(distinct: DataFrame, method: str, dim: int, rows: int | None = None) -> DataFrame:
    """(grp, u, v, w) over the distinct points (grp, rid, weight, xs); a copy counts by its weight.

    Ward's linkage takes groups of any size.  Average and complete linkage need the distances of all members, so a group
    must fit one block (`blocks.block_rows`: 4096 points at 64 dimensions); a larger one is refused, not cut.
    `linkage.agglomerative` splits groups beforehand where a threshold allows it.
    """
    if method not in METHODS:
        raise ValueError(f"unknown linkage: {method}")
    limit = chain_rows(dim, rows) if method == "ward" else block_rows(dim, rows)
    sizes = cut(distinct.groupBy("grp").agg(F.count("*").alias("n")))
    large = sizes.filter(F.col("n") > limit).select("grp")
    many = large.head(1)
    if many and method != "ward":
        raise ValueError(f"{method} linkage takes at most {limit} different points in a group")
    fits = sizes.filter(F.col("n") <= limit).select("grp")
    tree = _chained(distinct.join(fits, "grp", "left_semi"), method, dim, rows, limit)
    return cut(tree.unionByName(_ward_rounds(distinct.join(large, "grp", "left_semi"), dim, rows)) if many else tree)
