"""Spanning trees of large groups from a tree that is nearly least.

Any spanning tree rules out nearly all other edges: an edge that comes after every edge of the tree's path between its ends,
in the order of (weight, lesser id, greater id), is not in the least tree.  So a first tree is made of short lists, of each
point's least edges to a few near blocks, and every block pair within the bounds is then looked at once, for the
edges the first tree does not rule out.  The least tree of these and the first one is the least tree of all.  Where the
first tree is poor, more edges are looked at; no result depends on it.

A path's greatest edge is bounded without a look at the path.  The tree's edges, taken in order, grow components; one
that reaches a share of the group is an anchor.  A point keeps the edge that tied it to its anchor, and two anchors the
edge that tied them; the greatest of the three is no less than any edge between two points.  Distances are never kept: one task
holds the points and the edges that are left of a group, and everything else is done by block pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.blocks import (
    SLACK, bounds_of, box_squares, coords, rough_squares, squares_at, stripes, values,
)
from feedloom.operators.density import join_weights
from feedloom.operators.knn import pair_rows
from feedloom.session import cut

SEEDED_ROWS, SEEDED_VALUES = 1_048_576, 8_388_608  # points of a group, and their coordinates, that one task holds
NEAR_BLOCKS, LIST = 16, 8   # blocks that a point's first edges go to besides its own, and first edges of a point
ANCHORS = 256               # an anchor has this share of its group
LINK_POINTS, LINK_TRIES = 64, 8  # points of a component that look for a way out, and those that go on from what they found

EDGES = "grp string, u array<int>, v array<int>, w array<double>"
START = ("grp string, block long, at array<int>, w array<double>, lo array<int>, hi array<int>, anchor array<int>, "
         "anchors array<int>, g_at array<int>, g_w array<double>, g_lo array<int>, g_hi array<int>")


def least_forest(n: int, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of edges in order, the places of those that make the least forest of `n` nodes, and the component of every node."""
    comp, due, taken = np.arange(n), np.arange(len(u)), []
    while True:
        a, b = comp[u[due]], comp[v[due]]
        open_ = a != b
        due, a, b = due[open_], a[open_], b[open_]
        if not len(due):
            break
        first = np.full(n, len(u))
        other = first.copy()
        first[a[::-1]] = other[b[::-1]] = due[::-1]  # of several numbers put in one place the last one, the least, stays
        first = np.minimum(first, other)
        roots = np.flatnonzero(first < len(u))
        least = first[roots]
        ends = comp[u[least]]
        to = np.where(ends == roots, comp[v[least]], ends)
        parent = np.arange(n)
        parent[roots] = to
        mutual = roots[(parent[to] == roots) & (roots < to)]
        parent[mutual] = mutual
        taken.append(np.unique(least))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        comp = parent[comp]
    return np.sort(np.unique(np.concatenate(taken))) if taken else np.zeros(0, int), comp


def _in_order(u: np.ndarray, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges as (lesser, greater, weight), in order."""
    lo, hi = np.minimum(u, v), np.maximum(u, v)
    order = np.lexsort((hi, lo, w))
    return lo[order], hi[order], w[order]


def _least_tree(n: int, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    lo, hi, w = _in_order(u, v, w)
    kept, comp = least_forest(n, lo, hi)
    return lo[kept], hi[kept], w[kept], comp


def _joined(parts: pd.Series, kind: type) -> np.ndarray:
    return np.concatenate([np.asarray(p, kind) for p in parts] or [np.zeros(0, kind)])


def _ranks(rows: pd.DataFrame) -> pd.DataFrame:
    """Points by the place of their id among all ids of the group."""
    ids = np.concatenate([np.asarray(p, object) for p in rows["ids"]])
    _, rank = np.unique(ids, return_inverse=True)
    ends = np.cumsum([len(p) for p in rows["ids"]])
    return pd.DataFrame({"grp": rows["grp"], "block": rows["block"], "ranks": [r.astype("int32") for r in np.split(rank, ends[:-1])]})


# --- the first tree -----------------------------------------------------------------------------------

def _first(rows: np.ndarray, ranks: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Places of the `LIST` least entries of each row, by (row, weight, rank)."""
    order = np.lexsort((ranks, w, rows))
    rows = rows[order]
    return order[np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < LIST]


def _near_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least edges of the points of a left block to the right blocks that follow each other; its own block comes first."""
    def row(grp: str, ranks: np.ndarray, rows: np.ndarray, to: np.ndarray, w: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([grp]), *(pa.array([x], pa.list_(kind)) for x, kind in ((ranks[rows], pa.int32()), (to, pa.int32()), (w, pa.float64())))],
            ["grp", "u", "v", "w"])

    key, held, ra = None, None, None
    for batch in batches:
        for i in range(batch.num_rows):
            dim, now = batch.column("dim")[i].as_py(), (batch.column("grp")[i].as_py(), batch.column("block")[i].as_py())
            if now != key:
                if key is not None:
                    yield row(key[0], ra, *held)
                key, held = now, (np.zeros(0, int), np.zeros(0, np.int32), np.zeros(0))
                xa, ca, ra = coords(batch, i, "xs", dim), values(batch, i, "cores"), values(batch, i, "ranks")
                worst = np.full(len(xa), np.inf)
            xb, cb, rb = coords(batch, i, "o_xs", dim), values(batch, i, "o_cores"), values(batch, i, "o_ranks")
            twice = len(np.intersect1d(ra, rb)) > 0
            found = [held]
            open_ = np.flatnonzero(~(box_squares(xa, xb) > worst ** 2 * SLACK))
            for here in stripes(len(open_), len(xb)):
                part = open_[here]
                d, off = rough_squares(xa[part], xb)
                np.maximum(d, ca[part, None] ** 2, out=d)
                np.maximum(d, cb ** 2, out=d)
                if twice:
                    d[ra[part, None] == rb] = np.inf
                inside = d <= (worst[part] ** 2 * SLACK + 2 * off)[:, None]
                if d.shape[1] > LIST and np.count_nonzero(inside) > 4 * LIST * len(d):
                    inside &= d <= (np.partition(d, LIST - 1, axis=1)[:, LIST - 1] * SLACK + 2 * off)[:, None]
                rows, cols = np.nonzero(inside & np.isfinite(d))
                w = np.maximum(np.sqrt(squares_at(xa[part], xb, rows, cols)), np.maximum(ca[part][rows], cb[cols]))
                top = _first(rows, rb[cols], w)
                found.append((part[rows[top]], rb[cols[top]], w[top]))
            rows, to, w = (np.concatenate(x) for x in zip(*found))
            top = _first(rows, to, w)
            held = rows, to, w = rows[top], to[top], w[top]
            full = np.bincount(rows, minlength=len(xa)) == LIST
            worst = np.full(len(xa), np.inf)
            last = np.flatnonzero(np.diff(np.append(rows, -1)))
            worst[rows[last]] = w[last]
            worst[~full] = np.inf
    if key is not None:
        yield row(key[0], ra, *held)


def _links(x: np.ndarray, core: np.ndarray, rank: np.ndarray, comp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An edge out of every component but the largest; a short one, not always the shortest."""
    def weights(at: np.ndarray, barred: np.ndarray) -> np.ndarray:
        w = np.maximum(np.sqrt(np.maximum(rough_squares(x[at], x)[0], 0.0)), np.maximum(core[at, None], core))
        w[:, barred] = np.inf
        return np.where(np.isnan(w), np.inf, w)

    of = comp[rank]
    order = np.argsort(of, kind="stable")
    starts = np.flatnonzero(np.diff(np.append(-1, of[order])))
    groups = np.split(order, starts[1:])
    groups.sort(key=len)
    out = []
    for members in groups[:-1]:
        own = np.zeros(len(x), bool)
        own[members] = True
        most = min(len(members), 1 if len(groups) > 500 else max(4, min(LINK_POINTS, len(members) // 64)))
        at = members[np.argsort(core[members], kind="stable")][np.linspace(0, len(members) - 1, most).astype(int)]
        best = []
        for part in stripes(len(at), len(x)):
            w = weights(at[part], own)
            to = w.argmin(axis=1)
            best += zip(w[np.arange(len(to)), to], at[part], to)
        best.sort()
        best = best[:LINK_TRIES if len(members) > LINK_POINTS else 1]
        for _ in range(3 if len(members) > LINK_POINTS else 0):  # there and back, each time to the nearest
            back = weights(np.array([b[2] for b in best]), ~own).argmin(axis=1)
            w = weights(back, own)
            to = w.argmin(axis=1)
            best = sorted([*best, *zip(w[np.arange(len(to)), to], back, to)])[:LINK_TRIES]
        out.append((best[0][1], best[0][2] if np.isfinite(best[0][0]) else np.flatnonzero(~own)[0]))
    a, b = (np.array(e) for e in zip(*out))
    with np.errstate(over="ignore", invalid="ignore"):
        w = np.maximum(np.sqrt(squares_at(x, x, a, b)), np.maximum(core[a], core[b]))
    return rank[a], rank[b], np.where(np.isnan(w), np.inf, w)


def _start(rows: pd.DataFrame) -> pd.DataFrame:
    """The first tree (block -1), and per block what it says of its points and their anchors."""
    edges, rows = rows[rows["block"].isna()], rows[rows["block"].notna()]
    grp, dim = rows["grp"].iloc[0], int(rows["dim"].iloc[0])
    rank, core, x = _joined(rows["ranks"], np.int64), _joined(rows["cores"], float), _joined(rows["xs"], float).reshape(-1, dim)
    n = int(rank.max()) + 1
    lo, hi, w, comp = _least_tree(n, _joined(edges["u"], np.int64), _joined(edges["v"], np.int64), _joined(edges["w"], float))
    while len(lo) < n - 1:
        more = _links(x, core, rank, comp)
        lo, hi, w, comp = _least_tree(n, np.append(lo, more[0]), np.append(hi, more[1]), np.append(w, more[2]))
    if n < 2:
        return pd.DataFrame(columns=[c.split(" ")[0] for c in START.split(", ")])
    anchor, joined, between, m = join_weights(np.ones(n, int), np.zeros(n), lo, hi, np.arange(n - 1, dtype=float), min(n, max(2, n // ANCHORS)))
    tied, sets, where = np.full((m, m), -1), [np.array([i]) for i in range(m)], list(range(m))
    for a, b, e in between:
        a, b = where[a], where[b]
        tied[np.ix_(sets[a], sets[b])] = tied[np.ix_(sets[b], sets[a])] = int(e)
        for i in sets[b]:
            where[i] = a
        sets[a] = np.append(sets[a], sets[b])
    out = [(grp, -1, [], w, lo, hi, [], [], [], [], [], [])]
    told = lambda e: (np.where(e < 0, -np.inf, w[e]), np.where(e < 0, -1, lo[e]), np.where(e < 0, -1, hi[e]))
    for block, ranks in zip(rows["block"].astype("int64"), rows["ranks"]):
        at = joined[ranks].astype(int)
        anchors, own = np.unique(anchor[ranks], return_inverse=True)
        ties = tied[anchors].ravel()
        out.append((grp, block, at, *told(at), own, anchors, ties, *told(ties)))
    return pd.DataFrame(out, columns=[c.split(" ")[0] for c in START.split(", ")])


# --- what the first tree does not rule out ------------------------------------------------------------------------

def _better_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a block pair that come before the greatest one on the first tree's path, as far as the bounds tell."""
    def bounds(batch: pa.RecordBatch, i: int, side: str, here: np.ndarray, tie: tuple) -> tuple[np.ndarray, ...]:
        own = [values(batch, i, f"{side}{c}")[here] for c in ("at", "w", "lo", "hi")]
        return tuple(np.where(own[0] >= tie[0], x, t) for x, t in zip(own, tie))

    for batch in batches:
        for i in range(batch.num_rows):
            dim, same = batch.column("dim")[i].as_py(), batch.column("block")[i].as_py() == batch.column("other")[i].as_py()
            xs, o_xs, cores, o_cores = coords(batch, i, "xs", dim), coords(batch, i, "o_xs", dim), values(batch, i, "cores"), values(batch, i, "o_cores")
            ranks, o_ranks, anchor, o_anchor = (values(batch, i, c) for c in ("ranks", "o_ranks", "anchor", "o_anchor"))
            ties = [coords(batch, i, f"g_{c}", values(batch, i, "g_at").size // values(batch, i, "anchors").size) for c in ("at", "w", "lo", "hi")]
            found = []
            for a in range(len(ties[0])):
                for b, of in enumerate(values(batch, i, "o_anchors")):
                    mine, yours = np.flatnonzero(anchor == a), np.flatnonzero(o_anchor == b)
                    tie = tuple(t[a, of] for t in ties)
                    left, right = bounds(batch, i, "", mine, tie), bounds(batch, i, "o_", yours, tie)
                    # points that are farther from the box of the others than any bound between them have no part
                    near = np.flatnonzero(~(box_squares(xs[mine], o_xs[yours]) > np.maximum(left[1], right[1].max()) ** 2 * SLACK))
                    mine, left = mine[near], [x[near] for x in left]
                    if not len(mine):
                        continue
                    near = np.flatnonzero(~(box_squares(o_xs[yours], xs[mine]) > np.maximum(right[1], left[1].max()) ** 2 * SLACK))
                    yours, right = yours[near], [x[near] for x in right]
                    if not len(yours):
                        continue
                    xb, cb = o_xs[yours], o_cores[yours]
                    far = right[1] ** 2
                    for part in stripes(len(mine), len(yours)):
                        xa, ca = xs[mine[part]], cores[mine[part]]
                        d, off = rough_squares(xa, xb)
                        near, room = left[1][part] ** 2, 2 * off.max(initial=0.0)
                        inside = d <= (near * SLACK + room)[:, None]
                        inside |= d <= far * SLACK + room
                        rows, cols = np.nonzero(inside)
                        w = np.maximum(np.sqrt(squares_at(xa, xb, rows, cols)), np.maximum(ca[rows], cb[cols]))
                        u, v = ranks[mine[part]][rows], o_ranks[yours][cols]
                        lo, hi = np.minimum(u, v), np.maximum(u, v)
                        by_left = left[0][part][rows] >= right[0][cols]
                        _, bw, blo, bhi = (np.where(by_left, x[part][rows], y[cols]) for x, y in zip(left, right))
                        before = (w < bw) | ((w == bw) & ((lo < blo) | ((lo == blo) & (hi < bhi))))
                        kept = before & np.isfinite(w) & ((u < v) if same else (u != v))
                        found.append((lo[kept], hi[kept], w[kept]))
            if not found:
                continue
            lo, hi, w = (np.concatenate(x) for x in zip(*found))
            if len(lo) > len(xs) + len(o_xs):  # no more than their own least forest can matter
                lo, hi, w = _in_order(lo, hi, w)
                names, ends = np.unique(np.concatenate([lo, hi]), return_inverse=True)
                kept, _ = least_forest(len(names), ends[:len(lo)], ends[len(lo):])
                lo, hi, w = lo[kept], hi[kept], w[kept]
            if len(lo):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("grp")[i].as_py()]), *(pa.array([x], pa.list_(kind)) for x, kind in ((lo, pa.int32()), (hi, pa.int32()), (w, pa.float64())))],
                    ["grp", "u", "v", "w"])


def _finish(rows: pd.DataFrame) -> pd.DataFrame:
    """The least tree of the edges that are left, with ids."""
    told = rows[rows["ids"].notna()]
    ids, rank = np.concatenate([np.asarray(p, object) for p in told["ids"]]), _joined(told["ranks"], np.int64)
    names = np.empty(int(rank.max()) + 1, object)
    names[rank] = ids
    edges = rows[rows["u"].notna()]
    lo, hi, w, _ = _least_tree(len(names), _joined(edges["u"], np.int64), _joined(edges["v"], np.int64), _joined(edges["w"], float))
    real = np.isfinite(w)
    return pd.DataFrame({"grp": rows["grp"].iloc[0], "u": names[lo[real]], "v": names[hi[real]], "w": w[real]})


def seeded_trees(parts: DataFrame, dim: int, shape: str) -> DataFrame:
    """Edges (grp, u, v, w) of the least trees of groups in several blocks, each small enough for `SEEDED_ROWS` and `SEEDED_VALUES`."""
    ranks = parts.select("grp", "block", "ids").groupBy("grp").applyInPandas(_ranks, "grp string, block long, ranks array<int>")
    packed = cut(parts.select("grp", "block", "dim", "ids", "xs", "cores", "lo", "hi").join(ranks, ["grp", "block"]))
    centre = F.zip_with("lo", "hi", lambda p, q: (p + q) / 2)
    centres = cut(packed.select("grp", "block", centre.alias("c")))
    apart = F.aggregate(F.zip_with("c", "o_c", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, x: s + x)
    order = Window.partitionBy("grp", "block").orderBy(F.col("other") != F.col("block"), "apart", "other")
    pairs = centres.join(centres.select("grp", F.col("block").alias("other"), F.col("c").alias("o_c")), "grp").withColumn("apart", apart)
    pairs = cut(pairs.withColumn("near", F.row_number().over(order)).filter(F.col("near") <= NEAR_BLOCKS + 1).select("grp", "block", "other", "near"))
    left = packed.select("grp", "block", "dim", "xs", "cores", "ranks")
    right = packed.select("grp", F.col("block").alias("other"), *[F.col(c).alias(f"o_{c}") for c in ("xs", "cores", "ranks")])
    # every left block goes to a task of its own, so that no two large ones meet in one while others idle
    blocks = centres.count()
    numbers = cut(centres.select("grp", "block").withColumn("task", (F.row_number().over(Window.orderBy("grp", "block")) - 1).cast("int")))
    lists = pairs.join(numbers, ["grp", "block"]).join(left, ["grp", "block"]).join(right, ["grp", "other"]).repartitionById(
        blocks, "task").sortWithinPartitions("grp", "block", "near").drop("task")
    lists = cut(lists.mapInArrow(_near_edges, EDGES))
    none = lambda kind: F.array().cast(kind)
    points = packed.select("grp", "block", "dim", "ranks", "cores", "xs", none("array<int>").alias("u"), none("array<int>").alias("v"), none("array<double>").alias("w"))
    listed = lists.select("grp", F.lit(None).cast("long").alias("block"), F.lit(dim).alias("dim"), none("array<int>").alias("ranks"), none("array<double>").alias("cores"),
                          none("array<double>").alias("xs"), "u", "v", "w")
    start = cut(points.unionByName(listed).groupBy("grp").applyInPandas(_start, START))
    tree = start.filter("block < 0").select("grp", F.col("lo").alias("u"), F.col("hi").alias("v"), "w")
    told = start.filter("block >= 0")
    # block pairs that can hold an edge within the bounds, each once
    by = bounds_of(packed, dim)
    narrow = cut(told.select("grp", "block", F.array_max("w").alias("most"), "anchors", "g_w").join(packed.select("grp", "block", "lo", "hi"), ["grp", "block"]))
    a = narrow.select("grp", *[F.col(c).alias(f"a_{c}") for c in ("block", "most", "anchors", "g_w", "lo", "hi")])
    b = narrow.select("grp", *[F.col(c).alias(f"b_{c}") for c in ("block", "most", "anchors", "lo", "hi")])
    width = (F.size("a_g_w") / F.size("a_anchors")).cast("int")
    ties = F.flatten(F.transform(F.sequence(F.lit(0), F.size("a_anchors") - 1), lambda i: F.transform("b_anchors", lambda j: F.get(F.col("a_g_w"), i * width + j))))
    pairs = a.join(b, "grp").filter(F.col("a_block") <= F.col("b_block")).filter(
        (F.col("a_block") == F.col("b_block")) | (by.gap("a_", "b_") <= F.greatest("a_most", "b_most", F.array_max(ties)) * SLACK))
    pairs = pairs.select("grp", F.col("a_block").alias("block"), F.col("b_block").alias("other"))
    both = cut(packed.select("grp", "block", "dim", "xs", "cores", "ranks").join(told, ["grp", "block"]))
    cols = ["xs", "cores", "ranks", "at", "w", "lo", "hi", "anchor", "anchors"]
    better = pair_rows(pairs, both, both, ["dim", *cols, "g_at", "g_w", "g_lo", "g_hi"], cols).mapInArrow(_better_edges, EDGES)
    edges = tree.unionByName(cut(better)).withColumn("ids", F.lit(None).cast("array<string>")).withColumn("ranks", F.lit(None).cast("array<int>"))
    names = packed.select("grp", F.lit(None).cast("array<int>").alias("u"), F.lit(None).cast("array<int>").alias("v"),
                          F.lit(None).cast("array<double>").alias("w"), "ids", "ranks")
    return edges.unionByName(names).groupBy("grp").applyInPandas(_finish, shape)
