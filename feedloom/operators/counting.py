"""How many points lie within given distances, counted over block pairs; core distances by narrowing.

A point asks for the weight of the other points of its group within a few radii.  A pair of blocks that is farther apart
than every radius adds nothing; one that is nearer than every radius adds its whole weight without a look at its points;
only the pairs between are opened.  What leaves a task is one row of counts per point, however many points were counted, and
the counts of a point are added by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.blocks import (
    SLACK, STRIPE_VALUES, bounds_of, box_squares, coords, dealt, descend, rough_squares, squared_distances, squares_at, task_count, tree_levels, values,
)
from feedloom.session import cut

STRIPE = 512        # rows whose distances are held at once
EDGES = 16          # parts that an interval is cut into per round
LISTED = 64         # distances of a point that are listed in the end
PAIRS_PER_TASK = 16  # block pairs of one left block that one task works on
SORTED_COLUMNS = 1024  # of so many columns those between the radii of a row are sorted


def block_pairs(left: DataFrame, right: DataFrame, dim: int) -> DataFrame:
    """(grp, block, other, low, span) of all block pairs within the bound of the left block.

    `left` has grp, block, lo, hi, bound; `right` are blocks.  `low` and `span` are the least and greatest distance
    that points of the two can have.
    """
    whole = left.join(right.filter("whole").select("grp", "block"), ["grp", "block"], "left_semi")
    alone = whole.select("grp", "block", F.col("block").alias("other"), F.lit(0.0).alias("low"), F.lit(float("inf")).alias("span"))
    parts = right.filter("NOT whole")
    if not parts.head(1):
        return alone
    by = bounds_of(parts, dim)
    seekers = left.select("grp", "block", "lo", "hi", "bound").join(parts.select("grp").distinct(), "grp", "left_semi")
    pairs = descend(seekers, tree_levels(parts, by.width), low=by.gap("a_", "b_"), keep=F.lit(True))
    a = left.select("grp", "block", F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"))
    b = right.select("grp", F.col("block").alias("other"), F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"))
    both = pairs.join(a, ["grp", "block"]).join(b, ["grp", "other"])
    return alone.unionByName(both.select("grp", "block", "other", by.gap("a_", "b_").alias("low"), by.span("a_", "b_").alias("span")))


def spread(pairs: DataFrame) -> DataFrame:
    """`pairs` with a `slice` per left block, so that a task works on a bounded number of them."""
    sizes = pairs.groupBy("grp", "block").agg(F.ceil(F.count("*") / PAIRS_PER_TASK).cast("int").alias("slices"))
    return pairs.join(sizes, ["grp", "block"]).withColumn("slice", F.pmod(F.xxhash64("other"), F.col("slices")).cast("int")).drop("slices")


def opened(pairs: DataFrame, left: DataFrame, right: DataFrame, left_cols: list[str], right_cols: list[str]) -> DataFrame:
    """One row per pair with both sides; rows with one left block and slice follow each other."""
    b = right.select("grp", F.col("block").alias("other"), *[F.col(c).alias(f"o_{c}") for c in right_cols])
    pairs = cut(spread(pairs.select("grp", "block", "other")))
    tasks = task_count(pairs, pairs.count())
    return pairs.join(b, ["grp", "other"]).join(left.select("grp", "block", *left_cols), ["grp", "block"]) \
        .repartition(tasks, "grp", "block", "slice").sortWithinPartitions("grp", "block", "slice")


def _weights_within(d: np.ndarray, radii: np.ndarray, weights: np.ndarray, below: np.ndarray | None = None) -> np.ndarray:
    """Per row and radius the weight of the columns with d <= radius; with `below`, d < radius or a tie that `below` lets in."""
    plain = bool((weights == 1).all())
    out = np.zeros((len(d), radii.shape[1]), np.int64)
    for j in range(radii.shape[1]):
        if below is None:
            inside = d <= radii[:, j, None]
        else:
            inside = (d < radii[:, j, None]) | ((d == radii[:, j, None]) & (np.arange(d.shape[1]) < below[:, j, None]))
        out[:, j] = np.count_nonzero(inside, axis=1) if plain else (inside * weights).sum(axis=1)
    return out


def _weights_about(a: np.ndarray, b: np.ndarray, d: np.ndarray, off: np.ndarray, radii: np.ndarray, weights: np.ndarray,
                   squared: bool, below: np.ndarray | None = None) -> np.ndarray:
    """`_weights_within` from rough squares that may be `off`: what lies next to a radius is measured again.

    Columns nearer than all radii of a row are added up and those beyond all are left out; only those between meet each radius.
    Where they are many, they are sorted per row instead, so that their number does not count per radius.
    """
    ends = radii if squared else np.where(radii < 0, -1.0, radii * radii)
    low, high = ends.min(axis=1), ends.max(axis=1)
    slack = off + 1e-14 * np.abs(high)  # room for the roots and squares
    sure = d <= (low - 2 * slack)[:, None]
    base = np.count_nonzero(sure, axis=1) if bool((weights == 1).all()) else sure @ weights
    out = np.repeat(base.astype(np.int64)[:, None], radii.shape[1], axis=1)
    open_ = (d <= (high + 2 * slack)[:, None]) & ~sure
    if d.shape[1] >= SORTED_COLUMNS and np.count_nonzero(open_) * radii.shape[1] > d.size and np.isfinite(high).all():
        for rows, cols, near_to in _add_sorted(out, open_, d, ends, slack, weights):
            _add_measured(out, a, b, rows, cols, near_to, radii, weights, squared, below)
        return out
    rows, cols = np.nonzero(open_)
    near, room, weight = d[rows, cols], slack[rows], weights[cols]
    for j in range(radii.shape[1]):
        gap = near - ends[rows, j]
        inside = gap < -room
        close = np.flatnonzero(np.abs(gap) <= room)
        out[:, j] += np.bincount(rows[inside], weights=weight[inside], minlength=len(d)).astype(np.int64)
        _add_measured(out, a, b, rows[close], cols[close], np.full(len(close), j), radii, weights, squared, below)
    return out


def _add_sorted(out: np.ndarray, open_: np.ndarray, d: np.ndarray, ends: np.ndarray, slack: np.ndarray,
                weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Add the weight of the open columns that surely lie within each radius; yields (row, column, radius) of those next to one."""
    m = ends.shape[1]
    # a radius less its room, and just above a radius with its room: what is sorted in between is next to it
    keys = np.concatenate([ends - slack[:, None], np.nextafter(ends + slack[:, None], np.inf)], axis=1)
    plain, places_of = bool((weights == 1).all()), np.arange(m)
    held, n_held = [], 0
    for i in np.flatnonzero(open_.any(axis=1)):
        at = np.flatnonzero(open_[i])
        near = d[i, at]
        order = near.argsort()
        places = near[order].searchsorted(keys[i])
        first, more = places[:m], places[m:] - places[:m]
        out[i] += first if plain else np.append(0, np.cumsum(weights[at[order]]))[first]
        n = int(more.sum())
        if n:
            found = order[np.arange(n) + np.repeat(first - np.cumsum(more) + more, more)]
            held.append((np.full(n, i), at[found], np.repeat(places_of, more)))
            n_held += n
            if n_held >= STRIPE_VALUES // 2:
                yield tuple(np.concatenate(part) for part in zip(*held))
                held, n_held = [], 0
    if held:
        yield tuple(np.concatenate(part) for part in zip(*held))


def _add_measured(out: np.ndarray, a: np.ndarray, b: np.ndarray, rows: np.ndarray, cols: np.ndarray, near_to: np.ndarray,
                  radii: np.ndarray, weights: np.ndarray, squared: bool, below: np.ndarray | None) -> None:
    """Add the weight of the columns that, measured, lie within the radius each is next to."""
    if len(rows):
        exact = squares_at(a, b, rows, cols)
        exact = exact if squared else np.sqrt(exact)
        r = radii[rows, near_to]
        inside = exact <= r if below is None else (exact < r) | ((exact == r) & (cols < below[rows, near_to]))
        np.add.at(out, (rows[inside], near_to[inside]), weights[cols[inside]])


def _counted(m: int, squared: bool, ties: bool):
    """Counts of the rows of one left block, added over the pairs that follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, last = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                grp, block, other = (batch.column(c)[i].as_py() for c in ("grp", "block", "other"))
                dim = batch.column("dim")[i].as_py()
                a, b = coords(batch, i, "xs", dim), coords(batch, i, "o_xs", dim)
                radii, weights = coords(batch, i, "radii", m), values(batch, i, "o_weights")
                if key != (grp, block):
                    if held is not None:
                        yield _count_rows(*key, held, last)
                    held, key = np.zeros((len(a), m), np.int64), (grp, block)
                last = batch.column("pos")[i].values.to_numpy(zero_copy_only=False)
                below = None
                if ties:  # of the right block's sorted ids, how many are less than the tied one
                    below = np.searchsorted(values(batch, i, "o_ids").astype(str), values(batch, i, "tied").astype(str)).reshape(-1, m)
                rows = np.arange(len(a))
                if block != other:  # points that are farther from the other block's box than all their radii count nothing there
                    with np.errstate(over="ignore"):
                        most = radii.max(axis=1) if squared else radii.max(axis=1) * np.abs(radii.max(axis=1)) * SLACK
                    rows = np.flatnonzero(~(box_squares(a, b) > most))
                for start in range(0, len(rows), STRIPE):
                    part = rows[start:start + STRIPE]
                    d, off = rough_squares(a[part], b)
                    if block == other:  # a point is not counted for itself
                        d[np.arange(len(d)), last[part]] = np.inf
                    ties_at = None if below is None else below[part]
                    with np.errstate(over="ignore"):
                        told = off.any() or np.isfinite(radii[part] * radii[part]).all()
                    if told:
                        held[part] += _weights_about(a[part], b, d, off, radii[part], weights, squared, ties_at)
                    else:
                        held[part] += _weights_within(d if squared else np.sqrt(d), radii[part], weights, ties_at)
        if held is not None:
            yield _count_rows(*key, held, last)

    return run


def _count_rows(grp: str, block: int, counts: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    m = len(counts)
    return pa.RecordBatch.from_arrays(
        [pa.array([grp] * m, pa.string()), pa.array([block] * m, pa.int64()), pa.array(pos.astype(np.int32)),
         *[pa.array(column) for column in counts.T]], ["grp", "block", "pos", *[f"c{j}" for j in range(counts.shape[1])]])


def within(pairs: DataFrame, left: DataFrame, right: DataFrame, m: int, squared: bool = False, ties: bool = False) -> DataFrame:
    """(grp, block, pos, c0, c1, ...): the weight of the other points within each of the `m` radii of a point.

    `pairs` (see `block_pairs`) are all that can lie within a radius.  `left` has grp, block, dim, xs, pos (places of its rows
    in their block), radii (m per row, flat), least (its least radius) and, with `ties`, tied (an id per radius: points at
    exactly this distance count if their id is less).  Radii of -1 count nothing; `squared` says that radii are squared.
    """
    inside = F.col("span") * SLACK < F.col("least")
    marked = pairs.join(left.select("grp", "block", "least"), ["grp", "block"]).withColumn("inside", inside & (F.col("block") != F.col("other")))
    weights = right.select("grp", F.col("block").alias("other"), F.aggregate("weights", F.lit(0).cast("long"), lambda t, w: t + w).alias("w"))
    whole = marked.filter("inside").join(weights, ["grp", "other"]).groupBy("grp", "block").agg(F.sum("w").alias("whole"))
    cols = ["dim", "xs", "pos", "radii", *(["tied"] if ties else [])]
    rows = opened(marked.filter("NOT inside"), left, right, cols, ["xs", "weights", *(["ids"] if ties else [])])
    names = [f"c{j}" for j in range(m)]
    counts = rows.mapInArrow(_counted(m, squared, ties), "grp string, block long, pos int, " + ", ".join(f"{c} long" for c in names))
    summed = counts.groupBy("grp", "block", "pos").agg(*[F.sum(c).alias(c) for c in names])
    every = left.select("grp", "block", F.explode("pos").alias("pos"))
    joined = every.join(summed, ["grp", "block", "pos"], "left").join(whole, ["grp", "block"], "left")
    return joined.select("grp", "block", "pos", *[(F.coalesce(c, F.lit(0)) + F.coalesce("whole", F.lit(0))).alias(c) for c in names])


# --- core distances ----------------------------------------------------------------------------------------

def _own_reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per point of a block the distance within which its own block has k others, infinite where it has fewer."""
    for batch in batches:
        for i in range(batch.num_rows):
            x, weights, k = coords(batch, i, "xs", batch.column("dim")[i].as_py()), values(batch, i, "weights"), batch.column("k")[i].as_py()
            reach = np.full(len(x), np.inf)
            for start in range(0, len(x), STRIPE):
                d = np.sqrt(squared_distances(x[start:start + STRIPE], x))
                order = np.argsort(d, axis=1)
                seen = np.cumsum(weights[order], axis=1) - 1  # a point is no other of itself
                at = (seen >= k).argmax(axis=1)
                rows = np.arange(len(d))
                full = seen[rows, at] >= k
                reach[start:start + STRIPE][full] = d[rows, order[rows, at]][full]
            yield pa.RecordBatch.from_arrays([batch.column("grp")[i:i + 1], batch.column("block")[i:i + 1], pa.array([reach], pa.list_(pa.float64()))], ["grp", "block", "reach"])


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per point the distances to the points of the other block that lie in its interval, with their weights."""
    for batch in batches:
        for i in range(batch.num_rows):
            dim, grp = batch.column("dim")[i].as_py(), batch.column("grp")[i].as_py()
            block, other = batch.column("block")[i].as_py(), batch.column("other")[i].as_py()
            a, b = coords(batch, i, "xs", dim), coords(batch, i, "o_xs", dim)
            lo, hi, pos, weights = (values(batch, i, c) for c in ("lo", "hi", "pos", "o_weights"))
            near = np.arange(len(a)) if block == other else np.flatnonzero(~(box_squares(a, b) > hi * np.abs(hi) * SLACK))
            for start in range(0, len(near), STRIPE):
                part = near[start:start + STRIPE]
                d, off = rough_squares(a[part], b)
                if block == other:
                    d[np.arange(len(d)), pos[part]] = np.inf
                least, most = lo[part] ** 2, hi[part] ** 2
                slack = off + 1e-14 * most
                rows, cols = np.nonzero((d >= (least - slack)[:, None]) & (d <= (most + slack)[:, None]))
                exact = np.sqrt(squares_at(a[part], b, rows, cols))
                inside = (exact > lo[part][rows]) & (exact <= hi[part][rows])
                rows, cols, exact = rows[inside], cols[inside], exact[inside]
                m = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([grp] * m, pa.string()), pa.array(np.full(m, block, np.int64)), pa.array(pos[part][rows].astype(np.int32)),
                     pa.array(exact), pa.array(weights[cols])], ["grp", "block", "pos", "d", "w"])


def _packed(points: DataFrame, blocks: DataFrame, fields: list[str]) -> DataFrame:
    """Rows (grp, block, pos, fields) as arrays beside the vectors of just these places; a block's rows are bounded."""
    rows = points.groupBy("grp", "block").agg(F.sort_array(F.collect_list(F.struct("pos", *fields))).alias("p"))
    rows = rows.join(blocks.select("grp", "block", "dim", "lo", "hi", "xs"), ["grp", "block"]).withColumnsRenamed({"lo": "block_lo", "hi": "block_hi"})
    part = F.flatten(F.transform(F.col("p.pos"), lambda i: F.slice("xs", i * F.col("dim") + 1, F.col("dim"))))
    return rows.select("grp", "block", "dim", "block_lo", "block_hi", part.alias("xs"), F.col("p.pos").alias("pos"), *[F.col(f"p.{f}").alias(f) for f in fields])


def narrowed_cores(parts: DataFrame, dim: int) -> DataFrame:
    """(grp, block, cores array): for every point of `parts` (blocks with `k`) the distance to its k-th other point.

    Each point keeps an interval that holds this distance and the weight up to its lower end.  A round counts the weight up
    to `EDGES` places of the interval and keeps the part in which the k-th point lies, so an interval holds some sixteenth
    of the points after it.  Once few points are left in it, their distances are listed; an interval that cannot be cut any
    more holds points at one distance.  So what is kept per point does not depend on k.  Where a point has fewer than k
    others, the farthest decides.
    """
    by = bounds_of(parts, dim)
    total = F.aggregate("weights", F.lit(0).cast("long"), lambda t, w: t + w)
    groups = parts.groupBy("grp").agg(
        F.sum(total).alias("total"), F.array(*[F.min(F.col("lo")[i]) for i in range(by.width)]).alias("b_lo"),
        F.array(*[F.max(F.col("hi")[i]) for i in range(by.width)]).alias("b_hi"))
    capped = parts.join(groups, "grp").withColumn("k", F.least(F.col("k").cast("long"), F.col("total") - 1))
    capped = capped.withColumnsRenamed({"lo": "a_lo", "hi": "a_hi"}).withColumn("most", by.span("a_", "b_"))
    capped = cut(capped.select("grp", "block", "n", "dim", "xs", "weights", "k", "most", "whole", F.col("a_lo").alias("lo"), F.col("a_hi").alias("hi")))
    reach = dealt(capped.select("grp", "block", "dim", "xs", "weights", "k")).mapInArrow(_own_reach, "grp string, block long, reach array<double>")
    points = capped.select("grp", "block", "k", "most", F.posexplode("weights").alias("pos", "weight")).join(
        reach.select("grp", "block", F.posexplode("reach").alias("pos", "reach")), ["grp", "block", "pos"])
    spare = F.col("weight") - 1
    points = cut(points.select("grp", "block", "pos", "k", spare.alias("spare"), spare.alias("below"), F.lit(0.0).alias("low"), F.least("reach", "most").alias("high")))
    settled = points.filter(F.col("spare") >= F.col("k")).select("grp", "block", "pos", F.lit(0.0).alias("core"))
    state = points.filter(F.col("spare") < F.col("k"))
    edges = F.transform(F.sequence(F.lit(1), F.lit(EDGES)), lambda j: F.when(j == EDGES, F.col("high")).otherwise(
        F.col("low") + (F.col("high") - F.col("low")) * (j / F.lit(float(EDGES)))))
    pairs, lists = None, []
    while True:
        state = cut(state.withColumn("radii", edges))
        if not state.head(1):
            break
        left = _packed(state, capped, ["radii", "low", "high"])
        left = cut(left.select("grp", "block", "dim", "xs", "pos", F.col("block_lo").alias("lo"), F.col("block_hi").alias("hi"), F.flatten("radii").alias("radii"),
                               F.array_min("low").alias("least"), F.array_max("high").alias("bound")))
        if pairs is None:
            pairs = cut(block_pairs(left, capped, dim))
        due = pairs.join(left.select("grp", "block", "bound"), ["grp", "block"]).filter(F.col("low") <= F.col("bound") * SLACK).drop("bound")
        counts = within(due, left, capped, EDGES)
        seen = F.transform(F.array(*[f"c{j}" for j in range(EDGES)]), lambda c: c + F.col("spare"))
        found = state.join(counts, ["grp", "block", "pos"]).withColumn("seen", seen)
        found = found.withColumn("at", F.array_position(F.transform("seen", lambda c: c >= F.col("k")), True).cast("int"))
        found = cut(found.select(
            "grp", "block", "pos", "k", "spare",
            F.when(F.col("at") > 1, F.get("seen", F.col("at") - 2)).otherwise(F.col("below")).alias("below"),
            F.when(F.col("at") > 1, F.get("radii", F.col("at") - 2)).otherwise(F.col("low")).alias("new_low"),
            F.get("radii", F.col("at") - 1).alias("new_high"), F.get("seen", F.col("at") - 1).alias("upto"), "low", "high"))
        stuck = (F.col("new_low") == F.col("low")) & (F.col("new_high") == F.col("high"))
        few = F.col("upto") - F.col("below") <= LISTED
        settled = settled.unionByName(found.filter(stuck & ~few).select("grp", "block", "pos", F.col("new_high").alias("core")))
        rest = found.select("grp", "block", "pos", "k", "spare", "below", F.col("new_low").alias("low"), F.col("new_high").alias("high"), few.alias("few"), stuck.alias("stuck"))
        lists.append(rest.filter("few").drop("few", "stuck"))
        state = rest.filter("NOT few AND NOT stuck").drop("few", "stuck")
    if lists:
        due = lists[0]
        for more in lists[1:]:
            due = due.unionByName(more)
        left = _packed(due, capped, ["low", "high"])
        left = cut(left.select("grp", "block", "dim", "xs", "pos", F.col("low").alias("lo"), F.col("high").alias("hi"),
                               F.array_min("low").alias("least"), F.array_max("high").alias("bound")))
        near = pairs.join(left.select("grp", "block", "least", "bound"), ["grp", "block"]).filter(
            (F.col("low") <= F.col("bound") * SLACK) & (F.col("span") * SLACK >= F.col("least")))
        rows = opened(near, left, capped, ["dim", "xs", "pos", "lo", "hi"], ["xs", "weights"])
        rows = rows.mapInArrow(_listed, "grp string, block long, pos int, d double, w long")
        rows = rows.groupBy("grp", "block", "pos").agg(F.sort_array(F.collect_list(F.struct("d", "w"))).alias("near"))
        walked = F.aggregate("near", F.struct(F.col("below").alias("seen"), F.col("high").alias("core")), lambda s, e: F.struct(
            (s["seen"] + e["w"]).alias("seen"), F.when(s["seen"] >= F.col("k"), s["core"]).otherwise(e["d"]).alias("core")))["core"]
        settled = settled.unionByName(due.join(rows, ["grp", "block", "pos"]).select("grp", "block", "pos", walked.alias("core")))
    return settled.groupBy("grp", "block").agg(F.sort_array(F.collect_list(F.struct("pos", "core")))["core"].alias("cores"))
