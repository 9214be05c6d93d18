"""Points packed into blocks of bounded size, and the block pairs a search must look at.

Neighbour search inside a group would need all pairs of the group.  Here the points of a
group are ordered and cut into blocks of at most `rows` points; one row holds one block.
A search compares a block only with blocks that can lie within the block's current bound,
found by descending a tree of blocks one level at a time with equi-joins.  A task then works
on one block pair at a time, so no task ever holds a whole group, and nothing within a bound
is left out.

What a block says of its points are intervals `lo`, `hi`.  In few dimensions these are its
bounding box, and the order is a space-filling curve.  In many dimensions boxes overlap
whatever the data; there the intervals are those of the distances to a few pivots, and the
order is by nearest pivots.  By the triangle inequality, points whose distances to a pivot
differ by g are at least g apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import cut

BLOCK_ROWS = 4096      # points per block
BLOCK_VALUES = 262_144  # coordinates per block, so wide vectors give shorter blocks
FANOUT_BITS = 3        # eight children per tree node
CURVE_DIMS, CURVE_BITS = 6, 10
SLACK = 1 + 1e-9       # rounding must never drop a pair that lies on the bound
BOX_DIMS = 8           # vectors with more parts are told apart by pivots
SHORT_DIMS = 3         # so short vectors are measured by coordinate at once
PIVOTS, PIVOT_SAMPLE = 32, 2000  # the pivots are fitted on at most so many points
STRIPE_VALUES = 2_097_152  # distances that a task holds at once
ROUNDING = 1e-12       # relative error of a distance to a pivot, with room
TASKS_PER_CORE, ROWS_PER_TASK = 4, 16  # tasks that packed rows are dealt to, and rows of a task at most

PACKED = ("grp string, block long, n int, dim int, ids array<string>, weights array<long>, xs array<double>, "
          "lo array<double>, hi array<double>, whole boolean")


def block_rows(dim: int, limit: int | None = None) -> int:
    return limit or max(64, min(BLOCK_ROWS, BLOCK_VALUES // max(dim, 1)))


def distinct_points(points: DataFrame, keep: int = 1) -> DataFrame:
    """Copies of a vector as one weighted point (grp, rid, xs, weight, copies).

    `rid` is the least id of the copies; `copies` holds the first `keep` ids only, picked by
    a pruned rank, as a third of a group may be copies of one vector.
    """
    window = Window.partitionBy("grp", "xs").orderBy("pid")
    firsts = points.withColumn("r", F.row_number().over(window)).filter(F.col("r") <= keep)
    firsts = firsts.groupBy("grp", "xs").agg(F.sort_array(F.collect_list("pid")).alias("copies"))
    counts = points.groupBy("grp", "xs").agg(F.count("*").alias("weight"), F.min("pid").alias("rid"))
    if keep == 1:
        return counts.select("grp", "rid", "xs", "weight", F.array("rid").alias("copies"))
    return counts.join(firsts, ["grp", "xs"]).select("grp", "rid", "xs", "weight", "copies")


def _curve_key(dim: int) -> Column:
    """Bits of the first coordinates, interleaved; one scale for all, so that blocks of a long thin group stay compact."""
    dims = min(dim, CURVE_DIMS)
    cells = []
    widths = [F.col("maxs")[i] - F.col("mins")[i] for i in range(dims)]
    width = F.greatest(*widths) if dims > 1 else widths[0]
    for i in range(dims):
        share = F.coalesce(F.try_divide(F.col("xs")[i] - F.col("mins")[i], width), F.lit(0.0))
        cells.append(F.least(F.floor(share * 2**CURVE_BITS), F.lit(2**CURVE_BITS - 1)).cast("bigint"))
    key = F.lit(0).cast("bigint")
    for bit in range(CURVE_BITS):
        for i, cell in enumerate(cells):
            key = key + F.shiftleft(F.shiftright(cell, bit).bitwiseAND(F.lit(1).cast("bigint")), bit * dims + i)
    return key


def choose_pivots(points: DataFrame, pivots: int = PIVOTS, sample: int = PIVOT_SAMPLE) -> np.ndarray:
    """Centres of a bounded sample of (rid, xs), the points with the least hashes.  Any choice gives right results."""
    def least(rows: DataFrame) -> list:
        return rows.orderBy(F.xxhash64("rid"), "rid").limit(sample).select("xs").collect()

    n = points.count()
    rows = []
    if n > 4 * sample:  # every task sends its least rows, so they are thinned by the hash to about twice the sample first
        rows = least(points.filter(F.xxhash64("rid") < int(2**64 * (2 * sample + 200) / n) - 2**63))
    x = np.array([r.xs for r in rows or least(points)], float)
    if not len(x):
        return np.zeros((1, 1))
    centres = [x[0]]
    far = ((x - x[0]) ** 2).sum(axis=1)
    while len(centres) < pivots and far.max() > 0:
        centres.append(x[far.argmax()])
        far = np.minimum(far, ((x - centres[-1]) ** 2).sum(axis=1))
    found = np.array(centres)
    for _ in range(5):
        nearest = ((x[:, None] - found[None]) ** 2).sum(axis=2).argmin(axis=1)
        found = np.array([x[nearest == i].mean(axis=0) if (nearest == i).any() else c for i, c in enumerate(found)])
    return found


def to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of all points to all pivots."""
    return np.sqrt(squared_distances(x, pivots))


def _by_pivots(pivots: np.ndarray):
    """Add `key`, the numbers of the three nearest pivots, and `near`, the distance to the nearest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d = to_pivots(batch.column("xs").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1), pivots)
            nearest = np.argsort(d, axis=1, kind="stable")[:, :3]
            key = np.zeros(len(d), np.int64)
            for column in nearest.T:
                key = key * len(pivots) + column
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key), pa.array(d.min(axis=1))], [*batch.schema.names, "key", "near"])

    return run


def _list(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array([values], pa.list_(kind))


def pack(distinct: DataFrame, dim: int, rows: int | None = None, pivots: np.ndarray | None = None, most_whole: int = 0) -> DataFrame:
    """Blocks of the distinct points, written once.  `whole` marks a block that is its entire group."""
    return pack_told(distinct, dim, rows, pivots, most_whole)[0]


def pack_told(distinct: DataFrame, dim: int, rows: int | None = None, pivots: np.ndarray | None = None,
              most_whole: int = 0) -> tuple[DataFrame, bool]:
    """`pack`, and whether there is any group of several blocks.  `pivots` may be given, so that several tables share them.

    Small groups are gathered by a plain group-by of at most `rows` points, or `most_whole` if that is more.  Larger ones are
    sorted across the cluster by range partitioning and cut as the rows stream by.
    """
    limit = block_rows(dim, rows)
    whole = max(limit, most_whole)
    counts = distinct.groupBy("grp").agg(F.count("*").alias("n"))
    most = counts.agg(F.max("n")).head()[0] or 0

    def gathered(points: DataFrame) -> DataFrame:
        packed = points.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("rid", "weight", "xs"))).alias("p"))
        none = F.array().cast("array<double>")  # a whole group is compared with itself only
        return packed.select("grp", F.lit(0).cast("long").alias("block"), F.size("p").alias("n"), F.lit(dim).alias("dim"), F.col("p.rid").alias("ids"),
                             F.col("p.weight").alias("weights"), F.flatten("p.xs").alias("xs"), none.alias("lo"), none.alias("hi"), F.lit(True).alias("whole"))

    if most <= whole:
        return cut(gathered(distinct)), False
    if dim > BOX_DIMS and pivots is None:
        pivots = choose_pivots(distinct)

    def extent(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        told = x if pivots is None else to_pivots(x, pivots)
        return told.min(axis=0), told.max(axis=0)

    sizes = cut(distinct.groupBy("grp").agg(
        F.count("*").alias("n"),
        F.array(*[F.min(F.col("xs")[i]) for i in range(min(dim, CURVE_DIMS))]).alias("mins"),
        F.array(*[F.max(F.col("xs")[i]) for i in range(min(dim, CURVE_DIMS))]).alias("maxs"),
    ))
    small = gathered(distinct.join(sizes.filter(F.col("n") <= whole).select("grp"), "grp", "left_semi"))
    keyed = distinct.join(sizes.filter(F.col("n") > whole), "grp").select(
        "grp", "rid", "weight", "xs", *([_curve_key(dim).alias("key"), F.lit(0.0).alias("near")] if pivots is None else []))
    if pivots is not None:
        keyed = keyed.mapInArrow(_by_pivots(pivots), "grp string, rid string, weight long, xs array<double>, key long, near double")
    order = ["grp", "key", "near", "rid"]
    keyed = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "grp", "rid", "weight", "xs", F.spark_partition_id().alias("part"), "key")
    cell = 1 if pivots is None else len(pivots) ** 2  # points of one nearest pivot
    least = limit // 4  # a block may end early where a cell ends, but not too early

    def cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {"grp": None, "ids": [], "w": [], "x": [], "cell": None}
        seq = 0

        def flush(part: int):
            order = np.argsort(np.array(held["ids"], dtype=object), kind="stable")
            ids = [held["ids"][i] for i in order]
            x = np.array(held["x"])[order]
            w = np.array(held["w"], dtype=np.int64)[order]
            lo, hi = extent(x)
            return pa.RecordBatch.from_arrays(
                [pa.array([held["grp"]]), pa.array([part * 2**32 + seq], pa.int64()), pa.array([len(ids)], pa.int32()),
                 pa.array([dim], pa.int32()), pa.array([ids], pa.list_(pa.string())), _list(w, pa.int64()),
                 _list(x.ravel(), pa.float64()), _list(lo, pa.float64()), _list(hi, pa.float64()),
                 pa.array([False])],
                ["grp", "block", "n", "dim", "ids", "weights", "xs", "lo", "hi", "whole"],
            )

        part = 0
        for batch in batches:
            grps, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            weights = batch.column(2).to_pylist()
            x = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1) if ids else []
            part = batch.column(4)[0].as_py() if ids else part
            cells = batch.column(5).to_numpy(zero_copy_only=False) // cell
            for i, grp in enumerate(grps):
                left = pivots is not None and held["cell"] != cells[i] and len(held["ids"]) > least
                if held["ids"] and (grp != held["grp"] or len(held["ids"]) == limit or left):
                    yield flush(part)
                    seq += 1
                    held = {"grp": None, "ids": [], "w": [], "x": []}
                held["grp"], held["cell"] = grp, cells[i]
                held["ids"].append(ids[i])
                held["w"].append(weights[i])
                held["x"].append(x[i])
        if held["ids"]:
            yield flush(part)

    large = cut(keyed.mapInArrow(cutter, PACKED))
    # Dense numbers along the curve: the part number above, the place inside the part below.
    span = large.agg(F.max(F.col("block") % 2**32)).head()[0] + 1
    bits = int(span - 1).bit_length()
    dense = F.shiftright("block", 32) * 2**bits + F.col("block") % 2**32
    return cut(small.unionByName(large.withColumn("block", dense))), True


def with_extent(blocks: DataFrame, dim: int, pivots: np.ndarray | None) -> DataFrame:
    """Blocks with intervals on all of them, whole groups too, by the boxes or pivots that other blocks were told apart with."""
    rest = [c for c in blocks.columns if c not in ("lo", "hi")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = []
            for i in range(batch.num_rows):
                x = coords(batch, i, "xs", dim)
                told = x if pivots is None else to_pivots(x, pivots)
                ends.append((told.min(axis=0), told.max(axis=0)))
            doubles = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([lo for lo, _ in ends], doubles), pa.array([hi for _, hi in ends], doubles)], [*rest, "lo", "hi"])

    kinds = dict(blocks.dtypes)
    return cut(blocks.select(*rest).mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in [*rest, "lo", "hi"])))


# --- what the intervals say ---------------------------------------------------------------

def _sides(a: str, b: str, gap: Callable) -> Column:
    zipped = F.arrays_zip(F.col(f"{a}lo").alias("p"), F.col(f"{a}hi").alias("q"), F.col(f"{b}lo").alias("r"), F.col(f"{b}hi").alias("s"))
    return F.sqrt(F.aggregate(F.transform(zipped, gap), F.lit(0.0), lambda t, x: t + x * x))


def box_gap(a: str, b: str) -> Column:
    """Least distance between two boxes."""
    return _sides(a, b, lambda z: F.greatest(F.lit(0.0), z["r"] - z["q"], z["p"] - z["s"]))


def box_span(a: str, b: str) -> Column:
    """Greatest distance between two boxes."""
    return _sides(a, b, lambda z: F.greatest(z["s"] - z["p"], z["q"] - z["r"]))


def pivot_gap(a: str, b: str) -> Column:
    """At least so far apart are the points of two blocks, by their distances to the pivots."""
    zipped = F.arrays_zip(F.col(f"{a}lo").alias("p"), F.col(f"{a}hi").alias("q"), F.col(f"{b}lo").alias("r"), F.col(f"{b}hi").alias("s"))
    apart = F.transform(zipped, lambda z: F.greatest(z["r"] - z["q"], z["p"] - z["s"]) - (z["q"] + z["s"]) * ROUNDING)
    return F.greatest(F.lit(0.0), F.array_max(apart))


def pivot_span(a: str, b: str) -> Column:
    """At most so far apart are the points of two blocks, going by way of a pivot."""
    zipped = F.arrays_zip(F.col(f"{a}hi").alias("q"), F.col(f"{b}hi").alias("s"))
    return F.array_min(F.transform(zipped, lambda z: (z["q"] + z["s"]) * (1 + ROUNDING)))


@dataclass(frozen=True)
class Bounds:
    """Least and greatest distance between the blocks with two prefixes, and the number of intervals of a block."""

    gap: Callable[[str, str], Column]
    span: Callable[[str, str], Column]
    width: int


def bounds_of(blocks: DataFrame, dim: int) -> Bounds:
    """How blocks of `dim`-part vectors are told apart."""
    if dim <= BOX_DIMS:
        return Bounds(box_gap, box_span, dim)
    one = blocks.select(F.size("lo")).head()
    return Bounds(pivot_gap, pivot_span, one[0] if one else 1)


def tree_levels(leaves: DataFrame, width: int, extra: dict[str, Callable] | None = None) -> list[DataFrame]:
    """Node tables from the blocks (level 0) up to one node per group.

    A node holds the count and intervals of the blocks below it, plus the `extra`
    columns with their aggregates.  Only these narrow columns of the blocks are read.
    """
    extra = extra or {}
    last = leaves.agg(F.max("block")).head()[0] or 0
    top = -(-int(last).bit_length() // FANOUT_BITS)
    levels = [leaves.select("grp", F.col("block").alias("node"), "n", "lo", "hi", *extra)]
    for level in range(1, top + 1):
        levels.append(leaves.groupBy("grp", F.shiftright("block", FANOUT_BITS * level).alias("node")).agg(
            F.sum("n").alias("n"),
            F.array(*[F.min(F.col("lo")[i]) for i in range(width)]).alias("lo"),
            F.array(*[F.max(F.col("hi")[i]) for i in range(width)]).alias("hi"),
            *[combine(name).alias(name) for name, combine in extra.items()],
        ))
    return levels


def descend(seekers: DataFrame, levels: list[DataFrame], low: Column, keep: Column, bound_key: str | None = None,
            high: Column | None = None, usable: Column | None = None) -> DataFrame:
    """Pairs (grp, block, other) of blocks that lie within the bound of each seeking block.

    `seekers` has grp, block, lo, hi, bound and what `low` / `keep` read (seeker columns are
    prefixed `a_`, node columns `b_`).  On each level a pair stays when `low` <= bound.
    With `high` given, each usable node proves an upper bound, so the bound shrinks on the
    way down: per seeking block, or per `bound_key` when several blocks share one bound.
    """
    pairs = seekers.select("grp", *[F.col(c).alias(f"a_{c}") for c in seekers.columns if c != "grp"])
    kept = pairs.columns
    for depth in range(len(levels) - 1, -1, -1):
        nodes = levels[depth].select("grp", *[F.col(c).alias(f"b_{c}") for c in levels[depth].columns if c != "grp"])
        if depth == len(levels) - 1:
            joined = pairs.join(nodes, "grp")
        else:
            nodes = nodes.withColumn("parent", F.shiftright("b_node", FANOUT_BITS))
            joined = pairs.join(nodes, ["grp", "parent"]).drop("parent")
        joined = joined.withColumn("low", low).filter(keep & (F.col("low") <= F.col("a_bound") * SLACK))
        if high is not None:
            joined = cut(joined)
            proof = joined if usable is None else joined.filter(usable)
            key = f"a_{bound_key}" if bound_key else "a_block"
            better = proof.groupBy("grp", key).agg(F.min(high).alias("proved"))
            joined = joined.join(better.filter(F.col(key).isNotNull()), ["grp", key], "left").withColumn(
                "a_bound", F.least("a_bound", F.coalesce("proved", "a_bound"))
            ).drop("proved").filter(F.col("low") <= F.col("a_bound") * SLACK)
        pairs = joined.select(*kept, F.col("b_node").alias("parent"))
    return pairs.select("grp", F.col("a_block").alias("block"), F.col("parent").alias("other"))


# --- how blocks come to tasks ---------------------------------------------------------------

def task_count(rows: DataFrame, n: int, most: int = ROWS_PER_TASK) -> int:
    """Tasks for `n` packed rows: some for each core, more where a task would take over `most` rows, which may come to Python at once."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(1, min(n, max(TASKS_PER_CORE * cores, -(-n // most))))


def task_number(tasks: int) -> Column:
    """Numbers that deal the rows of a stored table evenly to `tasks`; every part of it starts at another task."""
    i = F.monotonically_increasing_id()
    return F.pmod(i.bitwiseAND(F.lit(2**33 - 1)) + F.shiftright(i, 33) * 7, F.lit(tasks)).cast("int")


def dealt(rows: DataFrame) -> DataFrame:
    """The rows of a stored table of blocks, dealt evenly to tasks.

    A block takes little room and much work, so tasks told by bytes, as Spark tells them, would leave most cores idle.
    """
    tasks = task_count(rows, rows.count())
    return rows if tasks == 1 else rows.withColumn("task", task_number(tasks)).repartitionById(tasks, "task").drop("task")


# --- inside a task ------------------------------------------------------------------------

def stripes(n: int, columns: int) -> Iterator[slice]:
    """Slices of `n` rows whose distances to `columns` points are held at once, as many as a stripe of a block has."""
    step = max(1, STRIPE_VALUES // max(columns, BLOCK_ROWS))
    return (slice(start, min(start + step, n)) for start in range(0, n, step))


def coords(batch: pa.RecordBatch, i: int, name: str, dim: int) -> np.ndarray:
    return np.asarray(batch.column(name)[i].values.to_numpy(zero_copy_only=False)).reshape(-1, dim)


def values(batch: pa.RecordBatch, i: int, name: str) -> np.ndarray:
    return batch.column(name)[i].values.to_numpy(zero_copy_only=False)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances, summed by coordinate so that small ones keep their digits."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return out


def rough_squares(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(squares, off): squared distances by one matrix product, and per row of `a` how far they may be from `squared_distances`.

    Short vectors, and lengths that are not finite, are summed by coordinate; then nothing is off.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        la, lb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
        off = 16 * (a.shape[1] + 8) * np.finfo(float).eps * (la + lb.max(initial=0.0))
    if a.shape[1] <= SHORT_DIMS or not np.isfinite(off).all():
        return squared_distances(a, b), np.zeros(len(a))
    out = a @ b.T
    out *= -2.0
    out += la[:, None]
    out += lb
    return out, off


def box_squares(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Per point its squared distance to the box around the others, summed like `squared_distances`, so never more than one of those."""
    out = np.zeros(len(points))
    if len(others):
        with np.errstate(over="ignore", invalid="ignore"):
            for x, low, high in zip(points.T, others.min(axis=0), others.max(axis=0)):
                out += np.maximum(np.maximum(low - x, x - high), 0.0) ** 2
    return out


def squares_at(a: np.ndarray, b: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """`squared_distances` of some places, to the last bit."""
    if a.shape[1] and len(rows) <= BLOCK_ROWS // 16:  # few places at once: running sums add in the same order
        gap = a[rows] - b[cols]
        return np.add.accumulate(gap * gap, axis=1)[:, -1]
    out = np.zeros(len(rows))
    for j in range(a.shape[1]):
        out += (a[rows, j] - b[cols, j]) ** 2
    return out
