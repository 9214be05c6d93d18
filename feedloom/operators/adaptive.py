"""Parameters that adapt to depth and size, the recursion rule and terminal labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.labels import child_label

# Fixed values of the adaptive rules: (upper size limit, value...); the last row has no limit.
LAYOUT_BY_SIZE = [(100, 0.0, 1.0), (500, 0.05, 1.5), (None, 0.1, 2.0)]      # min_dist, spread
SIZE_BOUNDS = [(100, 5, 5), (500, 8, 8), (2000, 10, 10), (None, 15, 10)]    # least, divisor of the greatest
NEIGHBOUR_RANGE, NEIGHBOUR_SHARE, NEIGHBOUR_DECAY = (5, 30), 0.05, 0.85
SIZE_DECAY, SAMPLES_LEAST, EPSILON = 0.6, 3, 0.1
POINTS_LEAST, POINTS_GROWTH, NOISE_MOST = 50, 1.3, 0.5
PERSISTENCE_LEAST, PERSISTENCE_STEP, PERSISTENCE_DEPTHS = 0.05, 0.025, 4


def _by_size(n: Column, rows: list[tuple], pick: int) -> Column:
    chain = None
    for row in rows[:-1]:
        chain = (F if chain is None else chain).when(n < row[0], F.lit(row[pick]))
    return chain.otherwise(F.lit(rows[-1][pick]))


def neighbour_params(depth: Column, n: Column, n_components: int) -> Column:
    """struct(n_neighbors, min_dist, spread).  Twice the components is the floor of n_neighbors."""
    wish = F.sqrt(n) / 2 * F.pow(F.lit(NEIGHBOUR_DECAY), depth)
    low, high = NEIGHBOUR_RANGE
    wish = F.greatest(F.least(wish, F.lit(float(high))), F.lit(float(low)))
    wish = F.least(wish, F.floor(n * NEIGHBOUR_SHARE).cast("double"))
    return F.struct(
        F.floor(F.greatest(wish, F.lit(2.0 * n_components))).cast("int").alias("n_neighbors"),
        _by_size(n, LAYOUT_BY_SIZE, 1).alias("min_dist"),
        _by_size(n, LAYOUT_BY_SIZE, 2).alias("spread"),
    )


def density_params(depth: Column, n: Column, base_pct: float = 0.02) -> Column:
    """struct(min_cluster_size, min_samples, epsilon).  The greatest size wins over the least."""
    wish = F.floor(F.lit(base_pct) * F.pow(F.lit(SIZE_DECAY), depth) * n)
    most = F.floor(n / _by_size(n, SIZE_BOUNDS, 2))
    size = F.least(F.greatest(wish, _by_size(n, SIZE_BOUNDS, 1)), most).cast("int")
    return F.struct(
        size.alias("min_cluster_size"),
        F.greatest(F.lit(SAMPLES_LEAST), F.floor(size / 2)).cast("int").alias("min_samples"),
        F.when((depth >= 2) & (n < 500), F.lit(EPSILON)).otherwise(F.lit(0.0)).alias("epsilon"),
    )


def large_enough(depth: Column, n: Column, max_depth: int) -> Column:
    """C4 without quality: whether a group is clustered at all."""
    return (depth < max_depth) & (n >= POINTS_LEAST * F.pow(F.lit(POINTS_GROWTH), depth))


def should_recurse(depth: Column, n: Column, max_depth: int, n_clusters: Column, mean_persistence: Column,
                   noise_ratio: Column) -> Column:
    """C4 for a child of size `n` at `depth`, with cluster count and quality of its parent.

    A missing mean persistence counts as 1.
    """
    steps = F.least(depth, F.lit(PERSISTENCE_DEPTHS))
    stable = F.coalesce(mean_persistence, F.lit(1.0)) >= PERSISTENCE_LEAST + PERSISTENCE_STEP * steps
    return (
        large_enough(depth, n, max_depth)
        & stable
        & (n_clusters <= n / 10)
        & (F.coalesce(noise_ratio, F.lit(0.0)) <= NOISE_MOST)
    )


def terminal_label(parent: Column, n_clusters: Column, cluster: Column) -> Column:
    """C11: the label of a point after its group was clustered.

    No cluster: all points are noise.  One cluster: all points, noise included, belong to
    it.  Otherwise the point's own cluster, with -1 as noise.
    """
    return (
        F.when(n_clusters == 0, child_label(parent, F.lit("noise")))
        .when(n_clusters == 1, child_label(parent, F.lit("0")))
        .when(cluster < 0, child_label(parent, F.lit("noise")))
        .otherwise(child_label(parent, cluster))
    )
