"""Quality of a clustering: metrics per parent, trustworthiness, silhouette, spreads."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.vectors import dot, l2_distance, squared_l2
from feedloom.operators.blocks import block_rows, pack, squared_distances
from feedloom.operators.counting import STRIPE, block_pairs, within
from feedloom.operators.knn import knn_graph, vector_size
from feedloom.operators.reports import first_per_group
from feedloom.session import cut


def clustering_quality(labelled: DataFrame, by: list[str], validity: DataFrame | None = None) -> DataFrame:
    """C9 + A23: metrics per clustering `by`, from (cluster, probability, persistence) per point.

    Counted per cluster first; a cluster of -1 is noise.  `validity` has (by, relative_validity), see below; where it is not
    given there is no spanning tree to tell it from, and it is null.  Persistence is null where there is no cluster.
    """
    has = F.col("cluster") >= 0
    sizes = labelled.groupBy(*by, "cluster").agg(
        F.count("*").alias("n"), F.sum("probability").alias("p"), F.count_if(F.col("probability") < 0.5).alias("low"),
        F.max("persistence").alias("persistence"),
    )
    size = F.when(has, F.col("n"))
    told = F.lit(None).cast("double") if validity is None else F.first("relative_validity")
    sizes = sizes if validity is None else sizes.join(validity, by, "left")
    return sizes.groupBy(*by).agg(
        F.sum("n").alias("n_points"),
        F.count(size).alias("n_clusters"),
        told.alias("relative_validity"),
        F.min(F.when(has, F.col("persistence"))).alias("min_persistence"),
        F.avg(F.when(has, F.col("persistence"))).alias("mean_persistence"),
        (F.sum("p") / F.sum("n")).alias("mean_probability"),
        (F.sum("low") / F.sum("n")).alias("low_confidence_ratio"),
        (F.coalesce(F.sum(F.when(~has, F.col("n"))), F.lit(0)) / F.sum("n")).alias("noise_ratio"),
        (F.max(size) / F.sum(size)).alias("largest_cluster_ratio"),
        F.min(size).alias("smallest_cluster_size"),
        F.avg(size).alias("mean_cluster_size"),
        F.stddev_samp(size).alias("cluster_size_std"),
    )


def hash_sample(points: DataFrame, size: int, seed: int = 42) -> DataFrame:
    """The same `size` rows per group every time: those with the least hash of id and seed.

    Rows of a large group are first thinned by the same hash to about twice the size, far
    enough above it to hold the `size` least ones, so the ranking never sees a whole group.
    """
    span = 2**30
    mark = F.pmod(F.xxhash64(F.lit(seed), "pid"), F.lit(span))
    sizes = points.groupBy("grp").agg(F.count("*").alias("_n"))
    thinned = points.withColumn("_mark", mark).join(sizes, "grp").filter(
        F.col("_mark") < F.lit(span) * F.lit(2.0 * size + 200) / F.col("_n"))
    return first_per_group(thinned, "grp", [F.col("_mark"), F.col("pid")], size, rank="_rank").drop("_rank", "_mark", "_n")


def _squared(a: Column, b: Column) -> Column:
    """Summed part by part like `blocks.squared_distances`, so that both give the same number."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def _block_trust(rows: pd.DataFrame) -> pd.DataFrame:
    """Summed excess ranks of a group that fits one block."""
    rows = rows.sort_values("pid", kind="stable")
    full, flat, k = np.vstack(rows["xs"].to_list()), np.vstack(rows["reduced"].to_list()), int(rows["k"].iloc[0])
    lost = 0
    for start in range(0, len(full), STRIPE):
        here = np.arange(start, min(start + STRIPE, len(full)))
        far, near = squared_distances(full[here], full), squared_distances(flat[here], flat)
        far[np.arange(len(here)), here] = near[np.arange(len(here)), here] = np.inf
        closest = np.argsort(near, axis=1, kind="stable")[:, :k]
        ranks = np.argsort(np.argsort(far, axis=1, kind="stable"), axis=1, kind="stable") + 1
        lost += int(np.maximum(np.take_along_axis(ranks, closest, axis=1) - k, 0).sum())
    return pd.DataFrame({"grp": [rows["grp"].iloc[0]], "lost": [lost]})


def _excess_ranks(picked: DataFrame, reduced: DataFrame, sizes: DataFrame, dim: int, rows: int | None) -> DataFrame:
    """(grp, lost) of groups of any size, from pairs of blocks; `sizes` has (grp, n, k)."""
    most = sizes.agg(F.max("k")).head()[0]
    picked = cut(picked)
    near = knn_graph(cut(reduced), most, rows).select("grp", "pid", "nbr", "rank")
    ends = picked.select("grp", "pid", "xs")
    near = near.join(ends.withColumnsRenamed({"pid": "nbr", "xs": "there"}), ["grp", "nbr"]).join(ends, ["grp", "pid"])
    near = near.select("grp", "pid", "rank", "nbr", _squared(F.col("xs"), F.col("there")).alias("d"))
    lists = near.groupBy("grp", "pid").agg(F.sort_array(F.collect_list(F.struct("rank", "d", "nbr"))).alias("near"))  # `most` at most
    blocks = pack(picked.select("grp", F.col("pid").alias("rid"), F.lit(1).cast("long").alias("weight"), "xs"), dim, rows)
    places = blocks.select("grp", "block", F.posexplode("ids").alias("pos", "pid")).join(lists, ["grp", "pid"])
    filled = lambda field, empty: F.concat(F.col(f"near.{field}"), F.array_repeat(F.lit(empty), F.lit(most) - F.size("near")))
    asked = places.groupBy("grp", "block").agg(F.sort_array(F.collect_list(F.struct("pos", filled("d", -1.0).alias("d"), filled("nbr", "").alias("nbr")))).alias("p"))
    left = asked.join(blocks.select("grp", "block", "dim", "lo", "hi", "xs"), ["grp", "block"])
    radii = F.flatten("p.d")
    left = cut(left.select("grp", "block", "dim", "lo", "hi", "xs", F.col("p.pos").alias("pos"), radii.alias("radii"), F.flatten("p.nbr").alias("tied"),
                           F.sqrt(F.array_min(F.filter(radii, lambda d: d >= 0))).alias("least"), F.sqrt(F.array_max(radii)).alias("bound")))
    counts = within(block_pairs(left, blocks, dim), left, blocks, most, squared=True, ties=True).join(sizes, "grp")
    excess = [F.when(F.col("k") > j, F.greatest(F.col(f"c{j}") + 1 - F.col("k"), F.lit(0))).otherwise(0) for j in range(most)]
    return counts.groupBy("grp").agg(F.sum(sum(excess[1:], excess[0])).alias("lost"))


def trustworthiness(points: DataFrame, reduced: DataFrame, n_neighbors: Column | int, sample: int | None = None, rows: int | None = None) -> DataFrame:
    """(grp, n_group, n, trustworthiness) of a reduction, on all `n_group` rows or, if asked, on at most `sample` of a group.

    1 - 2 / (n k (2n - 3k - 1)) times the summed excess over k of the original ranks of the neighbours in the reduced space.
    The rank of a neighbour is one more than the number of points that are nearer, or as near with a lesser id.  A group that
    fits one block is measured there; else ranks are counted over pairs of blocks, so a task holds two blocks and never
    more.  `n_neighbors` may read the columns of `points`.
    """
    k = n_neighbors if isinstance(n_neighbors, Column) else F.lit(n_neighbors)
    picked = points.select("grp", "pid", "xs", k.cast("int").alias("n_neighbors"))
    picked = picked if sample is None else cut(hash_sample(picked, sample))
    half = F.greatest(F.floor((F.col("n") - 1) / 2), F.lit(1))
    sizes = cut(picked.groupBy("grp").agg(F.count("*").alias("n"), F.first("n_neighbors").alias("k")).select(
        "grp", "n", F.least(F.col("k").cast("long"), half).cast("int").alias("k")))
    dim = vector_size(picked)
    fits = F.col("n") <= block_rows(dim, rows)
    picked = picked.select("grp", "pid", "xs")
    flat = reduced.select("grp", "pid", "xs")
    small = picked.join(sizes.filter(fits).select("grp", "k"), "grp").join(flat.withColumnRenamed("xs", "reduced"), ["grp", "pid"])
    lost = small.groupBy("grp").applyInPandas(_block_trust, "grp string, lost long")
    large = sizes.filter(~fits)
    if large.head(1):
        mine = large.select("grp")
        of = picked.join(mine, "grp", "left_semi")
        flat = flat.join(of.select("grp", "pid"), ["grp", "pid"], "left_semi")
        lost = lost.unionByName(_excess_ranks(of, flat, large, dim, rows))
    scale = F.col("n") * F.col("k") * (2 * F.col("n") - 3 * F.col("k") - 1)
    value = F.when(scale > 0, 1.0 - 2.0 * F.coalesce("lost", F.lit(0)) / scale).otherwise(1.0)
    groups = points.groupBy("grp").agg(F.count("*").alias("n_group"))
    return sizes.join(lost, "grp", "left").join(groups, "grp").select("grp", "n_group", F.col("n").cast("int").alias("n"), value.alias("trustworthiness"))


# --- relative validity ----------------------------------------------------------------------------

def relative_validity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """(grp, relative_validity) of a density clustering from its spanning tree, without pairs of points.

    `edges`: (grp, u, v, w), the tree; `labels`: (grp, node, cluster, weight), -1 for noise.  A cluster is as sparse as its
    longest inner edge and as separate as its shortest edge to another cluster; its validity is the difference over the
    greater of the two, and clusters count by their share of all points, noise included.  A cluster without an edge to another one
    is taken to be twice as far as the longest edge of the tree; a lone one twice as far as its nearest noise.  0 without clusters.
    """
    ends = labels.select("grp", "node", "cluster")
    sided = edges.join(ends.withColumnsRenamed({"node": "u", "cluster": "a"}), ["grp", "u"]).join(
        ends.withColumnsRenamed({"node": "v", "cluster": "b"}), ["grp", "v"])
    # one row per group and pair of clusters is all that goes on
    pairs = cut(sided.groupBy("grp", "a", "b").agg(F.max("w").alias("longest"), F.min("w").alias("shortest")))
    noise = (F.col("a") < 0) != (F.col("b") < 0)
    trees = pairs.groupBy("grp").agg(F.max("longest").alias("longest"), F.min(F.when(noise, F.col("shortest"))).alias("to_noise"))
    inner = pairs.filter("a = b AND a >= 0").select("grp", F.col("a").alias("cluster"), F.col("longest").alias("sparse"))
    outer = pairs.filter("a <> b AND a >= 0 AND b >= 0")
    outer = outer.select("grp", F.col("a").alias("cluster"), "shortest").unionByName(outer.select("grp", F.col("b").alias("cluster"), "shortest"))
    outer = outer.groupBy("grp", "cluster").agg(F.min("shortest").alias("apart"))
    sizes = labels.groupBy("grp", "cluster").agg(F.sum("weight").alias("n"))
    groups = sizes.groupBy("grp").agg(F.sum("n").alias("total"), F.count_if(F.col("cluster") >= 0).alias("clusters"))
    rows = sizes.filter("cluster >= 0").join(inner, ["grp", "cluster"], "left").join(outer, ["grp", "cluster"], "left").join(groups, "grp").join(trees, "grp", "left")
    far = 2.0 * F.when(F.col("clusters") > 1, F.col("longest")).otherwise(F.coalesce("to_noise", "longest"))
    sparse, apart = F.coalesce("sparse", F.lit(0.0)), F.coalesce("apart", far, F.lit(0.0))
    validity = F.coalesce(F.try_divide(apart - sparse, F.greatest(apart, sparse)), F.lit(0.0))
    sums = rows.groupBy("grp").agg(F.sum(F.col("n") * validity / F.col("total")).alias("sum"))
    return groups.select("grp").join(sums, "grp", "left").select("grp", F.coalesce("sum", F.lit(0.0)).alias("relative_validity"))


# --- distances to centres and silhouettes ------------------------------------------------------

def centroids(labelled: DataFrame, dim: int) -> DataFrame:
    """(grp, cluster, centre, square, n): mean vector and mean squared length per cluster."""
    return labelled.groupBy("grp", "cluster").agg(
        F.array(*[F.avg(F.col("xs")[i]) for i in range(dim)]).alias("centre"),
        F.avg(dot(F.col("xs"), F.col("xs"))).alias("square"),
        F.count("*").alias("n"),
    )


def intra_cluster_distance(labelled: DataFrame, dim: int) -> DataFrame:
    """Distances of the members to the centre of their cluster."""
    centres = centroids(labelled, dim).select("grp", "cluster", "centre")
    d = l2_distance(F.col("xs"), F.col("centre"))
    rows = labelled.join(centres, ["grp", "cluster"]).select("grp", "cluster", d.alias("d"))
    return rows.groupBy("grp", "cluster").agg(
        F.avg("d").alias("mean_distance"), F.max("d").alias("max_distance"), F.stddev_pop("d").alias("std_distance"),
        F.var_pop("d").alias("variance"), F.count("*").alias("cluster_size"),
    )


def silhouette_points(labelled: DataFrame, dim: int) -> DataFrame:
    """C20: the silhouette of every point under squared Euclidean distance.

    The mean squared distance of a point to a cluster follows from the cluster's mean vector
    and mean squared length, so no pairs are formed: each point meets one row that holds the
    summary of every cluster of its group.  A cluster of one point scores 0.
    """
    summary = centroids(labelled, dim).groupBy("grp").agg(
        F.collect_list(F.struct("cluster", "centre", "square", "n")).alias("all"))
    xs, own = F.col("xs"), F.col("cluster")
    mean_to = lambda c: dot(xs, xs) + c["square"] - 2.0 * dot(xs, c["centre"])
    rows = labelled.join(summary, "grp").withColumn("to", F.transform("all", lambda c: F.struct(
        c["cluster"].alias("cluster"), c["n"].alias("n"), mean_to(c).alias("d"))))
    mine = F.filter("to", lambda c: c["cluster"] == own)[0]
    rows = rows.select(
        "grp", "pid", "cluster", mine["n"].alias("n"),
        (mine["d"] * mine["n"] / F.greatest(mine["n"] - 1, F.lit(1))).alias("inner"),
        F.array_min(F.transform(F.filter("to", lambda c: c["cluster"] != own), lambda c: c["d"])).alias("outer"),
    )
    score = F.when((F.col("n") == 1) | F.col("outer").isNull(), 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("outer") - F.col("inner"), F.greatest("outer", "inner")), F.lit(0.0)))
    return rows.select("grp", "pid", "cluster", score.alias("silhouette"))


def silhouette(labelled: DataFrame, dim: int) -> DataFrame:
    """C20: mean silhouette per cluster and, with a null cluster, over the whole group."""
    sums = silhouette_points(labelled, dim).groupBy("grp", "cluster").agg(
        F.sum("silhouette").alias("s"), F.count("*").alias("n"))
    per_cluster = sums.select("grp", "cluster", (F.col("s") / F.col("n")).alias("score"), "n")
    overall = sums.groupBy("grp").agg((F.sum("s") / F.sum("n")).alias("score"), F.sum("n").alias("n"))
    return per_cluster.unionByName(overall.withColumn("cluster", F.lit(None).cast(dict(labelled.dtypes)["cluster"])))


def nearest_to_centre(labelled: DataFrame, dim: int, k: int = 5) -> DataFrame:
    """The k members nearest to the centre of each cluster, the quotes that describe it."""
    centres = centroids(labelled, dim).select("grp", "cluster", "centre")
    rows = labelled.join(centres, ["grp", "cluster"]).select(
        "grp", "cluster", "pid", F.sqrt(squared_l2(F.col("xs"), F.col("centre"))).alias("distance"),
        F.struct("grp", "cluster").alias("_key"),
    )
    return first_per_group(rows, "_key", [F.round("distance", 9), F.col("pid")], k).drop("_key")
