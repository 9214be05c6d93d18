"""Connected components of keyed edge tables (used by the tree, DBSCAN and linkage operators)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import cut

LOCAL_EDGES = 200_000  # a group with fewer edges is finished inside one task


def find_roots(u: list, v: list) -> dict:
    """Least member of the component of every node (union-find with path halving)."""
    parent: dict = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(u, v):
        a, b = root(a), root(b)
        if a != b:
            low, high = (a, b) if a < b else (b, a)
            parent[high] = low
    return {x: root(x) for x in list(parent)}


def _local(edges: pd.DataFrame) -> pd.DataFrame:
    roots = find_roots(edges["u"].tolist(), edges["v"].tolist())
    return pd.DataFrame({"grp": edges["grp"].iloc[0], "node": list(roots), "comp": list(roots.values())})


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("grp", "u", "v"))).head())


def _stars(edges: DataFrame) -> DataFrame:
    """Large-star and small-star steps in turn until every node hangs on its least member.

    The least neighbour is a combinable aggregate and the rest are equi-joins, so a hub with a
    third of all edges is an aggregate input or a skewed join side, never a gathered group.
    """
    state = cut(edges.select("grp", F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    mark = _mark(state)
    while True:
        both = state.unionByName(state.select("grp", F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("grp", "u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, ["grp", "u"]).select("grp", F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.filter("u <> v").distinct())
        least = large.groupBy("grp", "u").agg(F.min("v").alias("m"))
        small = large.join(least, ["grp", "u"]).filter("v <> m").select("grp", F.col("v").alias("u"), F.col("m").alias("v"))
        state = cut(small.unionByName(least.select("grp", "u", F.col("m").alias("v"))).distinct())
        now = _mark(state)
        if now == mark:
            break
        mark = now
    hung = state.select("grp", F.col("u").alias("node"), F.col("v").alias("comp"))
    nodes = edges.select("grp", F.explode(F.array("u", "v")).alias("node")).distinct()
    return nodes.join(hung, ["grp", "node"], "left").withColumn("comp", F.coalesce("comp", "node"))


def components(edges: DataFrame, local_edges: int = LOCAL_EDGES, stored: bool = False) -> DataFrame:
    """(grp, node, comp) for every node that has an edge (grp, u, v); `comp` is the least node.

    Groups with few edges are solved one per task; the others take the distributed steps.
    `stored` says that `edges` reads a stored table, so that it need not be written first.
    """
    edges = edges.select("grp", "u", "v")
    edges = edges if stored else cut(edges)
    sizes = edges.groupBy("grp").agg(F.count("*").alias("edges"))
    few = edges.join(sizes.filter(F.col("edges") <= local_edges), "grp", "left_semi")
    found = few.groupBy("grp").applyInPandas(_local, "grp string, node string, comp string")
    if sizes.filter(F.col("edges") > local_edges).head(1):
        many = edges.join(sizes.filter(F.col("edges") > local_edges), "grp", "left_semi")
        found = found.unionByName(_stars(many))
    return found
