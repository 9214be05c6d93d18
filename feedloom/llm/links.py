"""Connected components of an edge table of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import cut


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).head())


HUB_EDGES, MOST_HUBS = 1000, 10_000


def _to_least(edges: DataFrame, least: DataFrame, count: int) -> DataFrame:
    """`edges` (u, v) with `m` of `least` (u, m, n); the edges of nodes that have many stay where they are.

    A node is a hub if it has more than HUB_EDGES and more than 2 * count / MOST_HUBS of the `count` edges.  As each edge counts at two nodes
    at most, there are no more than MOST_HUBS of them, few enough to send to every task.
    """
    hubs = least.filter(F.col("n") > max(HUB_EDGES, 2 * count // MOST_HUBS)).select("u", F.col("m").alias("hub_m"))
    marked = edges.join(F.broadcast(hubs), "u", "left")
    near = marked.filter("hub_m IS NOT NULL").select("u", "v", F.col("hub_m").alias("m"))
    return near.unionByName(marked.filter("hub_m IS NULL").drop("hub_m").join(least.select("u", "m"), "u"))


def least_members(edges: DataFrame) -> DataFrame:
    """(node, least) for every node of `edges` (u, v) that is not the least of its component.

    Large-star and small-star steps in turn: every node sends its greater neighbours, then its lesser ones, to the least
    neighbour, until nothing changes.  The least neighbour is a combinable aggregate and the rest are equi-joins, hubs apart.
    Each round is written to the shared folder.  Loops and repeated edges are fine.
    """
    edges = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("m", "u"))
        large = _to_least(both.filter("v > u"), least, mark[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = cut(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = _to_least(large, least, mark[0]).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        edges = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        mark, before = _mark(edges), mark
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("least"))
