"""K-means for all groups at once."""

from __future__ import annotations

from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.vectors import squared_l2
from feedloom.operators.reports import first_per_group
from feedloom.session import cut


def initial_centres(points: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """(grp, centres): k distinct vectors per group, picked by hash, so the same in every run."""
    distinct = points.groupBy("grp", "xs").agg(F.min("pid").alias("pid"))
    picked = first_per_group(distinct, "grp", [F.xxhash64(F.lit(seed), "pid"), F.col("pid")], k)
    return picked.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("rank", "xs")))["xs"].alias("centres"))


def assign(points: DataFrame, centres: DataFrame) -> DataFrame:
    """Each point with the number (from 0) and squared distance of its nearest centre.

    All centres of a group travel as one row, so a point meets one row and is not multiplied.
    Equal distances go to the lower number.
    """
    nearest = F.array_min(F.transform("centres", lambda c, i: F.struct(
        squared_l2(F.col("xs"), c).alias("d"), i.alias("i"))))
    rows = points.join(centres, "grp").withColumn("_near", nearest)
    return rows.select(*points.columns, F.col("_near.i").cast("int").alias("cluster"), F.col("_near.d").alias("cost"))


def step(points: DataFrame, centres: DataFrame, dim: int) -> DataFrame:
    """One Lloyd step: (grp, cluster, centre, n), the means of the points nearest to each centre."""
    return assign(points, centres).groupBy("grp", "cluster").agg(
        F.array(*[F.avg(F.col("xs")[i]) for i in range(dim)]).alias("centre"), F.count("*").alias("n"))


def fit(points: DataFrame, k: int, dim: int, iterations: int | None = None, seed: int = 42, tolerance: float = 1e-9,
        starts: DataFrame | None = None) -> DataFrame:
    """(grp, centres) after Lloyd steps over all groups until nothing moves, or after so many `iterations`.

    `starts` (grp, centres) may be given; else they are seeded.  A centre that loses all its points stays where it is.
    """
    centres = cut(oversampled_start(points, k, seed) if starts is None else starts)
    for _ in count() if iterations is None else range(iterations):
        moved = step(points, centres, dim)
        old = centres.select("grp", F.posexplode("centres").alias("cluster", "was"))
        merged = old.join(moved, ["grp", "cluster"], "left").withColumn("now", F.coalesce("centre", "was"))
        packed = cut(merged.groupBy("grp").agg(
            F.sort_array(F.collect_list(F.struct("cluster", "now")))["now"].alias("centres"),
            F.max(squared_l2(F.col("was"), F.col("now"))).alias("shift"),
        ))
        centres = packed.select("grp", "centres")
        if not packed.filter(F.col("shift") > tolerance).head(1):
            break
    return centres


ROUNDS, OVERSAMPLE = 4, 2


def _reduced(k: int):
    """The k starts among weighted candidates: the heaviest, then always the one with the greatest weight times squared distance."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("cluster")
        x, weights = np.vstack(rows["xs"].to_list()), rows["n"].to_numpy(float)
        chosen = [int(weights.argmax())]
        far = ((x - x[chosen[0]]) ** 2).sum(axis=1)
        while len(chosen) < k and far.max() > 0:
            chosen.append(int((weights * far).argmax()))
            far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
        centres = x[chosen]
        for _ in range(10):  # weighted Lloyd steps on the candidates
            nearest = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
            moved = np.array([np.average(x[nearest == i], axis=0, weights=weights[nearest == i]) if weights[nearest == i].sum() > 0 else c for i, c in enumerate(centres)])
            if np.allclose(moved, centres):
                break
            centres = moved
        return pd.DataFrame({"grp": [rows["grp"].iloc[0]], "centres": [list(centres)]})

    return run


def oversampled_start(points: DataFrame, k: int, seed: int = 42, rounds: int = ROUNDS) -> DataFrame:
    """(grp, centres): k starts per group, fewer where a group has fewer different vectors.

    A few rounds over all points, whatever k is: each takes a point as a candidate with a chance of 2k times its share of the
    group's squared distance to the candidates so far, told by a hash, so that every run takes the same ones.  The candidates,
    some 2k per round, are weighted by the points nearest to them and reduced to k in one task per group.
    """
    centres = cut(initial_centres(points, 1, seed))
    done = 0
    while True:
        near = assign(points, centres)
        shares = near.groupBy("grp").agg(F.sum("cost").alias("total"), F.max(F.struct("cost", "pid", "xs")).alias("far"))
        if done >= rounds:
            # only where equal vectors or few points left a group short: the farthest point, until it has k or no other vector
            short = centres.filter(F.size("centres") < k).select("grp").join(shares.filter("total > 0"), "grp")
            short = cut(short.select("grp", F.array(F.col("far.xs")).alias("more")))
            if not short.head(1):
                break
            picked = short
        else:
            chance = F.pmod(F.xxhash64(F.lit(seed), F.lit(done), "pid"), F.lit(2**53)) / F.lit(float(2**53))
            taken = near.join(shares.filter("total > 0").select("grp", "total"), "grp").filter(chance * F.col("total") < OVERSAMPLE * k * F.col("cost"))
            picked = cut(taken.groupBy("grp").agg(F.array_sort(F.collect_set("xs")).alias("more")))
        centres = cut(centres.join(picked, "grp", "left").select("grp", F.array_union("centres", F.coalesce("more", F.array().cast("array<array<double>>"))).alias("centres")))
        done += 1
    weighed = assign(points, centres).groupBy("grp", "cluster").agg(F.count("*").alias("n"))
    candidates = centres.select("grp", F.posexplode("centres").alias("cluster", "xs")).join(weighed, ["grp", "cluster"], "left")
    return candidates.select("grp", "cluster", "xs", F.coalesce("n", F.lit(0)).alias("n")).groupBy("grp").applyInPandas(_reduced(k), "grp string, centres array<array<double>>")
