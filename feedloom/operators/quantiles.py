"""Weighted quantiles per group by narrowing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import cut

BINS = 1024
LEFT = 10_000  # different values of a group that are sorted in the end


def weighted_quantile(values: DataFrame, share: float, bins: int = BINS, left: int = LEFT) -> DataFrame:
    """(grp, value) with the `share` quantile of (grp, value, weight), interpolated between the two values around it.

    Like sorting every value as often as its weight says.  A round counts the weight per bin of the range that holds the
    place, with the least and greatest value of each bin, and keeps the bin; a task hands on at most `bins` rows per group
    and place.  Once few different values are left they are ranked.  Null values are left out, groups without values too.
    """
    rows = cut(values.filter("value IS NOT NULL").groupBy("grp", "value").agg(F.sum("weight").cast("long").alias("weight")))
    ends = rows.groupBy("grp").agg(F.sum("weight").alias("total"), F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("n"))
    exact = F.lit(float(share)) * (F.col("total") - 1)
    # two places, from 0: the one at or before the quantile, and the one after it
    places = F.array(F.floor(exact).cast("long"), F.ceil(exact).cast("long"))
    ends = cut(ends.withColumn("part", exact - F.floor(exact)).withColumn("places", places))
    state = ends.select("grp", F.posexplode("places").alias("side", "place"), F.lit(0).cast("long").alias("before"), "low", "high", "n")
    parts = []
    while True:
        state = cut(state)
        parts.append(state.filter(F.col("n") <= left))
        state = state.filter(F.col("n") > left)
        if not state.head(1):
            break
        inside = rows.join(state, "grp").filter((F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high")))
        at = F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * bins)
        counted = inside.groupBy("grp", "side", "place", "before", F.least(at, F.lit(bins - 1)).alias("bin")).agg(
            F.sum("weight").alias("weight"), F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("n"))
        order = Window.partitionBy("grp", "side").orderBy("bin")  # `bins` rows at most
        counted = counted.withColumn("upto", F.col("before") + F.sum("weight").over(order))
        held = (F.col("place") < F.col("upto")) & (F.col("place") >= F.col("upto") - F.col("weight"))
        state = counted.filter(held).select("grp", "side", "place", (F.col("upto") - F.col("weight")).alias("before"), "low", "high", "n")
    due = parts[0]
    for more in parts[1:]:
        due = due.unionByName(more)
    inside = rows.join(due, "grp").filter((F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high")))
    upto = F.col("before") + F.sum("weight").over(Window.partitionBy("grp", "side").orderBy("value"))  # `left` rows at most
    found = inside.withColumn("upto", upto).filter(F.col("place") < F.col("upto")).groupBy("grp").agg(
        F.min(F.when(F.col("side") == 0, F.col("value"))).alias("a"), F.min(F.when(F.col("side") == 1, F.col("value"))).alias("b"))
    return found.join(ends.select("grp", "part"), "grp").select("grp", (F.col("a") + F.col("part") * (F.col("b") - F.col("a"))).alias("value"))
