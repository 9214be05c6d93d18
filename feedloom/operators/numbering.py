"""Consecutive numbers within groups of any size, without a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import cut


def ranked(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "pos") -> DataFrame:
    """`rows` with `name`: 1, 2, ... within equal `keys`, in `order`, which must leave no ties.

    Null keys are a group of their own.  Rows are spread by ranges of (keys, order), numbered inside their range, and shifted by the count of the
    ranges before; so a group that holds most rows lies in many ranges.  Only a count per group and range is added up.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    # sampling the ranges reads the rows once more: have them stored
    spread = cut(cut(rows).repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()))
    inside = spread.withColumn("_in", F.row_number().over(Window.partitionBy("_range", *keys).orderBy(*order)))
    counts = spread.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(F.struct(*keys).alias("_key"), F.col("_range").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    same = F.struct(*keys).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_of"))
    return inside.join(shifts, same).withColumn(name, F.col("_in") + F.col("_shift")).drop("_range", "_in", "_shift", "_key", "_of")
