"""Dimension reduction per group: principal components of unit vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.vectors import has_direction, unit
from feedloom.session import cut

ROWS_PER_PART = 1_000_000  # rows summed by one task; a hot group is spread over many
MODEL = "grp string, mean array<double>, axes array<array<double>>"


def unit_points(points: DataFrame) -> DataFrame:
    """Points scaled to length one, zero vectors left out: Euclidean order is then cosine order."""
    return points.filter(has_direction(F.col("xs"))).withColumn("xs", unit(F.col("xs")))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by group: row -1 is (count, sums), row i is the i-th row of X'X."""
    held, sums, gram = None, None, None

    def flush():
        d = len(gram)
        rows = [sums, *gram]
        return pa.RecordBatch.from_arrays(
            [pa.array([held] * (d + 1), pa.string()), pa.array(np.arange(-1, d, dtype=np.int32)),
             pa.array([r.tolist() for r in rows], pa.list_(pa.float64()))],
            ["grp", "i", "row"],
        )

    for batch in batches:
        if batch.num_rows == 0:
            continue
        grps = np.array(batch.column("grp").to_pylist(), dtype=object)
        x = batch.column("xs").flatten().to_numpy(zero_copy_only=False).reshape(len(grps), -1)
        starts = np.flatnonzero(np.append(True, grps[1:] != grps[:-1]))
        for a, b in zip(starts, np.append(starts[1:], len(grps))):
            if held is not None and grps[a] != held:
                yield flush()
                held = None
            part = x[a:b]
            total = np.append(float(b - a), part.sum(axis=0))
            if held is None:
                held, sums, gram = grps[a], total, part.T @ part
            else:
                sums, gram = sums + total, gram + part.T @ part
    if held is not None:
        yield flush()


def _axes(k: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("i")
        head = np.array(rows["row"].iloc[0])
        n, mean = head[0], head[1:] / head[0]
        cov = np.vstack(rows["row"].iloc[1:].to_list()) / n - np.outer(mean, mean)
        _, vectors = np.linalg.eigh(cov)
        axes = vectors[:, ::-1][:, :k].T
        sign = np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])
        return pd.DataFrame({"grp": [rows["grp"].iloc[0]], "mean": [mean], "axes": [list(axes * sign[:, None])]})

    return run


def principal_axes(points: DataFrame, k: int) -> DataFrame:
    """(grp, mean, axes): centre and the first k principal axes of every group, in one pass.

    A task sums the second moments of the rows of one group at a time.  Partial sums are
    d rows of d numbers per million points; they are added per cell of the matrix, and only
    the d x d sum of a group meets in one task.  The result is stored.
    """
    sizes = cut(points.groupBy("grp").agg(F.count("*").alias("n")))  # stored, so that the join knows how small it is
    parts = F.ceil(F.col("n") / ROWS_PER_PART)
    spread = points.join(sizes, "grp").select(
        "grp", F.pmod(F.xxhash64("pid"), parts).alias("salt"), "xs"
    ).repartition("grp", "salt").sortWithinPartitions("grp", "salt").select("grp", "xs")
    partial = spread.mapInArrow(_moments, "grp string, i int, row array<double>")
    # added cell by cell: a million points of d numbers come as d x d cells, which are combined before they are shuffled
    cells = partial.select("grp", "i", F.posexplode("row").alias("j", "v")).groupBy("grp", "i", "j").agg(F.sum("v").alias("v"))
    added = cells.groupBy("grp", "i").agg(F.sort_array(F.collect_list(F.struct("j", "v")))["v"].alias("row"))
    return cut(added.groupBy("grp").applyInPandas(_axes(k), MODEL))


def project(points: DataFrame, model: DataFrame) -> DataFrame:
    """Points (grp, pid, xs) in the axes of their group; stays in the JVM."""
    centred = F.zip_with("xs", "mean", lambda x, m: x - m)
    rows = points.join(model, "grp").withColumn("xs", centred)
    return rows.select(
        "grp", "pid",
        F.transform(
            "axes", lambda axis: F.aggregate(F.zip_with("xs", axis, lambda x, a: x * a), F.lit(0.0), lambda s, v: s + v)
        ).alias("xs"),
    )


def reduce_vectors(points: DataFrame, k: int = 3) -> DataFrame:
    """Every group in its own first k principal axes of unit vectors."""
    rows = unit_points(points)
    return project(rows, principal_axes(rows, k))
