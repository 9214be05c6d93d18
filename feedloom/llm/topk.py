"""Exact top-k search by inner product over a vector-approximation file.

Vectors are packed into blocks.  A block keeps one byte per component (its cell on the block's own grid), the grid,
and the exact vectors.  The search has two scans:

1. *Bounds.*  Every block of queries meets the approximations of every block of vectors.  The cell edges give a lower
   and an upper bound for each score; the k greatest lower bounds of a query over all blocks give its threshold.
2. *Exact scores.*  Vectors whose upper bound reaches the threshold are read in the order of their upper bounds, until
   the next bound is below the k-th exact score found so far.  So the result is exact.

Equal vectors are one entry with their smallest k + 1 ids (no other id of them can be among k results when ties go to
the smaller id), so thousands of copies cost as much as one vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import cut

BLOCK_ROWS = 4096
QUERY_ROWS = 512
CELLS = 255
CHUNK = 64  # exact vectors read at a time


def integer_components(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    """Neither null nor holding a null, NaN or infinite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = np.concatenate([np.asarray(chunk.flatten(), dtype=np.int64) for chunk in column.chunks])
    return flat.reshape(rows, len(flat) // rows)


def _pack_vectors(table: pa.Table) -> pa.Table:
    exact = _matrix(table["vector"], table.num_rows)
    low, high = exact.min(axis=0), exact.max(axis=0)
    step = np.maximum((high - low) / CELLS, 1e-9)
    cells = np.minimum(((exact - low) / step).astype(np.int64), CELLS).astype(np.uint8)
    # An edge may move by rounding: shift a component to the cell that holds it for sure.
    cells = np.where(low + cells * step > exact, cells - 1, cells).astype(np.uint8)
    return pa.table({
        "dims": pa.array([exact.shape[1]], pa.int32()), "block": table["block"][:1].cast(pa.int64()),
        "rows": pa.array([len(exact)], pa.int32()), "cells": pa.array([cells.tobytes()], pa.binary()),
        "low": pa.array([low.astype(np.float64).tobytes()], pa.binary()), "step": pa.array([step.tobytes()], pa.binary()),
        "exact": pa.array([exact.tobytes()], pa.binary()), "ids": pa.array([table["ids"].to_pylist()], pa.list_(pa.list_(pa.int64())))})


def _pack_queries(table: pa.Table) -> pa.Table:
    exact = _matrix(table["vector"], table.num_rows)
    return pa.table({
        "dims": pa.array([exact.shape[1]], pa.int32()), "qblock": table["qblock"][:1].cast(pa.int64()),
        "qids": pa.array([table["query_id"].to_pylist()], pa.list_(pa.int64())),
        "qvectors": pa.array([exact.tobytes()], pa.binary())})


def _bounds(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries and, per query and vector, a lower and an upper bound of the score."""
    dims, rows = row["dims"], row["rows"]
    queries = np.frombuffer(row["qvectors"], np.int64).reshape(len(row["qids"]), dims)
    cells = np.frombuffer(row["cells"], np.uint8).reshape(rows, dims).astype(np.float64)
    low, step = np.frombuffer(row["low"]), np.frombuffer(row["step"])
    q = queries.astype(np.float64)
    base = q @ low
    at = (q * step) @ cells.T + base[:, None]  # score of the low corner
    up, down = np.maximum(q, 0) @ step, np.minimum(q, 0) @ step  # a cell is one step wide
    slack = 1e-9 * (np.abs(q) @ (np.abs(low) + 256 * step)) + 1e-6
    return queries, at + (down - slack)[:, None], at + (up + slack)[:, None]


def _lower_bounds(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, lower, _ = _bounds(row)
                qids = np.array(row["qids"], np.int64)
                for i, own in enumerate(row["single"]):  # vectors that only the query itself has
                    if own is not None:
                        lower[qids == own, i] = -np.inf
                keep = min(k, lower.shape[1])
                best = -np.partition(-lower, keep - 1, axis=1)[:, :keep]
                ids = np.repeat(qids, keep)
                fine = np.isfinite(best.ravel())
                yield pa.record_batch({"query_id": pa.array(ids[fine]), "bound": pa.array(best.ravel()[fine])})
    return run


def _exact(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                queries, _, upper = _bounds(row)
                exact = np.frombuffer(row["exact"], np.int64).reshape(row["rows"], row["dims"])
                found: list[tuple[int, int, int]] = []
                for i, query_id in enumerate(row["qids"]):
                    limit = row["thresholds"][i]
                    limit = -np.inf if limit is None else limit
                    due = np.flatnonzero(upper[i] >= limit)
                    due = due[np.argsort(-upper[i, due], kind="stable")]
                    best: list[tuple[int, int]] = []  # (-score, id), sorted
                    for start in range(0, len(due), CHUNK):
                        part = due[start:start + CHUNK]
                        if len(best) >= k and upper[i, part[0]] < -best[k - 1][0]:
                            break
                        scores = exact[part] @ queries[i]
                        best += [(-int(s), v) for s, n in zip(scores, part) for v in row["ids"][n] if v != query_id]
                        best = sorted(best)[:k]
                    found += [(query_id, v, -s) for s, v in best]
                q, v, s = zip(*found) if found else ((), (), ())
                yield pa.record_batch({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.int64())})
    return run


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The k vectors of greatest inner product per query: query_id, rank (from 1), vec_id, score.

    `vectors`: vec_id long, vector array<long>; `queries`: query_id long, vector array<long>.  Other columns are ignored.
    Ties go to the smaller vec_id.  A vector with the query's own id is no candidate.  Rows with a null id or vector take
    no part; equal rows count once; an id with several vectors is a candidate with each of them, and as a query uses the
    least one.  Vectors are compared with vectors of their own length.  Fewer than k candidates give fewer rows, an empty
    table gives none.  Scores have to fit a long.
    """
    spark = vectors.sparkSession
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "vector").filter("vec_id IS NOT NULL AND vector IS NOT NULL")
    same = Window.partitionBy("vector").orderBy("vec_id")
    few = plain.distinct().withColumn("n", F.row_number().over(same)).filter(F.col("n") <= k + 1)
    entries = cut(few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("dims", F.size("vector")))
    asked = queries.select(F.col("query_id").cast("long").alias("query_id"), "vector").filter("query_id IS NOT NULL AND vector IS NOT NULL")
    asked = cut(asked.groupBy("query_id").agg(F.min("vector").alias("vector")).withColumn("dims", F.size("vector")))
    blocks = max(1, math.ceil(entries.count() / block_rows))
    qblocks = max(1, math.ceil(asked.count() / query_rows))
    filed = entries.withColumn("block", F.pmod(F.xxhash64("vector"), F.lit(blocks)))
    filed = cut(filed.groupBy("dims", "block").applyInArrow(
        _pack_vectors, "dims int, block long, rows int, cells binary, low binary, step binary, exact binary, ids array<array<long>>"))
    packed = asked.withColumn("qblock", F.pmod(F.xxhash64("query_id"), F.lit(qblocks)))
    packed = cut(packed.groupBy("dims", "qblock").applyInArrow(_pack_queries, "dims int, qblock long, qids array<long>, qvectors binary"))

    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(qblocks - 1).cast("long")))
    single = F.transform("ids", lambda x: F.when(F.size(x) == 1, x[0]))
    scan = filed.select("dims", "block", "rows", "cells", "low", "step", single.alias("single"), numbers.alias("qblock"))
    spread = max(spark.sparkContext.defaultParallelism, blocks * qblocks)
    lower = scan.repartition(min(spread, 4096), "block", "qblock").join(F.broadcast(packed) if qblocks * query_rows <= 4096 else packed, ["dims", "qblock"])
    lower = lower.mapInArrow(_lower_bounds(k), "query_id long, bound double")
    ranked = lower.withColumn("n", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound"))))
    limits = ranked.filter(F.col("n") <= k).groupBy("query_id").agg(F.when(F.count("*") == k, F.min("bound")).alias("threshold"))
    # the thresholds, in the order of the packed queries
    order = packed.select("dims", "qblock", F.posexplode("qids").alias("at", "query_id"))
    limits = order.join(limits, "query_id", "left").groupBy("dims", "qblock").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "threshold"))), lambda x: x["threshold"]).alias("thresholds"))
    ready = cut(packed.join(limits, ["dims", "qblock"]))

    read = filed.select("dims", "block", "rows", "cells", "low", "step", "exact", "ids", numbers.alias("qblock"))
    read = read.repartition(min(spread, 4096), "block", "qblock").join(F.broadcast(ready) if qblocks * query_rows <= 4096 else ready, ["dims", "qblock"])
    found = read.mapInArrow(_exact(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
