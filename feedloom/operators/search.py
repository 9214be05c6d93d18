"""Similarity search over stored vectors: exact and bucketed.

Stored vectors and queries are packed into blocks, scaled to length one, and meet by an equi-join on block numbers; neither
passes through the driver, and the stored vectors are read once however many queries there are.  A first round compares each block
of queries with the one block of vectors that seems nearest.  The k-th distance found there is a threshold per query;
the second round opens only block pairs that can hold something nearer, and takes only rows below the threshold.  A block
pair hands on k rows per query at most.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.vectors import has_direction, unit
from feedloom.operators.blocks import BOX_DIMS, SLACK, bounds_of, choose_pivots, coords, descend, pack, pack_told, tree_levels, values, with_extent
from feedloom.operators.joined import enrich
from feedloom.operators.knn import pair_rows
from feedloom.operators.reports import first_per_group
from feedloom.session import cut

STRIPE = 64    # queries whose distances are held at once
QUERIES_PER_SCAN = 1000  # queries of a block at most
SCAN_ROWS, SCAN_VALUES = 32_768, 2_097_152  # vectors and numbers of a stored block at most: 16 MB
PAIRS_PER_TASK = 4  # rows of two blocks that a task takes, so at most so many lie in its memory
LISTED_ROWS = 16_384  # queries by lists that are handed on at once
DIGITS = 12    # distances are told apart up to here, so that copies of a vector tie
HITS = "query_id string, feedback_id string, distance double"


def comparable(vector: Column, dim: int) -> Column:
    """Whether a vector has a direction, the given length and only finite parts."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(vector) == dim) & fine, F.lit(False)) & has_direction(vector)


def unit_rows(df: DataFrame, key: str, dim: int) -> DataFrame:
    """(rid, xs): the vectors of `df` that are `comparable`, scaled to length one.

    One function over batches, so that a vector that is computed from a text is computed once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.equal(pc.list_value_length(batch.column("vector")), dim))
            x = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            with np.errstate(all="ignore"):
                lengths = np.linalg.norm(x, axis=1)
                fine = np.isfinite(x).all(axis=1) & (lengths > 0) & np.isfinite(lengths)
                x = x[fine] / lengths[fine, None]
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * dim)
            yield pa.RecordBatch.from_arrays([batch.column("rid").filter(pa.array(fine)), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], ["rid", "xs"])

    return df.select(F.col(key).cast("string").alias("rid"), "vector").mapInArrow(run, "rid string, xs array<double>")


def _best(queries: np.ndarray, vectors: np.ndarray, k: int, limit: np.ndarray):
    """Row, column and cosine distance of the k nearest vectors per query, no farther than its limit.

    Vectors are sorted by id, so equal distances go to the lesser id.
    """
    for start in range(0, len(queries), STRIPE):
        d = np.round(1.0 - queries[start:start + STRIPE] @ vectors.T, DIGITS) + 0.0
        mask = d <= limit[start:start + STRIPE, None]
        if d.shape[1] > k:
            mask &= d <= np.partition(d, k - 1, axis=1)[:, k - 1:k]
        rows, cols = np.nonzero(mask)
        order = np.lexsort((cols, d[rows, cols], rows))
        rows, cols = rows[order], cols[order]
        top = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        rows, cols = rows[top], cols[top]
        yield rows + start, cols, d[rows, cols]


def _compared(batches: Iterator[pa.RecordBatch], k: int, threshold: float | None) -> Iterator[pa.RecordBatch]:
    """Hits of the block pairs; `limits`, if there, are the greatest useful distances."""
    for batch in batches:
        for i in range(batch.num_rows):
            dim = batch.column("dim")[i].as_py()
            q, v = coords(batch, i, "xs", dim), coords(batch, i, "o_xs", dim)
            limit = values(batch, i, "limits") if "limits" in batch.schema.names else np.full(len(q), np.inf)
            qids, vids = values(batch, i, "ids"), values(batch, i, "o_ids")
            for rows, cols, d in _best(q, v, k, limit):
                if threshold is not None:
                    near = d < threshold
                    rows, cols, d = rows[near], cols[near], d[near]
                yield pa.RecordBatch.from_arrays([pa.array(qids[rows], pa.string()), pa.array(vids[cols], pa.string()), pa.array(d)],
                                                 ["query_id", "feedback_id", "distance"])


def _reach(cosine: Column) -> Column:
    """Euclidean distance of unit vectors at a cosine distance, with room for rounding."""
    return F.sqrt(2.0 * cosine) * SLACK + 1e-9


def nearest(vectors: DataFrame, queries: DataFrame, dim: int, k: int, threshold: float | None = None, rows: int | None = None) -> DataFrame:
    """(query_id, feedback_id, distance): for each query at least its k nearest vectors of its group.

    Both tables have (grp, rid, xs) with unit vectors; `queries` is read from a stored table.  A query may be in several groups.
    """
    one = F.lit(1).cast("long").alias("weight")
    vectors, queries = cut(vectors.select("grp", "rid", one, "xs")), queries.select("grp", "rid", one, "xs")
    limit = rows or max(64, min(SCAN_ROWS, SCAN_VALUES // max(dim, 1)))
    stored, many = pack_told(vectors, dim, limit)
    asked = pack(queries, dim, min(limit, QUERIES_PER_SCAN))
    compared = partial(_compared, k=k, threshold=threshold)

    def met(pairs: DataFrame, left: DataFrame, *more: str) -> DataFrame:
        return pair_rows(pairs, left, stored, ["dim", "ids", "xs", *more], ["ids", "xs"], PAIRS_PER_TASK).mapInArrow(compared, HITS)

    alone = stored.filter("whole").select("grp", F.col("block").alias("other"))
    whole = met(asked.select("grp", "block").join(alone, "grp"), asked)
    if not many:
        return whole
    parts = stored.filter("NOT whole")
    pivots = choose_pivots(vectors) if dim > BOX_DIMS else None  # those that `parts` were told apart by
    groups = parts.select("grp").distinct()
    asked = with_extent(asked.join(groups, "grp", "left_semi"), dim, pivots)
    by = bounds_of(parts, dim)
    far = F.lit(float("inf")) if threshold is None else _reach(F.lit(float(threshold)))
    seekers = asked.select("grp", "block", "lo", "hi", far.alias("bound"))
    proof = {"high": by.span("a_", "b_"), "usable": F.col("b_n") >= k}
    pairs = descend(seekers, tree_levels(parts, by.width), low=by.gap("a_", "b_"), keep=F.lit(True), **proof)
    a = asked.select("grp", "block", F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"))
    b = parts.select("grp", F.col("block").alias("other"), F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"))
    told = pairs.join(a, ["grp", "block"]).join(b, ["grp", "other"]).select("grp", "block", "other", by.gap("a_", "b_").alias("low"), by.span("a_", "b_").alias("span"))
    told = cut(told)
    first = told.groupBy("grp", "block").agg(F.min(F.struct("low", "span", "other")).alias("f")).select("grp", "block", F.col("f.other").alias("other"))
    found = cut(met(first, asked))
    # k rows per group that holds the query
    last = found.groupBy(F.col("query_id").alias("rid")).agg(F.get(F.sort_array(F.collect_list("distance")), F.lit(k - 1)).alias("limit"))
    if threshold is not None:
        last = last.withColumn("limit", F.coalesce("limit", F.lit(float(threshold))))
    places = asked.select("grp", "block", F.posexplode("ids").alias("pos", "rid")).join(last, "rid", "left")
    limits = places.groupBy("grp", "block").agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("limit", F.lit(2.5)).alias("limit"))))["limit"].alias("limits"))
    limits = cut(limits)
    bound = limits.select("grp", "block", _reach(F.array_max("limits")).alias("bound"))
    rest = told.join(first, ["grp", "block", "other"], "left_anti").join(bound, ["grp", "block"]).filter(F.col("low") <= F.col("bound"))
    return whole.unionByName(found).unionByName(met(rest, asked.join(limits, ["grp", "block"]), "limits"))


def vector_length(queries: DataFrame) -> int | None:
    """The length of the first query with a vector."""
    row = queries.filter("vector IS NOT NULL").select(F.size("vector")).head()
    return row[0] if row else None


def search(embeddings: DataFrame, queries: DataFrame, k: int = 10, threshold: float | None = None,
           source: str | None = None, rows: int | None = None) -> DataFrame:
    """The k nearest stored vectors of every query by cosine distance: query_id, feedback_id, distance, rank.

    `queries` has (query_id, vector).  A threshold keeps distances strictly below it; None
    or 0 means no threshold.  Ties (up to 12 digits) are broken by feedback_id.  Only id and vector are read.  Vectors that
    are null, zero, not finite or of another length than the queries take no part.  `rows` bounds the vectors of a block.
    """
    kept = embeddings if source is None else embeddings.filter(F.col("source") == source)
    queries = cut(queries.select("query_id", "vector"))
    dim = vector_length(queries)
    if dim is None:
        return embeddings.sparkSession.createDataFrame([], HITS + ", rank int")
    one = F.lit("all").alias("grp")
    found = nearest(unit_rows(kept, "feedback_id", dim).select(one, "rid", "xs"), unit_rows(queries, "query_id", dim).select(one, "rid", "xs"), dim, k, threshold or None, rows)
    return first_per_group(found, "query_id", [F.col("distance"), F.col("feedback_id")], k)


def search_by_vector(embeddings: DataFrame, vector: Sequence[float], k: int = 10, threshold: float | None = None,
                     source: str | None = None) -> DataFrame:
    """N4 for one vector given by the caller."""
    query = embeddings.sparkSession.createDataFrame([("q", [float(x) for x in vector])], "query_id string, vector array<double>")
    return search(embeddings, query, k, threshold, source).drop("query_id")


def search_by_id(embeddings: DataFrame, feedback_id: str, k: int = 10, source: str | None = None,
                 exclude_self: bool = False) -> DataFrame:
    """What is nearest to a stored item; the item itself comes first unless excluded."""
    query = embeddings.filter(F.col("feedback_id") == feedback_id).select(F.col("feedback_id").alias("query_id"), "vector")
    rows = embeddings.filter(F.col("feedback_id") != feedback_id) if exclude_self else embeddings
    return search(rows, query, k, source=source).drop("query_id")


def search_by_text(embeddings: DataFrame, queries: DataFrame, embed, k: int = 10, source: str | None = None) -> DataFrame:
    """Search by free text.  `embed` is the function that embedded the stored texts, so both
    sides are lower-cased and hashed alike.  `queries` has (query_id, feedback_text)."""
    return search(embeddings, embed(queries).select("query_id", "vector"), k, source=source)


def with_distance(hits: DataFrame) -> DataFrame:
    """Similarity beside distance."""
    return hits.withColumn("similarity", 1.0 - F.col("distance"))


def search_enriched(hits: DataFrame, feedback: DataFrame, clusters: DataFrame) -> DataFrame:
    """Hits with rating, cluster and description."""
    return enrich(with_distance(hits), feedback, clusters)


def search_themes(hits: DataFrame, tags: DataFrame, feedback: DataFrame) -> DataFrame:
    """What the hits of each query have in common, as counts per tag, source and cluster."""
    rows = hits.select("query_id", "feedback_id").join(
        feedback.select("feedback_id", "feedback_source", "cluster_id"), "feedback_id"
    )
    tagged = rows.join(tags.select("feedback_id", "tag_name"), "feedback_id").select(
        "query_id", F.lit("tag").alias("kind"), F.col("tag_name").alias("theme")
    )
    sides = F.array(
        F.struct(F.lit("source").alias("kind"), F.col("feedback_source").alias("theme")),
        F.struct(F.lit("cluster").alias("kind"), F.col("cluster_id").alias("theme")),
    )
    other = rows.select("query_id", F.explode(sides).alias("s")).select("query_id", "s.kind", "s.theme")
    return tagged.unionByName(other).filter(F.col("theme").isNotNull()).groupBy("query_id", "kind", "theme").agg(
        F.count("*").alias("count")
    )


# --- bucketed search ------------------------------------------------------------------

def train_lists(embeddings: DataFrame, lists: int, seed: int = 42) -> np.ndarray:
    """List centres (lists x dim) from k-means over unit vectors.

    Spark fits them on all vectors that have a direction, one distributed pass per step.
    """
    rows = embeddings.filter(has_direction(F.col("vector"))).select("vector")
    features = rows.select(array_to_vector(unit(F.col("vector"))).alias("features"))
    model = KMeans(k=lists, seed=seed, maxIter=10).fit(features)
    return np.array(model.clusterCenters())


def assign_lists(embeddings: DataFrame, centres: np.ndarray) -> DataFrame:
    """Add `list_id`, the nearest centre.  Write the result partitioned by it.

    Vectors without a direction, not finite or of another length than the centres are left out, as no search finds them.
    """
    half = 0.5 * (centres * centres).sum(axis=1)
    rows = embeddings.select("feedback_id", "vector").filter(comparable(F.col("vector"), centres.shape[1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300) if len(x) else np.empty((0, centres.shape[1]))
            nearest_ = np.argmax(x @ centres.T - half, axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("feedback_id"), batch.column("vector"), pa.array(nearest_)], ["feedback_id", "vector", "list_id"])

    return rows.mapInArrow(run, _index_schema(embeddings))


def _probed(centres: np.ndarray, probes: int | None, radii: np.ndarray | None = None):
    """Per query one row per list to open: the `probes` nearest, or those that may hold something within its `reach`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("xs").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            far = np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1) - 2 * x @ centres.T, 0))
            nearest_ = np.argsort(far, axis=1, kind="stable")
            if probes is None:
                rows, lists = np.nonzero(far - radii <= batch.column("reach").to_numpy()[:, None])
            else:
                lists = nearest_[:, :probes].ravel()
                rows = np.repeat(np.arange(len(x)), min(probes, len(centres)))
            for start in range(0, len(rows), LISTED_ROWS):
                some = slice(start, start + LISTED_ROWS)
                taken = batch.select(["rid", "xs"]).take(pa.array(rows[some]))
                yield pa.RecordBatch.from_arrays([pa.array(lists[some].astype(np.int32)), taken.column("rid"), taken.column("xs")], ["list_id", "rid", "xs"])

    return run


PROBES = "list_id int, rid string, xs array<double>"


def _in_lists(index: DataFrame, pairs: DataFrame, dim: int, k: int, rows: int | None = None) -> DataFrame:
    """Hits of (list_id, rid, xs) queries in their lists.  Only the folders of these lists are read."""
    pairs = cut(pairs)
    opened = [row.list_id for row in pairs.select("list_id").distinct().collect()]  # numbers of lists
    stored = index.filter(F.col("list_id").isin(opened)).filter(comparable(F.col("vector"), dim))
    grp = F.col("list_id").cast("string").alias("grp")
    return nearest(stored.select(grp, F.col("feedback_id").cast("string").alias("rid"), unit(F.col("vector")).alias("xs")), pairs.select(grp, "rid", "xs"), dim, k, None, rows)


def ivf_search(index: DataFrame, centres: np.ndarray, queries: DataFrame, k: int = 10, probes: int = 10, rows: int | None = None) -> DataFrame:
    """Search only the `probes` lists nearest to each query.

    The lists to read are literals, so a table partitioned by `list_id` is pruned to their
    folders.  With as many probes as lists this is the exact search.
    """
    dim = centres.shape[1]
    pairs = unit_rows(queries, "query_id", dim).mapInArrow(_probed(centres, probes), PROBES)
    found = _in_lists(index, pairs, dim, k, rows)
    return first_per_group(found, "query_id", [F.col("distance"), F.col("feedback_id")], k)


# --- stored lists -------------------------------------------------------------------------

class StoredLists:
    """Inverted lists in a folder, written once: `vectors/list_id=<n>` and `lists` (list_id, centre, radius, n).

    The lists' centres are held by the driver and sent to every task: lists x dim numbers, a bound set by the writer.
    """

    def __init__(self, index: DataFrame, centres: np.ndarray, radii: np.ndarray, sizes: np.ndarray):
        self.index, self.centres, self.radii, self.sizes = index, centres, radii, sizes

    @classmethod
    def write(cls, embeddings: DataFrame, folder: str, lists: int, seed: int = 42) -> StoredLists:
        """Fit centres on all vectors, file every vector under the nearest one, and measure the lists."""
        spark = embeddings.sparkSession
        centres = train_lists(embeddings, lists, seed)
        assign_lists(embeddings, centres).repartition("list_id", F.pmod(F.xxhash64("feedback_id"), F.lit(8))).write.mode("overwrite").partitionBy("list_id").parquet(f"{folder}/vectors")
        table = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centres)], "list_id int, centre array<double>")
        index = spark.read.schema(_index_schema(embeddings)).parquet(f"{folder}/vectors")
        gap = F.aggregate(F.zip_with(unit(F.col("vector")), F.col("centre"), lambda x, c: (x - c) * (x - c)), F.lit(0.0), lambda s, x: s + x)
        measured = index.join(F.broadcast(table), "list_id").groupBy("list_id").agg(F.sqrt(F.max(gap)).alias("radius"), F.count("*").alias("n"))
        table.join(measured, "list_id", "left").select("list_id", "centre", F.coalesce("radius", F.lit(-1.0)).alias("radius"), F.coalesce("n", F.lit(0)).cast("long").alias("n")).write.mode(
            "overwrite").parquet(f"{folder}/lists")
        return cls.open(spark, folder)

    @classmethod
    def open(cls, spark, folder: str) -> StoredLists:
        index = spark.read.parquet(f"{folder}/vectors")
        rows = sorted(spark.read.parquet(f"{folder}/lists").collect(), key=lambda r: r.list_id)
        return cls(index, np.array([r.centre for r in rows]), np.array([r.radius for r in rows]), np.array([r.n for r in rows]))

    def search(self, queries: DataFrame, k: int = 10, probes: int | None = None, rows: int | None = None) -> DataFrame:
        """The k nearest vectors: query_id, feedback_id, distance, rank.

        With `probes`, of the so many nearest lists.  Without, exact by proof: the nearest list gives a k-th distance, and by the
        triangle inequality a list whose centre is farther than this plus its radius holds nothing nearer; all others are opened.
        """
        dim = self.centres.shape[1]
        asked = cut(unit_rows(queries, "query_id", dim))
        if probes is not None:
            found = _in_lists(self.index, asked.mapInArrow(_probed(self.centres, probes), PROBES), dim, k, rows)
        else:
            first = cut(asked.mapInArrow(_probed(self.centres, 1), PROBES))
            found = cut(_in_lists(self.index, first, dim, k, rows))
            due = asked.join(self._reaches(found, k), "rid", "left").withColumn("reach", F.coalesce("reach", F.lit(float("inf"))))
            due = due.mapInArrow(_probed(self.centres, None, self._room()), PROBES).join(first.select("rid", "list_id"), ["rid", "list_id"], "left_anti")
            found = found.unionByName(_in_lists(self.index, due.select("list_id", "rid", "xs"), dim, k, rows))
        return first_per_group(found, "query_id", [F.col("distance"), F.col("feedback_id")], k)

    def _room(self) -> np.ndarray:
        """Radii with room for rounding; an empty list is never opened."""
        return np.where(self.radii < 0, -np.inf, self.radii * SLACK + 1e-9)

    def _reaches(self, found: DataFrame, k: int) -> DataFrame:
        best = first_per_group(found, "query_id", [F.col("distance"), F.col("feedback_id")], k)
        return best.groupBy(F.col("query_id").alias("rid")).agg(F.when(F.count("*") >= k, _reach(F.max("distance"))).alias("reach"))

    def share(self, queries: DataFrame, k: int = 10, probes: int | None = None) -> float:
        """Of all pairs of a query and a stored vector, the share that a search compares."""
        dim = self.centres.shape[1]
        asked = cut(unit_rows(queries, "query_id", dim))
        if probes is not None:
            pairs = asked.mapInArrow(_probed(self.centres, probes), PROBES)
        else:
            first = asked.mapInArrow(_probed(self.centres, 1), PROBES)
            found = _in_lists(self.index, first, dim, k)
            due = asked.join(self._reaches(found, k), "rid", "left").withColumn("reach", F.coalesce("reach", F.lit(float("inf"))))
            pairs = due.mapInArrow(_probed(self.centres, None, self._room()), PROBES).select("rid", "list_id").unionByName(first.select("rid", "list_id")).distinct()
        sizes = F.array(*[F.lit(int(n)) for n in self.sizes])
        compared, total = pairs.agg(F.sum(F.get(sizes, F.col("list_id")))).head()[0] or 0, asked.count() * int(self.sizes.sum())
        return compared / total if total else 0.0


def _index_schema(embeddings: DataFrame) -> T.StructType:
    return T.StructType([*embeddings.select("feedback_id", "vector").schema.fields, T.StructField("list_id", T.IntegerType())])
