"""N-gram Jaccard join by MinHash banding.

Every text becomes the set of its word n-grams.  Texts with equal sets are one class, which a single member stands for.
Its MinHash signature is cut into bands; band and row counts follow from the threshold and a target recall.  Classes that
share a band hash are candidates: each is linked with the least class of its bucket, and the components of these links
hold every candidate pair.  Within a component all pairs are compared on their full n-gram sets, in blocks of bounded
size; a task returns counts of links and a forest, never the pairs.  Components of the forests are the near-duplicate
classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import fingerprint, held_rows, meet, stored
from feedloom.llm.links import least_members
from feedloom.session import cut

WIDTH = 5
THRESHOLD = 0.8
RECALL = 0.9999
HASHES = 200
BLOCK_GRAMS = 200_000  # n-grams of a block; a pair of blocks is compared in one task
BLOCK_SETS = 4_000  # sets of a block, as a pair of blocks is a matrix of sets by sets
COLUMNS = 2048  # n-grams per matrix product
SLICE = 512  # rows of that matrix that are judged at once


def bands_for(threshold: float, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective bands that find a pair at the threshold with the target recall."""
    for rows in range(hashes, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold ** rows))) if threshold < 1 else 1
        if bands * rows <= hashes:
            return bands, rows
    raise ValueError("more hashes are needed for this recall")


class _WordHashes(dict):
    """Hash of each word seen, bounded by starting anew."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_set(text: str | None, width: int, known: dict) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of a text's lower-case words; shorter texts are one n-gram, empty ones none."""
    tokens = (text or "").lower().encode("utf-8", "surrogatepass").split()
    if not tokens:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    width = min(width, len(hashes))
    total = np.full(len(hashes) - width + 1, width, np.uint64)
    for i in range(width):
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[i:len(hashes) - width + 1 + i])
    return np.unique(total)


def band_hashes(grams: np.ndarray, bands: int, rows: int, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(grams), 512):
        part = factors[:, None] * grams[None, start:start + 512]
        part += shifts[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    total = np.zeros(bands, np.uint64)
    for i in range(rows):
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + least[i::rows])
    return total


def _signatures(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng(11)
        factors = random.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        shifts = random.integers(0, 2**63, bands * rows, dtype=np.uint64)
        known = _WordHashes()
        for batch in batches:
            keys, sizes, found = [], [], []
            for value in batch.column(2):
                grams = gram_set(value.as_py(), width, known)
                keys.append(xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None)
                sizes.append(len(grams))
                found.append(band_hashes(grams, bands, rows, factors, shifts).view(np.int64) if len(grams) else None)
            yield pa.record_batch({"doc_id": batch.column(0), "fp": batch.column(1), "key": pa.array(keys, pa.binary()),
                                   "n_grams": pa.array(sizes, pa.int64()), "bands": pa.array(found, pa.list_(pa.int64()))})
    return run


def _gram_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            grams = [gram_set(value.as_py(), width, known).tobytes() for value in batch.column("text")]
            yield pa.record_batch({"key": batch.column("key"), "cluster": batch.column("cluster"), "blocks": batch.column("blocks"),
                                   "grams": pa.array(grams, pa.binary())})
    return run


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of `left` with all sets of `right`, by products of 0/1 matrices."""
    flat = np.concatenate(left + right)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in left + right])
    _, place, counts = np.unique(flat, return_inverse=True, return_counts=True)
    common = counts > 1
    keep = common[place]
    place, owner = (np.cumsum(common) - 1)[place[keep]], owner[keep]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    total = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, COLUMNS):
        a, b = np.searchsorted(place, [start, start + COLUMNS])
        part = np.zeros((len(left) + len(right), COLUMNS), np.float32)
        part[owner[a:b], place[a:b] - start] = 1
        total += part[:len(left)] @ part[len(left):].T
    return total


def _linked(shared: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold, from the sizes of their intersections and of the sets, in slices of rows."""
    out = np.empty(shared.shape, bool)
    for i in range(0, len(left), SLICE):
        part = shared[i:i + SLICE]
        out[i:i + SLICE] = part >= threshold * (left[i:i + SLICE, None] + right[None, :] - part) - 1e-6
    return out


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a forest with the components of a symmetric 0/1 matrix."""
    open_, edges = np.ones(len(linked), bool), []
    for root in range(len(linked)):
        if open_[root]:
            open_[root] = False
            due = [root]
            while due:
                at = due.pop()
                fresh = np.flatnonzero(linked[at] & open_)
                open_[fresh] = False
                edges += [(at, int(x)) for x in fresh]
                due += fresh.tolist()
    return edges


def _compare(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        first, second = table["first"][0].as_py(), table["second"][0].as_py()
        sides: dict[int, dict[bytes, np.ndarray]] = {first: {}, second: {}}
        for block, key, grams in zip(table["block"].to_pylist(), table["key"].to_pylist(), table["grams"]):
            if key not in sides[block]:
                sides[block][key] = np.frombuffer(grams.as_buffer(), np.uint64)
        (lk, left), (rk, right) = ((list(s), list(s.values())) for s in (sides[first], sides[second]))
        if not left or not right:
            return pa.table({"key": pa.array([], pa.binary()), "n_links": pa.array([], pa.int64()), "peer": pa.array([], pa.binary())})
        shared = shared_counts(left, right)
        ln, rn = np.array([len(x) for x in left]), np.array([len(x) for x in right])
        linked = _linked(shared, ln, rn, threshold)
        if first == second:
            np.fill_diagonal(linked, False)
            keys, counts, edges = lk, linked.sum(axis=1), _forest(linked)
        else:
            keys, counts = lk + rk, np.concatenate([linked.sum(axis=1), linked.sum(axis=0)])
            whole = np.zeros((len(keys), len(keys)), bool)
            whole[:len(lk), len(lk):] = linked
            edges = _forest(whole | whole.T)
        peers = [None] * len(keys) + [keys[b] for _, b in edges]
        return pa.table({"key": pa.array(keys + [keys[a] for a, _ in edges], pa.binary()),
                         "n_links": pa.array([*counts.tolist(), *[0] * len(edges)], pa.int64()), "peer": pa.array(peers, pa.binary())})
    return run


def block_counts(members: DataFrame, block_grams: int = BLOCK_GRAMS, block_sets: int = BLOCK_SETS) -> DataFrame:
    """(cluster, blocks): as many blocks as bound both the n-grams and the sets of each."""
    blocks = F.greatest(F.ceil(F.sum("n_grams") / block_grams), F.ceil(F.count("*") / block_sets))
    return members.groupBy("cluster").agg(blocks.cast("int").alias("blocks"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, recall: float = RECALL,
                    block_grams: int = BLOCK_GRAMS, block_sets: int = BLOCK_SETS) -> DataFrame:
    """One row per row of `docs`: doc_id, fp, copy_id, class_id, n_links, keeper.

    copy_id is the least id among texts with the same n-gram set, class_id the least id of the near-duplicate class (the
    texts joined by links), n_links the number of other n-gram sets with a Jaccard similarity of at least `threshold`,
    keeper tells the one (doc_id, fp) of a class that stays.  `fp` tells apart texts that share an id.

    Words are split at white space and lower-cased.  A text with fewer words than `width` is one n-gram; a null text or
    one without words has none, stands alone and is kept.  Null ids are least.  Repeated rows get equal answers.
    Other columns are ignored.
    """
    bands, rows = bands_for(threshold, recall)
    keyed = docs.select("doc_id", fingerprint(), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = cut(keyed.mapInArrow(_signatures(width, bands, rows), f"doc_id {kind}, fp long, key binary, n_grams long, bands array<long>"))
    classes = cut(signed.filter("key IS NOT NULL").groupBy("key").agg(
        F.min(F.struct("doc_id", "fp")).alias("head"), F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands")))

    filed = classes.select("key", F.posexplode("bands").alias("band", "hash"))
    buckets = filed.groupBy("band", "hash").agg(F.min("key").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n")
    near = filed.join(buckets, ["band", "hash"]).select(F.col("key").alias("u"), F.col("least").alias("v"))
    clusters = least_members(near)
    members = clusters.select(F.col("node").alias("key"), F.col("least").alias("cluster"))
    members = members.unionByName(members.select(F.col("cluster").alias("key"), "cluster").distinct())
    members = cut(members.join(classes.select("key", "head", "n_grams"), "key"))
    members = cut(members.join(block_counts(members, block_grams, block_sets), "cluster").select("key", "cluster", "blocks", F.col("head.doc_id").alias("doc_id"), F.col("head.fp").alias("fp")))

    sets = meet(keyed, members, "doc_id", "fp").mapInArrow(_gram_sets(width), "key binary, cluster binary, blocks int, grams binary")
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block")
    dealt = sets.select("cluster", "key", "grams", block, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other"))
    compared = cut(dealt.groupBy("cluster", "first", "second").applyInArrow(_compare(threshold), "key binary, n_links long, peer binary"))

    counts = compared.groupBy("key").agg(F.sum("n_links").alias("n_links"))
    joined = least_members(compared.filter("peer IS NOT NULL").select(F.col("key").alias("u"), F.col("peer").alias("v")))
    joined = joined.select(F.col("node").alias("key"), F.col("least").alias("root"))
    named = classes.select("key", "head").join(counts, "key", "left").join(joined, "key", "left").withColumn("root", F.coalesce("root", "key"))
    heads = named.groupBy("root").agg(F.min("head").alias("class_head"))
    named = cut(named.join(heads, "root").select("key", F.col("head.doc_id").alias("copy_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "class_head"))
    out = signed.select("doc_id", "fp", "key").join(named, "key", "left")
    own = F.struct("doc_id", "fp")
    head = F.when(F.col("key").isNull(), own).otherwise(F.col("class_head"))
    return out.select("doc_id", "fp", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
                      head["doc_id"].alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), head.eqNullSafe(own).alias("keeper"))


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, all columns, that are kept: one of each near-duplicate class, repeated rows once."""
    marks = stored(near_duplicates(docs, **options).select("doc_id", "fp", "keeper"))
    gone = marks.filter("NOT keeper").select("doc_id", "fp").distinct()
    rows = meet(held_rows(docs), gone, "doc_id", "fp", how="left_anti")
    # texts are only shuffled for repeated rows if there are any
    repeated = marks.filter("keeper").groupBy("doc_id", "fp").count().filter("count > 1").head(1)
    return (rows.dropDuplicates(["doc_id", "fp"]) if repeated else rows).select("row.*")
