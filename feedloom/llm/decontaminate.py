"""Benchmark decontamination: MinHash containment search, partitioned by item size, with DataFrame functions only.

An item counts as contained in a document if the document has at least `threshold` of the item's distinct shingles.  The
MinHash of an item under a hash order is its least shingle, and a document that holds it may contain the item.  Items are
partitioned by size.  A partition gets a sketch of as many least shingles as an item of its greatest size may miss, and
one more: a document that misses all of them misses too many.  So no contained item is lost, and documents, however long, need no
signature of their own.  Candidates are then verified on all shingles of both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import fingerprint, held_rows, meet, words
from feedloom.session import cut

WIDTH = 5
THRESHOLD = 0.8
SMALL_SHINGLES = 200_000  # item shingles (two longs each) that may be sent to every task


def shingled(rows: DataFrame, width: int, *keep: str) -> DataFrame:
    """`keep` columns and `shingles`: hashes of `width` consecutive lower-case words of `text`; none if it has fewer."""
    # The one-element array binds the word hashes to a name: the optimizer cannot repeat them inside the inner function.
    def spans(h):
        starts = F.when(F.size(h) >= width, F.sequence(F.lit(0), F.size(h) - width)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]))

    hashes = F.transform(words(F.lower("text")), lambda w: F.xxhash64(w))
    return rows.select(*keep, F.get(F.transform(F.array(hashes), spans), 0).alias("shingles"))


def _needed(shingles):
    """Distinct shared shingles that make an item contained, by number of its shingles."""
    return lambda threshold: F.ceil(shingles * threshold - 1e-9).cast("int")


def sketches(items: DataFrame, threshold: float) -> DataFrame:
    """size_class, item_id, shingle: the least shingles of each item, as many as its size partition asks for."""
    sized = items.withColumn("size_class", F.floor(F.log2("n_item")).cast("int"))
    # n - ceil(t n) + 1 does not fall with n, so the greatest size of a class is enough for all of it
    most = F.least(F.pow(F.lit(2.0), F.col("size_class") + 1) - 1, F.col("n_item") * 2.0)
    length = F.least(F.col("n_item"), (most - F.ceil(most * threshold - 1e-9) + 1).cast("int"))
    return sized.select("size_class", "item_id", "ifp", F.explode(F.slice(F.array_sort("shingles"), 1, length)).alias("shingle"))


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """Pairs (doc_id, fp, item_id, n_shared, n_item, containment) with containment of at least `threshold`.

    `docs`: doc_id, text; `items`: item_id, text; other columns are ignored.  `fp` tells apart texts that share an id.
    Words are split at white space and lower-cased.  A null or empty text, and one with fewer words than `width`, has no
    shingles: it contains nothing and is contained in nothing.  Repeated rows give one pair.  Null ids are ids like others.
    """
    plain = shingled(items.select("item_id", F.xxhash64("text").alias("ifp"), "text"), width, "item_id", "ifp")
    plain = plain.withColumn("shingles", F.array_distinct("shingles")).withColumn("n_item", F.size("shingles"))
    plain = cut(plain.filter("n_item > 0").dropDuplicates(["item_id", "ifp"]))
    total = plain.agg(F.coalesce(F.sum("n_item"), F.lit(0))).head()[0]
    sent = F.broadcast if total <= SMALL_SHINGLES else (lambda df: df)
    keyed = docs.select("doc_id", fingerprint(), "text")

    # explode_outer: an inner one would add a filter that computes the shingles twice; the join drops its null rows
    rows = shingled(keyed, width, "doc_id", "fp").select("doc_id", "fp", F.explode_outer("shingles").alias("shingle"))
    candidates = rows.join(sent(sketches(plain, threshold)), "shingle").select("doc_id", "fp", "item_id", "ifp").distinct()
    candidates = cut(candidates)

    chosen = meet(keyed, candidates.select("doc_id", "fp").distinct(), "doc_id", "fp", how="left_semi").dropDuplicates(["doc_id", "fp"])
    rows = shingled(chosen, width, "doc_id", "fp").select("doc_id", "fp", F.explode_outer(F.array_distinct("shingles")).alias("shingle"))
    full = plain.select("item_id", "ifp", "n_item", F.explode("shingles").alias("shingle"))
    shared = rows.join(sent(full), "shingle").groupBy("doc_id", "fp", "item_id", "ifp", "n_item").agg(F.count("*").alias("n_shared"))
    found = shared.filter(F.col("n_shared") >= _needed(F.col("n_item"))(threshold))
    return found.select("doc_id", "fp", "item_id", "n_shared", F.col("n_item").cast("long").alias("n_item"),
                        (F.col("n_shared") / F.col("n_item")).alias("containment")).distinct()


def clean_documents(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """The rows of `docs`, all columns, that contain no item."""
    hit = cut(contained_items(docs, items, threshold, width).select("doc_id", "fp").distinct())
    return meet(held_rows(docs), hit, "doc_id", "fp", how="left_anti").select("row.*")
