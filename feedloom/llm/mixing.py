"""Mixing sources to target weights, with DataFrame functions only.

Every source is a stream: its documents in a pseudorandom order, their words end to end, cut into blocks of a fixed number
of words.  A source takes as many *slots* (one block each) as its target asks for.  Slots are drawn to output shards at
random, which makes a shard's counts per source multinomial, given the totals.  A source's j-th slot reads block
perm(j mod n) of its n blocks, where perm is an affine permutation that changes with every pass over the source; slots and
blocks meet by an equi-join on (source, block).  So a block is read at most ceil(target / size) times.

A source with a third of all documents is no hot key: positions in its stream are sums in two levels (buckets, then
documents of a bucket), slots are made in chunks, and joins go by single blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import word_count, words
from feedloom.session import cut

WEIGHTS = (5, 2, 1)
REPEATS = 3  # no source is read more often
BLOCK_WORDS = 256
SHARD_SLOTS = 4096
BUCKET_ROWS = 10_000
CHUNK_SLOTS = 10_000
# Multipliers of the permutations: primes beyond any number of blocks, so each is coprime to it.
PRIMES = (1_000_000_000_039, 1_000_000_000_061, 1_000_000_000_063, 1_000_000_000_091)


@dataclass
class Mixture:
    """documents: doc_id, source, fingerprint, size, place (rank of the source), start (in its stream).
    sources: place, source, source_size, weight, target, blocks, slots.
    entries: shard, position, place, block, start, first_word, n_words: what a shard reads, one row per piece of a document."""

    documents: DataFrame
    sources: DataFrame
    entries: DataFrame


def sized(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` with its number of words and a copy number among equal rows."""
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("fingerprint"), word_count(F.col("text")).alias("size"))
    equal = Window.partitionBy("fingerprint", "doc_id", "source", "size").orderBy("size")
    return rows.withColumn("copy", F.row_number().over(equal))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Per source its share of all words by weight, at most `repeats` times its own; the excess is shared out again.

    Sources that stop are those with the least ratio of ceiling to weight, so running sums in that order tell which:
    a source stops if its share of what is left before it is above its ceiling.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name, everything = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    per = per.withColumn("place", F.row_number().over(by_name) - 1)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("place") % len(weights) + 1))
    per = per.withColumn("ceiling", F.col("source_size") * repeats)
    early = Window.orderBy(F.col("ceiling") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(early), F.lit(0)).cast("double")
    per = per.withColumn("left", F.sum("source_size").over(everything) - before("ceiling"))
    per = per.withColumn("open", F.sum("weight").over(everything) - before("weight"))
    per = per.withColumn("stops", F.col("left") * F.col("weight") > F.col("ceiling") * F.col("open"))
    stopped = lambda c: F.coalesce(F.sum(F.when(F.col("stops"), F.col(c))).over(everything), F.lit(0)).cast("double")
    per = per.withColumn("left", F.sum("source_size").over(everything) - stopped("ceiling"))
    per = per.withColumn("open", F.sum("weight").over(everything) - stopped("weight"))
    share = F.least(F.col("left") * F.col("weight") / F.nullif("open", F.lit(0.0)), F.col("ceiling").cast("double"))
    target = F.when(F.col("stops"), F.col("ceiling").cast("double")).otherwise(F.coalesce(share, F.lit(0.0)))
    return per.select("place", "source", "source_size", "weight", target.alias("target"))


def _in_stream(rows: DataFrame, seed: int) -> DataFrame:
    """`start` of every document in its source's stream; buckets of bounded size are summed first."""
    buckets = max(1, -(-rows.count() // BUCKET_ROWS))
    rows = rows.withColumn("turn", F.xxhash64(F.lit(seed), "doc_id", "fingerprint", "copy"))
    rows = rows.withColumn("bucket", F.pmod("turn", F.lit(buckets)))
    sums = rows.groupBy("place", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("place", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("place", "bucket").orderBy("turn", "doc_id", "fingerprint", "copy").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return rows.join(bases, ["place", "bucket"]).select("doc_id", "source", "fingerprint", "size", "place", (F.col("base") + F.col("inner")).alias("start"))


def _permuted(index: Column, blocks: Column, *salt: Column) -> Column:
    """An affine permutation of 0 .. blocks - 1, another one for each salt; decimals, so that no product overflows."""
    factor = F.element_at(F.array(*map(F.lit, PRIMES)), (F.pmod(F.xxhash64(*salt), F.lit(len(PRIMES))) + 1).cast("int")) % blocks
    shift = F.pmod(F.xxhash64(F.lit("shift"), *salt), blocks)
    wide = lambda c: c.cast("decimal(19,0)")
    return ((wide(factor) * wide(index) + wide(shift)) % wide(blocks)).cast("long")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, block_words: int = BLOCK_WORDS,
        shard_slots: int = SHARD_SLOTS, seed: int = 17) -> Mixture:
    """Mix `docs` (doc_id, source, text) so that sources share all words by `weights`, ordered by name, null last.

    Null texts and texts without words have size 0 and are never taken.  Equal rows are documents of their own.  Null ids
    are an id like others, a null source is a source.  Other columns are ignored.  No rows give no rows.  The result
    depends on the rows and the seed, not on their order or partitions.
    """
    rows = cut(sized(docs))
    per = targets(rows, weights, repeats)
    per = per.withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("long"))
    exact = F.coalesce(F.col("target") * F.col("blocks") / F.nullif("source_size", F.lit(0)), F.lit(0.0))
    per = cut(per.withColumn("slots", F.ceil(exact - 1e-9).cast("long")).withColumn("last_part", exact - F.col("slots") + 1))
    names = per.select("place", F.col("source").alias("name"))
    rows = rows.join(names, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    placed = cut(_in_stream(rows, seed))

    chunks = per.filter("slots > 0").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / CHUNK_SLOTS))))
    chunks = chunks.repartition(docs.sparkSession.sparkContext.defaultParallelism, "place", "chunk")
    top = F.least(F.col("slots"), (F.col("chunk") + 1) * CHUNK_SLOTS) - 1
    slots = chunks.withColumn("slot", F.explode(F.sequence(F.col("chunk") * CHUNK_SLOTS, top)))
    round_ = F.floor(F.col("slot") / F.col("blocks"))
    slots = slots.withColumn("block", _permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("place"), round_))
    length = F.least(F.lit(block_words).cast("long"), F.col("source_size") - F.col("block") * block_words)
    slots = slots.withColumn("upto", F.when(F.col("slot") == F.col("slots") - 1, F.round(F.col("last_part") * length).cast("long")).otherwise(length))
    shards = F.greatest(F.ceil(F.lit(per.agg(F.coalesce(F.sum("slots"), F.lit(0))).head()[0]) / shard_slots), F.lit(1))
    slots = slots.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "place", "slot"), shards))
    slots = slots.select("shard", "place", "slot", "block", "upto")

    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    pieces = placed.filter("size > 0").select("place", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.col("block") * block_words, F.col("start"))
    end = F.least((F.col("block") + 1) * block_words, F.col("start") + F.col("size"))
    pieces = pieces.select("place", "block", "start", begin.alias("begin"), end.alias("end"))
    # slots come from a few rows, so the planner takes them for small: never send them to every task
    met = slots.hint("merge").join(pieces, ["place", "block"])
    taken = F.least(F.col("end"), F.col("block") * block_words + F.col("upto")) - F.col("begin")
    entries = met.withColumn("n_words", taken).filter("n_words > 0").withColumn("first_word", F.col("begin") - F.col("start"))
    order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 1), "place", "slot"), "place", "slot", "first_word", "start")
    entries = entries.withColumn("position", F.row_number().over(order))
    return Mixture(placed, per, entries.select("shard", "position", "place", "block", "start", "first_word", "n_words"))


def shard_texts(mixture: Mixture, docs: DataFrame) -> DataFrame:
    """The words that each shard reads, in order: shard, position, doc_id, source, text (words joined by one space)."""
    where = mixture.documents.filter("size > 0").select("place", "start", "doc_id", "source", "fingerprint")
    texts = docs.select("doc_id", "source", F.xxhash64("text").alias("fingerprint"), "text").dropDuplicates(["doc_id", "source", "fingerprint"])
    keyed = where.join(texts.select(F.struct("doc_id", "source", "fingerprint").alias("key"), "text"),
                       F.struct("doc_id", "source", "fingerprint").eqNullSafe(F.col("key"))).drop("key")
    rows = mixture.entries.join(keyed, ["place", "start"])
    part = F.slice(words(F.col("text")), (F.col("first_word") + 1).cast("int"), F.col("n_words").cast("int"))
    return rows.select("shard", "position", "doc_id", "source", F.array_join(part, " ").alias("text"))


def digest(mixture: Mixture) -> DataFrame:
    """Per document: doc_id, size, source_size, target, the words that the mix takes of it and the number of shards that they go to."""
    taken = mixture.entries.groupBy("place", "start").agg(F.sum("n_words").alias("taken"), F.count_distinct("shard").alias("n_shards"))
    taken = taken.select(F.col("place").alias("p"), F.col("start").alias("s"), "taken", "n_shards")
    rows = mixture.documents.join(F.broadcast(mixture.sources.select("place", "source_size", "target")) if mixture.sources.count() <= 10_000
                                  else mixture.sources.select("place", "source_size", "target"), "place")
    rows = rows.join(taken, (F.col("size") > 0) & (F.col("place") == F.col("p")) & (F.col("start") == F.col("s")), "left")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source",
                       F.coalesce("n_shards", F.lit(0)).cast("long").alias("n_shards"))
