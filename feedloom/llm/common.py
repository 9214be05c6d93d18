"""Small helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import cut

WORD = r"[^\x20\x09-\x0D]+"  # fixed value: what counts as one word


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    """All words of a text, unchanged; null gives an empty array."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), 0)


SMALL_ROWS = 100_000  # narrow rows that may be sent to every task


def meet(rows: DataFrame, keys: DataFrame, *on: str, how: str = "inner") -> DataFrame:
    """Equi-join of a large table with a stored, narrow one, nulls being equal to nulls.

    The narrow table goes to every task if it is counted to have few rows; else both sides are shuffled.
    """
    spare = keys
    for name in on:
        spare = spare.withColumnRenamed(name, f"_{name}")
    met = F.lit(True)
    for name in on:
        met = met & F.col(name).eqNullSafe(F.col(f"_{name}"))
    small = keys.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS
    joined = rows.join(F.broadcast(spare) if small else spare, met, how)
    return joined.drop(*[f"_{name}" for name in on])


HOT_ROWS = 10_000


def meet_counted(rows: DataFrame, keys: DataFrame, *on: str, count: str) -> DataFrame:
    """Inner equi-join of a stored table with a stored one of unique keys, nulls being equal to nulls.

    Column `count` of `keys` says how many rows hold a key.  Keys of more than a ten-thousandth of all rows (and more than
    `HOT_ROWS`) number 10,000 at most, so they go to every task and their rows stay where they are; the others are shuffled.
    """
    total = keys.agg(F.sum(count)).head()[0] or 0
    limit = max(HOT_ROWS, total // 10_000)
    spare = keys
    for name in on:
        spare = spare.withColumnRenamed(name, f"_{name}")
    met = F.lit(True)
    for name in on:
        met = met & F.col(name).eqNullSafe(F.col(f"_{name}"))
    hot, rest = spare.filter(F.col(count) > limit), spare.filter(F.col(count) <= limit)
    found = rows.join(F.broadcast(hot), met)
    others = rows.join(F.broadcast(hot.select(*[f"_{name}" for name in on])), met, "left_anti").join(rest, met)
    return found.unionByName(others).drop(count, *[f"_{name}" for name in on])


def held_rows(docs: DataFrame) -> DataFrame:
    """Whole rows as one column `row`, beside their doc_id and fp: no other column can clash with an operator's own."""
    return docs.select(F.struct("*").alias("row"), "doc_id", fingerprint())


def fingerprint() -> Column:
    """What tells apart rows that share a doc_id."""
    return F.xxhash64("text").alias("fp")


def stored(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back; the shuffle files behind it are removed at once."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return cut(df)
    finally:
        conf.set(key, before)


def unique_texts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exact copies together: members (doc_id, sha) and one row (uid, sha, copies, text) per different text, both stored.

    Null texts count as empty.  A copy costs a narrow row from here on, so a text with a third of all rows is no hot group.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    keyed = docs.select("doc_id", text).withColumn("sha", F.sha2("text", 256)).withColumn("turn", F.xxhash64("doc_id"))
    members = stored(keyed.select("doc_id", "sha", "turn"))
    heads = members.groupBy("sha").agg(F.count("*").alias("copies"), F.min(F.struct("turn", "doc_id")).alias("head"))
    heads = heads.select(F.col("sha").alias("_sha"), "copies", F.col("head.doc_id").alias("_doc"))
    rows = keyed.join(heads, (F.col("sha") == F.col("_sha")) & F.col("doc_id").eqNullSafe(F.col("_doc")))
    rows = rows.dropDuplicates(["sha", "doc_id"]).select(F.monotonically_increasing_id().alias("uid"), "sha", "copies", "text")
    return members.select("doc_id", "sha"), stored(rows)
