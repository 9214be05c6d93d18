"""Restart-safe incremental ingest from a folder of feedback files.

Every micro-batch owns the folder `batch=<id>` of each table and overwrites it, so a
replayed batch leaves the same rows.  Ids known from other batches are left out through the
ledger, which is written last.  No table is rewritten.

The ledger lies in folders by key hash, `ledger/bucket=<n>/batch=<id>`.  A batch lists and reads only the
buckets that its own ids fall into, and of these only the ids.  `compact_ledger` keeps the number of
folders small.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators.clean import new_feedback
from feedloom.operators.upsert import last_per_key
from feedloom.plans.ingest import embed_rows, tag_rows
from feedloom.session import cut
from feedloom.sources.keyed import exists, folders, remove

BUCKETS = 64  # of the ledger; fixed for a root


def increment(batch: DataFrame, inventory: DataFrame, ledger: DataFrame) -> DataFrame:
    """The rows of a batch that are new: one per id, styled, worth analysing, not in the ledger."""
    columns = [c for c in batch.columns if c not in ("feedback_id", "created_at")]
    latest = last_per_key(batch, ["feedback_id"], ["created_at", *columns])
    return new_feedback(latest, inventory, ledger)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col("feedback_id").cast("string")), F.lit(buckets)).cast("int")


def known_ids(spark: SparkSession, root: str, batch_id: int, batch: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """What other batches have embedded, of the buckets that the ids of `batch` fall into."""
    touched = [row.b for row in batch.select(_bucket(buckets).alias("b")).distinct().collect()]  # numbers of buckets
    paths = [path for path in (f"{root}/ledger/bucket={b}" for b in sorted(touched)) if exists(spark, path)]
    if not paths:
        return spark.createDataFrame([], schemas.EMBEDDED_ITEMS)
    ledger = spark.read.schema("feedback_id string, embedded_at timestamp_ntz, bucket int, batch long").option("basePath", f"{root}/ledger").parquet(*paths)
    return ledger.filter(F.col("batch") != batch_id).select("feedback_id", "embedded_at")


def _write_ledger(rows: DataFrame, root: str, batch_id: int, buckets: int) -> None:
    spark = rows.sparkSession
    rows = cut(rows.withColumn("bucket", _bucket(buckets)))
    mine = {row.bucket for row in rows.select("bucket").distinct().collect()}
    for name in folders(spark, f"{root}/ledger"):  # what an earlier attempt of this batch left elsewhere
        if name.startswith("bucket=") and int(name[7:]) not in mine:
            remove(spark, f"{root}/ledger/{name}/batch={batch_id}")
    rows.withColumn("batch", F.lit(batch_id)).repartition("bucket").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(f"{root}/ledger")


def compact_ledger(spark: SparkSession, root: str, upto: int) -> None:
    """Join the ledger folders of all batches before `upto` into one per bucket.  Run it between runs of the stream.

    The joined folders (a new negative number) are complete before the old ones go, so a stop leaves ids twice at worst and
    never drops one.  Batches that may be replayed, the last one above all, must not be joined.
    """
    names = [name for name in folders(spark, f"{root}/ledger") if name.startswith("bucket=")]
    if not names:
        return
    ledger = spark.read.schema("feedback_id string, embedded_at timestamp_ntz, bucket int, batch long").parquet(f"{root}/ledger")
    old = ledger.filter(F.col("batch") < upto)
    numbers = sorted(row.batch for row in old.select("batch").distinct().collect())  # one row per batch
    if len(numbers) < 2:
        return
    fresh = min(numbers[0], 0) - 1
    joined = cut(last_per_key(old.select("feedback_id", "embedded_at", "bucket"), ["feedback_id", "bucket"], ["embedded_at"]))
    joined.withColumn("batch", F.lit(fresh)).repartition("bucket").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(f"{root}/ledger")
    for name in names:
        for number in numbers:
            remove(spark, f"{root}/ledger/{name}/batch={number}")


def ingest_batch(root: str, inventory: DataFrame, rules: Sequence[tuple[str, str]], now: Callable[[int], str],
                 dim: int = 64, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """The `foreachBatch` function.  `now(batch_id)` stamps a batch, the same on every replay."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = cut(batch)
        rows = cut(increment(batch, inventory, known_ids(spark, root, batch_id, batch, buckets)))
        stamp = F.to_timestamp_ntz(F.lit(now(batch_id)))
        tables = {
            "embeddings": embed_rows(rows, dim),
            "tags": tag_rows(rows, rules),
        }
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch_id}")
        _write_ledger(rows.select("feedback_id", stamp.alias("embedded_at")), root, batch_id, buckets)  # last

    return run


def run_available(spark: SparkSession, source: str, root: str, inventory: DataFrame, rules: Sequence[tuple[str, str]],
                  now: Callable[[int], str], dim: int = 64, files_per_batch: int = 1000):
    """Process every file that has arrived in `source` since the last run, then stop."""
    stream = spark.readStream.schema(schemas.FEEDBACK).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return (
        stream.writeStream.foreachBatch(ingest_batch(root, inventory, rules, now, dim))
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
    )
