"""Stored tables with keyed writes: a write reads and replaces only the folders that its keys fall into.

A table is a folder with one sub-folder `bucket=<n>` per hash of its key, so the folders a set of keys falls into are known
without reading the table, and a filter on `bucket` prunes the scan to them.  A write

1. keeps the last row per key and drops the rows that the table holds already, so repeating a write touches nothing;
2. writes the touched folders anew to `_pending`, which readers of the table do not see;
3. moves them into place, one folder at a time.

Step 2 ends with Spark's `_SUCCESS` file.  A write that stops before it has changed nothing; one that stops later is finished by
the next call, because moving the folders that are left can be repeated.  One writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import schemas
from feedloom.operators.upsert import last_per_key, upsert
from feedloom.session import cut

BUCKETS = 64


@dataclass(frozen=True)
class Written:
    """What a write did: keys given, keys that were new or different, folders replaced."""

    keys: int
    changed: int
    buckets: list[int] = field(default_factory=list)


def _path(spark: SparkSession, address: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(address)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, address: str) -> bool:
    path, files = _path(spark, address)
    return files.exists(path)


def folders(spark: SparkSession, address: str) -> list[str]:
    """Names inside a folder; none if it is absent."""
    path, files = _path(spark, address)
    return sorted(status.getPath().getName() for status in files.listStatus(path)) if files.exists(path) else []


def remove(spark: SparkSession, address: str) -> None:
    path, files = _path(spark, address)
    files.delete(path, True)


@dataclass(frozen=True)
class KeyedTable:
    """A table in `folder`.  `by` (part of the keys) decides the bucket; `order` decides between rows of one key in a write.

    The number of buckets belongs to the table: give the same one in every call.  Choose it so that a bucket holds a few
    hundred megabytes; a bucket is written by as many tasks as its size asks for.
    """

    folder: str
    schema: T.StructType
    keys: tuple[str, ...]
    order: tuple[str, ...]
    by: tuple[str, ...] = ()
    buckets: int = BUCKETS

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*(self.by or self.keys)), F.lit(self.buckets)).cast("int")

    def typed(self, rows: DataFrame) -> DataFrame:
        """`rows` with the table's columns and types, so that equal keys hash alike."""
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def read(self, spark: SparkSession) -> DataFrame:
        """The whole table; an absent one is empty."""
        return self._stored(spark).drop("bucket")

    def read_for(self, rows: DataFrame) -> DataFrame:
        """The rows of the buckets that the keys in `rows` fall into: what a join with them by key needs."""
        spark = rows.sparkSession
        kinds = {f.name: f.dataType for f in self.schema.fields}
        keyed = rows.select(*[F.col(name).cast(kinds[name]).alias(name) for name in (self.by or self.keys)])
        return self._some(spark, self._touched(keyed.withColumn("bucket", self.bucket()))).drop("bucket")

    def upsert(self, changes: DataFrame) -> Written:
        """Insert or replace the rows of `changes` by key; writing the same rows again touches no file.

        Null keys are keys like any other.  An empty write changes nothing.
        """
        spark = changes.sparkSession
        self._finish(spark)
        latest = cut(last_per_key(self.typed(changes), self.keys, self.order).withColumn("bucket", self.bucket()))
        given = latest.count()
        held = self._some(spark, self._touched(latest))
        same = F.lit(True)
        for f in self.schema.fields:
            same = same & latest[f.name].eqNullSafe(held[f.name])
        fresh = cut(latest.join(held, same & (latest["bucket"] == held["bucket"]), "left_anti"))
        changed = fresh.count()
        if changed:
            touched = self._touched(fresh)
            merged = upsert(self._some(spark, touched), fresh, [*self.keys, "bucket"], list(self.order))
            pending = f"{self.folder}/_pending"
            remove(spark, pending)
            merged.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(pending)
            self._finish(spark)
            return Written(given, changed, touched)
        return Written(given, 0)

    # --- folders ---

    def _stored(self, spark: SparkSession) -> DataFrame:
        full = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        full = T.StructType([T.StructField(f.name, f.dataType, True) for f in full.fields])
        if not exists(spark, self.folder):
            return spark.createDataFrame([], full)
        return spark.read.schema(full).parquet(self.folder)

    def _some(self, spark: SparkSession, buckets: list[int]) -> DataFrame:
        return self._stored(spark).filter(F.col("bucket").isin(buckets))

    def _touched(self, keyed: DataFrame) -> list[int]:
        """Bucket numbers, as many as the table has at most."""
        return sorted(row.bucket for row in keyed.select("bucket").distinct().collect())

    def _finish(self, spark: SparkSession) -> None:
        """Move the folders of a complete `_pending` into place; drop an incomplete one."""
        pending = f"{self.folder}/_pending"
        if exists(spark, f"{pending}/_SUCCESS"):
            source, files = _path(spark, pending)
            for status in files.listStatus(source):
                name = status.getPath().getName()
                if name.startswith("bucket="):
                    target, _ = _path(spark, f"{self.folder}/{name}")
                    files.delete(target, True)
                    if not files.rename(status.getPath(), target):
                        raise OSError(f"cannot move {status.getPath()} to {target}")
        remove(spark, pending)
        if exists(spark, self.folder):
            spark.catalog.refreshByPath(self.folder)


def embeddings_table(root: str, buckets: int = BUCKETS) -> KeyedTable:
    """S7."""
    return KeyedTable(f"{root}/embeddings", schemas.EMBEDDINGS, ("feedback_id",), ("created_at", "model"), buckets=buckets)


def ledger_table(root: str, buckets: int = BUCKETS) -> KeyedTable:
    """S8."""
    return KeyedTable(f"{root}/ledger", schemas.EMBEDDED_ITEMS, ("feedback_id",), ("embedded_at",), buckets=buckets)


def tags_table(root: str, buckets: int = BUCKETS) -> KeyedTable:
    """The tags of an item lie in one bucket."""
    return KeyedTable(f"{root}/tags", schemas.TAGS, ("feedback_id", "tag_name"), ("created_at", "confidence_score"), ("feedback_id",), buckets)


def clusters_table(root: str) -> KeyedTable:
    """The catalogue, a small table."""
    return KeyedTable(f"{root}/clusters", schemas.CLUSTERS, ("cluster_id",), ("created_at", "record_count"), buckets=1)


def assigned_table(root: str, buckets: int = BUCKETS) -> KeyedTable:
    """The cluster of each item, beside the feedback table, whose texts need not be rewritten for a new label."""
    return KeyedTable(f"{root}/assigned", schemas.ASSIGNED, ("feedback_id",), ("assigned_at", "cluster_id"), buckets=buckets)


def sync_ledger(ledger: KeyedTable, embeddings: DataFrame) -> int:
    """Bring the ledger in line with the embeddings; the number of items synced, whether they were new or not."""
    items = embeddings.select("feedback_id", F.col("created_at").alias("embedded_at"))
    return ledger.upsert(items).keys


def write_assignments(assigned: KeyedTable, assignments: DataFrame, now) -> Written:
    """Record (feedback_id, cluster_label) as of `now`; a later run wins over an earlier one."""
    return assigned.upsert(assignments.select(
        "feedback_id", F.col("cluster_label").alias("cluster_id"), F.to_timestamp_ntz(F.lit(str(now))).alias("assigned_at")))


def with_assigned(feedback: DataFrame, assigned: DataFrame) -> DataFrame:
    """The feedback rows with their cluster as assigned; the others keep theirs."""
    new = assigned.select("feedback_id", F.col("cluster_id").alias("_assigned"))
    return feedback.join(new, "feedback_id", "left").withColumn("cluster_id", F.coalesce("_assigned", "cluster_id")).select(*feedback.columns)
