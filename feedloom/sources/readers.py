"""Readers with fixed schemas (S1-S6) for Parquet folders and JDBC tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.times import in_period
from feedloom.functions.vectors import parsed


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table with its declared schema; no footer inference, no data pass."""
    return spark.read.schema(schema).parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              bounds: tuple[str, str] | None = None, partitions: int = 1, **options: str) -> DataFrame:
    """A relational table; with a partition column the scan runs as `partitions` range queries."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1],
            numPartitions=str(partitions),
        )
    return reader.load()


def scan_feedback(feedback: DataFrame) -> DataFrame:
    """Typed projection with the names the later stages use."""
    return feedback.select(
        "feedback_id",
        F.col("feedback_text").alias("text"),
        F.col("feedback_source").alias("source"),
        "created_at",
        F.col("sku").alias("product_id"),
        "category",
        "rating",
        "cluster_id",
    )


def scan_embeddings(embeddings: DataFrame, start=None, end=None, source: str | None = None) -> DataFrame:
    """Embeddings with an optional source and period; both filters reach the scan."""
    kept = embeddings
    if source is not None:
        kept = kept.filter(F.col("source") == source)
    if start is not None or end is not None:
        kept = kept.filter(in_period(F.col("created_at"), start, end))
    return kept.select("feedback_id", "vector", "source", "style", "created_at")


def embedded_ids(embeddings: DataFrame) -> DataFrame:
    """S3: what has been embedded, and when."""
    return embeddings.select("feedback_id", F.col("created_at").alias("embedded_at"))


def embeddings_by_ids(embeddings: DataFrame, ids: DataFrame) -> DataFrame:
    """The embeddings whose id occurs in `ids`."""
    return embeddings.join(ids.select("feedback_id"), "feedback_id", "left_semi").select(
        "feedback_id", "vector", "source", "style"
    )


def with_parsed_vectors(df: DataFrame, column: str = "vector") -> DataFrame:
    """Vectors stored as text become arrays; arrays pass through."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return df.withColumn(column, parsed(F.col(column)))
    return df.withColumn(column, F.col(column).cast("array<float>"))
