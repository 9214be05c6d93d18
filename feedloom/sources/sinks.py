"""Sinks: CSV export, quarantine and partitioned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def export_csv(df: DataFrame, folder: str) -> None:
    """CSV part files with a header; arrays become comma-joined text.

    Quotes are doubled and line breaks stay inside quoted fields, so that texts
    survive the round trip (read back with multiLine).
    """
    flat = [
        F.array_join(F.col(f.name).cast("array<string>"), ",").alias(f.name)
        if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(folder)


def split_failures(df: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """Rows without and rows with an error; the error text travels with its row's key."""
    marked = df.withColumn("error", error)
    return marked.filter(F.col("error").isNull()).drop("error"), marked.filter(F.col("error").isNotNull())


def quarantine(failed: DataFrame, folder: str) -> None:
    """Append the failed rows, keys and error included, to the dead-letter folder."""
    failed.write.mode("append").parquet(folder)


def write_embeddings(df: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """Embeddings laid out by source, so that a source filter prunes whole folders."""
    df.write.mode(mode).partitionBy("source").parquet(folder)
