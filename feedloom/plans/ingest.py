"""The ingest job: select, embed, tag, and account for new feedback."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.times import last_days
from feedloom.operators.clean import new_feedback
from feedloom.operators.embed import hash_embeddings
from feedloom.operators.tagging import explode_tags, keyword_tags
from feedloom.operators.upsert import last_per_key, sync_ledger, upsert_embeddings, upsert_ledger, upsert_tags
from feedloom.session import cut
from feedloom.sources import keyed


def embed_rows(rows: DataFrame, dim: int) -> DataFrame:
    """Embedding records of selected feedback rows."""
    return hash_embeddings(rows, dim).select(
        "feedback_id", "vector", "model", F.col("feedback_source").alias("source"), "style", "feedback_text", "created_at")


def tag_rows(rows: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Tag records of selected feedback rows."""
    return explode_tags(keyword_tags(rows, rules))


def ingest_stats(rows: DataFrame, embedded: DataFrame, tags: DataFrame | None) -> DataFrame:
    """Records, embeddings, tags, rows without an embedding, and the date range."""
    counted = rows.select("feedback_id", "created_at").join(
        embedded.select("feedback_id", F.lit(1).alias("e")), "feedback_id", "left")
    if tags is not None:
        per_item = tags.groupBy("feedback_id").agg(F.count("*").alias("t"))
        counted = counted.join(per_item, "feedback_id", "left")
    else:
        counted = counted.withColumn("t", F.lit(None).cast("bigint"))
    return counted.agg(
        F.count("*").alias("total_records"),
        F.count("e").alias("embeddings_created"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("tags_created"),
        (F.count("*") - F.count("e")).alias("errors"),
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
    )


def due_rows(feedback: DataFrame, inventory: DataFrame, ledger: DataFrame | None, start=None, end=None, limit: int | None = None) -> DataFrame:
    """What a run works on: one row per id, not in the ledger, oldest first where there is a limit."""
    rows = new_feedback(feedback, inventory, ledger, start=start, end=end)
    # a product with two styles gives one row, the last by all columns; then the limit counts ids, oldest first
    rows = last_per_key(rows, ["feedback_id"], ["created_at", *(c for c in rows.columns if c not in ("feedback_id", "created_at"))])
    return rows if limit is None else rows.orderBy("created_at", "feedback_id").limit(limit)


@dataclass(frozen=True)
class Ingested:
    """What a run wrote, and its statistics."""

    synced: int | None
    embeddings: keyed.Written
    tags: keyed.Written | None
    ledger: keyed.Written
    stats: dict


def run_ingest(spark: SparkSession, root: str, feedback: DataFrame, inventory: DataFrame, rules: Sequence[tuple[str, str]], *, now,
               dim: int = 64, start=None, end=None, days_back: int | None = None, limit: int | None = None,
               embeddings_only: bool = False, skip_embedded: bool = False, buckets: int = keyed.BUCKETS) -> Ingested:
    """P1 on stored tables under `root`: embeddings, tags and ledger, each written by key.

    The ledger is written last.  A run that stops can be repeated: what it has written already is written as it is.  With
    `skip_embedded` the ledger is first brought in line with the embeddings, ids only.
    """
    if days_back is not None:
        start, end = last_days(now, days_back)
    stored, ledger, tags = keyed.embeddings_table(root, buckets), keyed.ledger_table(root, buckets), keyed.tags_table(root, buckets)
    synced = keyed.sync_ledger(ledger, stored.read(spark)) if skip_embedded else None
    known = ledger.read_for(feedback) if skip_embedded else None
    rows = cut(due_rows(feedback, inventory, known, start, end, limit))
    embedded = cut(embed_rows(rows, dim))
    tagged = None if embeddings_only else cut(tag_rows(rows, rules))
    items = embedded.select("feedback_id", F.to_timestamp_ntz(F.lit(str(now))).alias("embedded_at"))
    return Ingested(
        synced, stored.upsert(embedded), None if tagged is None else tags.upsert(tagged), ledger.upsert(items),
        ingest_stats(rows, embedded, tagged).head().asDict())


def ingest_job(feedback: DataFrame, inventory: DataFrame, embeddings: DataFrame, ledger: DataFrame, tags: DataFrame,
               rules: Sequence[tuple[str, str]], *, now, dim: int = 64, start=None, end=None, days_back: int | None = None,
               limit: int | None = None, embeddings_only: bool = False, skip_embedded: bool = False) -> dict[str, DataFrame]:
    """The tables after one run, beside the run's own rows and statistics.

    `days_back` overrides the dates.  With `skip_embedded` the ledger is first brought in line
    with the embeddings, then its ids are left out.  Write `embeddings` before `ledger`: a run
    that stops between the two is repaired by the next one.
    """
    if days_back is not None:
        start, end = last_days(now, days_back)
    if skip_embedded:
        ledger = cut(sync_ledger(ledger, embeddings))
    rows = cut(due_rows(feedback, inventory, ledger if skip_embedded else None, start, end, limit))
    embedded = cut(embed_rows(rows, dim))
    items = embedded.select("feedback_id", F.to_timestamp_ntz(F.lit(str(now))).alias("embedded_at"))
    tagged = None if embeddings_only else cut(tag_rows(rows, rules))
    return {
        "new_embeddings": embedded,
        "embeddings": upsert_embeddings(embeddings, embedded),
        "ledger": upsert_ledger(ledger, items),
        "tags": tags if tagged is None else upsert_tags(tags, tagged),
        "stats": ingest_stats(rows, embedded, tagged),
    }
