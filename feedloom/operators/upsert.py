"""Keyed writes: upsert, ledger sync, catalogue rows and assignment updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last one by `order`.

    `max_by` combines on the map side, so a key repeated in a third of the rows is reduced
    before the shuffle.
    """
    values = [c for c in rows.columns if c not in keys]
    if not values:
        return rows.dropDuplicates(list(keys))
    last = F.max_by(F.struct(*values), F.struct(*order)).alias("row")
    return rows.groupBy(*keys).agg(last).select(*keys, "row.*").select(*rows.columns)


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The target after inserting or replacing the rows of `changes` by key.

    Repeated keys in `changes` resolve to the last row by `order`.  Written back with the
    same input it gives the same table, so a failed write can simply run again.
    """
    keys = list(keys)
    latest = last_per_key(changes, keys, order)
    kept = target.join(latest.select(*keys), keys, "left_anti")
    return kept.select(*target.columns).unionByName(latest.select(*target.columns))


def upsert_embeddings(target: DataFrame, changes: DataFrame) -> DataFrame:
    """Replace every column of the embeddings with the same feedback_id."""
    return upsert(target, changes, ["feedback_id"], ["created_at", "model"])


def upsert_ledger(ledger: DataFrame, items: DataFrame) -> DataFrame:
    """Record embedded items, the latest time wins."""
    return upsert(ledger, items, ["feedback_id"], ["embedded_at"])


def sync_ledger(ledger: DataFrame, embeddings: DataFrame) -> DataFrame:
    """The ledger brought in line with what the embeddings table holds."""
    return upsert_ledger(ledger, embeddings.select("feedback_id", F.col("created_at").alias("embedded_at")))


def upsert_tags(target: DataFrame, changes: DataFrame) -> DataFrame:
    """Tags keyed by (feedback_id, tag_name)."""
    return upsert(target, changes, ["feedback_id", "tag_name"], ["created_at", "confidence_score"])


def upsert_clusters(target: DataFrame, changes: DataFrame) -> DataFrame:
    """Catalogue rows keyed by cluster_id; sample ids are stored comma-joined."""
    if dict(changes.dtypes)["sample_feedback_ids"].startswith("array"):
        changes = changes.withColumn("sample_feedback_ids", F.concat_ws(",", "sample_feedback_ids"))
    return upsert(target, changes, ["cluster_id"], ["created_at", "record_count"])


def apply_assignments(feedback: DataFrame, assignments: DataFrame, order: Sequence[str] = ("cluster_label",)) -> DataFrame:
    """Set `cluster_id` from (feedback_id, cluster_label); unmatched rows keep theirs.

    Repeated ids resolve to the last label by `order`.
    """
    new = last_per_key(assignments.select("feedback_id", "cluster_label", *(c for c in order if c != "cluster_label")), ["feedback_id"], order)
    new = new.select("feedback_id", F.col("cluster_label").alias("new_cluster_id"))
    return (
        feedback.join(new, "feedback_id", "left")
        .withColumn("cluster_id", F.coalesce("new_cluster_id", "cluster_id"))
        .drop("new_cluster_id")
        .select(*feedback.columns)
    )
