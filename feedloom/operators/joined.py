"""Joined views of feedback, clusters and tags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.times import moment


def feedback_with_clusters(feedback: DataFrame, clusters: DataFrame, since) -> DataFrame:
    """Feedback since a date with its cluster, biggest cluster first, then newest."""
    recent = feedback.filter(F.col("created_at") >= moment(since))
    info = clusters.select("cluster_id", "cluster_description", "record_count")
    return recent.join(info, "cluster_id").orderBy(F.desc("record_count"), F.desc("created_at"), "feedback_id")


def item_tags(tags: DataFrame, feedback: DataFrame, feedback_id: str) -> DataFrame:
    """The tags of one item with its text; the id filter reaches both scans."""
    text = feedback.filter(F.col("feedback_id") == feedback_id).select("feedback_id", "feedback_text")
    return tags.filter(F.col("feedback_id") == feedback_id).join(text, "feedback_id")


def tagged_feedback(tags: DataFrame, feedback: DataFrame, tag: str, min_confidence: float = 0.8) -> DataFrame:
    """Feedback carrying a tag with enough confidence, surest first."""
    hits = tags.filter((F.col("tag_name") == tag) & (F.col("confidence_score") >= min_confidence))
    return (
        hits.select("feedback_id", "confidence_score")
        .join(feedback.select("feedback_id", "feedback_text", "feedback_source"), "feedback_id")
        .orderBy(F.desc("confidence_score"), "feedback_id")
    )


def feedback_details(feedback: DataFrame, clusters: DataFrame, ids: DataFrame) -> DataFrame:
    """Rating, cluster and description of an id list."""
    wanted = feedback.select("feedback_id", "rating", "cluster_id", "created_at").join(
        ids.select("feedback_id"), "feedback_id", "left_semi"
    )
    return wanted.join(clusters.select("cluster_id", "cluster_description"), "cluster_id", "left")


def enrich(hits: DataFrame, feedback: DataFrame, clusters: DataFrame) -> DataFrame:
    """Search hits with the details of each item, where there are any.

    The details are cut down to the hits before they meet the clusters.
    """
    return hits.join(feedback_details(feedback, clusters, hits), "feedback_id", "left")


def tags_for_ids(tags: DataFrame, ids: DataFrame) -> DataFrame:
    """The tags of an id list."""
    return (
        tags.join(ids.select("feedback_id"), "feedback_id", "left_semi")
        .select("feedback_id", "tag_name", "confidence_score")
        .orderBy("feedback_id", F.desc("confidence_score"), "tag_name")
    )


def tag_pivot(tags: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per item, one column per tag holding its confidence.

    The names are given, so no extra pass collects them; (feedback_id, tag_name) is a
    key, so the maximum is the only value.
    """
    return tags.groupBy("feedback_id").pivot("tag_name", list(names)).agg(F.max("confidence_score"))


def feedback_tag_matrix(feedback: DataFrame, tags: DataFrame, names: Sequence[str]) -> DataFrame:
    """Feedback with its tag columns, null where a tag is absent."""
    return feedback.join(tag_pivot(tags, names), "feedback_id", "left")
