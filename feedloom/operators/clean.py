"""Feedback selection: text quality, style lookup, ledger, periods and browsing filters (F*, J1, J2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import has_content, normalised
from feedloom.functions.times import in_period, last_days, moment


def with_style(feedback: DataFrame, inventory: DataFrame) -> DataFrame:
    """Add the style; rows without a styled product drop out.

    The size of `inventory` is left to the planner: it is broadcast when its
    statistics, or the shuffled size seen at run time, are below the session's limit.
    """
    styled = inventory.filter(F.col("style").isNotNull()).select("sku", "style")
    return feedback.join(styled, "sku", "inner")


def with_optional_style(feedback: DataFrame, inventory: DataFrame) -> DataFrame:
    """Like `with_style`, but rows without a styled product stay."""
    return feedback.join(inventory.select("sku", "style"), "sku", "left")


def clean_feedback(styled: DataFrame) -> DataFrame:
    """rows with a time, a style, a source and a text worth analysing."""
    return styled.filter(
        F.col("created_at").isNotNull()
        & F.col("style").isNotNull()
        & F.col("feedback_source").isNotNull()
        & has_content(F.col("feedback_text"))
    )


def not_embedded(feedback: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows whose id is not in the ledger."""
    return feedback.join(ledger.select("feedback_id"), "feedback_id", "left_anti")


def feedback_by_ids(feedback: DataFrame, inventory: DataFrame, ids: DataFrame) -> DataFrame:
    """The styled rows of an id list; the semi join runs first and keeps few rows."""
    return with_style(feedback.join(ids.select("feedback_id"), "feedback_id", "left_semi"), inventory)


def in_date_range(feedback: DataFrame, start=None, end=None) -> DataFrame:
    """Inclusive period, either bound optional, plain dates mean whole days."""
    return feedback.filter(in_period(F.col("created_at"), start, end))


def since(feedback: DataFrame, mark) -> DataFrame:
    """strictly after a high-water mark."""
    return feedback.filter(F.col("created_at") > moment(mark))


def days_back(feedback: DataFrame, now, days: int) -> DataFrame:
    """the last `days` days before `now`, both ends included."""
    return in_date_range(feedback, *last_days(now, days))


def new_feedback(feedback: DataFrame, inventory: DataFrame, ledger: DataFrame | None = None, *,
                 start=None, end=None, after=None, limit: int | None = None) -> DataFrame:
    """The ingest input: period, style, quality and, with a ledger, only rows not embedded yet.

    Filters on the feedback columns come before both joins.  A limit takes the oldest rows
    first, so that repeated limited runs walk through the backlog.
    """
    rows = in_date_range(feedback, start, end)
    if after is not None:
        rows = since(rows, after)
    rows = clean_feedback(with_style(rows, inventory))
    if ledger is not None:
        rows = not_embedded(rows, ledger)
    if limit is not None:
        rows = rows.orderBy("created_at", "feedback_id").limit(limit)
    return rows


def normalise_text(feedback: DataFrame) -> DataFrame:
    """lower-case text, the form that is embedded."""
    return feedback.withColumn("feedback_text", normalised(F.col("feedback_text")))


def noise_rows(assignments: DataFrame) -> DataFrame:
    """rows assigned to a noise label."""
    return assignments.filter(F.endswith(F.col("cluster_label"), F.lit(".noise")))


def browse_clusters(clusters: DataFrame, *, start=None, end=None, style: str | None = None,
                    source: str | None = None, depth: int | None = None) -> DataFrame:
    """catalogue rows by period, style, source and depth, largest first."""
    rows = clusters
    if start is not None:
        rows = rows.filter(F.col("period_start") >= moment(start))
    if end is not None:
        rows = rows.filter(F.col("period_end") <= moment(end))
    for name, value in (("style", style), ("source", source), ("cluster_depth", depth)):
        if value is not None:
            rows = rows.filter(F.col(name) == value)
    return rows.orderBy(F.desc("record_count"), "cluster_id")


def browse_feedback(feedback: DataFrame, inventory: DataFrame, tags: DataFrame | None = None, *,
                    cluster_id: str | None = None, source: str | None = None, style: str | None = None,
                    tag: str | None = None, min_confidence: float = 0.7, start=None, end=None,
                    limit: int | None = None) -> DataFrame:
    """Filtered feedback, newest first; only the first `limit` rows if that is asked for.

    The tag condition is a semi join, so a row never repeats and no DISTINCT over
    the texts is needed.
    """
    rows = feedback
    if cluster_id is not None:
        rows = rows.filter(F.col("cluster_id") == cluster_id)
    if source is not None:
        rows = rows.filter(F.col("feedback_source") == source)
    rows = in_date_range(rows, start, end)
    if tag is not None:
        tagged = tags.filter((F.col("tag_name") == tag) & (F.col("confidence_score") >= min_confidence))
        rows = rows.join(tagged.select("feedback_id"), "feedback_id", "left_semi")
    styles = inventory.select("sku", "style").distinct()
    if style is not None:
        rows = rows.join(styles.filter(F.col("style") == style), "sku", "inner")
    else:
        rows = rows.join(styles, "sku", "left")
    rows = rows.orderBy(F.desc("created_at"), "feedback_id")
    return rows.limit(limit) if limit else rows


def cluster_feedback(feedback: DataFrame, cluster_id: str) -> DataFrame:
    """F8: the rows of one cluster, newest first."""
    return feedback.filter(F.col("cluster_id") == cluster_id).orderBy(F.desc("created_at"), "feedback_id")


def style_hierarchy(clusters: DataFrame, style: str) -> DataFrame:
    """the clusters of one style by depth, then size."""
    return clusters.filter(F.col("style") == style).orderBy("cluster_depth", F.desc("record_count"), "cluster_id")


def top_level_clusters(clusters: DataFrame, depth: int = 2) -> DataFrame:
    """the clusters right below the slices (depth counts dots, so 2), by size."""
    return clusters.filter(F.col("cluster_depth") == depth).orderBy(F.desc("record_count"), "cluster_id")


def negative_reviews(feedback: DataFrame, inventory: DataFrame, style: str, worst: int = 2) -> DataFrame:
    """the low-rated rows of one style."""
    low = feedback.filter(F.col("rating") <= worst)
    return low.join(inventory.filter(F.col("style") == style).select("sku", "style"), "sku", "inner")
