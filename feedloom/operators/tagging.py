"""Tagging: reading model answers, keyword rules, tag rows and the taxonomy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import responses
from feedloom.functions.responses import UNCATEGORIZED
from feedloom.functions.text import numbered_block

# The default taxonomy, in its order of priority.
DEFAULT_CATEGORIES = [
    "Waterproof Leak", "Upper Knit Separation", "Insole Issue", "Inner Lining Rip", "Glue Gap",
    "Discolouration", "Sizes not standard", "Toe Area too narrow", "Toe area too big", "Instep too small",
    "instep too high", "shoe too narrow", "shoe too wide", "half size requests", "no heel lock/heel slip",
    "Lack of grip/traction", "Squeaky sound", "Not breathable enough", "hard to take off", "hard to put on",
    "Lack of support", "Heel Cup - too big", "Smelly", "Back Heel Rubbing", "Warping", "Stains",
    "Looks different than picture/ ugly/ not what was expected", "blisters", "Too Bulky", "Too Heavy",
]


def taxonomy_table(spark, names: Sequence[str] = DEFAULT_CATEGORIES) -> DataFrame:
    """The taxonomy as a table (category, priority)."""
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "category string, priority int")


def edit_taxonomy(taxonomy: DataFrame, add: DataFrame | None = None, remove: DataFrame | None = None) -> DataFrame:
    """A new taxonomy with categories removed and added; the given one stays as it is.

    Added names rank behind the present ones, in their own order; a name already present is
    not added again.
    """
    kept = taxonomy
    if remove is not None:
        kept = kept.join(remove.select("category"), "category", "left_anti")
    if add is not None:
        last = kept.agg(F.coalesce(F.max("priority"), F.lit(-1))).scalar()
        new = add.groupBy("category").agg(F.min("priority").alias("priority")).join(
            kept.select("category"), "category", "left_anti"
        )
        kept = kept.unionByName(new.select("category", (F.col("priority") + 1 + last).cast("int").alias("priority")))
    return kept


def parse_tag_responses(df: DataFrame, taxonomy: Sequence[str], column: str = "response") -> DataFrame:
    """The tags of each answer as an array, never empty."""
    return df.withColumn("tags", responses.multi_tags(F.col(column), taxonomy))


def parse_single_tags(df: DataFrame, taxonomy: Sequence[str], column: str = "response") -> DataFrame:
    """The one tag of each answer."""
    return df.withColumn("tag", responses.single_tag(F.col(column), taxonomy))


def parse_batch_responses(items: DataFrame, answers: DataFrame, taxonomy: Sequence[str],
                          fallback: Column | None = None, allow_multiple: bool = True) -> DataFrame:
    """Tags of every item from the answer of its batch.

    `items` has (shard, batch, position) beside its own columns, `answers` has (shard, batch,
    response).  The key of a row is its batch and position, so no order is relied on.
    `fallback` gives the tags of an item whose batch answer cannot be read.
    """
    rows = items.join(answers.select("shard", "batch", "response"), ["shard", "batch"], "left")
    none = F.array(F.lit(UNCATEGORIZED))
    tags = responses.batch_tags(F.col("response"), F.col("position"), taxonomy, none if fallback is None else fallback, allow_multiple)
    return rows.withColumn("tags", tags).drop("response")


def build_prompts(batches: DataFrame, width: int | None = None) -> DataFrame:
    """One numbered block of whole texts per batch, or of texts cut to `width`; a batch has a fixed number of rows."""
    in_order = F.sort_array(F.collect_list(F.struct("position", "feedback_text")))
    return batches.groupBy("shard", "batch").agg(
        numbered_block(in_order["feedback_text"], width).alias("block"), F.count("*").alias("n_items")
    )


def keyword_tags(df: DataFrame, rules: Sequence[tuple[str, str]], allow_multiple: bool = True,
                 column: str = "feedback_text") -> DataFrame:
    """T4: tags by text patterns, in the order of the rules, else Uncategorized.

    Each pattern is its own `rlike` on a literal, so it is compiled once per task and the
    whole text is searched inside the scan stage.
    """
    low = F.lower(F.coalesce(F.col(column), F.lit("")))
    hits = F.array_distinct(
        F.array_compact(F.array(*[F.when(low.rlike(pattern), F.lit(category)) for category, pattern in rules]))
    )
    tags = F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit(UNCATEGORIZED)))
    return df.withColumn("tags", tags if allow_multiple else F.slice(tags, 1, 1))


def explode_tags(tag_lists: DataFrame) -> DataFrame:
    """One row per tag with full confidence and the time of its feedback."""
    return tag_lists.select(
        "feedback_id",
        F.explode(F.array_distinct("tags")).alias("tag_name"),
        F.lit(1.0).alias("confidence_score"),
        "created_at",
    )


def apply_failure_policy(tag_lists: DataFrame, error: Column, policy: str) -> DataFrame:
    """What happens to the rows of a failed batch.

    `fail` stops the job and names the batch, `default` tags the rows Uncategorized,
    `quarantine` leaves them out (write them with sources.sinks.quarantine).
    """
    failed = error.isNotNull()
    if policy == "default":
        return tag_lists.withColumn("tags", F.when(failed, F.array(F.lit(UNCATEGORIZED))).otherwise(F.col("tags")))
    if policy == "quarantine":
        return tag_lists.filter(~failed)
    if policy == "fail":
        message = F.concat(F.lit("batch "), F.col("batch").cast("string"), F.lit(" failed: "), error)
        return tag_lists.withColumn("tags", F.when(failed, F.raise_error(message)).otherwise(F.col("tags")))
    raise ValueError(f"unknown policy {policy!r}: fail, default or quarantine")
