"""Report tables: counts, cross-tabs, trends and top-k (A*, W*).

Where a cluster catalogue or inventory joins in, the feedback side is counted per key
first, so the join moves one row per key instead of one per feedback item.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.labels import label_ancestors, label_depth, label_source, label_style
from feedloom.functions.responses import UNCATEGORIZED
from feedloom.functions.times import in_period, moment, week_of_year, year_month
from feedloom.operators.numbering import ranked


# --- counts -----------------------------------------------------------------

def count_by_source(feedback: DataFrame) -> DataFrame:
    """A1: clustered feedback per source."""
    rows = feedback.filter(F.col("cluster_id").isNotNull())
    return rows.groupBy("feedback_source").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "feedback_source")


def tag_frequency(tags: DataFrame) -> DataFrame:
    """A2: rows and mean confidence per tag."""
    return tags.groupBy("tag_name").agg(
        F.count("*").alias("count"), F.avg("confidence_score").alias("avg_confidence")
    ).orderBy(F.desc("count"), "tag_name")


def _at_depth(clusters: DataFrame, depth: int) -> DataFrame:
    return clusters.filter(F.col("cluster_depth") == depth)


def cluster_tag_crosstab(feedback: DataFrame, clusters: DataFrame, tags: DataFrame, depth: int = 2) -> DataFrame:
    """A3: tags per cluster at one depth."""
    members = feedback.select("feedback_id", "cluster_id").filter(F.col("cluster_id").isNotNull())
    counts = members.join(tags.select("feedback_id", "tag_name"), "feedback_id").groupBy(
        "cluster_id", "tag_name"
    ).agg(F.count("*").alias("count"))
    info = _at_depth(clusters, depth).select("cluster_id", "cluster_description")
    return counts.join(info, "cluster_id").orderBy("cluster_id", F.desc("count"), "tag_name")


def clusters_by_style(feedback: DataFrame, clusters: DataFrame, inventory: DataFrame, depth: int = 2) -> DataFrame:
    """A4: which clusters occur among the products of each style."""
    pairs = feedback.filter(F.col("cluster_id").isNotNull()).select("sku", "cluster_id").distinct()
    pairs = pairs.join(inventory.select("sku", F.col("style").alias("product_style")), "sku")
    info = _at_depth(clusters, depth).select("cluster_id", "cluster_description", "record_count")
    return pairs.select("product_style", "cluster_id").distinct().join(info, "cluster_id").orderBy(
        "product_style", F.desc("record_count"), "cluster_id"
    )


def category_issues(feedback: DataFrame, tags: DataFrame, min_confidence: float = 0.7) -> DataFrame:
    """A5: sure tags per product category."""
    sure = tags.filter(F.col("confidence_score") >= min_confidence).select("feedback_id", "tag_name")
    return sure.join(feedback.select("feedback_id", "category"), "feedback_id").groupBy("category", "tag_name").agg(
        F.count("*").alias("count")
    ).orderBy("category", F.desc("count"), "tag_name")


def monthly_cluster_trend(feedback: DataFrame, clusters: DataFrame, depth: int = 2) -> DataFrame:
    """Feedback per month and cluster description."""
    counts = feedback.filter(F.col("cluster_id").isNotNull()).groupBy(
        year_month(F.col("created_at")).alias("month"), "cluster_id"
    ).agg(F.count("*").alias("n"))
    info = _at_depth(clusters, depth).select("cluster_id", "cluster_description")
    return counts.join(info, "cluster_id").groupBy("month", "cluster_description").agg(
        F.sum("n").alias("count")
    ).orderBy("month", F.desc("count"), "cluster_description")


def weekly_tag_trend(feedback: DataFrame, tags: DataFrame) -> DataFrame:
    """Tags per calendar week of the feedback; weeks start on Sunday, week 1 holds January 1."""
    weeks = feedback.select(
        "feedback_id",
        F.year("created_at").alias("year"),
        week_of_year(F.col("created_at")).alias("week"),
    )
    return tags.select("feedback_id", "tag_name").join(weeks, "feedback_id").groupBy("year", "week", "tag_name").agg(
        F.count("*").alias("count")
    ).orderBy("year", "week", F.desc("count"), "tag_name")


def label_counts(df: DataFrame, column: str = "cluster_label") -> DataFrame:
    """Rows per value, nulls left out."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count")).orderBy(
        F.desc("count"), column
    )


def partition_sizes(embeddings: DataFrame) -> DataFrame:
    """The (source, style) slices and their sizes; a null style is not a slice."""
    return embeddings.filter(F.col("source").isNotNull() & F.col("style").isNotNull()).groupBy(
        "source", "style"
    ).agg(F.count("*").alias("n_points"))


# --- cluster catalogue and contents -------------------------------------------

def cluster_stats(assignments: DataFrame) -> DataFrame:
    """A8 without the id list: size and depth per label (the ids are the assignment table itself)."""
    return assignments.groupBy("cluster_label").agg(F.count("*").alias("count")).withColumn(
        "depth", label_depth(F.col("cluster_label"))
    )


def cluster_members(assignments: DataFrame) -> DataFrame:
    """A8 with the ids: one row per member, sorted inside its label, beside the label's size.

    A label may hold a third of all rows, so the ids are rows and not one array.
    """
    return assignments.select("cluster_label", "feedback_id").join(cluster_stats(assignments), "cluster_label")


def cluster_totals(assignments: DataFrame) -> DataFrame:
    """A8, whole run: records and distinct labels."""
    per_label = assignments.groupBy("cluster_label").agg(F.count("*").alias("n"))
    return per_label.agg(F.sum("n").alias("total_records"), F.count("*").alias("n_clusters"))


def first_per_group(df: DataFrame, group: str, order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group by an explicit order, with their rank.

    `row_number() <= k` is pruned to k rows per group inside every map task before the
    shuffle, so a hot group sends k rows per task and not all its rows.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def cluster_samples(assignments: DataFrame, feedback: DataFrame, k: int = 50) -> DataFrame:
    """The k earliest rows of each cluster."""
    rows = assignments.select("feedback_id", "cluster_label").join(
        feedback.select("feedback_id", "created_at"), "feedback_id"
    )
    return first_per_group(rows, "cluster_label", [F.col("created_at"), F.col("feedback_id")], k)


def sample_ids(assignments: DataFrame, k: int = 50) -> DataFrame:
    """Up to k ids per label, as one array of bounded length."""
    picked = first_per_group(
        assignments.select("cluster_label", "feedback_id", "created_at"),
        "cluster_label", [F.col("created_at"), F.col("feedback_id")], k,
    )
    ordered = F.sort_array(F.collect_list(F.struct("rank", "feedback_id")))
    return picked.groupBy("cluster_label").agg(ordered["feedback_id"].alias("sample_feedback_ids"))


def cluster_catalog(assignments: DataFrame, now, start=None, end=None, k: int = 50) -> DataFrame:
    """One catalogue row per label, with the fields read back from the label itself.

    `assignments` carries feedback_id, created_at and cluster_label.  The period defaults
    to `now`, a parameter.
    """
    label = F.col("cluster_label")
    counts = assignments.groupBy("cluster_label").agg(F.count("*").alias("record_count"))
    return counts.join(sample_ids(assignments, k), "cluster_label").select(
        label.alias("cluster_id"),
        "cluster_label",
        F.format_string("Cluster containing %d feedback items", F.col("record_count")).alias("cluster_description"),
        "sample_feedback_ids",
        "record_count",
        moment(start if start is not None else now).alias("period_start"),
        moment(end if end is not None else now).alias("period_end"),
        moment(now).alias("created_at"),
        label_style(label).alias("style"),
        label_source(label).alias("source"),
        label_depth(label).alias("cluster_depth"),
    )


def cluster_content(assignments: DataFrame, feedback: DataFrame, k: int = 10) -> DataFrame:
    """Size, share of all rows of the slice and up to k sample texts per label."""
    sizes = assignments.groupBy("source", "style", "cluster_label").agg(F.count("*").alias("size"))
    total = F.sum("size").over(Window.partitionBy("source", "style"))
    sizes = sizes.withColumn("percentage", F.col("size") * 100.0 / total)
    picked = cluster_samples(assignments, feedback, k).join(
        feedback.select("feedback_id", "feedback_text"), "feedback_id"
    )
    samples = picked.groupBy("cluster_label").agg(
        F.sort_array(F.collect_list(F.struct("rank", "feedback_text")))["feedback_text"].alias("samples")
    )
    return sizes.join(samples, "cluster_label", "left").withColumn(
        "sample_count", F.coalesce(F.size("samples"), F.lit(0))
    )


def cluster_samples_wide(assignments: DataFrame, feedback: DataFrame, columns: int = 3) -> DataFrame:
    """Size and the first sample texts side by side, empty text where there is none."""
    counts = assignments.groupBy("cluster_label").agg(F.count("*").alias("count"))
    picked = cluster_samples(assignments, feedback, columns).join(
        feedback.select("feedback_id", "feedback_text"), "feedback_id"
    )
    wide = picked.groupBy("cluster_label").agg(
        *[F.max(F.when(F.col("rank") == i, F.col("feedback_text"))).alias(f"sample_{i}") for i in range(1, columns + 1)]
    )
    return counts.join(wide, "cluster_label", "left").fillna("", [f"sample_{i}" for i in range(1, columns + 1)])


def latest_samples(feedback: DataFrame, clusters: DataFrame, top: int = 5, k: int = 5) -> DataFrame:
    """The k newest rows of each of the `top` biggest clusters, in one query."""
    biggest = top_clusters(clusters, top).select("cluster_id", "record_count")
    rows = feedback.select("feedback_id", "cluster_id", "feedback_source", "rating", "created_at").join(
        F.broadcast(biggest), "cluster_id"  # `top` rows at most
    )
    return first_per_group(rows, "cluster_id", [F.desc("created_at"), F.col("feedback_id")], k)


def top_clusters(clusters: DataFrame, k: int = 10) -> DataFrame:
    """The k biggest clusters of a catalogue."""
    return clusters.orderBy(F.desc("record_count"), "cluster_id").limit(k)


def top_labels(assignments: DataFrame, k: int = 10) -> DataFrame:
    """W3 over assignments: the k biggest labels with their share of all rows."""
    counts = assignments.groupBy("cluster_label").agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.orderBy(F.desc("count"), "cluster_label").limit(k).withColumn(
        "percentage", F.col("count") * 100.0 / total
    )


# --- breakdowns ---------------------------------------------------------------

def _breakdown(assignments: DataFrame, key: str) -> DataFrame:
    per_label = assignments.filter(F.col(key).isNotNull()).groupBy(key, "cluster_label").agg(F.count("*").alias("n"))
    return per_label.groupBy(key).agg(F.count("*").alias("n_clusters"), F.sum("n").alias("n_reviews"))


def breakdown_by_source(assignments: DataFrame) -> DataFrame:
    """A10: clusters and reviews per source."""
    return _breakdown(assignments, "source")


def breakdown_by_style(assignments: DataFrame) -> DataFrame:
    """Clusters and reviews per style."""
    return _breakdown(assignments, "style")


def breakdown_by_depth(assignments: DataFrame) -> DataFrame:
    """Clusters and reviews per label depth."""
    return _breakdown(assignments.withColumn("cluster_depth", label_depth(F.col("cluster_label"))), "cluster_depth")


def cluster_size_stats(assignments: DataFrame) -> DataFrame:
    """Per slice, the largest share and the spread of cluster sizes, noise left out."""
    sizes = assignments.filter(~F.endswith(F.col("cluster_label"), F.lit(".noise"))).groupBy(
        "source", "style", "cluster_label"
    ).agg(F.count("*").alias("n"))
    return sizes.groupBy("source", "style").agg(
        (F.max("n") / F.sum("n")).alias("largest_cluster_ratio"),
        F.min("n").alias("smallest_cluster_size"),
        F.avg("n").alias("mean_cluster_size"),
        F.stddev_samp("n").alias("cluster_size_std"),
    )


def hierarchy_rollup(assignments: DataFrame) -> DataFrame:
    """Rows under every label and under every ancestor of a label.

    Rows are counted per label first; only the label counts are multiplied.
    """
    counts = assignments.groupBy("cluster_label").agg(F.count("*").alias("n"))
    prefixes = counts.select(F.explode(label_ancestors(F.col("cluster_label"))).alias("label"), "n")
    return prefixes.groupBy("label").agg(F.sum("n").alias("count")).withColumn("depth", label_depth(F.col("label")))


# --- tags ---------------------------------------------------------------------

def category_distribution(tag_lists: DataFrame, taxonomy: Sequence[str], column: str = "tags") -> DataFrame:
    """Rows per taxonomy name; a name outside the taxonomy counts as Uncategorized."""
    name = F.when(F.col("tag").isin(*taxonomy), F.col("tag")).otherwise(F.lit(UNCATEGORIZED))
    return tag_lists.select(F.explode(column).alias("tag")).groupBy(name.alias("category")).agg(
        F.count("*").alias("count")
    ).orderBy(F.desc("count"), "category")


def multi_tag_stats(tag_lists: DataFrame, column: str = "tags") -> DataFrame:
    """How many tags the rows carry.  A row of only Uncategorized counts as single and as none."""
    n = F.size(column)
    none = F.col(column) == F.array(F.lit(UNCATEGORIZED))
    return tag_lists.agg(
        F.count("*").alias("total_feedback"),
        F.coalesce(F.avg(n), F.lit(0.0)).alias("avg_tags_per_feedback"),
        F.coalesce(F.max(n), F.lit(0)).alias("max_tags_single_feedback"),
        F.count_if(n == 1).alias("single_tag_count"),
        F.count_if(n > 1).alias("multi_tag_count"),
        F.count_if(none).alias("no_tag_count"),
    )


def tag_share(feedback: DataFrame, tags: DataFrame, inventory: DataFrame, tag: str) -> DataFrame:
    """Percentage of each (source, style) slice that carries a tag."""
    tagged = tags.filter(F.col("tag_name") == tag).select("feedback_id", F.lit(1).alias("hit"))
    styled = inventory.filter(F.col("style").isNotNull())
    rows = feedback.select("feedback_id", "feedback_source", "sku").join(styled, "sku").join(tagged, "feedback_id", "left")
    return rows.groupBy("feedback_source", "style").agg(
        F.count("*").alias("total"),
        F.count("hit").alias("tagged"),
        (F.count("hit") * 100.0 / F.count("*")).alias("percentage"),
    )


def one_star_styles(feedback: DataFrame, inventory: DataFrame, k: int = 1) -> DataFrame:
    """The styles with most one-star reviews."""
    per_sku = feedback.filter(F.col("rating") == 1).groupBy("sku").agg(F.count("*").alias("n"))
    styled = inventory.filter(F.col("style").isNotNull())
    return per_sku.join(styled, "sku").groupBy("style").agg(F.sum("n").alias("one_star")).orderBy(
        F.desc("one_star"), "style"
    ).limit(k)


def tag_by_source(feedback: DataFrame, tags: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Tag counts side by side for the given sources."""
    rows = tags.select("feedback_id", "tag_name").join(feedback.select("feedback_id", "feedback_source"), "feedback_id")
    wide = rows.groupBy("tag_name").pivot("feedback_source", list(sources)).agg(F.count("feedback_id"))
    return wide.fillna(0, list(sources))


def top_issue_per_style(feedback: DataFrame, tags: DataFrame, inventory: DataFrame, k: int = 1) -> DataFrame:
    """The k most frequent tags of each style."""
    per_sku = tags.select("feedback_id", "tag_name").join(feedback.select("feedback_id", "sku"), "feedback_id").groupBy(
        "sku", "tag_name"
    ).agg(F.count("*").alias("n"))
    styled = inventory.filter(F.col("style").isNotNull())
    counts = per_sku.join(styled, "sku").groupBy("style", "tag_name").agg(F.sum("n").alias("count"))
    return first_per_group(counts, "style", [F.desc("count"), F.col("tag_name")], k)


def complaints_by_category(feedback: DataFrame, tags: DataFrame) -> DataFrame:
    """Feedback rows, rows with a tag and tag rows per product category."""
    per_item = tags.groupBy("feedback_id").agg(F.count("*").alias("n_tags"))
    return feedback.select("feedback_id", "category").join(per_item, "feedback_id", "left").groupBy("category").agg(
        F.count("*").alias("n_feedback"),
        F.count("n_tags").alias("n_tagged"),
        F.coalesce(F.sum("n_tags"), F.lit(0)).alias("n_tags"),
    )


# --- headers ------------------------------------------------------------------

def clusters_summary(clusters: DataFrame) -> DataFrame:
    """Items, styles, sources and greatest depth of a catalogue."""
    return clusters.agg(
        F.sum("record_count").alias("total_items"),
        F.countDistinct("style").alias("n_styles"),
        F.countDistinct("source").alias("n_sources"),
        F.max("cluster_depth").alias("max_depth"),
    )


def feedback_summary(feedback: DataFrame) -> DataFrame:
    """Rows per source beside the date range and mean rating of that source."""
    return feedback.groupBy("feedback_source").agg(
        F.count("*").alias("count"),
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
        F.avg("rating").alias("avg_rating"),
    )


def feedback_header(feedback: DataFrame) -> DataFrame:
    """A18, whole selection: rows, date range and mean rating without the missing ones."""
    return feedback.agg(
        F.count("*").alias("count"),
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
        F.avg("rating").alias("avg_rating"),
    )


def first_feedback(feedback: DataFrame, n: int, start=None, end=None) -> DataFrame:
    """N rows, the oldest first, so that the same rows come back every time."""
    return feedback.filter(in_period(F.col("created_at"), start, end)).orderBy("created_at", "feedback_id").limit(n)


def hash_shard(shards: int) -> Column:
    """An even spread of the rows over `shards` numbers."""
    return F.pmod(F.xxhash64("feedback_id"), F.lit(shards))


def request_batches(df: DataFrame, size: int, shard: Column) -> DataFrame:
    """Consecutive numbering into batches of `size` inside each shard.

    The shard is part of the batch key, so numbering runs in parallel; take enough shards
    for the table, e.g. `hash_shard(n)` with about one per hundred thousand rows.
    """
    sharded = df.withColumn("shard", shard.cast("int"))
    rank = F.row_number().over(Window.partitionBy("shard").orderBy("created_at", "feedback_id")) - 1
    return sharded.withColumn("batch", F.floor(rank / size).cast("int")).withColumn(
        "position", (rank % size + 1).cast("int")
    )


def numbered_batches(df: DataFrame, size: int) -> DataFrame:
    """Batches of `size` consecutive rows of the whole table, oldest first, whatever its size; no shard to choose.

    Numbers are given range by range, see `numbering.ranked`, on ids and times only.  `feedback_id` is unique; rows without a time
    come first.  Adds `batch` (from 0) and `position` (from 1).
    """
    keys = df.select("feedback_id", "created_at", F.lit(0).alias("_all"))
    numbered = ranked(keys, ["_all"], ["created_at", "feedback_id"], "_n").select(
        "feedback_id", F.floor((F.col("_n") - 1) / size).alias("batch"), ((F.col("_n") - 1) % size + 1).cast("int").alias("position"))
    return df.join(numbered, "feedback_id")


def summary_report(assignments: DataFrame, quality: DataFrame | None = None, k: int = 10) -> DataFrame:
    """The whole report as one long table (section, item, metric, value).

    Every section derives from the counts per (source, style, label), a small table.
    """
    counts = assignments.groupBy("source", "style", "cluster_label").agg(F.count("*").alias("n"))
    counts = counts.withColumn("cluster_depth", label_depth(F.col("cluster_label")).cast("string"))

    def section(name: str, key: str) -> DataFrame:
        stats = counts.filter(F.col(key).isNotNull()).groupBy(key, "cluster_label").agg(F.sum("n").alias("n")).groupBy(
            key
        ).agg(F.count("*").alias("clusters"), F.sum("n").alias("reviews"))
        return _long(stats, name, F.col(key), ["clusters", "reviews"])

    totals = counts.agg(F.sum("n").alias("reviews"), F.countDistinct("cluster_label").alias("clusters"))
    top = counts.groupBy("cluster_label").agg(F.sum("n").alias("reviews")).orderBy(
        F.desc("reviews"), "cluster_label"
    ).limit(k)
    report = _long(totals, "total", F.lit("all"), ["clusters", "reviews"])
    for name, key in (("source", "source"), ("style", "style"), ("depth", "cluster_depth")):
        report = report.unionByName(section(name, key))
    report = report.unionByName(_long(top, "top", F.col("cluster_label"), ["reviews"]))
    if quality is not None:
        metrics = ["n_points", "n_clusters", "trustworthiness", "mean_persistence", "mean_probability", "noise_ratio"]
        report = report.unionByName(_long(quality, "quality", F.col("parent_label"), metrics))
    return report


def _long(df: DataFrame, section: str, item: Column, metrics: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return df.select(F.lit(section).alias("section"), item.alias("item"), F.explode(pairs).alias("m")).select(
        "section", "item", "m.metric", "m.value"
    ).filter(F.col("value").isNotNull())
