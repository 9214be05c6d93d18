"""Cluster descriptions from their own words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.embed import words
from feedloom.operators.reports import first_per_group
from feedloom.session import cut


def cluster_terms(texts: DataFrame, k: int = 5, min_length: int = 1) -> DataFrame:
    """The k terms that set each cluster apart, by term frequency times log inverse cluster frequency.

    `texts` has (cluster_label, feedback_text).  Words are counted inside every map task
    first; what is shuffled is one row per (cluster, word).
    """
    tokens = texts.select("cluster_label", F.explode(words(F.col("feedback_text"))).alias("term")).filter(
        F.length("term") >= min_length
    )
    counts = cut(tokens.groupBy("cluster_label", "term").agg(F.count("*").alias("tf")))  # read three times below
    spread = counts.groupBy("term").agg(F.count("*").alias("df"))
    clusters = counts.agg(F.countDistinct("cluster_label")).scalar()
    scored = counts.join(spread, "term").withColumn(
        "score", F.col("tf") * F.log((clusters + 1) / (F.col("df") + 1))
    )
    return first_per_group(scored, "cluster_label", [F.desc(F.round("score", 6)), F.col("term")], k)


def describe_clusters(catalog: DataFrame, terms: DataFrame) -> DataFrame:
    """Catalogue rows described by their terms; the counted text stays where there are none."""
    named = terms.groupBy("cluster_label").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("rank", "term")))["term"], ", ").alias("_terms")
    )
    return catalog.join(named, "cluster_label", "left").withColumn(
        "cluster_description", F.coalesce("_terms", "cluster_description")
    ).drop("_terms").select(*catalog.columns)
