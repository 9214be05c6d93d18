"""The feedback tables, derived by Spark from the given test tables.

One view per table of the data model; see FIXTURES.md.  The DuckDB twins are in
checks/twins.py and are written independently.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TAXONOMY = ["Waterproof Leak", "Sizes not standard", "Too Heavy", "Stains"]
TAG_STEPS = [("Waterproof Leak", 4), ("Sizes not standard", 6), ("Too Heavy", 5), ("Stains", 9)]


# Declared, so that reading a table needs no pass over its footers.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "benchmark": "item_id bigint, text string",
}


def _source(key: str):
    k = F.col(key) % 3
    return F.when(k == 0, "review").when(k == 1, "return").otherwise("chat")


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events").select("event_id", F.col("ts").alias("created_at"))

    @cached_property
    def inventory(self) -> DataFrame:
        style = F.when(F.col("p_partkey") % 10 != 9, F.col("p_type"))
        return self.raw("part").select(F.col("p_partkey").cast("string").alias("sku"), style.alias("style"))

    @cached_property
    def embeddings(self) -> DataFrame:
        style = F.when(F.col("vec_id") % 20 == 19, None).when(F.col("label") < 5, "Weekend").otherwise("Everyday")
        rows = self.raw("embeddings").join(self.events, F.col("vec_id") == F.col("event_id"))
        return rows.select(
            F.col("vec_id").cast("string").alias("feedback_id"),
            F.col("embedding").alias("vector"),
            F.lit("hash-64").alias("model"),
            _source("vec_id").alias("source"),
            style.alias("style"),
            "created_at",
            "label",
        )

    @cached_property
    def planted(self) -> DataFrame:
        """The vectors with ten well separated blobs planted along the axes."""
        near = F.transform(
            F.col("vector").cast("array<double>"),
            lambda x, i: x * 0.2 + F.when(i == F.col("label"), 1.0).otherwise(0.0),
        )
        return self.embeddings.withColumn("vector", near)

    @cached_property
    def ledger(self) -> DataFrame:
        """What was embedded so far: the vectors of the lower labels."""
        done = self.embeddings.filter(F.col("label") < 6)
        return done.select("feedback_id", F.col("created_at").alias("embedded_at"))

    @cached_property
    def assignments(self) -> DataFrame:
        e = self.embeddings
        rid = F.col("feedback_id").cast("bigint")
        tail = (
            F.when(F.col("style").isNull(), ".unclustered")
            .when(F.col("label") == 9, ".noise")
            .when(F.col("label") % 5 == 0, F.concat(F.lit(".0."), (rid % 2).cast("string")))
            .otherwise(F.concat(F.lit("."), (F.col("label") % 5).cast("string")))
        )
        head = F.concat(F.lit("source_"), F.col("source"), F.lit(".style_"), F.coalesce("style", F.lit("none")))
        sure = F.when(F.col("label") == 9, 0.0).otherwise(0.3 + (rid % 8) / 10.0)
        return e.select(
            "feedback_id", "source", "style", F.concat(head, tail).alias("cluster_label"),
            sure.alias("probability"), "created_at",
        )

    @cached_property
    def feedback(self) -> DataFrame:
        k = F.col("doc_id") % 50
        text = F.when(k == 7, " n/a ").when(k == 8, "!!!").when(k == 9, None).when(k == 10, "   ").otherwise(F.col("text"))
        rating = F.when(F.col("doc_id") % 3 == 0, (1 + (F.col("doc_id") * 11) % 5).cast("int"))
        rows = self.raw("documents").join(self.events, F.col("doc_id") == F.col("event_id")).select(
            F.col("doc_id").cast("string").alias("feedback_id"),
            text.alias("feedback_text"),
            _source("doc_id").alias("feedback_source"),
            "created_at",
            ((F.col("doc_id") * 7) % 200).cast("string").alias("sku"),
            F.col("lang").alias("category"),
            rating.alias("rating"),
        )
        clusters = self.assignments.select("feedback_id", F.col("cluster_label").alias("cluster_id"))
        return rows.join(clusters, "feedback_id", "left")

    @cached_property
    def tags(self) -> DataFrame:
        steps = F.array(*[F.struct(F.lit(n).alias("tag_name"), F.lit(m).alias("m")) for n, m in TAG_STEPS])
        due = F.filter(steps, lambda s: F.col("doc_id") % s["m"] == 0)
        rows = self.raw("documents").select("doc_id", F.explode(due).alias("t"))
        score = (50 + (F.col("doc_id") * 13 + F.col("t.m")) % 51).cast("double") / 100
        return rows.join(self.events, F.col("doc_id") == F.col("event_id")).select(
            F.col("doc_id").cast("string").alias("feedback_id"), F.col("t.tag_name").alias("tag_name"),
            score.alias("confidence_score"), "created_at",
        )

    @cached_property
    def clusters(self) -> DataFrame:
        counts = self.assignments.groupBy("cluster_label", "source", "style").agg(F.count("*").alias("record_count"))
        return counts.select(
            F.col("cluster_label").alias("cluster_id"),
            "cluster_label",
            F.format_string("Cluster containing %d feedback items", F.col("record_count")).alias("cluster_description"),
            "record_count", "source", "style",
            (F.size(F.split("cluster_label", r"\.")) - 1).alias("cluster_depth"),
            F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'").alias("period_start"),
            F.expr("TIMESTAMP_NTZ '2024-01-31 00:00:00'").alias("period_end"),
        )

    @cached_property
    def responses(self) -> DataFrame:
        """Model answers, one case per branch of the reader."""
        k = F.col("doc_id") % 8
        answer = (
            F.when(k == 0, '["Waterproof Leak", "Too Heavy"]')
            .when(k == 1, '```json\n["Stains"]\n```')
            .when(k == 2, 'Sure: ["Too Heavy", "Nope"] hope it helps')
            .when(k == 3, "It sounds like too heavy and STAINS")
            .when(k == 4, "[]")
            .when(k == 5, '"waterproof leak"')
            .when(k == 6, '{"1": ["Stains"]}')
            .otherwise("nothing here")
        )
        return self.raw("documents").select(F.col("doc_id").cast("string").alias("feedback_id"), answer.alias("response"))
