"""Sources, keyed writes, validation and filters: S*, V*, F*, J1, J2."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.canon import micro, r6, sql_micro, sql_ts, ts
from checks.twins import query
from feedloom.functions.times import in_period
from feedloom.operators import clean, upsert, validate
from feedloom.sources import readers

CLEAN_SQL = """f.created_at IS NOT NULL AND i.style IS NOT NULL AND f.feedback_source IS NOT NULL
  AND f.feedback_text IS NOT NULL AND trim(f.feedback_text, ' ') <> ''
  AND regexp_matches(f.feedback_text, '[A-Za-z0-9]')
  AND upper(trim(f.feedback_text, ' ')) NOT IN ('NA','N/A','N.A.','N.A','NOT APPLICABLE')"""
DAY1, DAY2 = "2024-01-01", "2024-01-02"
CORE = ["feedback_id", "feedback_source", "sku", "category", "rating", "cluster_id"]
CORE_SQL = "f.feedback_id, f.feedback_source, f.sku, f.category, f.rating, f.cluster_id"


@query("scan_feedback", "feedback", f"""
SELECT feedback_id, feedback_text AS text, feedback_source AS source, {sql_ts('created_at')} AS created_at,
  sku AS product_id, category, rating, cluster_id FROM feedback""")
def _(t):
    return readers.scan_feedback(t.feedback).withColumn("created_at", ts("created_at"))


@query("scan_embeddings", "fb_embeddings", f"""
SELECT feedback_id, {sql_micro('vector')} AS vector, source, style, {sql_ts('created_at')} AS created_at
FROM fb_embeddings WHERE source = 'review' AND created_at >= TIMESTAMP '2024-01-01'
  AND created_at < TIMESTAMP '2024-01-03'""")
def _(t):
    rows = readers.scan_embeddings(t.embeddings, DAY1, DAY2, "review")
    return rows.withColumn("vector", micro("vector")).withColumn("created_at", ts("created_at"))


@query("embedded_ids", "fb_embeddings", f"""
SELECT feedback_id, {sql_ts('created_at')} AS embedded_at FROM fb_embeddings""")
def _(t):
    return readers.embedded_ids(t.embeddings).withColumn("embedded_at", ts("embedded_at"))


@query("feedback_by_ids", "feedback inventory_info embedded_items", f"""
SELECT {CORE_SQL}, i.style FROM feedback f JOIN inventory_info i ON i.sku = f.sku
WHERE i.style IS NOT NULL AND f.feedback_id IN (SELECT feedback_id FROM embedded_items)""")
def _(t):
    return clean.feedback_by_ids(t.feedback, t.inventory, t.ledger).select(*CORE, "style")


@query("embeddings_by_ids", "fb_embeddings embedded_items", f"""
SELECT feedback_id, {sql_micro('vector')} AS vector, source, style FROM fb_embeddings
WHERE feedback_id IN (SELECT feedback_id FROM embedded_items)""")
def _(t):
    return readers.embeddings_by_ids(t.embeddings, t.ledger).withColumn("vector", micro("vector"))


@query("parse_vectors", "fb_embeddings", f"SELECT feedback_id, {sql_micro('vector')} AS vector FROM fb_embeddings")
def _(t):
    as_text = t.embeddings.select(
        "feedback_id", F.concat(F.lit("["), F.array_join(F.col("vector").cast("array<string>"), ", "), F.lit("]")).alias("vector")
    )
    return readers.with_parsed_vectors(as_text).withColumn("vector", micro("vector"))


# --- keyed writes: the target is one part of the table, the changes overlap it -----------

@query("upsert_embeddings", "fb_embeddings", f"""
SELECT feedback_id, CASE WHEN label >= 3 THEN 'v2' ELSE model END AS model, source, style,
  {sql_ts('created_at')} AS created_at, {sql_micro('vector')} AS vector FROM fb_embeddings""")
def _(t):
    target = t.embeddings.filter("label < 6").drop("label")
    changes = t.embeddings.filter("label >= 3").drop("label").withColumn("model", F.lit("v2"))
    repeated = changes.withColumn("model", F.lit("v1")).unionByName(changes)
    rows = upsert.upsert_embeddings(target, repeated)
    return rows.select("feedback_id", "model", "source", "style", ts("created_at"), micro("vector"))


@query("upsert_ledger", "fb_embeddings embedded_items", f"""
SELECT e.feedback_id, {sql_ts("CASE WHEN e.label >= 3 THEN e.created_at + INTERVAL 2 DAY ELSE e.created_at END")} AS embedded_at
FROM fb_embeddings e WHERE e.label < 6 OR e.label >= 3""")
def _(t):
    late = t.embeddings.filter("label >= 3")
    items = late.select("feedback_id", (F.col("created_at") + F.expr("INTERVAL 1 DAY")).alias("embedded_at")).unionByName(
        late.select("feedback_id", (F.col("created_at") + F.expr("INTERVAL 2 DAY")).alias("embedded_at"))
    )
    return upsert.upsert_ledger(t.ledger, items).withColumn("embedded_at", ts("embedded_at"))


@query("sync_ledger", "fb_embeddings", f"""
SELECT feedback_id, {sql_ts('created_at')} AS embedded_at FROM fb_embeddings""")
def _(t):
    return upsert.sync_ledger(t.ledger, t.embeddings).withColumn("embedded_at", ts("embedded_at"))


@query("upsert_tags", "tags", f"""
SELECT feedback_id, tag_name, round(CASE WHEN confidence_score >= 0.7 THEN 1.0 - confidence_score / 2 ELSE confidence_score END, 6)
  AS confidence_score, {sql_ts('created_at')} AS created_at FROM tags""")
def _(t):
    changes = t.tags.filter("confidence_score >= 0.7").withColumn("confidence_score", 1.0 - F.col("confidence_score") / 2)
    rows = upsert.upsert_tags(t.tags.filter("confidence_score < 0.9"), changes)
    return rows.select("feedback_id", "tag_name", r6("confidence_score"), ts("created_at"))


@query("upsert_clusters", "clusters assignments", """
WITH ids AS (SELECT cluster_label, string_agg(feedback_id, ',' ORDER BY created_at, feedback_id) AS ids
  FROM (SELECT *, row_number() OVER (PARTITION BY cluster_label ORDER BY created_at, feedback_id) AS rn FROM assignments)
  WHERE rn <= 50 GROUP BY cluster_label)
SELECT c.cluster_id, CASE WHEN c.cluster_depth >= 3 THEN i.ids ELSE 'old' END AS sample_feedback_ids,
  CAST(CASE WHEN c.cluster_depth >= 3 THEN c.record_count ELSE 0 END AS BIGINT) AS record_count,
  CAST(c.cluster_depth AS INTEGER) AS cluster_depth
FROM clusters c JOIN ids i USING (cluster_label)""")
def _(t):
    from feedloom.operators.reports import cluster_catalog

    now = "2024-02-01 00:00:00"
    fresh = cluster_catalog(t.assignments, now)
    old = fresh.withColumn("sample_feedback_ids", F.lit("old")).withColumn("record_count", F.lit(0).cast("bigint"))
    rows = upsert.upsert_clusters(old, fresh.filter("cluster_depth >= 3"))
    return rows.select("cluster_id", "sample_feedback_ids", "record_count", "cluster_depth")


@query("apply_assignments", "feedback assignments", """
SELECT f.feedback_id, COALESCE(CASE WHEN a.probability >= 0.5 THEN CONCAT(a.cluster_label, '.9') END, f.cluster_id) AS cluster_id
FROM feedback f LEFT JOIN assignments a USING (feedback_id)""")
def _(t):
    moved = t.assignments.filter("probability >= 0.5").withColumn("cluster_label", F.concat("cluster_label", F.lit(".9")))
    return upsert.apply_assignments(t.feedback, moved).select("feedback_id", "cluster_id")


# --- validation ---------------------------------------------------------------------

@query("validate_feedback", "feedback", """
SELECT feedback_id, feedback_text IS NOT NULL AS valid,
  CASE WHEN feedback_text IS NULL THEN 'missing feedback_text' ELSE '' END AS reason FROM feedback""")
def _(t):
    return validate.validate(t.feedback, "feedback").select("feedback_id", "valid", "reason")


@query("validate_vectors", "fb_embeddings", """
SELECT feedback_id, label >= 2 AS valid,
  CASE label WHEN 0 THEN 'wrong dimension' WHEN 1 THEN 'zero vector' ELSE '' END AS reason FROM fb_embeddings""")
def _(t):
    broken = t.embeddings.withColumn(
        "vector",
        F.when(F.col("label") == 0, F.slice("vector", 1, 40))
        .when(F.col("label") == 1, F.transform("vector", lambda x: F.lit(0.0).cast("float")))
        .otherwise(F.col("vector")),
    )
    return validate.validate(broken, "embedding", dim=64).select("feedback_id", "valid", "reason")


@query("validate_tags", "tags", """
SELECT feedback_id, tag_name, confidence_score <= 0.75 AS valid,
  CASE WHEN confidence_score > 0.75 THEN 'confidence out of range' ELSE '' END AS reason FROM tags""")
def _(t):
    shifted = t.tags.withColumn("confidence_score", F.col("confidence_score") + 0.25)
    return validate.validate(shifted, "tag").select("feedback_id", "tag_name", "valid", "reason")


# --- filters ------------------------------------------------------------------------

@query("feedback_with_style", "feedback inventory_info", f"""
SELECT {CORE_SQL}, i.style FROM feedback f JOIN inventory_info i ON i.sku = f.sku WHERE i.style IS NOT NULL""")
def _(t):
    return clean.with_style(t.feedback, t.inventory).select(*CORE, "style")


@query("clean_feedback", "feedback inventory_info", f"""
SELECT {CORE_SQL}, f.feedback_text, i.style FROM feedback f LEFT JOIN inventory_info i ON i.sku = f.sku WHERE {CLEAN_SQL}""")
def _(t):
    return clean.clean_feedback(clean.with_style(t.feedback, t.inventory)).select(*CORE, "feedback_text", "style")


@query("unembedded_feedback", "feedback inventory_info embedded_items", f"""
SELECT {CORE_SQL}, i.style FROM feedback f LEFT JOIN inventory_info i ON i.sku = f.sku
WHERE {CLEAN_SQL} AND f.feedback_id NOT IN (SELECT feedback_id FROM embedded_items)""")
def _(t):
    return clean.new_feedback(t.feedback, t.inventory, t.ledger).select(*CORE, "style")


@query("backlog_per_style", "feedback inventory_info embedded_items", f"""
SELECT i.style, COUNT(*) AS n_waiting, {sql_ts('MIN(f.created_at)')} AS oldest
FROM feedback f LEFT JOIN inventory_info i ON i.sku = f.sku
WHERE {CLEAN_SQL} AND f.feedback_id NOT IN (SELECT feedback_id FROM embedded_items)
GROUP BY i.style ORDER BY n_waiting DESC, i.style LIMIT 10""")
def backlog_per_style(t):
    waiting = clean.new_feedback(t.feedback, t.inventory, t.ledger)
    return (
        waiting.groupBy("style").agg(F.count("*").alias("n_waiting"), F.min("created_at").alias("oldest"))
        .orderBy(F.desc("n_waiting"), "style").limit(10).withColumn("oldest", ts("oldest"))
    )


@query("feedback_date_range", "feedback", f"""
SELECT {CORE_SQL} FROM feedback f WHERE created_at >= TIMESTAMP '2024-01-01 06:00:00' AND created_at <= TIMESTAMP '2024-01-02 18:00:00'""")
def _(t):
    return clean.in_date_range(t.feedback, "2024-01-01 06:00:00", "2024-01-02 18:00:00").select(*CORE)


@query("feedback_since", "feedback", f"""
SELECT {CORE_SQL} FROM feedback f WHERE created_at > (SELECT min(created_at) FROM feedback)
  AND created_at > TIMESTAMP '2024-01-01 12:00:00'""")
def _(t):
    return clean.since(t.feedback, "2024-01-01 12:00:00").select(*CORE)


@query("feedback_days_back", "feedback", f"""
SELECT {CORE_SQL} FROM feedback f WHERE created_at >= TIMESTAMP '2024-01-01 12:00:00' AND created_at <= TIMESTAMP '2024-01-03 12:00:00'""")
def _(t):
    return clean.days_back(t.feedback, "2024-01-03 12:00:00", 2).select(*CORE)


@query("date_bounds", "feedback", f"""
SELECT feedback_id, {sql_ts('created_at')} AS created_at,
  created_at < TIMESTAMP '2024-01-03' AS until_day2, created_at <= TIMESTAMP '2024-01-02' AS until_midnight,
  created_at >= TIMESTAMP '2024-01-02' AS from_day2, created_at >= TIMESTAMP '2024-01-02' AND created_at < TIMESTAMP '2024-01-03' AS on_day2
FROM feedback""")
def _(t):
    c = F.col("created_at")
    return t.feedback.select(
        "feedback_id", ts("created_at"),
        in_period(c, end=DAY2).alias("until_day2"),
        in_period(c, end=DAY2 + " 00:00:00").alias("until_midnight"),
        in_period(c, start=DAY2).alias("from_day2"),
        in_period(c, DAY2, DAY2).alias("on_day2"),
    )


@query("browse_clusters", "clusters", """
SELECT cluster_id, cluster_description, record_count, style, source, CAST(cluster_depth AS INTEGER) AS cluster_depth FROM clusters
WHERE period_start >= TIMESTAMP '2024-01-01' AND period_end <= TIMESTAMP '2024-02-01' AND style = 'Weekend'
  AND source = 'review' AND cluster_depth = 2""")
def _(t):
    rows = clean.browse_clusters(t.clusters, start="2024-01-01", end="2024-02-01", style="Weekend", source="review", depth=2)
    return rows.select("cluster_id", "cluster_description", "record_count", "style", "source", "cluster_depth")


@query("browse_feedback", "feedback inventory_info tags", f"""
SELECT DISTINCT {CORE_SQL}, i.style, {sql_ts('f.created_at')} AS created_at
FROM feedback f LEFT JOIN inventory_info i ON f.sku = i.sku JOIN tags t ON t.feedback_id = f.feedback_id
WHERE f.feedback_source = 'review' AND t.tag_name = 'Waterproof Leak' AND t.confidence_score >= 0.7
  AND f.created_at >= TIMESTAMP '2024-01-01' AND f.created_at < TIMESTAMP '2024-01-03'
ORDER BY created_at DESC, f.feedback_id LIMIT 100""")
def _(t):
    rows = clean.browse_feedback(t.feedback, t.inventory, t.tags, source="review", tag="Waterproof Leak",
                                 start=DAY1, end=DAY2, limit=100)
    return rows.select(*CORE, "style", ts("created_at"))


@query("cluster_feedback", "feedback assignments", f"""
WITH members AS (SELECT feedback_id FROM assignments WHERE cluster_label = 'source_chat.style_Everyday.2')
SELECT feedback_id, feedback_text, feedback_source, rating, {sql_ts('created_at')} AS created_at FROM feedback SEMI JOIN members USING (feedback_id)""")
def _(t):
    rows = clean.cluster_feedback(t.feedback, "source_chat.style_Everyday.2")
    return rows.select("feedback_id", "feedback_text", "feedback_source", "rating", ts("created_at"))


@query("style_hierarchy", "assignments", """
SELECT a.cluster_label AS cluster_id, CASE e.label WHEN 5 THEN 3 ELSE 2 END AS cluster_depth, 'Cluster containing ' || count(*) || ' feedback items' AS cluster_description,
  count(*) AS record_count FROM assignments a JOIN fb_embeddings e USING (feedback_id) WHERE e.label >= 5 AND e.style IS NOT NULL GROUP BY a.cluster_label, e.label""")
def _(t):
    return clean.style_hierarchy(t.clusters, "Everyday").select("cluster_id", "cluster_depth", "cluster_description", "record_count")


@query("top_level_clusters", "assignments", """
SELECT a.cluster_label AS cluster_id, 'Cluster containing ' || count(*) || ' feedback items' AS cluster_description, count(*) AS record_count, e.style, e.source
FROM assignments a JOIN fb_embeddings e USING (feedback_id) WHERE e.style IS NULL OR e.label NOT IN (0, 5) GROUP BY a.cluster_label, e.style, e.source""")
def _(t):
    return clean.top_level_clusters(t.clusters).select("cluster_id", "cluster_description", "record_count", "style", "source")


@query("normalize_text", "feedback", "SELECT feedback_id, lower(feedback_text) AS feedback_text FROM feedback")
def _(t):
    return clean.normalise_text(t.feedback).select("feedback_id", "feedback_text")


@query("noise_feedback", "assignments", """
SELECT feedback_id, source, style, cluster_label FROM assignments WHERE ends_with(cluster_label, '.noise')""")
def _(t):
    return clean.noise_rows(t.assignments).select("feedback_id", "source", "style", "cluster_label")


@query("negative_reviews", "feedback inventory_info", f"""
SELECT {CORE_SQL}, i.style FROM feedback f JOIN inventory_info i ON i.sku = f.sku WHERE i.style = 'PROMO' AND f.rating <= 2""")
def _(t):
    return clean.negative_reviews(t.feedback, t.inventory, "PROMO").select(*CORE, "style")
