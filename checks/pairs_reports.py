"""Joined views, aggregations, windows and reports: J*, A*, W*, P3."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.canon import joined, r6, sql_ts, ts
from checks.tables import TAXONOMY
from checks.twins import query
from feedloom.operators import joined as views
from feedloom.operators import reports as rep

NOW = "2024-02-01 00:00:00"

# The base tables again, for derivations that do not go through the derived views: items, and the divisors that give them tags.
ITEMS = """d AS (SELECT doc_id, text, lang, ts, ['review', 'return', 'chat'][doc_id % 3 + 1] AS source,
    CASE doc_id % 50 WHEN 7 THEN ' n/a ' WHEN 8 THEN '!!!' WHEN 9 THEN NULL WHEN 10 THEN '   ' ELSE text END AS feedback_text
  FROM documents JOIN events ON event_id = doc_id),
s AS (SELECT unnest(['Waterproof Leak', 'Too Heavy', 'Sizes not standard', 'Stains']) AS tag_name, unnest([4, 5, 6, 9]) AS m)"""
SCORE = "(50 + (doc_id * 13 + m) % 51) / 100.0::DOUBLE"
SIZED = "'Cluster containing ' || {0} || ' feedback items'"
SHALLOW = "NOT regexp_matches(cluster_label, '\\.[0-9]+\\.[0-9]+$')"  # labels of depth 2


# --- joins --------------------------------------------------------------------------

@query("feedback_with_clusters", "feedback", f"""
SELECT f.feedback_id, feedback_text, feedback_source, rating, {SIZED.format('n')} AS cluster_description, n AS record_count
FROM feedback f JOIN (SELECT feedback_id, count(*) OVER (PARTITION BY cluster_label) AS n FROM assignments) a USING (feedback_id)
WHERE f.created_at >= TIMESTAMP '2024-01-01 12:00:00'""")
def _(t):
    rows = views.feedback_with_clusters(t.feedback, t.clusters, "2024-01-01 12:00:00")
    return rows.select("feedback_id", "feedback_text", "feedback_source", "rating", "cluster_description", "record_count")


@query("item_tags", "", f"""
WITH {ITEMS} SELECT tag_name, {SCORE} AS confidence_score, text AS feedback_text FROM d, s WHERE doc_id = 180 AND 180 % m = 0""")
def _(t):
    return views.item_tags(t.tags, t.feedback, "180").select("tag_name", "confidence_score", "feedback_text")


@query("tagged_feedback", "", f"""
WITH {ITEMS}
SELECT CAST(doc_id AS VARCHAR) AS feedback_id, feedback_text, source AS feedback_source, {SCORE} AS confidence_score
FROM d, s WHERE m = 4 AND doc_id % 4 = 0 AND (doc_id * 13 + 4) % 51 >= 30""")
def _(t):
    return views.tagged_feedback(t.tags, t.feedback, "Waterproof Leak").select(
        "feedback_id", "feedback_text", "feedback_source", "confidence_score")


@query("feedback_details", "feedback clusters embedded_items", f"""
SELECT f.feedback_id, f.rating, f.cluster_id, {sql_ts('f.created_at')} AS created_at, c.cluster_description
FROM feedback f LEFT JOIN clusters c ON f.cluster_id = c.cluster_id
WHERE f.feedback_id IN (SELECT feedback_id FROM embedded_items)""")
def _(t):
    rows = views.feedback_details(t.feedback, t.clusters, t.ledger)
    return rows.select("feedback_id", "rating", "cluster_id", ts("created_at"), "cluster_description")


@query("tags_for_ids", "tags embedded_items", """
SELECT feedback_id, tag_name, confidence_score FROM tags WHERE feedback_id IN (SELECT feedback_id FROM embedded_items)""")
def _(t):
    return views.tags_for_ids(t.tags, t.ledger)


_PIVOT = ", ".join(f"""max(CASE WHEN tag_name = '{n}' THEN confidence_score END) AS "{n}\"""" for n in TAXONOMY)


@query("tag_pivot", "tags", f"SELECT feedback_id, {_PIVOT} FROM tags GROUP BY feedback_id")
def _(t):
    return views.tag_pivot(t.tags, TAXONOMY)


@query("feedback_tag_matrix", "feedback tags", f"""
WITH p AS (SELECT feedback_id, {_PIVOT} FROM tags GROUP BY feedback_id)
SELECT f.feedback_id, f.feedback_source, f.rating, p.* EXCLUDE (feedback_id) FROM feedback f LEFT JOIN p ON p.feedback_id = f.feedback_id""")
def _(t):
    return views.feedback_tag_matrix(t.feedback.select("feedback_id", "feedback_source", "rating"), t.tags, TAXONOMY)


# --- counts -------------------------------------------------------------------------

@query("count_by_source", "feedback", """
WITH n AS (SELECT feedback_source, count(cluster_id) AS count FROM feedback GROUP BY ALL) SELECT * FROM n WHERE count > 0""")
def _(t):
    return rep.count_by_source(t.feedback)


@query("tag_frequency", "", f"""
WITH {ITEMS} SELECT tag_name, count(*) AS count, round(avg({SCORE}), 6) AS avg_confidence FROM d JOIN s ON doc_id % m = 0 GROUP BY tag_name""")
def _(t):
    return rep.tag_frequency(t.tags).withColumn("avg_confidence", r6("avg_confidence"))


@query("cluster_tag_crosstab", "assignments", f"""
WITH {ITEMS}, a AS (SELECT CAST(feedback_id AS BIGINT) AS doc_id, cluster_label, count(*) OVER (PARTITION BY cluster_label) AS n FROM assignments)
SELECT cluster_label AS cluster_id, {SIZED.format('n')} AS cluster_description, tag_name, count(*) AS count
FROM a JOIN d USING (doc_id) JOIN s ON doc_id % m = 0 WHERE {SHALLOW} GROUP BY cluster_label, n, tag_name""")
def _(t):
    return rep.cluster_tag_crosstab(t.feedback, t.clusters, t.tags)


@query("clusters_by_style", "feedback clusters inventory_info", """
WITH sold AS (SELECT DISTINCT cluster_id, sku FROM feedback),
worn AS (SELECT DISTINCT cluster_id, style AS product_style FROM inventory_info NATURAL JOIN sold)
SELECT product_style, k.cluster_id, k.cluster_description, k.record_count
FROM worn, LATERAL (SELECT * FROM clusters WHERE clusters.cluster_id = worn.cluster_id AND len(string_split(cluster_label, '.')) = 3) k""")
def _(t):
    return rep.clusters_by_style(t.feedback, t.clusters, t.inventory)


@query("category_issues", "", f"""
WITH {ITEMS} SELECT lang AS category, tag_name, count(*) AS count FROM d JOIN s ON doc_id % m = 0 WHERE (doc_id * 13 + m) % 51 >= 20 GROUP BY lang, tag_name""")
def _(t):
    return rep.category_issues(t.feedback, t.tags)


@query("monthly_cluster_trend", "assignments", f"""
WITH a AS (SELECT *, count(*) OVER (PARTITION BY cluster_label) AS n FROM assignments)
SELECT strftime(created_at, '%Y-%m') AS month, {SIZED.format('n')} AS cluster_description, count(*) AS count FROM a
WHERE {SHALLOW} AND CAST(feedback_id AS BIGINT) IN (SELECT doc_id FROM documents) GROUP BY month, n""")
def _(t):
    return rep.monthly_cluster_trend(t.feedback, t.clusters)


@query("weekly_tag_trend", "", f"""
WITH {ITEMS}, w AS (SELECT *, make_date(year(ts), 1, 1) AS first FROM d JOIN s ON doc_id % m = 0)
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(1 + date_diff('day', first - CAST(dayofweek(first) AS INTEGER), CAST(ts AS DATE)) // 7 AS INTEGER) AS week,
  tag_name, count(*) AS count FROM w GROUP BY ALL""")
def _(t):
    return rep.weekly_tag_trend(t.feedback, t.tags)


@query("label_counts", "assignments", "SELECT cluster_label, COUNT(*) AS count FROM assignments GROUP BY cluster_label")
def _(t):
    return rep.label_counts(t.assignments)


@query("style_counts", "fb_embeddings", "SELECT style, COUNT(*) AS count FROM fb_embeddings WHERE style IS NOT NULL GROUP BY style")
def _(t):
    return rep.label_counts(t.embeddings, "style")


@query("partition_sizes", "fb_embeddings", """
SELECT source, style, COUNT(*) AS n_points FROM fb_embeddings WHERE style IS NOT NULL GROUP BY source, style""")
def _(t):
    return rep.partition_sizes(t.embeddings)


DEPTH_SQL = "CAST(LENGTH({0}) - LENGTH(REPLACE({0}, '.', '')) AS INTEGER)"


@query("cluster_stats", "assignments", f"""
SELECT a.cluster_label, a.feedback_id, s.count, s.depth FROM assignments a JOIN (
  SELECT cluster_label, COUNT(*) AS count, {DEPTH_SQL.format('cluster_label')} AS depth FROM assignments GROUP BY cluster_label) s
USING (cluster_label)""")
def _(t):
    return rep.cluster_members(t.assignments)


@query("cluster_totals", "assignments", """
SELECT COUNT(*) AS total_records, COUNT(DISTINCT cluster_label) AS n_clusters FROM assignments""")
def _(t):
    return rep.cluster_totals(t.assignments)


@query("cluster_catalog", "assignments", f"""
WITH s AS (SELECT *, row_number() OVER (PARTITION BY cluster_label ORDER BY created_at, feedback_id) AS rn FROM assignments)
SELECT cluster_label AS cluster_id, cluster_label, 'Cluster containing ' || COUNT(*) || ' feedback items' AS cluster_description,
  string_agg(CASE WHEN rn <= 50 THEN feedback_id END, ',' ORDER BY rn) AS sample_feedback_ids, COUNT(*) AS record_count,
  '2024-01-01 00:00:00.000000' AS period_start, '2024-02-01 00:00:00.000000' AS period_end,
  split_part(split_part(cluster_label, 'source_', 2), '.', 1) AS source,
  split_part(split_part(cluster_label, '.style_', 2), '.', 1) AS style, {DEPTH_SQL.format('cluster_label')} AS cluster_depth
FROM s GROUP BY cluster_label""")
def _(t):
    rows = rep.cluster_catalog(t.assignments, NOW, start="2024-01-01 00:00:00")
    return rows.select("cluster_id", "cluster_label", "cluster_description", joined("sample_feedback_ids", sep=","), "record_count",
                       ts("period_start"), ts("period_end"), "source", "style", "cluster_depth")


@query("breakdown_by_source", "assignments", """
SELECT source, COUNT(DISTINCT cluster_label) AS n_clusters, COUNT(*) AS n_reviews FROM assignments GROUP BY source""")
def _(t):
    return rep.breakdown_by_source(t.assignments)


@query("breakdown_by_style", "assignments", """
SELECT style, COUNT(DISTINCT cluster_label) AS n_clusters, COUNT(*) AS n_reviews FROM assignments WHERE style IS NOT NULL GROUP BY style""")
def _(t):
    return rep.breakdown_by_style(t.assignments)


@query("breakdown_by_depth", "assignments", f"""
SELECT {DEPTH_SQL.format('cluster_label')} AS cluster_depth, COUNT(DISTINCT cluster_label) AS n_clusters, COUNT(*) AS n_reviews
FROM assignments GROUP BY 1""")
def _(t):
    return rep.breakdown_by_depth(t.assignments)


@query("cluster_content", "assignments feedback", """
WITH a AS (SELECT a.cluster_label, f.feedback_text,
    row_number() OVER (PARTITION BY a.cluster_label ORDER BY f.created_at, f.feedback_id) AS rn
  FROM assignments a JOIN feedback f ON f.feedback_id = a.feedback_id),
s AS (SELECT cluster_label, string_agg(feedback_text, '|' ORDER BY rn) AS samples, COUNT(feedback_text) AS n
  FROM (SELECT * FROM a WHERE rn <= 10) GROUP BY cluster_label),
c AS (SELECT source, style, cluster_label, COUNT(*) AS size FROM assignments GROUP BY ALL),
m AS (SELECT cluster_label, CAST(COUNT(*) AS INTEGER) AS sample_count FROM a WHERE rn <= 10 GROUP BY cluster_label)
SELECT c.source, c.style, c.cluster_label, c.size, round(c.size * 100.0 / sum(c.size) OVER (PARTITION BY c.source, c.style), 6) AS percentage,
  s.samples, COALESCE(m.sample_count, 0) AS sample_count
FROM c LEFT JOIN s USING (cluster_label) LEFT JOIN m USING (cluster_label)""")
def _(t):
    rows = rep.cluster_content(t.assignments, t.feedback)
    return rows.select("source", "style", "cluster_label", "size", r6("percentage"), joined("samples"), "sample_count")


@query("cluster_samples_wide", "assignments feedback", """
WITH a AS (SELECT a.cluster_label, f.feedback_text,
    row_number() OVER (PARTITION BY a.cluster_label ORDER BY f.created_at, f.feedback_id) AS rn
  FROM assignments a JOIN feedback f ON f.feedback_id = a.feedback_id),
c AS (SELECT cluster_label, COUNT(*) AS count FROM assignments GROUP BY cluster_label)
SELECT c.cluster_label, c.count,
  COALESCE(max(CASE WHEN rn = 1 THEN feedback_text END), '') AS sample_1,
  COALESCE(max(CASE WHEN rn = 2 THEN feedback_text END), '') AS sample_2,
  COALESCE(max(CASE WHEN rn = 3 THEN feedback_text END), '') AS sample_3
FROM c LEFT JOIN a USING (cluster_label) GROUP BY c.cluster_label, c.count""")
def _(t):
    return rep.cluster_samples_wide(t.assignments, t.feedback)


@query("cluster_size_stats", "assignments", """
WITH s AS (SELECT source, style, cluster_label, COUNT(*) AS n FROM assignments
  WHERE NOT ends_with(cluster_label, '.noise') GROUP BY ALL)
SELECT source, style, round(max(n) / CAST(sum(n) AS DOUBLE), 6) AS largest_cluster_ratio, min(n) AS smallest_cluster_size,
  round(avg(n), 6) AS mean_cluster_size, round(stddev_samp(n), 6) AS cluster_size_std FROM s GROUP BY source, style""")
def _(t):
    return rep.cluster_size_stats(t.assignments).select(
        "source", "style", r6("largest_cluster_ratio"), "smallest_cluster_size", r6("mean_cluster_size"), r6("cluster_size_std"))


@query("hierarchy_rollup", "assignments", f"""
WITH RECURSIVE up AS (
  SELECT feedback_id, cluster_label AS label FROM assignments
  UNION ALL
  SELECT feedback_id, regexp_replace(label, '\\.[^.]*$', '') FROM up WHERE {DEPTH_SQL.format('label')} > 1)
SELECT label, COUNT(*) AS count, {DEPTH_SQL.format('label')} AS depth FROM up GROUP BY label""")
def _(t):
    return rep.hierarchy_rollup(t.assignments)


# --- tags ---------------------------------------------------------------------------

_LISTS = """SELECT f.feedback_id, CASE WHEN COUNT(t.tag_name) = 0 THEN ['Uncategorized'] ELSE list(t.tag_name ORDER BY t.tag_name) END AS tags
  FROM feedback f LEFT JOIN tags t ON t.feedback_id = f.feedback_id GROUP BY f.feedback_id"""


def tag_lists(t):
    per_item = t.tags.groupBy("feedback_id").agg(F.sort_array(F.collect_list("tag_name")).alias("tags"))
    return t.feedback.select("feedback_id").join(per_item, "feedback_id", "left").withColumn(
        "tags", F.coalesce("tags", F.array(F.lit("Uncategorized"))))


@query("category_distribution", "feedback tags", f"""
WITH l AS ({_LISTS}), x AS (SELECT unnest(tags) AS tag FROM l)
SELECT CASE WHEN tag IN ('Waterproof Leak', 'Sizes not standard', 'Stains') THEN tag ELSE 'Uncategorized' END AS category,
  COUNT(*) AS count FROM x GROUP BY 1""")
def _(t):
    return rep.category_distribution(tag_lists(t), ["Waterproof Leak", "Sizes not standard", "Stains"])


@query("multi_tag_stats", "feedback tags", f"""
WITH l AS ({_LISTS})
SELECT COUNT(*) AS total_feedback, round(AVG(len(tags)), 6) AS avg_tags_per_feedback, CAST(MAX(len(tags)) AS INTEGER) AS max_tags_single_feedback,
  COUNT(*) FILTER (len(tags) = 1) AS single_tag_count, COUNT(*) FILTER (len(tags) > 1) AS multi_tag_count,
  COUNT(*) FILTER (tags = ['Uncategorized']) AS no_tag_count FROM l""")
def _(t):
    return rep.multi_tag_stats(tag_lists(t)).withColumn("avg_tags_per_feedback", r6("avg_tags_per_feedback"))


@query("tag_share", "feedback tags inventory_info", """
SELECT f.feedback_source, i.style, COUNT(*) AS total, COUNT(t.feedback_id) AS tagged, round(COUNT(t.feedback_id) * 100.0 / COUNT(*), 6) AS percentage
FROM feedback f JOIN inventory_info i ON i.sku = f.sku LEFT JOIN tags t ON t.feedback_id = f.feedback_id AND t.tag_name = 'Sizes not standard'
WHERE i.style IS NOT NULL GROUP BY f.feedback_source, i.style""")
def _(t):
    return rep.tag_share(t.feedback, t.tags, t.inventory, "Sizes not standard").withColumn("percentage", r6("percentage"))


@query("one_star_styles", "feedback inventory_info", """
SELECT i.style, COUNT(*) AS one_star FROM feedback f JOIN inventory_info i ON i.sku = f.sku
WHERE f.rating = 1 AND i.style IS NOT NULL GROUP BY i.style ORDER BY one_star DESC, i.style LIMIT 1""")
def _(t):
    return rep.one_star_styles(t.feedback, t.inventory)


@query("tag_by_source", "feedback tags", """
SELECT t.tag_name, COUNT(*) FILTER (f.feedback_source = 'review') AS review, COUNT(*) FILTER (f.feedback_source = 'return') AS "return"
FROM tags t JOIN feedback f ON f.feedback_id = t.feedback_id GROUP BY t.tag_name""")
def _(t):
    return rep.tag_by_source(t.feedback, t.tags, ["review", "return"])


@query("top_issue_per_style", "feedback tags inventory_info", """
WITH c AS (SELECT i.style, t.tag_name, COUNT(*) AS count FROM tags t JOIN feedback f ON f.feedback_id = t.feedback_id
  JOIN inventory_info i ON i.sku = f.sku WHERE i.style IS NOT NULL GROUP BY ALL)
SELECT style, tag_name, count, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY style ORDER BY count DESC, tag_name) AS rank FROM c) WHERE rank <= 2""")
def _(t):
    return rep.top_issue_per_style(t.feedback, t.tags, t.inventory, k=2)


@query("complaints_by_category", "feedback tags", """
SELECT f.category, COUNT(DISTINCT f.feedback_id) AS n_feedback, COUNT(DISTINCT t.feedback_id) AS n_tagged, COUNT(t.feedback_id) AS n_tags
FROM feedback f LEFT JOIN tags t ON t.feedback_id = f.feedback_id GROUP BY f.category""")
def _(t):
    return rep.complaints_by_category(t.feedback, t.tags)


# --- headers and top-k ----------------------------------------------------------------

@query("clusters_summary", "clusters", """
SELECT CAST(SUM(record_count) AS BIGINT) AS total_items, COUNT(DISTINCT style) AS n_styles, COUNT(DISTINCT source) AS n_sources,
  CAST(MAX(cluster_depth) AS INTEGER) AS max_depth FROM clusters""")
def _(t):
    return rep.clusters_summary(t.clusters)


_HEADER = f"""COUNT(*) AS count, {sql_ts('MIN(created_at)')} AS first_at, {sql_ts('MAX(created_at)')} AS last_at,
  round(AVG(rating), 6) AS avg_rating FROM feedback"""


@query("feedback_summary", "feedback", f"""
SELECT feedback_source, {_HEADER} GROUP BY feedback_source UNION ALL SELECT 'all' AS feedback_source, {_HEADER}""")
def _(t):
    rows = rep.feedback_summary(t.feedback).unionByName(
        rep.feedback_header(t.feedback).withColumn("feedback_source", F.lit("all")))
    return rows.select("feedback_source", "count", ts("first_at"), ts("last_at"), r6("avg_rating"))


@query("cluster_samples", "assignments feedback", """
SELECT feedback_id, cluster_label, CAST(rank AS INTEGER) AS rank FROM (
  SELECT a.feedback_id, a.cluster_label, row_number() OVER (PARTITION BY a.cluster_label ORDER BY f.created_at, f.feedback_id) AS rank
  FROM assignments a JOIN feedback f ON f.feedback_id = a.feedback_id) WHERE rank <= 10""")
def _(t):
    return rep.cluster_samples(t.assignments, t.feedback, 10).select("feedback_id", "cluster_label", "rank")


@query("latest_samples", "feedback clusters", """
WITH top AS (SELECT cluster_id, record_count FROM clusters ORDER BY record_count DESC, cluster_id LIMIT 5)
SELECT cluster_id, record_count, feedback_id, feedback_source, rating, CAST(rank AS INTEGER) AS rank FROM (
  SELECT f.*, t.record_count, row_number() OVER (PARTITION BY f.cluster_id ORDER BY f.created_at DESC, f.feedback_id) AS rank
  FROM feedback f JOIN top t ON t.cluster_id = f.cluster_id) WHERE rank <= 5""")
def _(t):
    return rep.latest_samples(t.feedback, t.clusters).select("cluster_id", "record_count", "feedback_id", "feedback_source", "rating", "rank")


@query("top_clusters", "clusters", """
SELECT c.cluster_id, c.cluster_description, c.record_count, c.style, c.source FROM clusters c
WHERE (SELECT count(*) FROM clusters o WHERE (-o.record_count, o.cluster_id) < (-c.record_count, c.cluster_id)) < 10""")
def _(t):
    return rep.top_clusters(t.clusters).select("cluster_id", "cluster_description", "record_count", "style", "source")


@query("top_labels", "assignments", """
SELECT cluster_label, COUNT(*) AS count, round(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM assignments), 6) AS percentage
FROM assignments GROUP BY cluster_label ORDER BY count DESC, cluster_label LIMIT 10""")
def _(t):
    return rep.top_labels(t.assignments).withColumn("percentage", r6("percentage"))


@query("feedback_limit", "feedback", """
SELECT feedback_id, feedback_source, rating FROM feedback WHERE created_at >= TIMESTAMP '2024-01-01' ORDER BY created_at, feedback_id LIMIT 100""")
def _(t):
    return rep.first_feedback(t.feedback, 100, start="2024-01-01").select("feedback_id", "feedback_source", "rating")


@query("request_batches", "feedback", """
WITH r AS (SELECT feedback_id, CAST(CAST(feedback_id AS BIGINT) % 8 AS INTEGER) AS shard, created_at FROM feedback),
n AS (SELECT feedback_id, shard, row_number() OVER (PARTITION BY shard ORDER BY created_at, feedback_id) - 1 AS rn FROM r)
SELECT feedback_id, shard, CAST(rn // 10 AS INTEGER) AS batch, CAST(rn % 10 + 1 AS INTEGER) AS position FROM n""")
def _(t):
    rows = rep.request_batches(t.feedback, 10, F.col("feedback_id").cast("bigint") % 8)
    return rows.select("feedback_id", "shard", "batch", "position")


@query("numbered_batches", "feedback", """
SELECT feedback_id, (row_number() OVER o - 1) // 10 AS batch, CAST((row_number() OVER o - 1) % 10 + 1 AS INTEGER) AS position
FROM feedback WINDOW o AS (ORDER BY created_at NULLS FIRST, feedback_id)""")
def _(t):
    return rep.numbered_batches(t.feedback, 10).select("feedback_id", "batch", "position")


@query("summary_report", "assignments", f"""
WITH d AS (SELECT *, CAST({DEPTH_SQL.format('cluster_label')} AS VARCHAR) AS depth FROM assignments),
total AS (SELECT 'total' AS section, 'all' AS item, COUNT(DISTINCT cluster_label) AS clusters, COUNT(*) AS reviews FROM d),
parts AS (
  SELECT * FROM total
  UNION ALL SELECT 'source', source, COUNT(DISTINCT cluster_label), COUNT(*) FROM d WHERE source IS NOT NULL GROUP BY source
  UNION ALL SELECT 'style', style, COUNT(DISTINCT cluster_label), COUNT(*) FROM d WHERE style IS NOT NULL GROUP BY style
  UNION ALL SELECT 'depth', depth, COUNT(DISTINCT cluster_label), COUNT(*) FROM d GROUP BY depth),
top AS (SELECT cluster_label, COUNT(*) AS n FROM d GROUP BY cluster_label ORDER BY n DESC, cluster_label LIMIT 10)
SELECT section, item, 'clusters' AS metric, CAST(clusters AS DOUBLE) AS value FROM parts
UNION ALL SELECT section, item, 'reviews', CAST(reviews AS DOUBLE) FROM parts
UNION ALL SELECT 'top', cluster_label, 'reviews', CAST(n AS DOUBLE) FROM top""")
def _(t):
    return rep.summary_report(t.assignments)
