"""Labels, answers, keyword tags and embeddings: X*, T*, C22."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.canon import joined, micro, r6, sql_micro, sql_ts, ts
from checks.tables import TAXONOMY
from checks.twins import query
from feedloom.functions import labels
from feedloom.operators import embed, reports, tagging, terms

# words that do occur in the English and other texts
RULES = [("Waterproof Leak", "(^|[^a-z])that([^a-z]|$)"), ("Sizes not standard", "(^|[^a-z])with([^a-z]|$)"),
         ("Too Heavy", "(^|[^a-z])para([^a-z]|$)"), ("Stains", "(^|[^a-z])from([^a-z]|$)")]
NAMES_SQL = "['Waterproof Leak', 'Sizes not standard', 'Too Heavy', 'Stains']"


@query("parse_cluster_label", "assignments", """
WITH l AS (SELECT feedback_id, cluster_label || CASE WHEN style IS NULL THEN '.style_Late' ELSE '' END AS label FROM assignments
  UNION ALL SELECT feedback_id || 'x', 'plain.' || feedback_id FROM assignments)
SELECT feedback_id, label,
  COALESCE(replace(list_filter(string_split(label, '.'), lambda p: starts_with(p, 'source_'))[-1], 'source_', ''), 'unknown') AS source,
  replace(list_filter(string_split(label, '.'), lambda p: starts_with(p, 'style_'))[-1], 'style_', '') AS style,
  CAST(LENGTH(label) - LENGTH(REPLACE(label, '.', '')) AS INTEGER) AS depth, REPLACE(label, '.', '_') AS file_label FROM l""")
def _(t):
    a = t.assignments
    late = F.when(F.col("style").isNull(), ".style_Late").otherwise("")
    rows = a.select("feedback_id", F.concat("cluster_label", late).alias("label")).unionByName(
        a.select(F.concat("feedback_id", F.lit("x")).alias("feedback_id"), F.concat(F.lit("plain."), "feedback_id").alias("label")))
    label = F.col("label")
    return rows.select("feedback_id", "label", labels.label_source(label).alias("source"), labels.label_style(label).alias("style"),
                       labels.label_depth(label).alias("depth"), labels.file_safe(label).alias("file_label"))


# The SQL spells out what each kind of answer means; it does not parse JSON.
@query("parse_tag_response", "responses", """
SELECT feedback_id, CASE doc_id % 8 WHEN 0 THEN 'Waterproof Leak|Too Heavy' WHEN 1 THEN 'Stains' WHEN 2 THEN 'Too Heavy'
  WHEN 3 THEN 'Too Heavy|Stains' WHEN 5 THEN 'Waterproof Leak' WHEN 6 THEN 'Stains' ELSE 'Uncategorized' END AS tags FROM responses""")
def _(t):
    return tagging.parse_tag_responses(t.responses, TAXONOMY).select("feedback_id", joined("tags"))


@query("parse_single_tag", "responses", f"""
WITH s AS (SELECT feedback_id, regexp_replace(response, '^["'']+|["'']+$', '', 'g') AS r FROM responses)
SELECT feedback_id, CASE WHEN list_contains({NAMES_SQL}, r) THEN r ELSE COALESCE(
  list_filter({NAMES_SQL}, lambda n: lower(n) = lower(r))[1],
  list_filter({NAMES_SQL}, lambda n: contains(lower(r), lower(n)) OR contains(lower(n), lower(r)))[1], 'Uncategorized') END AS tag FROM s""")
def _(t):
    return tagging.parse_single_tags(t.responses, TAXONOMY).select("feedback_id", "tag")


@query("parse_batch_response", "responses", """
WITH n AS (SELECT feedback_id, doc_id, doc_id % 16 AS shard, row_number() OVER (PARTITION BY doc_id % 16 ORDER BY doc_id) - 1 AS rn FROM responses),
b AS (SELECT *, rn // 8 AS batch, rn % 8 + 1 AS position FROM n)
SELECT feedback_id, CAST(shard AS INTEGER) AS shard, CAST(batch AS INTEGER) AS batch, CAST(position AS INTEGER) AS position,
  CASE WHEN shard % 4 = 3 THEN 'Stains' WHEN position = 1 THEN 'Stains|Too Heavy' WHEN position = 2 THEN 'Too Heavy'
       ELSE 'Uncategorized' END AS tags FROM b""")
def _(t):
    rows = t.responses.withColumn("created_at", F.lpad("feedback_id", 12, "0"))
    items = reports.request_batches(rows, 8, F.col("feedback_id").cast("bigint") % 16).drop("response")
    object_ = '{"1": ["Stains", "Nope", "Too Heavy"], "2": "Too Heavy", "3": [], "4": 7, "5": "Other"}'
    answer = F.when(F.col("shard") % 4 == 3, "1. stains, 2. none").when(
        F.col("shard") % 4 == 2, F.concat(F.lit("```json\n"), F.lit(object_), F.lit("\n```"))).otherwise(object_)
    answers = items.select("shard", "batch").distinct().withColumn("response", answer)
    rows = tagging.parse_batch_responses(items, answers, TAXONOMY, fallback=F.array(F.lit("Stains")))
    return rows.select("feedback_id", "shard", "batch", "position", joined("tags"))


_TAGS = ", ".join(f"CASE WHEN regexp_matches(lower(COALESCE(feedback_text, '')), '{p}') THEN '{c}' END" for c, p in RULES)


@query("keyword_tags", "feedback", f"""
WITH k AS (SELECT feedback_id, list_filter([{_TAGS}], lambda x: x IS NOT NULL) AS tags FROM feedback)
SELECT feedback_id, CASE WHEN len(tags) = 0 THEN 'Uncategorized' ELSE array_to_string(tags, '|') END AS tags FROM k""")
def _(t):
    return tagging.keyword_tags(t.feedback, RULES).select("feedback_id", joined("tags"))


@query("explode_tags", "feedback", f"""
WITH k AS (SELECT feedback_id, created_at, list_filter([{_TAGS}], lambda x: x IS NOT NULL) AS tags FROM feedback)
SELECT feedback_id, unnest(CASE WHEN len(tags) = 0 THEN ['Uncategorized'] ELSE tags END) AS tag_name,
  CAST(1.0 AS DOUBLE) AS confidence_score, {sql_ts('created_at')} AS created_at FROM k""")
def _(t):
    return tagging.explode_tags(tagging.keyword_tags(t.feedback, RULES)).withColumn("created_at", ts("created_at"))


@query("batch_failure_policy", "feedback", f"""
WITH k AS (SELECT feedback_id, feedback_text IS NULL AS failed, list_filter([{_TAGS}], lambda x: x IS NOT NULL) AS tags FROM feedback)
SELECT feedback_id, CASE WHEN failed OR len(tags) = 0 THEN 'Uncategorized' ELSE array_to_string(tags, '|') END AS tags, 'default' AS policy FROM k
UNION ALL SELECT feedback_id, CASE WHEN len(tags) = 0 THEN 'Uncategorized' ELSE array_to_string(tags, '|') END, 'quarantine' FROM k WHERE NOT failed""")
def _(t):
    tagged = tagging.keyword_tags(t.feedback, RULES)
    error = F.when(F.col("feedback_text").isNull(), "no text")
    both = [tagging.apply_failure_policy(tagged, error, p).select("feedback_id", joined("tags"), F.lit(p).alias("policy"))
            for p in ("default", "quarantine")]
    return both[0].unionByName(both[1])


@query("taxonomy_edit", "tags inventory_info", """
SELECT DISTINCT tag_name AS category FROM tags WHERE tag_name <> 'Stains' UNION SELECT DISTINCT style FROM inventory_info WHERE style IS NOT NULL""")
def _(t):
    base = t.tags.groupBy("tag_name").agg(F.min("feedback_id").alias("m")).select(
        F.col("tag_name").alias("category"), F.length("tag_name").alias("priority"))
    add = t.inventory.filter("style IS NOT NULL").select(F.col("style").alias("category"), F.length("style").alias("priority"))
    remove = t.tags.filter("tag_name = 'Stains'").select(F.col("tag_name").alias("category"))
    return tagging.edit_taxonomy(base, add, remove).select("category")


@query("build_prompts", "feedback", """
WITH r AS (SELECT feedback_id, feedback_text, CAST(CAST(feedback_id AS BIGINT) % 8 AS INTEGER) AS shard, created_at FROM feedback WHERE feedback_text IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY created_at, feedback_id) - 1 AS rn FROM r)
SELECT shard, CAST(rn // 10 AS INTEGER) AS batch, COUNT(*) AS n_items,
  string_agg((rn % 10 + 1) || '. ' || feedback_text, chr(10) ORDER BY rn) AS block FROM n GROUP BY 1, 2""")
def _(t):
    rows = t.feedback.filter(F.col("feedback_text").isNotNull())
    return tagging.build_prompts(reports.request_batches(rows, 10, F.col("feedback_id").cast("bigint") % 8))


def hashed_sql(table: str, key: str, text: str, dim: int = 64) -> str:
    """`v` (key, vector): counts of the words by the place that their MD5 names, scaled to length one, as floats."""
    return f"""w AS (SELECT {key} AS key, unnest(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{N}}]+')) AS word FROM {table}),
h AS (SELECT key, CAST(('0x' || substr(md5(word), 1, 8)) AS BIGINT) % {dim} AS i, CAST(count(*) AS DOUBLE) AS n FROM w WHERE word <> '' GROUP BY ALL),
l AS (SELECT key, sqrt(sum(n * n)) AS size FROM h GROUP BY key),
v AS (SELECT l.key, list(CAST(coalesce(h.n, 0) / l.size AS FLOAT) ORDER BY r.i) AS vector
  FROM l CROSS JOIN (SELECT unnest(range(0, {dim})) AS i) r LEFT JOIN h ON h.key = l.key AND h.i = r.i GROUP BY l.key)"""


@query("hash_embeddings", "feedback", f"""
WITH {hashed_sql('feedback', 'feedback_id', 'feedback_text')}
SELECT key AS feedback_id, {sql_micro('vector')} AS vector, 'hash-64' AS model FROM v""")
def _(t):
    rows = embed.hash_embeddings(t.feedback.select("feedback_id", "feedback_text"))
    return rows.select("feedback_id", micro("vector"), "model")


@query("cluster_terms", "feedback", """
WITH w AS (SELECT cluster_id AS cluster_label, unnest(string_split_regex(lower(COALESCE(feedback_text, '')), '[^\\p{L}\\p{N}]+')) AS term
  FROM feedback WHERE cluster_id IS NOT NULL),
c AS (SELECT cluster_label, term, COUNT(*) AS tf FROM w WHERE length(term) >= 3 GROUP BY ALL),
d AS (SELECT term, COUNT(*) AS df FROM c GROUP BY term),
s AS (SELECT c.*, tf * ln(((SELECT COUNT(DISTINCT cluster_label) FROM c) + 1) / (df + 1)::DOUBLE) AS score FROM c JOIN d USING (term))
SELECT cluster_label, term, tf, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster_label ORDER BY round(score, 6) DESC, term) AS rank FROM s) WHERE rank <= 5""")
def _(t):
    rows = t.feedback.filter(F.col("cluster_id").isNotNull()).select(F.col("cluster_id").alias("cluster_label"), "feedback_text")
    return terms.cluster_terms(rows, min_length=3).select("cluster_label", "term", "tf", r6("score"), "rank")
