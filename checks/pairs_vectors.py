"""Distances and similarity search: N*."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.canon import r6
from checks.pairs_text import hashed_sql
from checks.twins import query
from feedloom.functions import vectors
from feedloom.operators import embed, search
from feedloom.session import shared_folder

# Queries: the items without a style.  Every stored vector is compared with each of them.
HITS_SQL = """d AS (SELECT q.feedback_id AS query_id, e.feedback_id,
    list_cosine_distance(CAST(e.vector AS DOUBLE[]), CAST(q.vector AS DOUBLE[])) AS distance
  FROM fb_embeddings e JOIN fb_embeddings q ON q.style IS NULL {cond}),
hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, feedback_id) AS rank FROM d) WHERE rank <= {k})"""
OUT = "query_id, feedback_id, round(distance, 6) + 0.0 AS distance, CAST(rank AS INTEGER) AS rank"


def unstyled(t):
    return t.embeddings.filter(F.col("style").isNull()).select(F.col("feedback_id").alias("query_id"), "vector")


def _pairs(t):
    """Every vector beside the vector with the next id."""
    e = t.embeddings.select(F.col("feedback_id").cast("bigint").alias("n"), F.col("vector").alias("a"))
    o = e.select((F.col("n") - 1).alias("n"), F.col("a").alias("b"))
    return e.join(o, "n"), F.col("a"), F.col("b")


def _pair_sql(expr: str) -> str:
    return f"""WITH e AS (SELECT CAST(feedback_id AS BIGINT) AS n, CAST(vector AS DOUBLE[]) AS v FROM fb_embeddings)
SELECT a.n, round({expr}, 6) AS distance FROM e a JOIN e b ON b.n = a.n + 1"""


@query("cosine_distance", "fb_embeddings", _pair_sql("list_cosine_distance(a.v, b.v)"))
def _(t):
    rows, a, b = _pairs(t)
    return rows.select("n", F.round(vectors.cosine_distance(a, b), 6).alias("distance"))


@query("l2_distance", "fb_embeddings", _pair_sql("list_distance(a.v, b.v)"))
def _(t):
    rows, a, b = _pairs(t)
    return rows.select("n", F.round(vectors.l2_distance(a, b), 6).alias("distance"))


@query("neg_inner_product", "fb_embeddings", _pair_sql("-list_inner_product(a.v, b.v)"))
def _(t):
    rows, a, b = _pairs(t)
    return rows.select("n", F.round(vectors.negative_inner_product(a, b), 6).alias("distance"))


@query("similar_feedback", "fb_embeddings",
       f"WITH {HITS_SQL.format(cond=chr(32), k=10)} SELECT {OUT} FROM hits")
def _(t):
    return search.search(t.embeddings, unstyled(t)).select("query_id", "feedback_id", r6("distance"), "rank")


@query("similar_below_threshold", "fb_embeddings", f"""
WITH {HITS_SQL.format(cond="AND e.source = 'review'", k=10)} SELECT {OUT} FROM hits WHERE distance < 0.7""")
def _(t):
    rows = search.search(t.embeddings, unstyled(t), threshold=0.7, source="review")
    return rows.select("query_id", "feedback_id", r6("distance"), "rank")


@query("similar_to_id", "fb_embeddings", """
SELECT e.feedback_id, round(list_cosine_distance(CAST(e.vector AS DOUBLE[]), CAST(q.vector AS DOUBLE[])), 6) + 0.0 AS distance,
  CAST(row_number() OVER (ORDER BY list_cosine_distance(CAST(e.vector AS DOUBLE[]), CAST(q.vector AS DOUBLE[])), e.feedback_id) AS INTEGER) AS rank
FROM fb_embeddings e JOIN fb_embeddings q ON q.feedback_id = '42' WHERE e.feedback_id <> '42' ORDER BY 2, 1 LIMIT 10""")
def _(t):
    rows = search.search_by_id(t.embeddings, "42", exclude_self=True)
    return rows.select("feedback_id", r6("distance"), "rank")


@query("similar_to_text", "feedback", f"""
WITH e AS (WITH {hashed_sql('feedback', 'feedback_id', 'feedback_text')} SELECT key AS feedback_id, CAST(vector AS DOUBLE[]) AS vector FROM v),
q AS (WITH {hashed_sql('benchmark', 'CAST(item_id AS VARCHAR)', 'text')} SELECT key AS query_id, CAST(vector AS DOUBLE[]) AS vector FROM v),
d AS (SELECT query_id, feedback_id, list_cosine_distance(e.vector, q.vector) AS distance FROM e, q),
hits AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 12), feedback_id) AS rank FROM d QUALIFY rank <= 10)
SELECT {OUT} FROM hits""")
def _(t):
    stored = embed.hash_embeddings(t.feedback.select("feedback_id", "feedback_text"))
    questions = t.raw("benchmark").select(F.col("item_id").cast("string").alias("query_id"), F.col("text").alias("feedback_text"))
    rows = search.search_by_text(stored, questions, embed.hash_embeddings)
    return rows.select("query_id", "feedback_id", r6("distance"), "rank")


LISTS, PROBES = 64, 30  # a recall of 0.9 or more at sf0.01, sf0.1 and check_s


def stored_lists(rows, lists: int) -> search.StoredLists:
    return search.StoredLists.write(rows, f"{shared_folder(rows.sparkSession)}/lists-{uuid.uuid4().hex}", lists)


@query("ivf_search")
def _(t):
    found = stored_lists(t.embeddings, LISTS).search(unstyled(t), probes=PROBES)
    return found.select("query_id", "feedback_id", r6("distance"), "rank")


@query("ivf_search_all_lists", "fb_embeddings",
       f"WITH {HITS_SQL.format(cond=chr(32), k=10)} SELECT {OUT} FROM hits")
def _(t):
    centres = search.train_lists(t.embeddings, lists=8)
    index = search.assign_lists(t.embeddings, centres)
    return search.ivf_search(index, centres, unstyled(t), probes=8).select("query_id", "feedback_id", r6("distance"), "rank")


@query("ivf_search_exact", "planted", """
WITH d AS (SELECT q.feedback_id AS query_id, e.feedback_id, list_cosine_distance(e.vector, q.vector) AS distance FROM planted e JOIN planted q ON q.style IS NULL),
hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, feedback_id) AS rank FROM d) WHERE rank <= 10)
SELECT query_id, feedback_id, round(distance, 6) + 0.0 AS distance, CAST(rank AS INTEGER) AS rank FROM hits""")
def _(t):
    """Exact by proof: lists are opened until the next one can hold nothing nearer."""
    asked = t.planted.filter(F.col("style").isNull()).select(F.col("feedback_id").alias("query_id"), "vector")
    return stored_lists(t.planted, 16).search(asked).select("query_id", "feedback_id", r6("distance"), "rank")


@query("search_enriched", "fb_embeddings feedback clusters", f"""
WITH {HITS_SQL.format(cond=chr(32), k=10)}
SELECT h.query_id, h.feedback_id, round(h.distance, 6) + 0.0 AS distance, round(1 - h.distance, 6) + 0.0 AS similarity, f.rating, f.cluster_id, c.cluster_description
FROM hits h LEFT JOIN feedback f ON f.feedback_id = h.feedback_id LEFT JOIN clusters c ON c.cluster_id = f.cluster_id""")
def _(t):
    rows = search.search_enriched(search.search(t.embeddings, unstyled(t)), t.feedback, t.clusters)
    return rows.select("query_id", "feedback_id", r6("distance"), r6("similarity"), "rating", "cluster_id", "cluster_description")


@query("search_themes", "fb_embeddings feedback tags", f"""
WITH {HITS_SQL.format(cond=chr(32), k=40)},
r AS (SELECT h.query_id, f.* FROM hits h JOIN feedback f ON f.feedback_id = h.feedback_id)
SELECT query_id, kind, theme, COUNT(*) AS count FROM (
  SELECT r.query_id, 'tag' AS kind, t.tag_name AS theme FROM r JOIN tags t ON t.feedback_id = r.feedback_id
  UNION ALL SELECT query_id, 'source', feedback_source FROM r
  UNION ALL SELECT query_id, 'cluster', cluster_id FROM r WHERE cluster_id IS NOT NULL) GROUP BY ALL""")
def _(t):
    return search.search_themes(search.search(t.embeddings, unstyled(t), k=40), t.tags, t.feedback)
