"""DuckDB versions of the derived tables, and the pairing of a Spark query with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.tables import Tables

VIEWS: dict[str, tuple[str, str]] = {
    # name: (views it needs, SQL)
    "inventory_info": ("", """
        SELECT CAST(p_partkey AS VARCHAR) AS sku,
               CASE WHEN p_partkey % 10 = 9 THEN NULL ELSE p_type END AS style FROM part"""),
    "fb_embeddings": ("", """
        SELECT CAST(v.vec_id AS VARCHAR) AS feedback_id, v.embedding AS vector, 'hash-64' AS model,
          CASE v.vec_id % 3 WHEN 0 THEN 'review' WHEN 1 THEN 'return' ELSE 'chat' END AS source,
          CASE WHEN v.vec_id % 20 = 19 THEN NULL WHEN v.label < 5 THEN 'Weekend' ELSE 'Everyday' END AS style,
          e.ts AS created_at, v.label AS label
        FROM embeddings v JOIN events e ON e.event_id = v.vec_id"""),
    "planted": ("fb_embeddings", """
        SELECT feedback_id, source, style, label, created_at,
          list_transform(vector, lambda x, i: CAST(x AS DOUBLE) * 0.2
            + CASE WHEN i - 1 = label THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS vector
        FROM fb_embeddings"""),
    "embedded_items": ("fb_embeddings", """
        SELECT feedback_id, created_at AS embedded_at FROM fb_embeddings WHERE label < 6"""),
    "assignments": ("fb_embeddings", """
        SELECT feedback_id, source, style, created_at,
          CONCAT('source_', source, '.style_', COALESCE(style, 'none'),
            CASE WHEN style IS NULL THEN '.unclustered' WHEN label = 9 THEN '.noise'
                 WHEN label % 5 = 0 THEN CONCAT('.0.', CAST(CAST(feedback_id AS BIGINT) % 2 AS VARCHAR))
                 ELSE CONCAT('.', CAST(label % 5 AS VARCHAR)) END) AS cluster_label,
          CASE WHEN label = 9 THEN 0.0::DOUBLE
               ELSE 0.3::DOUBLE + (CAST(feedback_id AS BIGINT) % 8)::DOUBLE / 10.0::DOUBLE END AS probability
        FROM fb_embeddings"""),
    "feedback": ("assignments", """
        SELECT CAST(d.doc_id AS VARCHAR) AS feedback_id,
          CASE d.doc_id % 50 WHEN 7 THEN ' n/a ' WHEN 8 THEN '!!!' WHEN 9 THEN NULL WHEN 10 THEN '   '
               ELSE d.text END AS feedback_text,
          CASE d.doc_id % 3 WHEN 0 THEN 'review' WHEN 1 THEN 'return' ELSE 'chat' END AS feedback_source,
          e.ts AS created_at, CAST((d.doc_id * 7) % 200 AS VARCHAR) AS sku, d.lang AS category,
          CASE WHEN d.doc_id % 3 = 0 THEN CAST(1 + (d.doc_id * 11) % 5 AS INTEGER) END AS rating,
          a.cluster_label AS cluster_id
        FROM documents d JOIN events e ON e.event_id = d.doc_id
        LEFT JOIN assignments a ON a.feedback_id = CAST(d.doc_id AS VARCHAR)"""),
    "tags": ("", """
        SELECT CAST(d.doc_id AS VARCHAR) AS feedback_id, t.tag_name AS tag_name,
          CAST(50 + (d.doc_id * 13 + t.m) % 51 AS DOUBLE) / 100 AS confidence_score, e.ts AS created_at
        FROM documents d JOIN events e ON e.event_id = d.doc_id
        JOIN (VALUES ('Waterproof Leak', 4), ('Sizes not standard', 6), ('Too Heavy', 5), ('Stains', 9))
             AS t(tag_name, m) ON d.doc_id % t.m = 0"""),
    "clusters": ("assignments", """
        SELECT cluster_label AS cluster_id, cluster_label,
          CONCAT('Cluster containing ', CAST(COUNT(*) AS VARCHAR), ' feedback items') AS cluster_description,
          COUNT(*) AS record_count, source, style,
          LENGTH(cluster_label) - LENGTH(REPLACE(cluster_label, '.', '')) AS cluster_depth,
          TIMESTAMP '2024-01-01 00:00:00' AS period_start, TIMESTAMP '2024-01-31 00:00:00' AS period_end
        FROM assignments GROUP BY cluster_label, source, style"""),
    "responses": ("", """
        SELECT CAST(doc_id AS VARCHAR) AS feedback_id, doc_id, CASE doc_id % 8
          WHEN 0 THEN '["Waterproof Leak", "Too Heavy"]' WHEN 1 THEN '```json\n["Stains"]\n```'
          WHEN 2 THEN 'Sure: ["Too Heavy", "Nope"] hope it helps' WHEN 3 THEN 'It sounds like too heavy and STAINS'
          WHEN 4 THEN '[]' WHEN 5 THEN '"waterproof leak"' WHEN 6 THEN '{"1": ["Stains"]}'
          ELSE 'nothing here' END AS response FROM documents"""),
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_views(names: str, body: str) -> str:
    """`body` behind the WITH clauses it needs, in dependency order."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in VIEWS[name][0].split():
            need(other)
        if name not in order:
            order.append(name)

    for name in names.split():
        need(name)
    if not order:
        return body
    clauses = ",\n".join(f"{name} AS ({VIEWS[name][1]})" for name in order)
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {clauses},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {clauses},\n{body[5:]}"
    return f"WITH {clauses}\n{body}"


def query(name: str, views: str = "", sql: str | None = None):
    """Register a Spark query and, when given, its SQL twin."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = with_views(views, sql)
        return build

    return register
