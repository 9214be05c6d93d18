"""One registered query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import chat, codes, decontaminate, interactions, jaccard, mixing, quality, recompress, secrets, suffix_dedup, tokens, topk, warc
from feedloom.llm.common import read_table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shared", "n_item").distinct()


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.without_repeats(read_table(spark, sf_dir, "documents"), 200, with_text=False)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(mixing.mix(read_table(spark, sf_dir, "documents")))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").filter(topk.usable(F.col("embedding")))
    rows = rows.select("vec_id", topk.integer_components(F.col("embedding")).alias("vector"))
    return topk.exact_top_k(rows, rows.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id"), 5)


def op5_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recompress.without_repeats(read_table(spark, sf_dir, "documents"), 35, with_text=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    machine = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.scored(docs, machine).drop("fp")


def op8_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(spark, warc.write_archive(read_table(spark, sf_dir, "pages")))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(read_table(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "copy_id", "class_id", "n_links")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").filter(topk.usable(F.col("embedding")))
    rows = rows.select("vec_id", "label", topk.integer_components(F.col("embedding"), 1024).alias("vector"))
    coded, books = codes.compress(rows)
    return coded.select("vec_id", "code", "error", "label_error", F.lit(codes.fingerprint(books)).alias("codebooks_sha256"))


def op12_chat_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(marked).alias("text"))
    members, nodes = chat.pack(chats.unionByName(probe))
    return chat.read_back(members, nodes)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = interactions.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return found.drop("filter")


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_suffix_array_dedup, op3_mix_sources, op4_exact_top_k, op5_recompression_dedup, op6_secret_scan,
    op7_quality_classifier, op8_warc_archive, op9_token_counts, op10_ngram_jaccard, op11_vector_codes, op12_chat_packs, op13_filter_audit)}


def _codebook_sql(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """Lloyd's rounds in SQL: b0 are the first books, a<i> the assignments by b<i>, b<i + 1> the means."""
    steps = [f"""b0 AS (SELECT p, n - 1 AS e, x FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY vec_id NULLS LAST) AS n FROM s) WHERE n <= {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS (
  SELECT r, p, min((d, e)) AS best FROM (
    SELECT s.r, s.p, b.e, CAST(list_inner_product(CAST(s.x AS DOUBLE[]), CAST(s.x AS DOUBLE[])) + list_inner_product(CAST(b.x AS DOUBLE[]), CAST(b.x AS DOUBLE[]))
      - 2 * list_inner_product(CAST(s.x AS DOUBLE[]), CAST(b.x AS DOUBLE[])) AS BIGINT) AS d FROM s JOIN b{i} b USING (p)) GROUP BY r, p)""")
        if i < rounds:
            steps.append(f"""m{i} AS (SELECT p, e, list(x ORDER BY k) AS x FROM (
    SELECT p, e, k, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM (
      SELECT a.p, a.best[2] AS e, generate_subscripts(s.x, 1) AS k, unnest(s.x) AS x FROM a{i} a JOIN s USING (r, p)) GROUP BY p, e, k) GROUP BY p, e)""".replace("a.best[2]", "struct_extract_at(a.best, 2)"))
            steps.append(f"b{i + 1} AS (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN m{i} m USING (p, e))")
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT r, vec_id, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x FROM v, (SELECT unnest(range({parts})) AS p)),
{("," + chr(10)).join(steps)},
c AS (SELECT r, string_agg(printf('%02x', CAST(struct_extract_at(best, 2) AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(struct_extract_at(best, 1)) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
l AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM v JOIN c USING (r) GROUP BY label),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, label_error, codebooks_sha256 FROM v JOIN c USING (r) JOIN l ON l.label IS NOT DISTINCT FROM v.label, h"""


def _escaped_sql(text: str) -> str:
    text = rf"replace({text}, '\', '\\')"
    for mark in chat.MARKS:
        text = rf"replace({text}, '{mark}', '{mark[0]}\{mark[1:]}')"
    return text


#: DuckDB SQL for the same rows; operators that SQL cannot express are tested against brute-force versions.
ORACLES = {
    "op1_decontaminate": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT item_id, text, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) AS s FROM d),
js AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) AS s FROM i),
n AS (SELECT item_id, count(*) AS n_item FROM js GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, n_item
FROM ds JOIN js USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id, n_item HAVING count(*) >= ceil(0.8 * n_item - 1e-9)""",
    "op5_recompression_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d),
h AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM s),
t AS (SELECT h FROM h GROUP BY h HAVING count(*) > 1),
c AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS k FROM h SEMI JOIN t USING (h)),
x AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM d),
a AS (
  SELECT x.r, count(c.k) AS n_removed, string_agg(x.word, ' ' ORDER BY x.k) FILTER (WHERE c.k IS NULL) AS kept
  FROM x LEFT JOIN c ON c.r = x.r AND c.k = x.k GROUP BY x.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN a USING (r)""",
    "op8_warc_archive": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
b AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda j:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, 5 * (j // 4) + 1, 5) AS BIGINT) >> CAST(15 - 5 * (j % 4) AS INTEGER)) & 31 AS INTEGER), 1)), '') AS payload_digest,
    max(page_id) OVER (PARTITION BY h) AS head FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN head IS NULL OR head IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN head IS NULL OR head IS NOT DISTINCT FROM page_id THEN NULL ELSE head END AS refers_to FROM b""",
    "op10_ngram_jaccard": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) END)) AS s FROM d),
c AS (SELECT min(doc_id) AS copy_id, s FROM g WHERE len(s) > 0 GROUP BY s),
e AS (SELECT copy_id, len(s) AS n, unnest(s) AS x FROM c),
p AS (
  SELECT a.copy_id AS u, b.copy_id AS v FROM e a JOIN e b ON a.x = b.x AND a.copy_id <> b.copy_id
  GROUP BY a.copy_id, b.copy_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-6),
r AS (SELECT copy_id AS node, copy_id AS seen FROM c UNION SELECT r.node, p.v FROM r JOIN p ON p.u = r.seen),
k AS (SELECT node, min(seen) AS class_id FROM r GROUP BY node),
l AS (SELECT u, count(*) AS n_links FROM p GROUP BY u)
SELECT g.doc_id, coalesce(c.copy_id, g.doc_id) AS copy_id, coalesce(k.class_id, g.doc_id) AS class_id, coalesce(l.n_links, 0) AS n_links
FROM g LEFT JOIN c ON c.s = g.s LEFT JOIN k ON k.node = c.copy_id LEFT JOIN l ON l.u = c.copy_id""",
    "op4_exact_top_k": """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
q AS (SELECT vec_id AS query_id, min(v) AS v FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id),
s AS (
  SELECT q.query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM q JOIN v c ON c.vec_id <> q.query_id AND len(c.v) = len(q.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op11_vector_codes": _codebook_sql(),
    "op12_chat_packs": f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (SELECT *, length({_escaped_sql("text")}) + CASE role WHEN 'assistant' THEN 7 WHEN 'user' THEN 13 WHEN 'system' THEN 11
  ELSE 20 + length({_escaped_sql("role")}) END AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars FROM f GROUP BY conv_id""",
    "op13_filter_audit": r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
h AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
w AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, coalesce(doc_id > least, false) AS e FROM d JOIN h USING (t)),
g AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
  || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
  || CASE WHEN e THEN 'E' ELSE '' END AS fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n
  FROM w LEFT JOIN g USING (doc_id) GROUP BY ALL),
p AS (SELECT '' AS o UNION ALL SELECT o || c FROM p, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c) WHERE NOT contains(o, c)),
q AS (SELECT o, k, substr(o, k, 1) AS f, substr(o, 1, k - 1) AS prior FROM p, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS k) WHERE length(o) = 5),
x AS (SELECT *, contains(fails, f) AS failing, length(translate(prior, fails, '')) < length(prior) AS gone FROM q, m),
s AS (SELECT part, o, k, f, sum(n) FILTER (NOT gone AND NOT failing) AS kept, sum(n) FILTER (failing AND NOT gone) AS removed, sum(n) FILTER (failing AND gone) AS redundant,
  sum(n) FILTER (fails = f) AS unique_fails, sum(n * good) FILTER (failing AND NOT gone) AS good_lost, sum(n * toxic) FILTER (failing AND NOT gone) AS toxic_lost
  FROM x GROUP BY part, o, k, f)
SELECT part, o AS filter_order, k AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley FROM s""",
}
