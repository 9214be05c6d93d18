"""Clustering: parameters, neighbours, trees, flat and recursive clusters, jobs: W7, C*, A28, P*, I1."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.canon import micro, r6, sql_ts, ts
from checks.pairs_tables import CLEAN_SQL, DAY1
from checks.pairs_text import RULES
from checks.twins import query
from feedloom.functions import vectors
from feedloom.functions.labels import slice_label
from feedloom.operators import adaptive, kmeans, knn, linkage, mst, quality, reduce, silhouettes
from feedloom.plans import clustering, ingest
from feedloom.session import cut
from feedloom.sources.sinks import split_failures
from feedloom.streaming.incremental import increment

SLICE_SQL = "'source_' || source || '.style_' || style"
POINTS_SQL = f"p AS (SELECT {SLICE_SQL} AS grp, feedback_id AS pid, vector AS xs, label FROM planted WHERE style IS NOT NULL)"
DIST_SQL = f"""{POINTS_SQL},
d AS (SELECT a.grp, a.pid, b.pid AS nbr, list_distance(a.xs, b.xs) AS dist FROM p a JOIN p b ON a.grp = b.grp AND a.pid <> b.pid)"""
NOW = "2024-02-01 00:00:00"


def slice_name():
    return slice_label(F.col("source"), F.col("style"))


def points(t):
    return knn.as_points(t.planted.filter(F.col("style").isNotNull()), slice_name())


def labelled(t):
    rows = t.planted.filter(F.col("style").isNotNull())
    return rows.select(slice_name().alias("grp"), F.col("feedback_id").alias("pid"), F.col("vector").alias("xs"), F.col("label").alias("cluster"))


# --- parameters ---------------------------------------------------------------------------

# group sizes of all magnitudes, as they occur in the tables
SIZES_SQL = """s AS (SELECT 'lang' AS kind, lang AS name, COUNT(*) AS n FROM documents GROUP BY lang
  UNION ALL SELECT 'event', event_type, COUNT(*) FROM events GROUP BY event_type
  UNION ALL SELECT 'label', CAST(label AS VARCHAR), COUNT(*) FROM embeddings GROUP BY label
  UNION ALL SELECT 'type', p_type, COUNT(*) FROM part GROUP BY p_type),
g AS (SELECT s.*, CAST(d.depth AS INTEGER) AS depth FROM s, (SELECT unnest(range(0, 5)) AS depth) d)"""


def sizes(t):
    parts = [("lang", "documents", "lang"), ("event", "events", "event_type"), ("label", "embeddings", "label"), ("type", "part", "p_type")]
    tables = [t.raw(table).groupBy(F.col(c).cast("string").alias("name")).agg(F.count("*").alias("n")).withColumn("kind", F.lit(kind))
              for kind, table, c in parts]
    rows = tables[0]
    for more in tables[1:]:
        rows = rows.unionByName(more)
    return rows.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(4))))


@query("adaptive_neighbors", "", f"""
WITH {SIZES_SQL},
x AS (SELECT *, least(greatest(least(sqrt(n) / 2 * power(0.85::DOUBLE, depth), 30), 5), floor(n * 0.05::DOUBLE)) AS x FROM g)
SELECT kind, name, n, depth, CAST(floor(CASE WHEN x < 6 THEN 6 ELSE x END) AS INTEGER) AS n_neighbors,
  CAST(CASE WHEN n < 100 THEN 0.0 WHEN n < 500 THEN 0.05 ELSE 0.1 END AS DOUBLE) AS min_dist,
  CAST(CASE WHEN n < 100 THEN 1.0 WHEN n < 500 THEN 1.5 ELSE 2.0 END AS DOUBLE) AS spread FROM x""")
def _(t):
    p = adaptive.neighbour_params(F.col("depth"), F.col("n"), 3)
    return sizes(t).withColumn("p", p).select("kind", "name", "n", "depth", "p.*")


@query("adaptive_density", "", f"""
WITH {SIZES_SQL},
m AS (SELECT *, floor(0.02::DOUBLE * power(0.6::DOUBLE, depth) * n) AS m,
  CASE WHEN n < 100 THEN 5 WHEN n < 500 THEN 8 WHEN n < 2000 THEN 10 ELSE 15 END AS lo,
  CASE WHEN n < 100 THEN n // 5 WHEN n < 500 THEN n // 8 ELSE n // 10 END AS hi FROM g),
c AS (SELECT *, CAST(least(greatest(m, lo), hi) AS INTEGER) AS min_cluster_size FROM m)
SELECT kind, name, n, depth, min_cluster_size, CAST(greatest(3, min_cluster_size // 2) AS INTEGER) AS min_samples,
  CAST(CASE WHEN depth >= 2 AND n < 500 THEN 0.1 ELSE 0.0 END AS DOUBLE) AS epsilon FROM c""")
def _(t):
    return sizes(t).withColumn("p", adaptive.density_params(F.col("depth"), F.col("n"))).select("kind", "name", "n", "depth", "p.*")


@query("should_recurse", "assignments", """
WITH q AS (SELECT source, style, COUNT(DISTINCT cluster_label) FILTER (NOT ends_with(cluster_label, '.noise')) AS k,
    avg(probability) / 4 AS persistence, count(*) FILTER (ends_with(cluster_label, '.noise')) / COUNT(*)::DOUBLE AS noise
  FROM assignments WHERE style IS NOT NULL GROUP BY source, style),
c AS (SELECT a.source, a.style, COUNT(*) AS n FROM assignments a WHERE a.style IS NOT NULL GROUP BY ALL),
r AS (SELECT c.*, q.k, q.persistence, q.noise, CAST(d.depth AS INTEGER) AS depth FROM c JOIN q USING (source, style), (SELECT unnest(range(0, 5)) AS depth) d)
SELECT source, style, depth, n, CASE WHEN depth >= 4 OR n < 50 * power(1.3::DOUBLE, depth) THEN false
  WHEN persistence < 0.05 + 0.025 * least(depth, 4) OR k > n / 10.0 OR noise > 0.5 THEN false ELSE true END AS open FROM r""")
def _(t):
    noise = F.endswith("cluster_label", F.lit(".noise"))
    rows = t.assignments.filter(F.col("style").isNotNull()).groupBy("source", "style").agg(
        F.count("*").alias("n"), F.countDistinct(F.when(~noise, F.col("cluster_label"))).alias("k"),
        (F.avg("probability") / 4).alias("persistence"), (F.count_if(noise) / F.count("*")).alias("noise"))
    rows = rows.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(4))))
    rule = adaptive.should_recurse(F.col("depth"), F.col("n"), 4, F.col("k"), F.col("persistence"), F.col("noise"))
    return rows.select("source", "style", "depth", "n", rule.alias("open"))


@query("terminal_labels", "planted", f"""
SELECT feedback_id, {SLICE_SQL} || CASE source WHEN 'chat' THEN '.noise' WHEN 'return' THEN '.0'
  ELSE CASE WHEN label = 9 THEN '.noise' ELSE '.' || label END END AS cluster_label FROM planted WHERE style IS NOT NULL""")
def _(t):
    rows = t.planted.filter(F.col("style").isNotNull())
    found = F.when(F.col("source") == "chat", 0).when(F.col("source") == "return", 1).otherwise(5)
    cluster = F.when(F.col("label") == 9, -1).otherwise(F.col("label"))
    return rows.select("feedback_id", adaptive.terminal_label(slice_name(), found, cluster).alias("cluster_label"))


@query("clustering_quality", "fb_embeddings", """
WITH a AS (SELECT source, style, CASE WHEN label = 9 THEN -1 ELSE label END AS cluster,
    CASE WHEN label = 9 THEN 0.0 ELSE (CAST(feedback_id AS BIGINT) % 11) / 10.0 END::DOUBLE AS probability, 0.1 + label / 20.0 AS persistence
  FROM fb_embeddings WHERE style IS NOT NULL),
s AS (SELECT source, style, cluster, COUNT(*) AS n, max(persistence) AS persistence FROM a WHERE cluster >= 0 GROUP BY ALL),
b AS (SELECT source, style, COUNT(*) AS n_clusters, min(persistence) AS min_persistence, avg(persistence) AS mean_persistence,
    max(n) / sum(n)::DOUBLE AS largest_cluster_ratio, min(n) AS smallest_cluster_size, avg(n) AS mean_cluster_size, stddev_samp(n) AS cluster_size_std
  FROM s GROUP BY source, style),
c AS (SELECT source, style, COUNT(*) AS n_points, avg(probability) AS mean_probability, avg((probability < 0.5)::INT) AS low_confidence_ratio,
    avg((cluster < 0)::INT) AS noise_ratio FROM a GROUP BY source, style)
SELECT source, style, n_points, n_clusters, round(min_persistence, 6) AS min_persistence, round(mean_persistence, 6) AS mean_persistence,
  round(mean_probability, 6) AS mean_probability, round(low_confidence_ratio, 6) AS low_confidence_ratio, round(noise_ratio, 6) AS noise_ratio,
  round(largest_cluster_ratio, 6) AS largest_cluster_ratio, smallest_cluster_size, round(mean_cluster_size, 6) AS mean_cluster_size,
  round(cluster_size_std, 6) AS cluster_size_std FROM b JOIN c USING (source, style)""")
def _(t):
    rows = t.embeddings.filter(F.col("style").isNotNull()).select(
        "source", "style", F.when(F.col("label") == 9, -1).otherwise(F.col("label")).alias("cluster"),
        F.when(F.col("label") == 9, 0.0).otherwise((F.col("feedback_id").cast("bigint") % 11) / 10.0).alias("probability"),
        (0.1 + F.col("label") / 20.0).alias("persistence"))
    names = ["min_persistence", "mean_persistence", "mean_probability", "low_confidence_ratio", "noise_ratio", "largest_cluster_ratio",
             "mean_cluster_size", "cluster_size_std"]
    return quality.clustering_quality(rows, ["source", "style"]).select(
        "source", "style", "n_points", "n_clusters", "smallest_cluster_size", *[r6(n) for n in names])


@query("relative_validity", "planted", f"""
WITH {POINTS_SQL},
c AS (SELECT *, CASE WHEN label = 9 OR (label = 3 AND grp LIKE '%chat%') THEN -1 ELSE label // 2 END AS c FROM p),
l AS (SELECT grp, c AS b, lag(c) OVER s AS a, list_distance(xs, lag(xs) OVER s) AS w FROM c WINDOW s AS (PARTITION BY grp ORDER BY pid)),
e AS (SELECT * FROM l WHERE w IS NOT NULL),
t AS (SELECT grp, count(*) AS total, count(DISTINCT c) FILTER (c >= 0) AS k FROM c GROUP BY grp),
m AS (SELECT grp, max(w) AS longest, min(w) FILTER ((a < 0) <> (b < 0)) AS noise FROM e GROUP BY grp),
n AS (SELECT grp, c, count(*) AS n FROM c WHERE c >= 0 GROUP BY grp, c),
x AS (SELECT n.grp, n.c, n.n, coalesce(max(w) FILTER (a = n.c AND b = n.c), 0) AS sparse, min(w) FILTER (a >= 0 AND b >= 0 AND a <> b) AS apart
  FROM n LEFT JOIN e ON e.grp = n.grp AND (e.a = n.c OR e.b = n.c) GROUP BY n.grp, n.c, n.n),
v AS (SELECT x.*, coalesce(apart, 2 * CASE WHEN t.k > 1 THEN longest ELSE coalesce(noise, longest) END) AS sep, total FROM x JOIN t USING (grp) JOIN m USING (grp))
SELECT grp, round(sum(n * (sep - sparse) / greatest(sep, sparse) / total), 6) + 0.0 AS relative_validity FROM v GROUP BY grp""")
def _(t):
    """From given edges (each point and the one before it) and given labels."""
    label = F.col("cluster")
    rows = labelled(t).withColumn("cluster", F.when((label == 9) | ((label == 3) & F.col("grp").contains("chat")), -1).otherwise(F.floor(label / 2)))
    before = Window.partitionBy("grp").orderBy("pid")
    edges = rows.select("grp", F.lag("pid").over(before).alias("u"), F.col("pid").alias("v"), vectors.l2_distance(F.lag("xs").over(before), F.col("xs")).alias("w"))
    marks = rows.select("grp", F.col("pid").alias("node"), "cluster", F.lit(1).alias("weight"))
    return quality.relative_validity(edges.filter("u IS NOT NULL"), marks).select("grp", r6("relative_validity"))


# --- neighbours and trees ---------------------------------------------------------------------

@query("knn_graph", "planted", f"""
WITH {DIST_SQL}
SELECT grp, pid, nbr, round(dist, 6) AS dist, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY grp, pid ORDER BY dist, nbr) AS rank FROM d) WHERE rank <= 5""")
def _(t):
    return knn.knn_graph(points(t), 5).select("grp", "pid", "nbr", r6("dist"), "rank")


CORE_SQL = """n AS (SELECT *, row_number() OVER (PARTITION BY grp, pid ORDER BY dist, nbr) AS rank FROM d),
c AS (SELECT grp, pid, dist AS core FROM n WHERE rank = 5)"""


@query("core_distances", "planted", f"WITH {DIST_SQL}, {CORE_SQL} SELECT grp, pid, round(core, 6) AS core FROM c")
def _(t):
    return knn.core_distances(points(t), 5).select("grp", "pid", r6("core"))


@query("mutual_reachability", "planted", f"""
WITH {DIST_SQL}, {CORE_SQL}
SELECT n.grp, n.pid, n.nbr, round(greatest(n.dist, a.core, b.core), 6) AS mreach FROM n
JOIN c a ON a.grp = n.grp AND a.pid = n.pid JOIN c b ON b.grp = n.grp AND b.pid = n.nbr WHERE n.rank <= 5""")
def _(t):
    rows = mst.mutual_reachability(knn.knn_graph(points(t), 5), knn.core_distances(points(t), 5))
    return rows.select("grp", "pid", "nbr", r6("mreach"))


@query("minimum_spanning_tree")
def _(t):
    return mst.minimum_spanning_tree(points(t), 5).select("grp", "u", "v", r6("w"))


@query("reduce_vectors")
def _(t):
    return reduce.reduce_vectors(points(t), 3).select("grp", "pid", micro("xs"))


@query("density_clusters")
def _(t):
    reduced = cut(reduce.reduce_vectors(points(t), 3))
    params = adaptive.density_params(F.lit(0), F.col("n_points"))
    found = clustering.cluster_groups(reduced, params["min_samples"], params["min_cluster_size"])
    return found.select("grp", "pid", "cluster", r6("probability"), r6("persistence"))


@query("trustworthiness", "planted", f"""
WITH {POINTS_SQL},
d AS (SELECT a.grp, a.pid, b.pid AS nbr, list_distance(a.xs, b.xs) AS far, list_distance(a.xs[1:3], b.xs[1:3]) AS near
  FROM p a JOIN p b ON a.grp = b.grp AND a.pid <> b.pid),
r AS (SELECT grp, pid, row_number() OVER (PARTITION BY grp, pid ORDER BY far, nbr) AS r_far, row_number() OVER (PARTITION BY grp, pid ORDER BY near, nbr) AS r_near FROM d),
s AS (SELECT grp, sum(greatest(r_far - 5, 0)) AS lost FROM r WHERE r_near <= 5 GROUP BY grp),
n AS (SELECT grp, COUNT(*) AS n FROM p GROUP BY grp)
SELECT grp, CAST(n AS INTEGER) AS n, round(1 - 2.0 * lost / (n * 5 * (2 * n - 16)), 6) AS trustworthiness FROM n JOIN s USING (grp)""")
def _(t):
    p = points(t)
    return quality.trustworthiness(p, p.withColumn("xs", F.slice("xs", 1, 3)), 5).select("grp", "n", r6("trustworthiness"))


# --- flat algorithms ----------------------------------------------------------------------------

@query("kmeans")
def _(t):
    p = points(t)
    return kmeans.assign(p, kmeans.fit(p, 5, 64)).select("grp", "pid", "cluster", r6("cost"))


@query("kmeans_step", "planted", f"""
WITH {POINTS_SQL},
f AS (SELECT grp, label, min(pid) AS pid FROM p GROUP BY grp, label),
c AS (SELECT f.grp, row_number() OVER (PARTITION BY f.grp ORDER BY f.label) - 1 AS cluster, p.xs AS centre FROM f JOIN p USING (grp, pid)),
a AS (SELECT p.grp, p.pid, p.xs, arg_min(c.cluster, list_distance(p.xs, c.centre)) AS cluster FROM p JOIN c USING (grp) GROUP BY ALL),
e AS (SELECT grp, cluster, generate_subscripts(xs, 1) AS i, unnest(xs) AS x FROM a),
m AS (SELECT grp, cluster, i, avg(x) AS x, COUNT(*) AS n FROM e GROUP BY ALL)
SELECT grp, CAST(cluster AS INTEGER) AS cluster, max(n) AS n,
  string_agg(CAST(CAST(round(x * 1e6) AS BIGINT) AS VARCHAR), ',' ORDER BY i) AS centre FROM m GROUP BY grp, cluster""")
def _(t):
    rows = labelled(t)
    firsts = rows.groupBy("grp", "cluster").agg(F.min_by("xs", "pid").alias("xs"))
    centres = firsts.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("cluster", "xs")))["xs"].alias("centres"))
    return kmeans.step(rows.select("grp", "pid", "xs"), centres, 64).select("grp", "cluster", "n", micro("centre"))


def _lloyd_sql(rounds: int) -> str:
    """Lloyd's rounds from given starts, the first point of each label: c0 the starts, a<i> the nearest of c<i>."""
    parts = ["""c0 AS (SELECT grp, label, row_number() OVER (PARTITION BY grp ORDER BY label) - 1 AS cluster, xs AS centre
  FROM (SELECT *, row_number() OVER (PARTITION BY grp, label ORDER BY pid) AS n FROM p) WHERE n = 1)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS (SELECT p.grp, p.pid, any_value(p.xs) AS xs, min({{'d': list_distance(p.xs, c.centre), 'c': c.cluster}}) AS near
  FROM p JOIN c{i} c USING (grp) GROUP BY p.grp, p.pid)""")
        if i < rounds:
            parts.append(f"""m{i} AS (SELECT grp, cluster, list(x ORDER BY k) AS centre FROM (SELECT grp, near.c AS cluster, k, avg(x) AS x
  FROM (SELECT grp, near, generate_subscripts(xs, 1) AS k, unnest(xs) AS x FROM a{i}) GROUP BY ALL) GROUP BY grp, cluster)""")
            parts.append(f"c{i + 1} AS (SELECT c.grp, c.cluster, coalesce(m.centre, c.centre) AS centre FROM c{i} c LEFT JOIN m{i} m USING (grp, cluster))")
    return f"""WITH {POINTS_SQL}, {", ".join(parts)}
SELECT grp, pid, CAST(near.c AS INTEGER) AS cluster, round(power(near.d, 2), 6) AS cost FROM a{rounds}"""


@query("kmeans_fit", "planted", _lloyd_sql(3))
def _(t):
    firsts = labelled(t).groupBy("grp", "cluster").agg(F.min_by("xs", "pid").alias("xs"))
    starts = firsts.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("cluster", "xs")))["xs"].alias("centres"))
    p = points(t)
    return kmeans.assign(p, kmeans.fit(p, 10, 64, iterations=3, starts=starts)).select("grp", "pid", "cluster", r6("cost"))


DBSCAN_SQL = f"""WITH RECURSIVE {DIST_SQL},
k AS (SELECT p.grp, p.pid, COUNT(d.nbr) + 1 >= 4 AS core FROM p LEFT JOIN d ON d.grp = p.grp AND d.pid = p.pid AND d.dist <= 0.27 GROUP BY ALL),
e AS (SELECT d.grp, d.pid, d.nbr FROM d JOIN k a ON a.grp = d.grp AND a.pid = d.pid AND a.core JOIN k b ON b.grp = d.grp AND b.pid = d.nbr AND b.core WHERE d.dist <= 0.27),
r AS (SELECT grp, pid, pid AS root FROM k WHERE core UNION SELECT e.grp, e.nbr, r.root FROM r JOIN e ON e.grp = r.grp AND e.pid = r.pid),
c AS (SELECT grp, pid, min(root) AS comp FROM r GROUP BY grp, pid),
b AS (SELECT d.grp, d.pid, arg_min(c.comp, (d.dist, d.nbr)) AS comp FROM d JOIN c ON c.grp = d.grp AND c.pid = d.nbr WHERE d.dist <= 0.27 GROUP BY d.grp, d.pid)
SELECT k.grp, k.pid, COALESCE(c.comp, b.comp) AS comp, k.core FROM k
LEFT JOIN c ON c.grp = k.grp AND c.pid = k.pid LEFT JOIN b ON b.grp = k.grp AND b.pid = k.pid"""


@query("dbscan", "planted", DBSCAN_SQL)
def _(t):
    return linkage.dbscan(points(t), eps=0.27, min_samples=4)


@query("agglomerative_cut", "planted", f"""
WITH RECURSIVE {DIST_SQL}, e AS (SELECT * FROM d WHERE dist <= 0.26),
r AS (SELECT grp, pid, pid AS root FROM p UNION SELECT e.grp, e.nbr, r.root FROM r JOIN e ON e.grp = r.grp AND e.pid = r.pid)
SELECT grp, pid, min(root) AS comp FROM r GROUP BY grp, pid""")
def _(t):
    return linkage.agglomerative(points(t), distance_threshold=0.26)


# The planted blobs lie five times as far apart as they are wide, so every method has to find the labels again.
BLOBS_SQL = f"""{POINTS_SQL}, b AS (SELECT grp, label, min(pid) AS comp, count(*) AS n FROM p GROUP BY grp, label),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY grp ORDER BY n DESC, comp) - 1 AS INTEGER) AS cluster FROM b)"""


@query("agglomerative_parts", "planted", f"WITH {BLOBS_SQL} SELECT grp, pid, cluster FROM p JOIN r USING (grp, label)")
def _(t):
    return linkage.numbered(linkage.agglomerative(points(t), n_clusters=5)).select("grp", "pid", "cluster")


@query("agglomerative_ward", "planted", f"WITH {BLOBS_SQL} SELECT grp, pid, comp FROM p JOIN r USING (grp, label)")
def _(t):
    return linkage.agglomerative(points(t), n_clusters=5, method="ward")


@query("agglomerative_average", "planted", f"WITH {BLOBS_SQL} SELECT grp, pid, comp FROM p JOIN r USING (grp, label)")
def _(t):
    return linkage.agglomerative(points(t), distance_threshold=0.8, method="average")


@query("kmeans_partition", "planted", f"WITH {BLOBS_SQL} SELECT grp, pid, comp FROM p JOIN r USING (grp, label)")
def _(t):
    found = kmeans.assign(points(t), kmeans.fit(points(t), 5, 64))
    return found.select("grp", "pid", F.min("pid").over(Window.partitionBy("grp", "cluster")).alias("comp"))


@query("density_blobs", "planted", f"WITH {BLOBS_SQL} SELECT grp, pid, cluster FROM p JOIN r USING (grp, label)")
def _(t):
    """Density clusters of the unreduced vectors."""
    size = F.greatest(F.lit(3), F.floor(F.col("n_points") / 12))
    return clustering.cluster_groups(points(t), 3, size).select("grp", "pid", "cluster")


CENTRE_SQL = f"""{POINTS_SQL}, e AS (SELECT grp, label, generate_subscripts(xs, 1) AS i, unnest(xs) AS x FROM p),
m AS (SELECT grp, label, i, avg(x) AS x FROM e GROUP BY ALL), c AS (SELECT grp, label, list(x ORDER BY i) AS centre FROM m GROUP BY ALL)"""


@query("intra_cluster_distance", "planted", f"""
WITH {CENTRE_SQL}, d AS (SELECT p.grp, p.label, list_distance(p.xs, c.centre) AS d FROM p JOIN c USING (grp, label))
SELECT grp, label AS cluster, round(avg(d), 6) AS mean_distance, round(max(d), 6) AS max_distance, round(stddev_pop(d), 6) AS std_distance,
  round(var_pop(d), 6) AS variance, COUNT(*) AS cluster_size FROM d GROUP BY grp, label""")
def _(t):
    rows = quality.intra_cluster_distance(labelled(t), 64)
    return rows.select("grp", "cluster", r6("mean_distance"), r6("max_distance"), r6("std_distance"), r6("variance"), "cluster_size")


@query("silhouette", "planted", f"""
WITH {POINTS_SQL},
d AS (SELECT a.grp, a.pid, a.label, b.label AS other, avg(power(list_distance(a.xs, b.xs), 2)) AS d FROM p a JOIN p b ON a.grp = b.grp AND a.pid <> b.pid GROUP BY ALL),
s AS (SELECT grp, pid, label, min(CASE WHEN other = label THEN d END) AS i, min(CASE WHEN other <> label THEN d END) AS o FROM d GROUP BY ALL),
x AS (SELECT grp, label, CASE WHEN i IS NULL OR o IS NULL THEN 0 ELSE (o - i) / greatest(o, i) END AS s FROM s)
SELECT grp, label AS cluster, round(avg(s), 6) AS score, COUNT(*) AS n FROM x GROUP BY grp, label
UNION ALL SELECT grp, NULL, round(avg(s), 6), COUNT(*) FROM x GROUP BY grp""")
def _(t):
    return quality.silhouette(labelled(t), 64).select("grp", "cluster", r6("score"), "n")


@query("silhouette_euclidean", "planted", f"""
WITH {POINTS_SQL},
d AS (SELECT a.grp, a.pid, a.label, b.label AS other, avg(list_distance(a.xs, b.xs)) AS d FROM p a JOIN p b ON a.grp = b.grp AND a.pid <> b.pid GROUP BY ALL),
s AS (SELECT grp, pid, label, min(CASE WHEN other = label THEN d END) AS i, min(CASE WHEN other <> label THEN d END) AS o FROM d GROUP BY ALL),
x AS (SELECT grp, label, CASE WHEN i IS NULL OR o IS NULL THEN 0 ELSE (o - i) / greatest(o, i) END AS s FROM s)
SELECT grp, label AS cluster, round(avg(s), 6) AS score, COUNT(*) AS n FROM x GROUP BY grp, label
UNION ALL SELECT grp, NULL, round(avg(s), 6), COUNT(*) FROM x GROUP BY grp""")
def _(t):
    return silhouettes.euclidean_silhouette(labelled(t), 64).select("grp", "cluster", r6("score"), "n")


@query("estimate_eps", "planted", f"""
WITH {DIST_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY grp, pid ORDER BY dist, nbr) AS rank FROM d)
SELECT grp, round(quantile_cont(dist, 0.95), 6) AS eps FROM n WHERE rank = 4 GROUP BY grp""")
def _(t):
    return knn.estimate_eps(points(t), 4).select("grp", r6("eps"))


@query("cluster_quotes", "planted", f"""
WITH {CENTRE_SQL}, d AS (SELECT p.grp, p.label, p.pid, round(list_distance(p.xs, c.centre), 9) AS d FROM p JOIN c USING (grp, label))
SELECT grp, label AS cluster, pid, round(d, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY grp, label ORDER BY d, pid) AS rank FROM d) WHERE rank <= 3""")
def _(t):
    return quality.nearest_to_centre(labelled(t), 64, 3).select("grp", "cluster", "pid", r6("distance"), "rank")


# --- recursion and jobs ---------------------------------------------------------------------------

@query("recursive_clusters")
def _(t):
    assignments, _ = clustering.recursive_clusters(t.planted)
    return assignments.select("feedback_id", "cluster_label", r6("probability"))


@query("cluster_hierarchy")
def _(t):
    _, hierarchy = clustering.recursive_clusters(t.planted)
    return hierarchy.select("parent_label", "depth", "n_points", "n_clusters", "neighbours.n_neighbors", "density.min_cluster_size",
                            "density.min_samples", r6("mean_persistence"), r6("noise_ratio"))


@query("quality_report")
def _(t):
    _, hierarchy = clustering.recursive_clusters(t.planted, clustering.ClusterSettings(measure_trust=True))
    return clustering.quality_report(hierarchy)


@query("simple_recluster")
def _(t):
    return clustering.simple_recluster(t.planted, max_depth=2, min_cluster_size=20, n_components=8)


@query("cluster_job")
def _(t):
    tables = clustering.cluster_job(t.planted, t.feedback, None, NOW, start=DAY1)
    return tables["clusters"].select("cluster_id", "cluster_description", "record_count", "source", "style", "cluster_depth")


@query("recluster_job")
def _(t):
    tables = clustering.recluster_job(t.planted, t.feedback, source="review", max_depth=1, min_cluster_size=10, n_components=8)
    return tables["analysis"]


@query("quarantine", "feedback", "SELECT feedback_id, feedback_source, 'no text' AS error FROM feedback WHERE feedback_text IS NULL")
def _(t):
    _, failed = split_failures(t.feedback, F.when(F.col("feedback_text").isNull(), "no text"))
    return failed.select("feedback_id", "feedback_source", "error")


WAITING_SQL = f"""w AS (SELECT f.* FROM feedback f LEFT JOIN inventory_info i ON i.sku = f.sku
  WHERE {CLEAN_SQL} AND f.feedback_id NOT IN (SELECT feedback_id FROM fb_embeddings))"""
_N_TAGS = " + ".join(f"regexp_matches(lower(feedback_text), '{p}')::INT" for _, p in RULES)


def _ingested(t):
    stored = t.embeddings.withColumn("feedback_text", F.lit(None).cast("string")).drop("label")
    return ingest.ingest_job(t.feedback, t.inventory, stored, t.ledger, t.tags, RULES, now=NOW, skip_embedded=True)


@query("ingest_stats", "feedback inventory_info fb_embeddings", f"""
WITH {WAITING_SQL}
SELECT COUNT(*) AS total_records, COUNT(*) AS embeddings_created, CAST(COALESCE(SUM(greatest({_N_TAGS}, 1)), 0) AS BIGINT) AS tags_created,
  CAST(0 AS BIGINT) AS errors, {sql_ts('MIN(created_at)')} AS first_at, {sql_ts('MAX(created_at)')} AS last_at FROM w""")
def _(t):
    return _ingested(t)["stats"].withColumn("first_at", ts("first_at")).withColumn("last_at", ts("last_at"))


@query("ingest_job", "feedback inventory_info fb_embeddings", f"""
WITH {WAITING_SQL}
SELECT feedback_id, {sql_ts("TIMESTAMP '" + NOW + "'")} AS embedded_at FROM w
UNION ALL SELECT feedback_id, {sql_ts('created_at')} FROM fb_embeddings""")
def _(t):
    return _ingested(t)["ledger"].withColumn("embedded_at", ts("embedded_at"))


@query("incremental_ingest", "feedback inventory_info", f"""
SELECT f.feedback_id, CASE WHEN f.created_at < TIMESTAMP '2024-01-02' THEN 1 ELSE 2 END AS run
FROM feedback f LEFT JOIN inventory_info i ON i.sku = f.sku WHERE {CLEAN_SQL}""")
def _(t):
    """Two runs over overlapping input and a third over the same input, which must add nothing."""
    none = t.ledger.filter("feedback_id IS NULL")
    first = increment(t.feedback.filter(F.col("created_at") < F.expr("TIMESTAMP_NTZ '2024-01-02'")), t.inventory, none)
    done = first.select("feedback_id")
    second = increment(t.feedback, t.inventory, done)
    done = done.unionByName(second.select("feedback_id"))
    third = increment(t.feedback, t.inventory, done)
    runs = [first, second, third]
    rows = [r.select("feedback_id", F.lit(i).alias("run")) for i, r in enumerate(runs, 1)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])
