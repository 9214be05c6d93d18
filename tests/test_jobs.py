"""Recursive clustering, the jobs around it, and restart-safe ingest."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.pairs_text import RULES
from feedloom.plans import clustering, ingest
from feedloom.plans.clusterer import Clusterer
from feedloom.session import cut
from feedloom.streaming import incremental

NOW = "2024-02-01 00:00:00"


def blobs(spark):
    """Two big slices of three blobs, each blob of two halves; a small slice; rows without a style; a zero vector."""
    rng = np.random.default_rng(8)
    rows = []
    for source in ("review", "chat"):
        for i in range(180):
            centre = np.zeros(6)
            centre[i % 3] = 4
            centre[3 + (i // 3) % 2] = 1.2
            rows.append((f"{source}{i:03d}", source, "Weekend", centre + rng.normal(size=6) * 0.05))
    rows += [(f"small{i}", "return", "Weekend", rng.normal(size=6)) for i in range(20)]
    rows += [(f"none{i}", "review", None, rng.normal(size=6)) for i in range(60)]
    rows += [("zero", "review", "Weekend", np.zeros(6))]
    data = [(f, s, t, [float(x) for x in v]) for f, s, t, v in rows]
    return cut(spark.createDataFrame(data, "feedback_id string, source string, style string, vector array<double>").withColumn(
        "created_at", F.expr("TIMESTAMP_NTZ '2024-01-05 00:00:00'")))


@pytest.fixture(scope="module")
def embeddings(spark):
    return blobs(spark)


def test_recursion(spark, embeddings):
    settings = clustering.ClusterSettings(max_depth=2, n_components=4)
    assignments, hierarchy = clustering.recursive_clusters(embeddings, settings)
    rows = {r.feedback_id: r.cluster_label for r in assignments.collect()}
    assert len(rows) == embeddings.count() == assignments.count()
    # too few points: the bare slice; no style or no direction: unclustered
    assert {rows[f"small{i}"] for i in range(20)} == {"source_return.style_Weekend"}
    assert {rows[f"none{i}"] for i in range(60)} == {"source_review.style_none.unclustered"}
    assert rows["zero"] == "source_review.style_Weekend.unclustered"
    # every label belongs to one blob
    for source in ("review", "chat"):
        seen = {}
        for i in range(180):
            label = rows[f"{source}{i:03d}"]
            assert label.startswith(f"source_{source}.style_Weekend.")
            if not label.endswith("noise"):
                seen.setdefault(label.split(".")[2], set()).add((i % 3, (i // 3) % 2))
        assert len(seen) >= 3
        assert all(len({b for b, _ in v}) == 1 for v in seen.values())
    tree = {r.parent_label: r for r in hierarchy.collect()}
    top = tree["source_chat.style_Weekend"]
    assert (top.depth, top.n_points) == (0, 180) and top.density.min_cluster_size == 8 and top.n_clusters >= 2


def test_cluster_job_writes_back(spark, embeddings):
    feedback = embeddings.select("feedback_id", F.lit("old").alias("cluster_id")).unionByName(
        spark.createDataFrame([("other", "kept")], "feedback_id string, cluster_id string"))
    out = clustering.cluster_job(embeddings, feedback, None, NOW, start="2024-01-01 00:00:00",
                                 settings=clustering.ClusterSettings(max_depth=1))
    clusters = {r.cluster_id: r for r in out["clusters"].collect()}
    assert sum(r.record_count for r in clusters.values()) == embeddings.count()
    assert all(len(r.sample_feedback_ids.split(",")) == min(50, r.record_count) for r in clusters.values())
    ids = {r.feedback_id: r.cluster_id for r in out["feedback"].collect()}
    assert ids["other"] == "kept" and "old" not in ids.values() and set(ids.values()) - {"kept"} == set(clusters)
    told = clustering.cluster_job(embeddings, feedback.withColumn("feedback_text", F.concat(F.lit("word"), "feedback_id")), None, NOW,
                                  start="2024-01-01 00:00:00", settings=clustering.ClusterSettings(max_depth=1))
    assert all(r.cluster_description.startswith("word") for r in told["clusters"].collect())


def test_simple_recluster(spark, embeddings):
    out = clustering.recluster_job(embeddings, embeddings.withColumn("feedback_text", F.col("feedback_id")), source="chat",
                                   max_depth=1, min_cluster_size=20, min_samples=5, n_components=4)
    labels = {r.cluster_label: r["count"] for r in out["counts"].collect()}
    assert sum(labels.values()) == 180 and all(k.startswith("root.") for k in labels)
    assert all(r.sample_1 for r in out["analysis"].collect())


def test_clusterer_front(spark):
    for bad, message in (({"algorithm": "kmeans"}, "n_clusters required for kmeans"), ({"algorithm": "dbscan"}, "eps .* required for DBSCAN"),
                         ({"algorithm": "x"}, "Unsupported algorithm")):
        with pytest.raises(ValueError, match=message):
            Clusterer(**bad)
    rows = spark.createDataFrame([(f"p{i}", [0.0, 0.0] if i < 5 else [10.0, 10.0]) for i in range(10)], "feedback_id string, vector array<double>")
    one = Clusterer("kmeans", n_clusters=2)
    assert {r["count"] for r in one.fit_predict(rows).groupBy("cluster").count().collect()} == {5}
    assert sorted(tuple(r.centre) for r in one.get_cluster_centers().collect()) == [(0.0, 0.0), (10.0, 10.0)]
    assert [r["count"] for r in one.get_cluster_stats().collect()] == [5, 5]
    assert {(r.cluster_size, r.mean_distance, r.std_distance) for r in one.calculate_intra_cluster_distances().collect()} == {(5, 0.0, 0.0)}
    scores = one.calculate_silhouette_scores().collect()
    assert len(scores) == 3 and all(r.score == 1.0 for r in scores)
    dense = Clusterer("dbscan", eps=0.5, min_samples=3).fit_predict(rows)
    assert {r["count"] for r in dense.groupBy("cluster").count().collect()} == {5}
    line = spark.createDataFrame([(f"p{i:02d}", [float(i), float(i)]) for i in range(20)], "feedback_id string, vector array<double>")
    assert Clusterer.estimate_eps_from_data(line, percentile=95, k=4) > 0


def test_ingest_options(spark, tables):
    stored = tables.embeddings.withColumn("feedback_text", F.lit(None).cast("string")).drop("label").limit(0)
    run = lambda **o: ingest.ingest_job(
        tables.feedback, tables.inventory, stored, tables.ledger.limit(0), tables.tags, RULES, now=NOW, **o)
    full = run()["stats"].head()
    assert full.total_records == full.embeddings_created > 100 and full.tags_created >= full.total_records and full.errors == 0
    only = run(embeddings_only=True, limit=7)
    assert tuple(only["stats"].head())[:4] == (7, 7, 0, 0)
    assert only["tags"].count() == tables.tags.count()
    assert run(days_back=1)["stats"].head().total_records == 0


def test_stream_is_restart_safe(spark, tables, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "state")
    feedback = tables.feedback
    feedback.filter("created_at < TIMESTAMP_NTZ '2024-01-03'").write.parquet(source)
    inventory = cut(tables.inventory)
    go = lambda: incremental.run_available(spark, source, root, inventory, RULES, lambda b: f"2024-02-0{b + 1} 00:00:00").awaitTermination()
    go()
    first = spark.read.parquet(f"{root}/ledger").count()
    feedback.write.mode("append").parquet(source)  # everything again, old rows included
    go()
    go()
    ledger = spark.read.parquet(f"{root}/ledger")
    want = incremental.increment(feedback, inventory, tables.ledger.limit(0)).select("feedback_id")
    assert 0 < first < ledger.count() == ledger.select("feedback_id").distinct().count() == want.count()
    assert want.join(ledger, "feedback_id", "left_anti").count() == 0
    n_embedded = spark.read.parquet(f"{root}/embeddings").select("feedback_id").distinct().count()
    n_wanted = want.count()
    # a replayed batch leaves the same rows
    incremental.ingest_batch(root, inventory, RULES, lambda b: f"2024-02-0{b + 1} 00:00:00")(feedback, 1)
    again = spark.read.parquet(f"{root}/embeddings")
    assert again.count() == n_embedded == n_wanted


def test_a_batch_reads_only_its_buckets(spark, tables, tmp_path):
    root = str(tmp_path)
    rows = cut(tables.feedback)
    inventory = cut(tables.inventory)
    run = incremental.ingest_batch(root, inventory, RULES, lambda b: f"2024-02-{b + 1:02d} 00:00:00", buckets=16)
    halves = [rows.filter(F.pmod(F.xxhash64("feedback_id"), F.lit(3)) == i) for i in range(3)]
    for i, part in enumerate(halves):
        run(part, i)
    one = rows.limit(1)
    known = incremental.known_ids(spark, root, 9, one, 16)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "1 paths" in plan and known.count() < spark.read.parquet(f"{root}/ledger").count()
    ledger = lambda: sorted((r.feedback_id, str(r.embedded_at)) for r in spark.read.parquet(f"{root}/ledger").collect())
    before = ledger()
    run(halves[1], 1)  # replayed
    assert ledger() == before and len(before) == len({i for i, _ in before})
    incremental.compact_ledger(spark, root, 2)
    assert ledger() == before and {r.batch for r in spark.read.parquet(f"{root}/ledger").select("batch").distinct().collect()} == {-1, 2}
    run(rows, 3)  # nothing is new
    assert ledger() == before and spark.read.parquet(f"{root}/embeddings/batch=3").count() == 0
    incremental.compact_ledger(spark, root, 4)
    assert ledger() == before and {r.batch for r in spark.read.parquet(f"{root}/ledger").select("batch").distinct().collect()} == {-2}
    # a replay that finds less leaves no id behind
    run(halves[0].limit(0), 3)
    assert ledger() == before
