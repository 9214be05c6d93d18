"""Search against brute force, and the bucketed search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.operators import embed, search


@pytest.fixture(scope="module")
def stored(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8))
    x[50:150] = x[50]  # a third of the rows are copies of one vector
    x[7] = 0.0
    rows = [(f"{i:03d}", [float(v) for v in x[i]], ["review", "chat"][i % 2], None) for i in range(300)]
    return x, spark.createDataFrame(rows, "feedback_id string, vector array<float>, source string, style string").repartition(5)


def brute(x, q, k, keep=lambda i: True):
    x = x.astype(np.float32).astype(float)
    d = [(1 - x[i] @ q / (np.linalg.norm(x[i]) * np.linalg.norm(q)), f"{i:03d}") for i in range(len(x)) if np.any(x[i]) and keep(i)]
    d = [(round(a, 9), b) for a, b in d]
    return [b for _, b in sorted(d)[:k]]


def found(df):
    return [r.feedback_id for r in df.orderBy("rank").collect()]


def test_top_k(spark, stored):
    x, df = stored
    q = np.linspace(-1, 1, 8)
    assert found(search.search_by_vector(df, q, k=12)) == brute(x, q, 12)
    assert found(search.search_by_vector(df, q, k=5, source="chat")) == brute(x, q, 5, lambda i: i % 2 == 1)
    near = search.search_by_vector(df, q, k=300, threshold=0.6).collect()
    assert near and all(r.distance < 0.6 for r in near)
    assert search.search_by_vector(df, q, k=300, threshold=0).count() == 299


def test_by_id(spark, stored):
    x, df = stored
    hits = found(search.search_by_id(df, "003", k=3))
    assert hits[0] == "003" and "003" not in found(search.search_by_id(df, "003", k=3, exclude_self=True))
    assert search.search_by_id(df, "absent").count() == 0


def test_query_slices_give_the_same_hits(spark, stored, monkeypatch):
    _, df = stored
    queries = df.filter("feedback_id < '040' AND feedback_id <> '007'").select(F.col("feedback_id").alias("query_id"), "vector")
    rows = lambda d: sorted(tuple(r)[:2] + (r["rank"],) for r in d.collect())
    want = rows(search.search(df, queries, k=4))
    monkeypatch.setattr(search, "QUERIES_PER_SCAN", 10)
    assert rows(search.search(df, queries, k=4)) == want


def test_bucketed_search(spark, stored, tmp_path):
    x, df = stored
    centres = search.train_lists(df, lists=6)
    search.assign_lists(df, centres).write.partitionBy("list_id").parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    queries = df.filter("feedback_id < '030' AND feedback_id <> '007'").select(F.col("feedback_id").alias("query_id"), "vector")
    rows = lambda d: {(r.query_id, r.feedback_id) for r in d.collect()}
    exact = rows(search.search(df, queries, k=3))
    assert rows(search.ivf_search(index, centres, queries, k=3, probes=6)) == exact
    part = rows(search.ivf_search(index, centres, queries, k=3, probes=3))
    assert len(part & exact) / len(exact) > 0.6
    assert all((q, q) in part for q in {r.query_id for r in queries.collect()})


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_recall_of_the_registered_bucketed_search(spark, size):
    from checks import registry

    rows = lambda name: {(r.query_id, r.feedback_id) for r in registry.QUERIES[name](spark, f"/root/testdata/{size}").collect()}
    exact = rows("similar_feedback")
    assert len(rows("ivf_search") & exact) >= 0.9 * len(exact)


def test_text_embeddings(spark):
    rows = spark.createDataFrame([("a", "Leaking SHOES"), ("b", "shoes leaking!"), ("c", "..."), ("d", "tight toe")],
                                 "feedback_id string, feedback_text string")
    out = {r.feedback_id: np.array(r.vector) for r in embed.hash_embeddings(rows, 32).collect()}
    assert set(out) == {"a", "b", "d"} and np.allclose(out["a"], out["b"])
    assert all(abs(np.linalg.norm(v) - 1) < 1e-6 for v in out.values())
    hits = search.search_by_text(embed.hash_embeddings(rows, 32), spark.createDataFrame([("q", "LEAKING shoes")], "query_id string, feedback_text string"),
                                 lambda d: embed.hash_embeddings(d, 32), k=2)
    assert sorted(found(hits)) == ["a", "b"]


def test_many_small_blocks_give_the_same_hits(spark):
    rng = np.random.default_rng(17)
    x = np.concatenate([c + 0.2 * rng.normal(size=(60, 16)) for c in rng.normal(size=(6, 16))])
    x[100:160] = x[100]
    df = spark.createDataFrame([(f"{i:03d}", [float(v) for v in p]) for i, p in enumerate(x)], "feedback_id string, vector array<double>").repartition(4)
    queries = df.filter("feedback_id % 7 = 0").select(F.col("feedback_id").alias("query_id"), "vector")
    rows = lambda d: sorted((r.query_id, r["rank"], r.feedback_id) for r in d.collect())
    for options in ({}, {"threshold": 0.05}):
        want = rows(search.search(df, queries, k=5, **options))
        assert rows(search.search(df, queries, k=5, rows=20, **options)) == want and len(want) > 60
    assert rows(search.search(df, queries, k=400, rows=50)) == rows(search.search(df, queries, k=400)) and search.search(df, queries, k=400).count() == 52 * 360


def test_vectors_that_cannot_be_compared_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("z", [0.0, 0.0]), ("n", None), ("s", [1.0]), ("l", [1.0, 0.0, 0.0]), ("x", [nan, 1.0]), ("i", [inf, 1.0]), ("e", [None, 1.0])]
    df = spark.createDataFrame(rows, "feedback_id string, vector array<double>")
    queries = df.withColumnRenamed("feedback_id", "query_id")
    got = {(r.query_id, r.feedback_id) for r in search.search(df, queries.filter("query_id IN ('a', 'b', 'z', 'x')"), k=9).collect()}
    assert got == {(q, f) for q in "ab" for f in "ab"}
    assert search.search(df, queries.limit(0)).count() == 0 and search.search(df.limit(0), queries.limit(1)).count() == 0
    index = search.assign_lists(df, np.eye(2))
    assert {r.feedback_id for r in index.collect()} == {"a", "b"}


def test_stored_lists_are_exact_by_proof(spark, tmp_path):
    rng = np.random.default_rng(19)
    centres = rng.normal(size=(10, 12))
    x = np.concatenate([c + 0.15 * rng.normal(size=(40, 12)) for c in centres])
    df = spark.createDataFrame([(f"{i:03d}", [float(v) for v in p]) for i, p in enumerate(x)], "feedback_id string, vector array<double>")
    lists = search.StoredLists.write(df, str(tmp_path / "index"), 10)
    again = search.StoredLists.open(spark, str(tmp_path / "index"))
    queries = df.filter("feedback_id % 20 = 0").select(F.col("feedback_id").alias("query_id"), "vector")
    rows = lambda d: sorted((r.query_id, r["rank"], r.feedback_id) for r in d.collect())
    want = rows(search.search(df, queries, k=6))
    assert rows(again.search(queries, k=6)) == want and again.share(queries, k=6) < 0.5
    assert rows(again.search(queries, k=6, probes=10)) == want and again.share(queries, probes=10) == 1.0
    assert rows(again.search(queries, k=60)) == rows(search.search(df, queries, k=60))  # more than a list holds
    assert int(lists.sizes.sum()) == 400 and (again.radii == lists.radii).all()


def test_only_the_folders_of_the_lists_are_read(spark, tmp_path):
    rng = np.random.default_rng(23)
    df = spark.createDataFrame([(f"{i:03d}", [float(v) for v in rng.normal(size=6)]) for i in range(200)], "feedback_id string, vector array<double>")
    lists = search.StoredLists.write(df, str(tmp_path / "index"), 8)
    plan = lists.index.filter(F.col("list_id").isin([1, 2]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [list_id" in plan
    one = df.limit(1).select(F.col("feedback_id").alias("query_id"), "vector")
    assert lists.search(one, k=3, probes=2).count() == 3 and 0 < lists.share(one, probes=2) < 0.6
