"""Rules at the edges: whole answers, finite parts, ordered ties, no silent cuts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.functions import responses, text
from feedloom.operators import clean, density, kmeans, mst, quality, tagging, upsert, validate
from feedloom.session import cut

NAMES = ["Waterproof Leak", "Too Heavy", "Stains"]


@pytest.mark.parametrize(("answer", "want"), [
    ("heavy\n", "Too Heavy"), ("\n", "Waterproof Leak"), (" 'stains' \t", "Stains"), ("nothing", "Uncategorized"),
])
def test_single_tag_ignores_white_space(spark, answer, want):
    df = spark.createDataFrame([(answer,)], "response string")
    assert df.select(responses.single_tag(F.col("response"), NAMES)).head()[0] == want


@pytest.mark.parametrize(("answer", "want"), [
    ('[], "x": "too heavy"', ["Too Heavy"]), ('["Stains"]\n', ["Stains"]), ('["Stains"], ["Too Heavy"]', ["Stains"]), ("[]", ["Uncategorized"]),
])
def test_multi_tags_read_one_whole_list(spark, answer, want):
    df = spark.createDataFrame([(answer,)], "response string")
    assert df.select(responses.multi_tags(F.col("response"), NAMES)).head()[0] == want


def test_batch_of_single_tags(spark):
    items = spark.createDataFrame([(0, 0, i) for i in (1, 2, 3)], "shard int, batch int, position int")
    answers = spark.createDataFrame([(0, 0, '{"1": ["Nope", "Stains", "Too Heavy"], "2": "Too Heavy", "3": []}\n')], "shard int, batch int, response string")
    many, one = ({r.position: r.tags for r in tagging.parse_batch_responses(items, answers, NAMES, allow_multiple=m).collect()} for m in (True, False))
    assert many == {1: ["Stains", "Too Heavy"], 2: ["Too Heavy"], 3: ["Uncategorized"]}
    assert one == {1: ["Stains"], 2: ["Too Heavy"], 3: ["Uncategorized"]}


def test_prompts_carry_whole_texts(spark):
    rows = spark.createDataFrame([(0, 0, 1, "x" * 500)], "shard int, batch int, position int, feedback_text string")
    assert tagging.build_prompts(rows).head().block == "1. " + "x" * 500
    assert tagging.build_prompts(rows, 200).head().block == "1. " + "x" * 200
    assert rows.select(text.stripped(F.lit("  a b\r\n"))).head()[0] == "a b"


def test_vectors_have_finite_parts(spark):
    bad = [[float("nan"), 1.0], [float("inf"), 1.0], [None, 1.0]]
    rows = [(str(i), v, "m", "s", "x") for i, v in enumerate([[1.0, 2.0], *bad])]
    df = spark.createDataFrame(rows, "feedback_id string, vector array<double>, model string, source string, style string").withColumn("created_at", F.current_timestamp())
    got = {r.feedback_id: r.reason for r in validate.validate(df, "embedding", 2).collect()}
    assert "not finite" not in got["0"] and all("part not finite" in got[str(i)] for i in (1, 2, 3))


def test_browse_keeps_every_row(spark):
    rows = spark.range(1500).selectExpr("cast(id as string) feedback_id", "'t' feedback_text", "'review' feedback_source", "timestamp_ntz'2024-01-01' created_at", "'1' sku", "'c' category", "1 rating", "'k' cluster_id")
    inventory = spark.createDataFrame([("1", "S")], "sku string, style string")
    assert clean.browse_feedback(rows, inventory).count() == 1500 and clean.browse_feedback(rows, inventory, limit=10).count() == 10


def test_repeated_assignments_follow_the_order(spark):
    feedback = spark.createDataFrame([("a", "old"), ("b", "old")], "feedback_id string, cluster_id string")
    new = spark.createDataFrame([("a", "z", 1), ("a", "y", 2)], "feedback_id string, cluster_label string, turn int")
    assert {r.feedback_id: r.cluster_id for r in upsert.apply_assignments(feedback, new, ["turn"]).collect()} == {"a": "y", "b": "old"}
    assert {r.cluster_id for r in upsert.apply_assignments(feedback, new).collect()} == {"z", "old"}


def grid_points(spark, rng, n=110):
    xy = rng.integers(0, 15, (n, 2)).astype(float)
    return spark.createDataFrame([("g", f"p{i:03d}", list(map(float, v))) for i, v in enumerate(xy)], "grp string, pid string, xs array<double>")


def kruskal(ids, x, core):
    edges = sorted((max(float(np.sqrt(((x[i] - x[j]) ** 2).sum())), core[i], core[j]), *sorted((ids[i], ids[j]))) for i in range(len(ids)) for j in range(i))
    root, tree = {i: i for i in ids}, set()

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for _, a, b in edges:
        if find(a) != find(b):
            root[find(a)] = find(b)
            tree.add((a, b))
    return tree


def test_tree_of_tied_weights_is_the_same_for_any_block_size(spark):
    rng = np.random.default_rng(5)
    points = grid_points(spark, rng)
    trees = []
    for rows in (None, 16):
        parts = mst.spanning_trees(points, 4, rows)
        tree = next(p for p in parts if {"u", "v", "w"} <= set(p.columns))
        trees.append({(min(r.u, r.v), max(r.u, r.v)) for r in tree.collect()})
    assert trees[0] == trees[1]


def test_prim_follows_the_order_of_edges():
    rng = np.random.default_rng(2)
    x, core = rng.integers(0, 5, (40, 2)).astype(float), rng.integers(0, 3, 40).astype(float)
    ids = np.array([f"q{i}" for i in rng.permutation(40)], dtype=object)
    u, v, _ = mst.prim(x, core, ids)
    assert {tuple(sorted((ids[a], ids[b]))) for a, b in zip(u, v)} == kruskal(ids, x, core)


def test_density_clusters_of_tied_points(spark):
    rng = np.random.default_rng(1)
    grid = grid_points(spark, rng)
    same = spark.createDataFrame([("s", f"s{i}", [1.0, 0.0]) for i in range(30)], "grp string, pid string, xs array<double>")
    lattice = spark.createDataFrame([("l", f"l{i}", [float(i % 10), float(i // 10)]) for i in range(100)], "grp string, pid string, xs array<double>")
    points = grid.unionByName(same).unionByName(lattice)
    found = []
    for rows, local in ((None, 100_000), (16, 100_000), (None, 0)):
        edges, nodes, _ = mst.spanning_trees(points, 4, rows)
        nodes = cut(nodes.withColumn("min_cluster_size", F.lit(6)).withColumn("epsilon", F.lit(0.0)))
        labelled = density.density_clusters(edges, nodes, local).select("grp", "rid", "cluster", F.round("probability", 9), F.round("persistence", 9))
        found.append(sorted(map(tuple, labelled.collect()), key=str))
    assert found[0] == found[1] == found[2]
    assert {row[0] for row in found[0]} == {"g", "s", "l"}


def test_kmeans_runs_until_it_rests(spark):
    rng = np.random.default_rng(3)
    points = spark.createDataFrame([("g", f"p{i:04d}", [float(a), float(b)]) for i, (a, b) in enumerate(rng.random((300, 2)))], "grp string, pid string, xs array<double>")
    centres = kmeans.fit(points, 6, 2)
    again = kmeans.step(points, centres, 2)
    before = {i: c for r in centres.collect() for i, c in enumerate(r.centres)}
    assert all(np.allclose(before[r.cluster], r.centre, atol=1e-4) for r in again.collect())


def test_trustworthiness_tells_its_sample(spark):
    points = grid_points(spark, np.random.default_rng(6))
    assert [(r.n_group, r.n) for r in quality.trustworthiness(points, points, 5).collect()] == [(110, 110)]
    assert [(r.n_group, r.n) for r in quality.trustworthiness(points, points, 5, sample=50).collect()] == [(110, 50)]
