"""The leaf tree as a table: numbers, merges, ancestors and selection against the versions inside one task."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from feedloom.operators import density, leaftree, mst
from feedloom.operators.numbering import ranked
from feedloom.session import cut


def test_numbers_of_a_hot_group(spark):
    rows = [("hot", i * 7919 % 3001) for i in range(3000)] + [(f"g{i % 40}", i) for i in range(200)] + [(None, i) for i in range(3)]
    rows = spark.createDataFrame(rows, "grp string, v int")
    got = ranked(rows, ["grp"], ["v"]).toPandas()
    want = got.sort_values("v").groupby("grp", dropna=False).cumcount() + 1
    assert len(got) == 3203 and (got["pos"] == want.sort_index()).all()
    assert ranked(rows.limit(0), ["grp"], ["v"]).count() == 0


def trees(rng):
    """Trees over up to 60 leaves: falling, rising and mixed paths, a star, a brush, random ones."""
    out = {"pair": [(0, 1)], "rising": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 50)],
           "brush": [(i, i + 1) for i in range(20)] + [(i, 40 + i) for i in range(20)]}
    order = {name: list(range(len(edges))) for name, edges in out.items()}
    out["zigzag"], order["zigzag"] = out["rising"], [i // 2 if i % 2 else 59 - i // 2 for i in range(60)]
    for n in (3, 17, 60):
        out[f"random{n}"] = [(int(rng.integers(0, i)), i) for i in range(1, n)]
        order[f"random{n}"] = rng.permutation(n - 1).tolist()
    return [(name, r + 1, -a - 1, -b - 1) for name, edges in out.items() for r, (a, b) in zip(order[name], edges)]


@pytest.mark.parametrize("local", [1, 9])
def test_merges_in_rounds(spark, local):
    rows = pd.DataFrame(trees(np.random.default_rng(4)), columns=["grp", "r", "a", "b"])
    want = pd.concat([leaftree._merge_here(part) for _, part in rows.groupby("grp")])
    got = leaftree.merge_tree(spark.createDataFrame(rows, "grp string, r long, a long, b long"), local).toPandas()
    assert sorted(map(tuple, got.values)) == sorted(map(tuple, want.values))


def test_ancestors_sums_and_scores(spark):
    rng = np.random.default_rng(5)
    rows = pd.DataFrame(trees(rng), columns=["grp", "r", "a", "b"])
    tree = pd.concat([leaftree._merge_here(part) for _, part in rows.groupby("grp")])
    parent = {(g, n): up for g, n, up in tree.itertuples(index=False)}
    nodes = sorted(set(parent) | {(g, up) for (g, _), up in parent.items()}, key=lambda x: (x[0], x[1]))
    own = {x: float(v) for x, v in zip(nodes, rng.integers(0, 30, len(nodes)))}
    chosen = {x: bool(v) for x, v in zip(nodes, rng.random(len(nodes)) < 0.3)}
    total, low, score, kids = dict(own), dict(own), {}, {}
    for g, n in nodes:  # numbers rise towards the root
        below = kids.get((g, n), [])
        score[g, n] = max(own[g, n], sum(score[g, c] for c in below)) if below else own[g, n]
        if (g, n) in parent:
            up = (g, parent[g, n])
            total[up] += total[g, n]
            low[up] = min(low[up], low[g, n])
            kids.setdefault(up, []).append(n)

    def path(x):
        while x in parent:
            yield x
            x = (x[0], parent[x])
        yield x

    steps = leaftree.steps_up(cut(spark.createDataFrame(tree, leaftree.NODES)))
    frame = cut(spark.createDataFrame([(g, n, own[g, n], own[g, n], chosen[g, n], *sorted(kids.get((g, n), [None, None]), key=str)) for g, n in nodes],
                                      "grp string, node long, total double, low double, chosen boolean, x long, y long"))
    sums = leaftree.subtree_sums(frame.select("grp", "node", "total", "low"), steps).collect()
    assert {(r.grp, r.node): (r.total, r.low) for r in sums} == {x: (total[x], low[x]) for x in nodes}
    tops = leaftree.topmost(frame, steps).collect()
    assert {(r.grp, r.node): r.top for r in tops} == {x: next((p[1] for p in reversed(list(path(x))) if chosen[p]), None) for x in nodes}
    found = leaftree.best_scores(frame.select("grp", "node", F.col("total").alias("own"), "x", "y")).collect()
    assert {(r.grp, r.node): r.score for r in found} == score
    rows = frame.select("grp", "node", F.col("node").alias("at"), F.lit(11).alias("bound"))
    far = leaftree.climb(rows, steps, F.col("up") < F.col("bound")).collect()
    assert len(far) == len(nodes)
    for r in far:
        assert r["at"] == [p[1] for p in path((r.grp, r.node)) if p[1] < 11 or p[1] == r.node][-1]


@pytest.mark.parametrize("epsilon", [0.0, 0.12])
def test_labels_of_many_leaves(spark, epsilon):
    rng = np.random.default_rng(9)
    centres = rng.random((30, 2)) * 6
    rows = [("a", centres[i % 30] + rng.normal(0, 0.05 + 0.01 * (i % 7), 2)) for i in range(420)]
    rows += [("line", np.array([0.01 * i * i, 0.0])) for i in range(60)] + [("grid", np.array([i % 9, i // 9])) for i in range(81)]
    rows += [("same", np.zeros(2))] * 20 + [("copies", np.array([i % 4, 0.0])) for i in range(40)]
    points = spark.createDataFrame([(g, f"p{i:04d}", [float(v) for v in x]) for i, (g, x) in enumerate(rows)], "grp string, pid string, xs array<double>")
    edges, nodes, _ = mst.spanning_trees(cut(points), 3)
    edges, nodes = cut(edges), cut(nodes.withColumn("min_cluster_size", F.lit(3)).withColumn("epsilon", F.lit(epsilon)))
    found = []
    for bounds in ((100_000,), (0, 10**6), (0, 0, 4)):
        labelled = density.density_clusters(edges, nodes, *bounds).select(
            "grp", "rid", "weight", "cluster", F.round("probability", 8), F.round("persistence", 8))
        found.append(sorted(map(tuple, labelled.collect()), key=str))
    assert len({row[3] for row in found[0] if row[0] == "a"}) > 20
    assert found[0] == found[1] == found[2]
