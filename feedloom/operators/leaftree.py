"""The tree over leaf clusters as a table, for groups with any number of leaves.

Input are the edges between the leaves, a spanning tree.  In order of length every edge merges two clusters, so the
merges are nodes.  Leaves have negative numbers, merges their rank in that order; hence numbers rise towards the root.

Merges form chains, in which each one adds a single leaf, and the few that join two chains.  The latter are the
edges that are least for neither of their ends; they are at most half, and their own tree is found first, the same
way.  All other merges are then sorted into its branches.  So the rounds grow with the logarithm of the leaves, however
deep the tree is.  Questions about ancestors are answered by tables of 1, 2, 4, ... steps up.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.numbering import ranked
from feedloom.session import cut

LOCAL_MERGES = 100_000  # a tree with fewer merges is built inside one task
NODES = "grp string, node long, up long"


# --- the merges --------------------------------------------------------------------------------

def _merge_here(edges: pd.DataFrame) -> pd.DataFrame:
    """The tree of one group by union-find, edges taken in order."""
    edges = edges.sort_values("r")
    above: dict[int, int] = {}   # union-find over leaves
    top: dict[int, int] = {}     # its roots -> node of the tree
    nodes, ups = [], []

    def find(x: int) -> int:
        while above.setdefault(x, x) != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    for r, a, b in zip(edges["r"].tolist(), edges["a"].tolist(), edges["b"].tolist()):
        a, b = find(a), find(b)
        nodes += [top.get(a, a), top.get(b, b)]
        ups += [r, r]
        above[b] = a
        top[a] = r
    return pd.DataFrame({"grp": edges["grp"].iloc[0], "node": nodes, "up": ups})


def _gathered(own: DataFrame) -> DataFrame:
    """(grp, c, root): what hangs together if every end follows its least edge (grp, c, r, to)."""
    back = own.select("grp", F.col("c").alias("to"), F.col("r").alias("back"))
    # two ends that follow the same edge to each other: the lesser one stays
    stays = (F.col("r") == F.col("back")) & (F.col("c") < F.col("to"))
    state = cut(own.join(back, ["grp", "to"]).select("grp", "c", F.when(stays, F.col("c")).otherwise(F.col("to")).alias("root")))
    while True:
        on = state.select("grp", F.col("c").alias("root"), F.col("root").alias("next"))
        moved = cut(state.join(on, ["grp", "root"]).select("grp", "c", "root", "next"))
        state = moved.select("grp", "c", F.col("next").alias("root"))
        if not moved.filter("root <> next").head(1):
            return state


def merge_tree(edges: DataFrame, local: int = LOCAL_MERGES) -> DataFrame:
    """(grp, node, up) for every leaf and merge but the last, from edges (grp, r, a, b) between leaves."""
    edges = cut(edges.select("grp", "r", "a", "b"))
    sizes = cut(edges.groupBy("grp").agg(F.count("*").alias("n")))
    found = edges.join(sizes.filter(F.col("n") <= local), "grp", "left_semi").groupBy("grp").applyInPandas(_merge_here, NODES)
    large = sizes.filter(F.col("n") > local)
    if not large.head(1):
        return cut(found)
    many = edges.join(large, "grp", "left_semi")
    ends = many.select("grp", F.col("a").alias("c"), "r", F.col("b").alias("to")).unionByName(
        many.select("grp", F.col("b").alias("c"), "r", F.col("a").alias("to")))
    own = cut(ends.groupBy("grp", "c").agg(F.min(F.struct("r", "to")).alias("e")).select("grp", "c", "e.r", "e.to"))
    roots = _gathered(own)
    chained = own.select("grp", "r").distinct()
    a, b = roots.withColumnsRenamed({"c": "a", "root": "ra"}), roots.withColumnsRenamed({"c": "b", "root": "rb"})
    joints = many.join(chained, ["grp", "r"], "left_anti").join(a, ["grp", "a"]).join(b, ["grp", "b"])
    frame = merge_tree(joints.select("grp", "r", F.col("ra").alias("a"), F.col("rb").alias("b")), local)
    # the branch of the frame that a chained merge lies on is named by the node at its lower end
    inner = own.join(roots, ["grp", "c"]).groupBy("grp", "r").agg(F.first("root").alias("at"))
    inner = climb(inner, steps_up(frame), F.col("up") < F.col("r"))
    placed = cut(ranked(inner, ["grp", "at"], ["r"]))
    after = placed.select("grp", "at", (F.col("pos") - 1).alias("pos"), F.col("r").alias("next"))
    ahead = frame.withColumnsRenamed({"node": "at"})
    chains = placed.join(after, ["grp", "at", "pos"], "left").join(ahead, ["grp", "at"], "left").select(
        "grp", F.col("r").alias("node"), F.coalesce("next", "up").alias("up")).filter("up IS NOT NULL")
    lowest = placed.filter("pos = 1 AND at > 0").select("grp", F.col("at").alias("node"), F.col("r").alias("up"))
    others = frame.filter("node > 0").join(lowest, ["grp", "node"], "left_anti").select("grp", "node", "up")
    leaves = own.select("grp", F.col("c").alias("node"), F.col("r").alias("up"))
    return cut(found.unionByName(leaves).unionByName(chains).unionByName(lowest).unionByName(others))


# --- ancestors -----------------------------------------------------------------------------------

def steps_up(tree: DataFrame) -> list[DataFrame]:
    """Tables (grp, node, up, ...) of the ancestors 1, 2, 4, ... steps up; further columns of `tree` describe `up`."""
    told = [c for c in tree.columns if c not in ("grp", "node")]
    tables = []
    step = tree
    while step.head(1):
        tables.append(step)
        on = step.withColumnsRenamed({"node": "mid"})
        step = cut(step.select("grp", "node", F.col("up").alias("mid")).join(on, ["grp", "mid"]).select("grp", "node", *told))
    return tables


def climb(rows: DataFrame, steps: list[DataFrame], further: Column) -> DataFrame:
    """`rows` with `at` moved to its highest ancestor up to which `further` holds.

    `further` reads the columns of the steps and of `rows`; towards the root it may turn false once only.
    """
    if not steps:
        return cut(rows)
    kept = [c for c in rows.columns if c != "at"]
    # most rows stay where they are: only those that take a first step go on
    first = cut(rows.join(steps[0].withColumnsRenamed({"node": "at"}), ["grp", "at"], "left")
                .select(*kept, "at", F.coalesce(further, F.lit(False)).alias("_moves")))
    moving = first.filter("_moves").drop("_moves")
    for step in reversed(steps):
        moving = moving.join(step.withColumnsRenamed({"node": "at"}), ["grp", "at"], "left").select(
            *kept, F.when(further, F.col("up")).otherwise(F.col("at")).alias("at"))
    return cut(first.filter("NOT _moves").drop("_moves").unionByName(moving))


def subtree_sums(own: DataFrame, steps: list[DataFrame]) -> DataFrame:
    """(grp, node, total, low): sum and least value of (grp, node, total, low) over each node and all below it."""
    for step in steps:
        sent = own.join(step, ["grp", "node"]).select("grp", F.col("up").alias("node"), "total", "low")
        own = cut(own.unionByName(sent).groupBy("grp", "node").agg(F.sum("total").alias("total"), F.min("low").alias("low")))
    return own


def topmost(nodes: DataFrame, steps: list[DataFrame]) -> DataFrame:
    """(grp, node, top): the highest chosen one of a node and its ancestors, null without any; `nodes`: (grp, node, chosen)."""
    state = cut(nodes.select("grp", "node", F.when(F.col("chosen"), F.col("node")).alias("top")))
    for step in steps:
        over = state.select("grp", F.col("node").alias("up"), F.col("top").alias("over"))
        ups = step.select("grp", "node", "up").join(over, ["grp", "up"])
        state = cut(state.join(ups, ["grp", "node"], "left").select("grp", "node", F.coalesce("over", "top").alias("top")))
    return state


def best_scores(nodes: DataFrame) -> DataFrame:
    """(grp, node, score) with score = the greater of `own` and the scores of both children together.

    `nodes` is (grp, node, own, x, y), children null at leaves.  A node's score is kept as max(a, b + score(x) + score(y)).
    Every round puts in the scores that are known by now, and where one child is left and hangs on one child itself,
    the child's formula; so long chains halve.
    """
    leaf = F.col("x").isNull()
    state = cut(nodes.select("grp", "node", F.col("own").alias("a"), F.lit(0.0).alias("b"), "x", "y",
                             F.when(leaf, F.col("own")).alias("score")))
    while state.filter("score IS NULL").head(1):
        def child(name: str) -> DataFrame:
            return state.select("grp", F.col("node").alias(name), F.struct(
                "a", "b", "score", F.coalesce("x", "y").alias("on"),
                (F.col("score").isNull() & (F.col("x").isNull() | F.col("y").isNull())).alias("single")).alias(f"{name}_"))

        open_ = state.filter("score IS NULL").drop("score").join(child("x"), ["grp", "x"], "left").join(child("y"), ["grp", "y"], "left")
        known = lambda c: F.coalesce(F.col(f"{c}_.score"), F.lit(0.0))
        left = lambda c: F.when(F.col(f"{c}_.score").isNull(), F.col(c))
        put = open_.select("grp", "node", "a", (F.col("b") + known("x") + known("y")).alias("b"), left("x").alias("x"), left("y").alias("y"), "x_", "y_")
        last = F.when(F.col("x").isNull(), F.col("y_")).when(F.col("y").isNull(), F.col("x_"))
        put = put.withColumn("last", last).withColumn("follow", F.coalesce(F.col("last.single"), F.lit(False)))
        put = put.select(
            "grp", "node",
            F.when(F.col("follow"), F.greatest(F.col("a"), F.col("b") + F.col("last.a"))).otherwise(F.col("a")).alias("a"),
            F.when(F.col("follow"), F.col("b") + F.col("last.b")).otherwise(F.col("b")).alias("b"),
            F.when(F.col("follow"), F.col("last.on")).otherwise(F.col("x")).alias("x"),
            F.when(~F.col("follow"), F.col("y")).alias("y"),
        )
        done = F.col("x").isNull() & F.col("y").isNull()
        put = put.withColumn("score", F.when(done, F.greatest("a", "b")))
        state = cut(state.filter("score IS NOT NULL").unionByName(put))
    return state.select("grp", "node", "score")


# --- selection --------------------------------------------------------------------------------------

def leaf_clusters(between: DataFrame, joined: DataFrame, params: DataFrame, least_weight: float, local: int = LOCAL_MERGES) -> DataFrame:
    """(grp, rid, weight, lam, cluster, greatest, persistence): the chosen cluster, -1 for none, of every point in a leaf.

    `between`: edges (grp, u, v, w, lo, hi) between leaves, `joined`: points (grp, rid, weight, leaf, w), `params`: (grp, epsilon).
    """
    edges = cut(ranked(between, ["grp"], ["w", "lo", "hi"], "r"))
    names = edges.select("grp", F.col("u").alias("leaf")).unionByName(edges.select("grp", F.col("v").alias("leaf"))).distinct()
    names = cut(ranked(names, ["grp"], ["leaf"], "n").select("grp", "leaf", (-F.col("n")).cast("long").alias("at")))
    a, b = names.withColumnsRenamed({"leaf": "u", "at": "a"}), names.withColumnsRenamed({"leaf": "v", "at": "b"})
    merges = edges.select("grp", F.col("r").alias("up"), F.col("w").alias("up_w"))
    tree = merge_tree(edges.join(a, ["grp", "u"]).join(b, ["grp", "v"]).select("grp", "r", "a", "b"), local)
    roots = edges.groupBy("grp").agg(F.max("r").alias("root"))
    tree = cut(tree.join(merges, ["grp", "up"]).join(roots, "grp").join(params, "grp").select(
        "grp", "node", "up", "up_w", (F.col("up") == F.col("root")).alias("to_root"), "epsilon"))
    steps = steps_up(tree)

    # a point is held by the highest cluster that was there when the point joined
    density = lambda w: 1.0 / F.greatest(w, F.lit(least_weight))
    points = joined.join(names, ["grp", "leaf"]).select("grp", "rid", "weight", "w", "at")
    held = climb(points, steps, F.col("up_w") <= F.col("w")).select("grp", "rid", "weight", F.col("at").alias("node"), density(F.col("w")).alias("lam"))
    own = held.groupBy("grp", "node").agg(
        F.sum("weight").alias("count"), F.sum(F.col("weight") * F.col("lam")).alias("lam_sum"), F.max("lam").alias("lam_max"), F.min("rid").alias("low"))
    met = edges.select("grp", F.col("r").alias("node"), density(F.col("w")).alias("met"))
    every = names.select("grp", F.col("at").alias("node")).unionByName(met.select("grp", "node"))
    sides = tree.groupBy("grp", F.col("up").alias("node")).agg(F.min("node").alias("x"), F.max("node").alias("y"))
    born = tree.select("grp", "node", density(F.col("up_w")).alias("born"))
    nodes = cut(every.join(own, ["grp", "node"], "left").join(met, ["grp", "node"], "left").join(born, ["grp", "node"], "left")
                .join(sides, ["grp", "node"], "left").fillna(0, ["count"]).fillna(0.0, ["lam_sum", "lam_max"]))
    sums = subtree_sums(nodes.select("grp", "node", F.col("count").alias("total"), "low"), steps)
    bear = F.coalesce("born", F.lit(0.0))
    inner = F.when(F.col("met").isNotNull(), (F.col("total") - F.col("count")) * (F.col("met") - bear)).otherwise(0.0)
    nodes = cut(nodes.drop("low").join(sums, ["grp", "node"]).select(
        "grp", "node", "x", "y", "total", "low", F.col("born").isNull().alias("is_root"),
        (F.col("lam_sum") - F.col("count") * bear + inner).alias("stability"),
        F.greatest("lam_max", F.coalesce("met", F.lit(0.0))).alias("peak")))

    # excess of mass: a cluster is chosen if it outlasts what is chosen below; the root never is
    scores = best_scores(nodes.select("grp", "node", F.when(F.col("is_root"), F.lit(float("-inf"))).otherwise(F.col("stability")).alias("own"), "x", "y"))
    sx, sy = (scores.withColumnsRenamed({"node": c, "score": f"s{c}"}) for c in ("x", "y"))
    weighed = nodes.join(sx, ["grp", "x"], "left").join(sy, ["grp", "y"], "left")
    outlasts = F.col("x").isNull() | (F.col("stability") >= F.col("sx") + F.col("sy"))
    tops = topmost(weighed.select("grp", "node", (~F.col("is_root") & outlasts).alias("chosen")), steps)
    if params.filter("epsilon > 0").head(1):
        first = tops.filter("top = node").select("grp", F.col("node").alias("at"))
        wide = climb(first, steps, (F.col("up_w") < F.col("epsilon")) & ~F.col("to_root")).distinct().select("grp", F.col("at").alias("node"), F.lit(True).alias("wide"))
        tops = topmost(nodes.select("grp", "node").join(wide, ["grp", "node"], "left").select("grp", "node", F.coalesce("wide", F.lit(False)).alias("chosen")), steps)

    picked = nodes.join(tops.filter("top = node").select("grp", "node"), ["grp", "node"], "left_semi").filter("total > 0")
    picked = ranked(picked, ["grp"], [-F.col("total"), F.col("low")])
    densest = nodes.groupBy("grp").agg(F.max("peak").alias("densest"))
    # copies have no finite density: lasting cannot be put in proportion
    plain = (F.col("densest") >= 1.0 / least_weight) | (F.col("densest") == 0)
    picked = picked.join(densest, "grp").select(
        "grp", F.col("node").alias("top"), (F.col("pos") - 1).cast("int").alias("cluster"), F.col("peak").alias("greatest"),
        F.when(plain, 1.0).otherwise(F.col("stability") / (F.col("total") * F.col("densest"))).alias("persistence"))
    found = cut(tops.join(picked, ["grp", "top"]).select("grp", "node", "cluster", "greatest", "persistence"))
    return held.join(found, ["grp", "node"], "left").withColumn("cluster", F.coalesce("cluster", F.lit(-1))).drop("node")
