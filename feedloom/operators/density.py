"""Density clusters from spanning trees: condensed tree, selection, probabilities.

Seen from the shortest edge up, a component below `min_cluster_size` only matters through
the moment it joins something larger, and a component that reaches the size is a leaf
cluster.  So each point is described by two values: the leaf it joined and the weight at
which it joined.  What is left of the tree is one node per leaf cluster, a small table.

Small groups are worked off edge by edge in one task.  In larger groups, rounds of joins
contract all components below the size at once along their least edges, and a tree over many leaf clusters is a table too.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.components import components
from feedloom.operators.leaftree import LOCAL_MERGES, leaf_clusters
from feedloom.session import cut

LOCAL_EDGES = 1_048_576  # a tree with fewer edges is condensed inside one task
LOCAL_LEAVES = 1_000    # a tree over fewer leaf clusters is worked off inside one task
LEAST_WEIGHT = 1e-12    # a zero distance counts as this, so that densities stay finite

LABELLED = "grp string, rid string, weight long, cluster int, probability double, persistence double"


# --- the tree over leaf clusters -----------------------------------------------------------

class LeafTree:
    """Merges of `k` leaf clusters along their sorted edges (a, b, weight)."""

    def __init__(self, k: int, edges: list[tuple[int, int, float]]):
        size = max(2 * k - 1, k)
        self.parent = np.full(size, -1)
        self.birth = np.full(size, np.inf)     # weight at which a node is swallowed by its parent
        self.split = np.full(size, np.nan)     # weight at which its two children met
        self.children: dict[int, tuple[int, int]] = {}
        top = list(range(k))
        where = list(range(k))                 # leaf -> slot in `top`, resolved like a union-find

        def slot(i: int) -> int:
            while where[i] != i:
                where[i] = where[where[i]]
                i = where[i]
            return i

        node = k
        for a, b, w in edges:
            i, j = slot(a), slot(b)
            x, y = top[i], top[j]
            self.parent[[x, y]] = node
            self.birth[[x, y]] = w
            self.split[node] = w
            self.children[node] = (x, y)
            where[j] = i
            top[i] = node
            node += 1
        self.size, self.root = node, node - 1

    def holder(self, leaf: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The cluster that a point belongs to when it joins `leaf` at `weight`."""
        at = leaf.copy()
        while True:
            up = self.birth[at] <= weight
            if not up.any():
                return at
            at[up] = self.parent[at[up]]

    def select(self, count: np.ndarray, lam_sum: np.ndarray, lam_max: np.ndarray, first: list, epsilon: float):
        """Chosen clusters by excess of mass: per node (cluster or -1, greatest density, persistence).

        The root is never chosen.  With `epsilon`, clusters that split below that distance
        are replaced by their first ancestor above it.
        """
        total, stability = count.astype(float).copy(), np.zeros(self.size)
        low = list(first)
        peak = lam_max.copy()
        born = 1.0 / np.maximum(self.birth, LEAST_WEIGHT)
        chosen = np.zeros(self.size, dtype=bool)
        score = np.zeros(self.size)
        for node in range(self.size):
            inner = 0.0
            if node in self.children:
                x, y = self.children[node]
                total[node] += total[x] + total[y]
                # leaves that are born and merged at one weight hold no point of their own
                low[node] = min((v for v in (low[node], low[x], low[y]) if v is not None), default=None)
                met = 1.0 / max(self.split[node], LEAST_WEIGHT)
                inner = (total[x] + total[y]) * (met - born[node])
                peak[node] = max(peak[node], met)
            stability[node] = lam_sum[node] - count[node] * born[node] + inner
            below = sum(score[c] for c in self.children.get(node, ()))
            if node != self.root and (node not in self.children or stability[node] >= below):
                chosen[node], score[node] = True, stability[node]
                self._clear(node, chosen)
            else:
                score[node] = below
        if epsilon > 0:
            chosen = self._widen(chosen, epsilon)
        picked = sorted(np.flatnonzero(chosen & (total > 0)), key=lambda c: (-total[c], low[c]))
        densest = peak.max(initial=0.0)
        endless = densest >= 1.0 / LEAST_WEIGHT  # copies: lasting cannot be put in proportion
        cluster, greatest, persist = np.full(self.size, -1), np.zeros(self.size), np.full(self.size, np.nan)
        for number, node in enumerate(picked):
            lasting = 1.0 if endless or densest == 0 else stability[node] / (total[node] * densest)
            for member in self._subtree(node):
                cluster[member], greatest[member], persist[member] = number, peak[node], lasting
        return cluster, greatest, persist

    def _subtree(self, node: int):
        stack = [node]
        while stack:
            at = stack.pop()
            yield at
            stack.extend(self.children.get(at, ()))

    def _clear(self, node: int, chosen: np.ndarray) -> None:
        for below in self._subtree(node):
            if below != node:
                chosen[below] = False

    def _widen(self, chosen: np.ndarray, epsilon: float) -> np.ndarray:
        out = np.zeros_like(chosen)
        for node in np.flatnonzero(chosen):
            at = node
            while self.birth[at] < epsilon and self.parent[at] != self.root:
                at = self.parent[at]
            out[at] = True
        for node in np.flatnonzero(out)[::-1]:
            if out[node]:
                self._clear(node, out)
        return out


# --- one task per small group -----------------------------------------------------------------

def join_weights(weights: np.ndarray, cores: np.ndarray, u: np.ndarray, v: np.ndarray, w: np.ndarray, least: int):
    """(leaf, joining weight) of every node and the edges between leaves; edges come sorted.

    A node in no leaf keeps leaf -1.
    """
    n = len(weights)
    parent = list(range(n))
    size = weights.tolist()
    members: list = [[i] for i in range(n)]
    leaf_of = np.full(n, -1)
    leaf = [-1] * n
    joined = np.full(n, np.nan)
    leaves = 0
    for i in range(n):
        if size[i] >= least:
            leaf[i] = leaf_of[i] = leaves
            joined[i] = cores[i]
            members[i] = []
            leaves += 1
    between = []
    for a, b, weight in zip(u.tolist(), v.tolist(), w.tolist()):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        while parent[b] != b:
            parent[b] = parent[parent[b]]
            b = parent[b]
        if leaf[a] >= 0 and leaf[b] >= 0:
            between.append((leaf[a], leaf[b], weight))
        if leaf[a] < 0 and (leaf[b] >= 0 or len(members[a]) < len(members[b])):
            a, b = b, a
        parent[b] = a
        size[a] += size[b]
        if leaf[a] >= 0:
            leaf_of[members[b]] = leaf[a]
            joined[members[b]] = weight
        else:
            members[a].extend(members[b])
            if size[a] >= least:
                leaf_of[members[a]] = leaf[a] = leaves
                joined[members[a]] = weight
                members[a] = []
                leaves += 1
        members[b] = []
    return leaf_of, joined, between, leaves


def _condense(edges: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("rid", kind="stable").reset_index(drop=True)
    ids = nodes["rid"].tolist()
    place = {r: i for i, r in enumerate(ids)}
    u, v = edges["u"].map(place).to_numpy(dtype=int), edges["v"].map(place).to_numpy(dtype=int)
    u, v = np.minimum(u, v), np.maximum(u, v)
    w = edges["w"].to_numpy(dtype=float)
    order = np.lexsort((v, u, w))
    weights = nodes["weight"].to_numpy()
    least, epsilon = int(nodes["min_cluster_size"].iloc[0]), float(nodes["epsilon"].iloc[0])
    leaf, joined, between, leaves = join_weights(weights, nodes["core"].to_numpy(), u[order], v[order], w[order], least)
    cluster = np.full(len(ids), -1)
    probability, persistence = np.zeros(len(ids)), np.full(len(ids), np.nan)
    if leaves > 1:
        tree = LeafTree(leaves, between)
        inside = leaf >= 0
        at = np.zeros(len(ids), dtype=int)
        at[inside] = tree.holder(leaf[inside], joined[inside])
        lam = np.where(inside, 1.0 / np.maximum(np.nan_to_num(joined, nan=1.0), LEAST_WEIGHT), 0.0)
        count, lam_sum, lam_max = np.zeros(tree.size), np.zeros(tree.size), np.zeros(tree.size)
        np.add.at(count, at[inside], weights[inside])
        np.add.at(lam_sum, at[inside], weights[inside] * lam[inside])
        np.maximum.at(lam_max, at[inside], lam[inside])
        first: list = [None] * tree.size
        for i in range(len(ids)):
            if inside[i] and first[at[i]] is None:
                first[at[i]] = ids[i]
        number, greatest, lasting = tree.select(count, lam_sum, lam_max, first, epsilon)
        cluster[inside] = number[at[inside]]
        named = cluster >= 0
        probability[named] = np.minimum(lam[named], greatest[at[named]]) / greatest[at[named]]
        persistence[named] = lasting[at[named]]
    return pd.DataFrame({
        "grp": nodes["grp"], "rid": ids, "weight": weights, "cluster": cluster.astype("int32"),
        "probability": probability, "persistence": persistence,
    })


# --- rounds of joins for large groups ------------------------------------------------------------

def _contract(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(joined, between): (grp, rid, weight, leaf, w) and the edges (grp, u, v, w, lo, hi) between leaves."""
    big = F.col("weight") >= F.col("min_cluster_size")
    comps = nodes.select("grp", F.col("rid").alias("c"), F.col("weight").alias("size"), big.alias("leaf"), "min_cluster_size")
    done = cut(nodes.filter(big).select("grp", "rid", "weight", F.col("rid").alias("leaf"), F.col("core").alias("w")))
    open_ = nodes.filter(~big).select("grp", "rid", "weight", F.col("rid").alias("c"))
    links = edges.select("grp", F.col("u").alias("a"), F.col("v").alias("b"), "w",
                         F.least("u", "v").alias("lo"), F.greatest("u", "v").alias("hi"))
    while True:
        comps, links, open_ = cut(comps), cut(links), cut(open_)
        key = F.struct("w", "lo", "hi")
        ends = links.select("grp", F.col("a").alias("c"), F.col("b").alias("other"), key.alias("key")).unionByName(
            links.select("grp", F.col("b").alias("c"), F.col("a").alias("other"), key.alias("key"))
        )
        # every component below the size follows its least edge
        small = comps.filter("NOT leaf").select("grp", "c")
        least = cut(ends.join(small, ["grp", "c"], "left_semi").groupBy("grp", "c").agg(
            F.min(F.struct("key", "other")).alias("e")).select("grp", "c", "e.key", "e.other"))
        if not least.head(1):
            break
        trees = components(least.select("grp", F.col("c").alias("u"), F.col("other").alias("v")), stored=True)
        trees = cut(trees.select("grp", F.col("node").alias("c"), F.col("comp").alias("tree")))
        marked = comps.join(trees, ["grp", "c"], "left").join(least.select("grp", "c", "key"), ["grp", "c"], "left")
        heads = marked.filter("leaf").filter(F.col("tree").isNotNull()).select("grp", "tree", F.col("c").alias("head"))
        # the least edge that leaves a tree limits what may merge before something else happens
        sides = ends.join(trees, ["grp", "c"]).join(
            trees.select("grp", F.col("c").alias("other"), F.col("tree").alias("other_tree")), ["grp", "other"], "left"
        )
        leaving = sides.filter(~F.col("tree").eqNullSafe(F.col("other_tree"))).groupBy("grp", "tree").agg(F.min("key").alias("limit"))
        rows = marked.filter(~F.col("leaf")).join(heads, ["grp", "tree"], "left").join(leaving, ["grp", "tree"], "left")
        rows = cut(rows)
        onto_leaf = rows.filter(F.col("head").isNotNull()).select("grp", "c", F.col("head").alias("to"), F.col("head").alias("leaf_id"), F.col("key.w").alias("w"))
        # no leaf in the tree: its members merge in the order of their edges
        order = Window.partitionBy("grp", "tree").orderBy("key", "c")
        paired = rows.filter(F.col("head").isNull() & F.col("tree").isNotNull())
        paired = paired.withColumn("ready", F.col("limit").isNull() | (F.col("key") < F.col("limit")))
        paired = paired.withColumn("so_far", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        reached = F.col("ready") & (F.col("so_far") >= F.col("min_cluster_size"))
        grown = paired.filter(reached).groupBy("grp", "tree").agg(F.min("key").alias("grown"))
        paired = cut(paired.join(grown, ["grp", "tree"], "left"))
        into_new = paired.filter(F.col("grown").isNotNull()).select(
            "grp", "c", F.col("tree").alias("to"), F.col("tree").alias("leaf_id"),
            F.greatest(F.col("key.w"), F.col("grown.w")).alias("w"),
        )
        still = paired.filter(F.col("grown").isNull() & F.col("ready"))
        together = still.groupBy("grp", "tree").agg(F.min("c").alias("to"))
        still = still.join(together, ["grp", "tree"]).select(
            "grp", "c", "to", F.lit(None).cast("string").alias("leaf_id"), F.lit(None).cast("double").alias("w"))
        moves = cut(onto_leaf.unionByName(into_new).unionByName(still))
        done = done.unionByName(cut(
            open_.join(moves.filter(F.col("leaf_id").isNotNull()), ["grp", "c"]).select("grp", "rid", "weight", F.col("leaf_id").alias("leaf"), "w")
        ))
        open_ = open_.join(moves.select("grp", "c", "to", "leaf_id"), ["grp", "c"], "left").filter(F.col("leaf_id").isNull()).select(
            "grp", "rid", "weight", F.coalesce("to", "c").alias("c"))
        comps = comps.join(moves.select("grp", "c", "to", "leaf_id"), ["grp", "c"], "left").groupBy(
            "grp", F.coalesce("to", "c").alias("c")
        ).agg(
            F.sum("size").alias("size"), F.bool_or(F.col("leaf") | F.col("leaf_id").isNotNull()).alias("leaf"),
            F.first("min_cluster_size").alias("min_cluster_size"),
        )
        to = moves.select("grp", "c", "to")
        links = links.join(to.withColumnsRenamed({"c": "a", "to": "to_a"}), ["grp", "a"], "left").join(
            to.withColumnsRenamed({"c": "b", "to": "to_b"}), ["grp", "b"], "left"
        ).select("grp", F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b"), "w", "lo", "hi").filter("a <> b")
    lost = open_.select("grp", "rid", "weight", F.lit(None).cast("string").alias("leaf"), F.lit(None).cast("double").alias("w"))
    return done.unionByName(lost), links.select("grp", F.col("a").alias("u"), F.col("b").alias("v"), "w", "lo", "hi")


def _leaf_tree(between: pd.DataFrame) -> tuple[LeafTree, list[str]]:
    """The tree over the leaves that have an edge; names in order."""
    names = sorted(set(between["u"]) | set(between["v"]))
    place = {name: i for i, name in enumerate(names)}
    between = between.sort_values(["w", "lo", "hi"], kind="stable")
    return LeafTree(len(names), [(place[a], place[b], w) for a, b, w in zip(between["u"], between["v"], between["w"])]), names


def _ranges(between: pd.DataFrame) -> pd.DataFrame:
    """For every leaf, the cluster that holds a point joining it at a weight in [since, until)."""
    tree, names = _leaf_tree(between)
    out = []
    for i, name in enumerate(names):
        low, at = -np.inf, i
        while at >= 0:
            out.append((between["grp"].iloc[0], name, at, low, tree.birth[at]))
            low, at = tree.birth[at], tree.parent[at]
    return pd.DataFrame(out, columns=["grp", "leaf", "node", "since", "until"])


def _selection(sums: pd.DataFrame, between: pd.DataFrame) -> pd.DataFrame:
    tree, _ = _leaf_tree(between)
    count, lam_sum, lam_max = np.zeros(tree.size), np.zeros(tree.size), np.zeros(tree.size)
    first: list = [None] * tree.size
    for row in sums.itertuples():
        count[row.node], lam_sum[row.node], lam_max[row.node], first[row.node] = row.count_, row.lam_sum, row.lam_max, row.first_id
    number, greatest, lasting = tree.select(count, lam_sum, lam_max, first, float(sums["epsilon"].iloc[0]))
    return pd.DataFrame({"grp": sums["grp"].iloc[0], "node": np.arange(tree.size), "cluster": number.astype("int32"),
                         "greatest": greatest, "persistence": lasting})


def _label_few(joined: DataFrame, between: DataFrame, nodes: DataFrame) -> DataFrame:
    """Groups whose leaf tree fits one task, as counted by the caller; columns as of `leaf_clusters`."""
    ranges = between.groupBy("grp").applyInPandas(_ranges, "grp string, leaf string, node int, since double, until double")
    lam = 1.0 / F.greatest(F.col("w"), F.lit(LEAST_WEIGHT))
    held = cut(joined.join(ranges, ["grp", "leaf"]).filter(
        (F.col("w") >= F.col("since")) & (F.col("w") < F.col("until"))).select("grp", "rid", "weight", "node", lam.alias("lam")))
    params = nodes.groupBy("grp").agg(F.first("epsilon").alias("epsilon"))
    sums = held.groupBy("grp", "node").agg(
        F.sum("weight").alias("count_"), F.sum(F.col("weight") * F.col("lam")).alias("lam_sum"),
        F.max("lam").alias("lam_max"), F.min("rid").alias("first_id"),
    ).join(params, "grp")
    chosen = sums.groupBy("grp").cogroup(between.groupBy("grp")).applyInPandas(
        _selection, "grp string, node int, cluster int, greatest double, persistence double")
    return held.join(chosen, ["grp", "node"]).select("grp", "rid", "weight", "lam", "cluster", "greatest", "persistence")


def _label_large(edges: DataFrame, nodes: DataFrame, local_leaves: int, local_merges: int) -> DataFrame:
    joined, between = _contract(edges, nodes)
    joined, between = cut(joined), cut(between)
    # one row per edge between two leaf clusters; a group without such an edge has no split, hence no cluster
    split = cut(between.groupBy("grp").agg(F.count("*").alias("n")))
    few, many = split.filter(F.col("n") < local_leaves).select("grp"), split.filter(F.col("n") >= local_leaves).select("grp")
    inside = joined.filter(F.col("leaf").isNotNull())
    named = _label_few(inside, between.join(few, "grp", "left_semi"), nodes.join(few, "grp", "left_semi"))
    if many.head(1):
        params = cut(nodes.join(many, "grp", "left_semi").groupBy("grp").agg(F.first("epsilon").alias("epsilon")))
        named = named.unionByName(leaf_clusters(
            between.join(many, "grp", "left_semi"), inside.join(many, "grp", "left_semi"), params, LEAST_WEIGHT, local_merges))
    labelled = named.select(
        "grp", "rid", "weight", "cluster",
        F.when(F.col("cluster") >= 0, F.least("lam", "greatest") / F.col("greatest")).otherwise(0.0).alias("probability"),
        F.when(F.col("cluster") >= 0, F.col("persistence")).alias("persistence"),
    )
    loose = joined.filter(F.col("leaf").isNull()).unionByName(inside.join(split, "grp", "left_anti")).select(
        "grp", "rid", "weight", F.lit(-1).alias("cluster"), F.lit(0.0).alias("probability"), F.lit(None).cast("double").alias("persistence"))
    return labelled.unionByName(loose)


def density_clusters(edges: DataFrame, nodes: DataFrame, local_edges: int = LOCAL_EDGES, local_leaves: int = LOCAL_LEAVES,
                     local_merges: int = LOCAL_MERGES) -> DataFrame:
    """(grp, rid, weight, cluster, probability, persistence) from spanning trees.

    `nodes` has (grp, rid, weight, core, min_cluster_size, epsilon).  Clusters are numbered by
    falling size, then least id; -1 is noise.  A single cluster is never reported, as the
    whole group is no cluster.  The three bounds say what a single task may take; they change no result.
    """
    sizes = cut(nodes.groupBy("grp").agg(F.count("*").alias("n")))
    few, many = sizes.filter(F.col("n") <= local_edges), sizes.filter(F.col("n") > local_edges)
    found = edges.join(few, "grp", "left_semi").groupBy("grp").cogroup(
        nodes.join(few, "grp", "left_semi").groupBy("grp")
    ).applyInPandas(_condense, LABELLED)
    found = found.withColumn("persistence", F.when(F.col("cluster") >= 0, F.col("persistence")))
    if many.head(1):
        found = found.unionByName(_label_large(
            edges.join(many, "grp", "left_semi"), nodes.join(many, "grp", "left_semi"), local_leaves, local_merges))
    return found
