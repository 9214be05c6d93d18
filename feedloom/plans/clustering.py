"""Recursive density clustering of embeddings, all open groups of a level in one job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.labels import child_label, slice_label
from feedloom.functions.vectors import has_direction, unit
from feedloom.operators import adaptive
from feedloom.operators.density import LOCAL_EDGES, density_clusters
from feedloom.operators.mst import spanning_trees
from feedloom.operators.quality import clustering_quality, relative_validity, trustworthiness
from feedloom.operators.reduce import principal_axes, project
from feedloom.operators.reports import cluster_catalog, cluster_samples_wide, label_counts
from feedloom.operators.terms import cluster_terms, describe_clusters
from feedloom.operators.upsert import apply_assignments, upsert_clusters
from feedloom.session import cut
from feedloom.sources.readers import scan_embeddings, with_parsed_vectors

HIERARCHY = ("parent_label string, depth int, n_points long, n_clusters long, "
             "neighbours struct<n_neighbors:int,min_dist:double,spread:double>, "
             "density struct<min_cluster_size:int,min_samples:int,epsilon:double>, "
             "trustworthiness double, trust_points long, relative_validity double, min_persistence double, mean_persistence double, "
             "mean_probability double, low_confidence_ratio double, noise_ratio double, largest_cluster_ratio double, "
             "smallest_cluster_size long, mean_cluster_size double, cluster_size_std double")


@dataclass(frozen=True)
class ClusterSettings:
    max_depth: int = 2
    n_components: int = 3
    min_cluster_pct: float = 0.02
    measure_trust: bool = False
    trust_sample: int | None = None     # rows per group that trustworthiness is measured on; None = all
    block_rows: int | None = None       # points per block; None = sized by the dimension
    local_edges: int = LOCAL_EDGES      # trees below this are condensed in one task


def cluster_groups(points: DataFrame, min_samples: Column | int, min_cluster_size: Column | int, epsilon: Column | float = 0.0,
                   block_rows: int | None = None, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(grp, pid, cluster, probability, persistence): C6-C8 for every group of (grp, pid, xs).

    The parameters may read `n_points`, the number of points of the group.
    """
    return measured_clusters(points, min_samples, min_cluster_size, epsilon, block_rows, local_edges, validity=False)[0]


def measured_clusters(points: DataFrame, min_samples: Column | int, min_cluster_size: Column | int, epsilon: Column | float = 0.0,
                      block_rows: int | None = None, local_edges: int = LOCAL_EDGES, validity: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """`cluster_groups` and, if asked, (grp, relative_validity) told from the same spanning trees."""
    edges, nodes, distinct = spanning_trees(points, min_samples, block_rows)
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    params = distinct.groupBy("grp").agg(F.sum("weight").alias("n_points")).select(
        "grp", as_column(min_cluster_size).cast("int").alias("min_cluster_size"), as_column(epsilon).cast("double").alias("epsilon"))
    labelled = density_clusters(edges, nodes.join(params, "grp"), local_edges)
    labelled = cut(labelled) if validity else labelled
    members = points.join(distinct.select("grp", "rid", "xs"), ["grp", "xs"]).select("grp", "pid", "rid")
    found = members.join(labelled.drop("weight"), ["grp", "rid"]).drop("rid")
    if not validity:
        return found, None
    # copies of a point hang on it at its core distance
    copies = nodes.filter("weight > 1").select("grp", F.col("rid").alias("u"), F.col("rid").alias("v"), F.col("core").alias("w"))
    marks = labelled.select("grp", F.col("rid").alias("node"), "cluster", "weight")
    return found, relative_validity(edges.select("grp", "u", "v", "w").unionByName(copies), marks)


def recursive_clusters(embeddings: DataFrame, settings: ClusterSettings = ClusterSettings()) -> tuple[DataFrame, DataFrame]:
    """(assignments, hierarchy).

    The recursion runs by level: at each depth the label so far is the group key and all
    groups that may be split are reduced and clustered together.  Rows without source, style
    or a direction (zero vector) are `unclustered`; every input row comes back once.
    """
    label = slice_label(F.col("source"), F.col("style"))
    usable = F.col("source").isNotNull() & F.col("style").isNotNull() & has_direction(F.col("vector"))
    vectors = cut(embeddings.filter(usable).select(
        label.alias("grp"), F.col("feedback_id").alias("pid"), unit(F.col("vector")).alias("xs")))
    sizes = cut(vectors.groupBy("grp").agg(F.count("*").alias("n")))
    state = vectors.select("grp", "pid").join(sizes, "grp").withColumn(
        "open", adaptive.large_enough(F.lit(0), F.col("n"), settings.max_depth)).select(
        "grp", "pid", "open", F.lit(None).cast("double").alias("probability"))
    finished, levels = [], []
    for depth in range(settings.max_depth):
        state = cut(state)
        finished.append(state.filter("NOT open").select("pid", F.col("grp").alias("cluster_label"), "probability"))
        going_on = state.filter("open").select("grp", "pid")
        if not going_on.head(1):
            state = None
            break
        # labels travel between levels; vectors are written again only for the groups that go on
        points = vectors.join(sizes.filter(adaptive.large_enough(F.lit(0), F.col("n"), settings.max_depth)), "grp", "left_semi") if depth == 0 \
            else cut(vectors.select("pid", "xs").join(going_on, "pid").select("grp", "pid", "xs"))
        found, hierarchy = _level(points, depth, settings)
        levels.append(hierarchy)
        quality = hierarchy.select(F.col("parent_label").alias("grp"), "n_clusters", "mean_persistence", "noise_ratio")
        named = found.join(quality, "grp").withColumn(
            "label", adaptive.terminal_label(F.col("grp"), F.col("n_clusters"), F.col("cluster")))
        named = cut(named.select("grp", "pid", "label", "cluster", "probability", "n_clusters", "mean_persistence", "noise_ratio"))
        children = named.groupBy("label").agg(F.count("*").alias("n")).join(
            named.filter((F.col("cluster") >= 0) & (F.col("n_clusters") > 1)).select(
                "label", "n_clusters", "mean_persistence", "noise_ratio").distinct(), "label", "left")
        children = children.select("label", F.coalesce(adaptive.should_recurse(
            F.lit(depth + 1), F.col("n"), settings.max_depth, F.col("n_clusters"), F.col("mean_persistence"), F.col("noise_ratio")
        ) & F.col("n_clusters").isNotNull(), F.lit(False)).alias("open"))
        state = named.join(children, "label").select(F.col("label").alias("grp"), "pid", "open", "probability")
    if state is not None:
        finished.append(cut(state).select("pid", F.col("grp").alias("cluster_label"), "probability"))
    labels = finished[0]
    for more in finished[1:]:
        labels = labels.unionByName(more)
    assignments = embeddings.select("feedback_id", "source", "style", "created_at").join(
        labels.withColumnRenamed("pid", "feedback_id"), "feedback_id", "left"
    ).withColumn("cluster_label", F.coalesce("cluster_label", child_label(label, F.lit("unclustered"))))
    spark = embeddings.sparkSession
    tree = levels[0] if levels else spark.createDataFrame([], HIERARCHY)
    for more in levels[1:]:
        tree = tree.unionByName(more)
    return assignments, tree.filter(F.col("n_clusters") > 1)


def _level(points: DataFrame, depth: int, settings: ClusterSettings) -> tuple[DataFrame, DataFrame]:
    """Reduce and cluster every group of one level; (labelled points, one row per group)."""
    reduced = cut(project(points, principal_axes(points, settings.n_components)))
    params = adaptive.density_params(F.lit(depth), F.col("n_points"), settings.min_cluster_pct)
    found, validity = measured_clusters(reduced, params["min_samples"], params["min_cluster_size"], params["epsilon"],
                                        settings.block_rows, settings.local_edges)
    found = cut(found)
    quality = clustering_quality(found, ["grp"], validity).withColumn(
        "neighbours", adaptive.neighbour_params(F.lit(depth), F.col("n_points"), settings.n_components)).withColumn("density", params)
    if settings.measure_trust:
        k = quality.select("grp", F.col("neighbours.n_neighbors").alias("k"))
        trust = trustworthiness(points.join(k, "grp"), reduced, F.col("k"), settings.trust_sample, settings.block_rows)
        quality = quality.join(trust.select("grp", "trustworthiness", F.col("n").cast("long").alias("trust_points")), "grp", "left")
    else:
        quality = quality.withColumn("trustworthiness", F.lit(None).cast("double")).withColumn("trust_points", F.lit(None).cast("long"))
    names = [f.strip().split(" ")[0] for f in HIERARCHY.replace("n_neighbors:int,min_dist:double,spread", "").replace(
        "min_cluster_size:int,min_samples:int,epsilon", "").split(", ")]
    hierarchy = quality.withColumn("depth", F.lit(depth)).withColumnRenamed("grp", "parent_label").select(*names)
    return found, cut(hierarchy)


def quality_report(hierarchy: DataFrame) -> DataFrame:
    """The quality table by depth and parent; `trust_points` of the `n_points` were measured for trustworthiness."""
    return hierarchy.select(
        "parent_label", "depth", "n_points", "n_clusters", "trustworthiness", "trust_points", "relative_validity", "mean_persistence",
        "mean_probability", "noise_ratio",
    ).orderBy("depth", "parent_label")


def cluster_job(embeddings: DataFrame, feedback: DataFrame, catalog: DataFrame | None, now, start=None, end=None,
                settings: ClusterSettings = ClusterSettings()) -> dict[str, DataFrame]:
    """Read, cluster, build the catalogue and update the feedback rows.

    Clusters are described by the terms that set their texts apart, where `feedback` has texts.
    The caller writes the returned tables; each can be written again without harm.
    """
    rows = scan_embeddings(with_parsed_vectors(embeddings), start, end)
    assignments, hierarchy = recursive_clusters(rows, settings)
    assignments = cut(assignments)
    fresh = cluster_catalog(assignments, now, start, end)
    if "feedback_text" in feedback.columns:
        texts = feedback.select("feedback_id", "feedback_text").join(assignments.select("feedback_id", "cluster_label"), "feedback_id")
        fresh = describe_clusters(fresh, cluster_terms(texts))
    if catalog is None:
        fresh = fresh.withColumn("sample_feedback_ids", F.concat_ws(",", "sample_feedback_ids"))
    return {
        "assignments": assignments,
        "hierarchy": hierarchy,
        "clusters": fresh if catalog is None else upsert_clusters(catalog, fresh),
        "feedback": apply_assignments(feedback, assignments),
    }


# --- the simple variant ----------------------------------------------------------------------------

def simple_recluster(embeddings: DataFrame, max_depth: int = 1, min_cluster_size: int = 100, min_samples: int = 10,
                     n_components: int = 2, prefix: str = "root", block_rows: int | None = None,
                     local_edges: int = LOCAL_EDGES) -> DataFrame:
    """Reduce once, then split while a part has twice the least size; (pid, cluster_label)."""
    points = cut(embeddings.filter(has_direction(F.col("vector"))).select(
        F.lit(prefix).alias("grp"), F.col("feedback_id").alias("pid"), unit(F.col("vector")).alias("xs")))
    reduced = cut(project(points, principal_axes(points, n_components)))
    state = reduced.join(reduced.groupBy("grp").agg(F.count("*").alias("n")), "grp").withColumn(
        "open", F.col("n") >= 2 * min_cluster_size)
    finished = []
    for _ in range(max_depth):
        state = cut(state.select("grp", "pid", "xs", "open"))
        finished.append(state.filter("NOT open").select("pid", F.col("grp").alias("cluster_label")))
        open_ = state.filter("open").select("grp", "pid", "xs")
        if not open_.head(1):
            state = None
            break
        found = cluster_groups(open_, min_samples, min_cluster_size, 0.0, block_rows, local_edges)
        noise = F.col("cluster") < 0
        named = cut(found.select(
            "pid", noise.alias("noise"),
            child_label(F.col("grp"), F.when(noise, F.lit("noise")).otherwise(F.col("cluster").cast("string"))).alias("grp")))
        sizes = named.groupBy("grp").agg(F.count("*").alias("n"))
        state = named.join(sizes, "grp").join(open_.select("pid", "xs"), "pid").withColumn(
            "open", ~F.col("noise") & (F.col("n") >= 2 * min_cluster_size))
    if state is not None:
        finished.append(cut(state.select("pid", F.col("grp").alias("cluster_label"))))
    labels = finished[0]
    for more in finished[1:]:
        labels = labels.unionByName(more)
    return labels


def recluster_job(embeddings: DataFrame, feedback: DataFrame, *, source: str | None = None, style: str | None = None,
                  start=None, end=None, limit: int | None = None, **options) -> dict[str, DataFrame]:
    """An exploratory run over a filtered selection; nothing is written back."""
    rows = scan_embeddings(with_parsed_vectors(embeddings), start, end, source)
    if style is not None:
        rows = rows.filter(F.col("style") == style)
    if limit is not None:
        rows = rows.orderBy("created_at", "feedback_id").limit(limit)
    rows = cut(rows)
    labels = simple_recluster(rows, **options).withColumnRenamed("pid", "feedback_id")
    assignments = cut(rows.select("feedback_id", "source", "style").join(labels, "feedback_id"))
    return {
        "assignments": assignments,
        "counts": label_counts(assignments),
        "analysis": cluster_samples_wide(assignments, feedback),
    }
