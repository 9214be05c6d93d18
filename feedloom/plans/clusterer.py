"""One front for the flat clustering algorithms: k-means, DBSCAN, agglomerative."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators import kmeans, knn, linkage, quality, reports, silhouettes
from feedloom.session import cut


class Clusterer:
    """Clusters (feedback_id, vector) tables; every result is a DataFrame.

    >>> labels = Clusterer("kmeans", n_clusters=3).fit_predict(embeddings)
    """

    def __init__(self, algorithm: str = "kmeans", n_clusters: int | None = None, eps: float | None = None,
                 min_samples: int = 5, distance_threshold: float | None = None, seed: int = 42,
                 linkage: str = "single"):
        needs = {
            "kmeans": ("n_clusters", n_clusters, "n_clusters required for kmeans"),
            "dbscan": ("eps", eps, "eps is required for DBSCAN"),
            "agglomerative": ("n_clusters", n_clusters, "n_clusters required for agglomerative"),
            "agglomerative_distance": ("distance_threshold", distance_threshold,
                                       "distance_threshold required for agglomerative_distance"),
        }
        if algorithm not in needs:
            raise ValueError(f"Unsupported algorithm: {algorithm}")
        if needs[algorithm][1] is None:
            raise ValueError(needs[algorithm][2])
        self.algorithm, self.n_clusters, self.eps = algorithm, n_clusters, eps
        self.min_samples, self.distance_threshold, self.seed, self.linkage = min_samples, distance_threshold, seed, linkage
        self._labelled: DataFrame | None = None
        self._centres: DataFrame | None = None
        self._dim = 0

    def fit_predict(self, embeddings: DataFrame) -> DataFrame:
        """(feedback_id, cluster); -1 is noise."""
        points = cut(knn.as_points(embeddings, F.lit("all")))
        self._dim = knn.vector_size(points)
        if self.algorithm == "kmeans":
            self._centres = kmeans.fit(points, self.n_clusters, self._dim, seed=self.seed)
            found = kmeans.assign(points, self._centres).select("grp", "pid", "xs", "cluster")
        else:
            if self.algorithm == "dbscan":
                named = linkage.dbscan(points, self.eps, self.min_samples)
            else:
                given = {"distance_threshold": self.distance_threshold} if self.algorithm.endswith("distance") else {
                    "n_clusters": self.n_clusters}
                named = linkage.agglomerative(points, **given, method=self.linkage)
            found = linkage.numbered(named).select("grp", "pid", "cluster").join(points, ["grp", "pid"])
            found = found.select("grp", "pid", "xs", "cluster")
        self._labelled = cut(found)
        return self._labelled.select(F.col("pid").alias("feedback_id"), "cluster")

    def _clusters(self) -> DataFrame:
        if self._labelled is None:
            raise ValueError("call fit_predict first")
        return self._labelled.filter("cluster >= 0")

    def get_cluster_centers(self) -> DataFrame:
        """(cluster, centre): the mean of every cluster."""
        return quality.centroids(self._clusters(), self._dim).select("cluster", "centre")

    def get_cluster_stats(self) -> DataFrame:
        return reports.label_counts(self._clusters(), "cluster")

    def calculate_intra_cluster_distances(self) -> DataFrame:
        return quality.intra_cluster_distance(self._clusters(), self._dim).drop("grp")

    def calculate_silhouette_scores(self) -> DataFrame:
        """(cluster, score, n); the null cluster is the overall score."""
        return silhouettes.euclidean_silhouette(self._clusters(), self._dim).drop("grp")

    @staticmethod
    def estimate_eps_from_data(embeddings: DataFrame, percentile: float = 95.0, k: int = 4) -> float:
        points = cut(knn.as_points(embeddings, F.lit("all")))
        return float(knn.estimate_eps(points, k, percentile).head()["eps"])
