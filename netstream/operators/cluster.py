"""Clustering: power iteration clustering (E6), k-means on spectral
embeddings (E4, E5), cluster sizes (E8) and the membership table (K7).

Labels are always returned with their node id: ``(id, cluster)``.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import KMeans, PowerIterationClustering
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netstream.operators.graph import degrees, drop_self_loops
from netstream.operators.indexing import row_index
from netstream.operators.spectrum import power_iteration_vector


def pic_clusters(edges: DataFrame, k: int, max_iter: int = 10,
                 init_mode: str = "degree", seed: int | None = None) -> DataFrame:
    """MLlib power iteration clustering on a unit-weight undirected graph.

    The ml defaults are ``maxIter=20, initMode='random'``; the reference's
    settings are 10 steps from the degree vector.  Self-loops are dropped
    (PIC ignores ``i == j`` pairs).
    """
    pic = PowerIterationClustering(k=k, maxIter=max_iter, initMode=init_mode,
                                   srcCol="src", dstCol="dst", weightCol="weight")
    if seed is not None:
        pic = pic.setSeed(seed)
    w = drop_self_loops(edges).select("src", "dst", F.lit(1.0).alias("weight"))
    return pic.assignClusters(w).select(F.col("id").cast("long").alias("id"),
                                         F.col("cluster").cast("int").alias("cluster"))


VALUE_BINS = 512  # bins of the histogram over which values are clustered


def optimal_cuts(place: np.ndarray, count: np.ndarray, k: int) -> list[int]:
    """Ends (exclusive) of the at most ``k`` runs of the ascending ``place``
    (``count`` values at each) with the least sum of squared distances to their
    means; of equal ones the earliest cuts.  A dynamic programme: exact, unlike
    Lloyd rounds from a random start."""
    n = np.append(0, np.cumsum(count, dtype=np.int64)).astype(np.float64)
    s1 = np.append(0, np.cumsum(count * place, dtype=np.int64)).astype(np.float64)
    s2 = np.append(0, np.cumsum(count * place * place, dtype=np.int64)).astype(np.float64)
    m, k = len(place), min(k, len(place))

    def cost(i: np.ndarray, j: int) -> np.ndarray:  # of the run i .. j - 1
        return (s2[j] - s2[i]) - (s1[j] - s1[i]) * (s1[j] - s1[i]) / (n[j] - n[i])

    best = np.array([np.inf] + [float(cost(np.array([0]), j)[0]) for j in range(1, m + 1)])
    came = []
    for runs in range(2, k + 1):
        here, cut = np.full(m + 1, np.inf), np.zeros(m + 1, np.int64)
        for j in range(runs, m + 1):
            i = np.arange(runs - 1, j)
            total = best[i] + cost(i, j)
            cut[j], here[j] = i[total.argmin()], total.min()
        came.append(cut)
        best = here
    ends, at = [m], m
    for cut in reversed(came):
        at = int(cut[at])
        ends.append(at)
    return ends[::-1]


def interval_clusters(values: DataFrame, k: int, bins: int = VALUE_BINS, value: str = "v", ident: str = "id") -> DataFrame:
    """Optimal one-dimensional k-means of ``value`` over ``bins`` equal intervals
    between its least and greatest: ``(id, cluster)``, clusters numbered by rising
    value.  The driver holds the histogram (at most ``bins`` rows) and its cuts; a
    null value has a null cluster."""
    low, high = values.agg(F.min(value), F.max(value)).first()
    if low is None or high == low:
        return values.select(F.col(ident).alias("id"), F.when(F.col(value).isNotNull(), 0).cast("int").alias("cluster"))
    place = F.when(F.col(value).isNotNull(),  # least() passes over nulls
                   F.least(F.floor((F.col(value) - low) / (high - low) * bins), F.lit(bins - 1)).cast("int"))
    placed = values.select(F.col(ident).alias("id"), place.alias("bin"))
    rows = sorted((r["bin"], r["count"]) for r in placed.where("bin IS NOT NULL").groupBy("bin").count().collect())
    at, count = (np.array(c, np.int64) for c in zip(*rows))
    label = np.zeros(bins, np.int64)
    label[at] = np.searchsorted(optimal_cuts(at, count, k), np.arange(len(at)), side="right")
    return placed.select("id", F.get(F.array(*[F.lit(int(x)) for x in label]), F.col("bin")).cast("int").alias("cluster"))


def pic_interval_clusters(edges: DataFrame, k: int, max_iter: int = 10, bins: int = VALUE_BINS) -> DataFrame:
    """Power iteration clustering with an exact last step: MLlib's iteration
    (degree start, its stop rule), then ``interval_clusters`` of the vector in place
    of k-means from a random start, so equal graphs have equal labels."""
    return interval_clusters(power_iteration_vector(edges, max_iter, early_stop=True), k, bins)


def kmeans_clusters(vectors: DataFrame, k: int, seed: int = 7, n_columns: int | None = None,
                    max_iter: int = 20, features: str = "features") -> DataFrame:
    """k-means on the first ``n_columns`` (default k) entries of an
    ``ARRAY<DOUBLE>`` feature column: ``(id, cluster)``."""
    n_columns = n_columns or k
    feats = vectors.select(
        "id", array_to_vector(F.slice(F.col(features), 1, n_columns)).alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, initSteps=5, featuresCol="features",
                   predictionCol="cluster").fit(feats)
    return model.transform(feats).select("id", F.col("cluster").cast("int").alias("cluster"))


def degree_scaled(vectors: DataFrame, edges: DataFrame, features: str = "features") -> DataFrame:
    """Row ``i`` of an eigenvector block divided by ``sqrt(d_i)`` - the
    spectral-embedding form that maps normalised-Laplacian vectors back to
    random-walk vectors."""
    deg = degrees(edges).select("id", F.sqrt("degree").alias("sd"))
    return (vectors.join(deg, "id")
                   .select("id", F.transform(F.col(features), lambda x: x / F.col("sd")).alias(features)))


def labelled_by_least_member(labels: DataFrame) -> DataFrame:
    """``(id, cluster)`` with each cluster named by its least id, so that equal
    partitions have equal labels whatever numbers the model gave."""
    least = labels.groupBy("cluster").agg(F.min("id").alias("least"))
    return labels.join(F.broadcast(least), "cluster").select("id", F.col("least").alias("cluster"))  # k rows


def cluster_sizes(labels: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Nodes per label: ``(cluster, n_nodes)`` (partial aggregation first)."""
    return labels.groupBy(F.col(cluster).alias("cluster")).agg(
        F.count(F.lit(1)).alias("n_nodes"))


def cluster_members(labels: DataFrame, cluster: str = "cluster", ident: str = "id") -> DataFrame:
    """Membership table: one row per node with its 0-based rank inside its
    cluster and the cluster size.  No cluster is gathered into one array or
    one task: ranks come from range partitions over ``(cluster, id)``."""
    base = labels.select(F.col(cluster).alias("cluster"), F.col(ident).alias("id"))
    ranked = row_index(base, order="id", group="cluster", index_col="member_pos")
    sizes = cluster_sizes(base)
    return ranked.join(sizes, "cluster").select("cluster", "id", "member_pos", "n_nodes")
