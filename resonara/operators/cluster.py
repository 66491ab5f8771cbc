"""Clusters: K-Means, centroids, profiles and the order clusters are visited in."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resonara.functions.vectors import to_double
from resonara.operators.neighbours import knn, nearest_rows, present

# --- fixed values -----------------------------------------------------------
SEED = 42
SWEEP = (2, 3, 4, 5, 6, 8, 10, 12)
MAX_ITER = 300  # where the usual libraries stop a fit that has not converged
# ----------------------------------------------------------------------------

MAX_LOCAL_BYTES = 64 << 20  # centroids beyond this are joined, not shipped


def mean_vectors(df: DataFrame, *keys: str, vector: str = "embedding") -> DataFrame:
    """``keys, size, embedding``: mean vector per key from partial sums."""
    typed = df.where(F.col(vector).isNotNull()).select(*keys, array_to_vector(to_double(F.col(vector))).alias("_v"))
    means = typed.groupBy(*keys).agg(F.count("*").alias("size"), Summarizer.mean(F.col("_v")).alias("_m"))
    return means.select(*keys, "size", vector_to_array("_m").alias("embedding"))


def centroids(df: DataFrame, cluster: str = "cluster", vector: str = "embedding") -> DataFrame:
    return mean_vectors(df, cluster, vector=vector)


def _local(centres: DataFrame, cluster: str, local_bytes: int) -> pd.DataFrame | None:
    """Centroids as a pandas frame ordered by cluster, if small enough."""
    size = centres.select(F.count("*").alias("n"), F.max(F.size("embedding")).alias("d")).first()
    if size["n"] * (size["d"] or 0) * 8 > local_bytes:
        return None
    return centres.select(cluster, "embedding").toPandas().sort_values(cluster, ignore_index=True)


def _listed(matrix: np.ndarray, labels: np.ndarray, kept: int, cluster_type: T.DataType):
    """UDF: the ``kept`` nearest centres, nearest first, measured exactly, ties by label."""
    entry = T.StructType([T.StructField("cluster", T.ArrayType(cluster_type)), T.StructField("distance_sq", T.ArrayType(T.DoubleType()))])

    @F.pandas_udf(entry)
    def closest(vectors: pd.Series) -> pd.DataFrame:
        x = np.stack(vectors.to_list()).astype(np.float64)
        found = [(labels[picks], away) for _, picks, away in nearest_rows(x, matrix, kept)]
        return pd.DataFrame(found, columns=["cluster", "distance_sq"])

    return closest


def _nearest(queries: DataFrame, centres: DataFrame, kept: int, local_bytes: int) -> DataFrame:
    """``query_id, cluster, distance_sq`` of the ``kept`` nearest centres.

    Few centres travel to the rows, many are joined; both measure exactly and
    give the same rows.  Rows without a vector are left out.
    """
    queries, named = present(queries), centres.where(F.col("embedding").isNotNull())
    local = _local(named, "cluster", local_bytes)
    if local is None:
        near = knn(named, queries, kept, corpus_id="cluster", query_id="query_id", skip_self=False, plan="blocks")
        return near.select("query_id", F.col("item_id").alias("cluster"), "distance_sq")
    if local.empty:
        return queries.select("query_id", F.lit(None).cast(named.schema["cluster"].dataType).alias("cluster"),
                              F.lit(None).cast("double").alias("distance_sq")).limit(0)
    matrix = np.stack(local["embedding"].to_list()).astype(np.float64)
    closest = _listed(matrix, local["cluster"].to_numpy(), min(kept, len(local)), named.schema["cluster"].dataType)
    listed = queries.select("query_id", closest("embedding").alias("_near"))
    return listed.select("query_id", F.inline(F.arrays_zip("_near.cluster", "_near.distance_sq")))


def nearest_centroid(df: DataFrame, centres: DataFrame, *, item_id: str = "item_id", vector: str = "embedding",
                     cluster: str = "cluster", local_bytes: int = MAX_LOCAL_BYTES) -> DataFrame:
    """Add the nearest cluster and the squared distance to its centroid.

    Used for unseen vectors with stored centroids; nothing is refitted.  Ties go to
    the smaller label; rows without a vector are left out.  Few centres travel to the
    rows, which then stay where they are; many are joined by id, which must be unique.
    """
    named = centres.select(F.col(cluster).alias("cluster"), "embedding").where(F.col("embedding").isNotNull())
    others = [c for c in df.columns if c != cluster]
    local = _local(named, "cluster", local_bytes)
    if local is not None and len(local):
        closest = _listed(np.stack(local["embedding"].to_list()).astype(np.float64), local["cluster"].to_numpy(), 1, named.schema["cluster"].dataType)
        return present(df, vector).withColumn("_near", closest(vector)).select(
            *others, F.get("_near.cluster", F.lit(0)).alias(cluster), F.get("_near.distance_sq", F.lit(0)).alias("centroid_distance_sq"))
    asked = df.select(F.col(item_id).alias("query_id"), F.col(vector).alias("embedding"))
    near = _nearest(asked, named, 1, local_bytes).select(
        F.col("query_id").alias(item_id), F.col("cluster").alias(cluster), F.col("distance_sq").alias("centroid_distance_sq"))
    return df.select(*others).join(near, item_id).select(*others, cluster, "centroid_distance_sq")


def cluster_visits(corpus: DataFrame, queries: DataFrame, centres: DataFrame, n: int, *, cluster: str = "cluster",
                   query_id: str = "query_id", vector: str = "embedding", local_bytes: int = MAX_LOCAL_BYTES,
                   among_items: bool = True) -> DataFrame:
    """``query_id, cluster, cell_rank``: the own cluster, then the others by
    centroid distance, as many as are needed to hold n other items.

    ``among_items``: the queries are items themselves and do not count.

    Clusters without items are left out first.  Every other one holds at least one,
    so its n + 1 nearest centroids are enough and the per-query list is bounded by
    n, not by the cluster count.
    """
    sizes = present(corpus, vector).groupBy(F.col(cluster).alias("cluster")).agg(F.count("*").alias("size"))
    return visits_by_size(sizes, queries, centres, n, cluster=cluster, query_id=query_id, vector=vector, local_bytes=local_bytes,
                          among_items=among_items)


def visits_by_size(sizes: DataFrame, queries: DataFrame, centres: DataFrame, n: int, *, cluster: str = "cluster",
                   query_id: str = "query_id", vector: str = "embedding", local_bytes: int = MAX_LOCAL_BYTES,
                   among_items: bool = True) -> DataFrame:
    """``cluster_visits`` where the clusters' sizes (``cluster, size``, filled ones only) are known."""
    own = present(queries, vector).select(F.col(query_id).alias("query_id"), F.col(cluster).alias("_own"), F.col(vector).alias("embedding"))
    filled = centres.select(F.col(cluster).alias("cluster"), "embedding").join(sizes, "cluster", "left_semi")
    near = _nearest(own.select("query_id", "embedding"), filled, n + 1, local_bytes)
    mine = own.select("query_id", F.col("_own").alias("cluster"), F.lit(-1.0).alias("distance_sq"))
    order = Window.partitionBy("query_id").orderBy("distance_sq", "cluster")
    listed = (
        near.unionByName(mine).groupBy("query_id", "cluster").agg(F.min("distance_sq").alias("distance_sq"))
        .join(sizes, "cluster")
        # the query itself is one of the items of its own cluster
        .withColumn("others", F.col("size") - F.when(F.col("distance_sq") < 0, int(among_items)).otherwise(0))
        .withColumn("cell_rank", F.row_number().over(order) - 1)
        .withColumn("before", F.sum("others").over(order) - F.col("others"))
    )
    return listed.where(F.col("before") < n).select("query_id", F.col("cluster").alias(cluster), "cell_rank")


# --- K-Means ----------------------------------------------------------------

def fit_kmeans(df: DataFrame, k: int, *, vector: str = "embedding", seed: int = SEED,
               max_iter: int = MAX_ITER) -> KMeansModel | None:
    """K-Means on an array column, to convergence.  One cluster needs no model.
    Rows without a vector are left out."""
    if k < 1:
        raise ValueError("k must be positive")
    if k == 1:
        return None
    features = present(df, vector).select(array_to_vector(to_double(F.col(vector))).alias("features"))
    return KMeans(k=k, seed=seed, maxIter=max_iter, initMode="k-means||").fit(features)


def assign_kmeans(df: DataFrame, model: KMeansModel | None, *, vector: str = "embedding",
                  cluster: str = "cluster") -> DataFrame:
    """Add the cluster of every row with a vector; also for rows the model has not seen."""
    df = present(df, vector)
    if model is None:
        return df.withColumn(cluster, F.lit(0))
    featured = df.withColumn("_features", array_to_vector(to_double(F.col(vector))))
    model = model.copy({model.featuresCol: "_features", model.predictionCol: cluster})
    return model.transform(featured).drop("_features")


def model_centroids(df: DataFrame, model: KMeansModel | None, vector: str = "embedding") -> DataFrame:
    """The fitted centres as a table (k rows)."""
    if model is None:
        return centroids(df.withColumn("cluster", F.lit(0)), vector=vector)
    rows = [(i, [float(x) for x in centre]) for i, centre in enumerate(model.clusterCenters())]
    return df.sparkSession.createDataFrame(rows, "cluster int, embedding array<double>")


def kmeans_sweep(df: DataFrame, ks: tuple[int, ...] = SWEEP, *, vector: str = "embedding",
                 seed: int = SEED) -> DataFrame:
    """One ``Cluster_k`` column per k.  The input is read from cache for every
    fit; the assignments are chained projections, no join or pivot."""
    cached = df.persist()
    try:
        models = {k: fit_kmeans(cached, k, vector=vector, seed=seed) for k in ks}
    finally:
        cached.unpersist()
    for k, model in models.items():
        df = assign_kmeans(df, model, vector=vector, cluster=f"Cluster_{k}")
    return df


def lloyd_step(df: DataFrame, centres: DataFrame, *, item_id: str = "item_id", vector: str = "embedding") -> DataFrame:
    """One assignment and mean update: ``cluster, size, cost, embedding``."""
    placed = nearest_centroid(df, centres, item_id=item_id, vector=vector)
    typed = placed.withColumn("_v", array_to_vector(to_double(F.col(vector))))
    moved = typed.groupBy("cluster").agg(
        F.count("*").alias("size"), F.sum("centroid_distance_sq").alias("cost"), Summarizer.mean(F.col("_v")).alias("_m"))
    return moved.select("cluster", "size", "cost", vector_to_array("_m").alias("embedding"))


# --- profiles ---------------------------------------------------------------

def cluster_profile(df: DataFrame, *, item_id: str = "item_id", cluster: str = "cluster",
                    vector: str = "embedding") -> DataFrame:
    """``cluster, size, inertia, radius`` of a clustered table.

    Inertia and radius are against each cluster's own mean, which is joined on
    (k rows) rather than collected.
    """
    from resonara.functions.vectors import squared_l2

    centre = centroids(df, cluster, vector).select(cluster, F.col("embedding").alias("_centre"))
    away = df.join(centre, cluster).select(cluster, squared_l2(F.col(vector), F.col("_centre")).alias("d"))
    return away.groupBy(cluster).agg(F.count("*").alias("size"), F.sum("d").alias("inertia"),
                                     F.sqrt(F.max("d")).alias("radius"))


def contingency(df: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """``cluster, label, n`` with the cluster's size and the label's share."""
    cells = df.groupBy(cluster, label).agg(F.count("*").alias("n"))
    totals = cells.groupBy(cluster).agg(F.sum("n").alias("size"))
    return cells.join(totals, cluster).withColumn("share", F.col("n") / F.col("size"))


def purity(df: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """``cluster, size, purity``: share of the most frequent label."""
    cells = df.groupBy(cluster, label).agg(F.count("*").alias("n"))
    return cells.groupBy(cluster).agg(F.sum("n").alias("size"), (F.max("n") / F.sum("n")).alias("purity"))


def profile_by_feature(df: DataFrame, *features: str, vector: str = "embedding") -> DataFrame:
    """Size and mean vector per combination of the features."""
    return mean_vectors(df, *features, vector=vector)
