"""Embeddings of the same items by several models: choice of one, and comparison of two.

A table of embeddings has a ``model`` column and is stored with a folder per model,
so a query for one model reads that model's files only.  Two models are compared by
the neighbourhoods they give each item and by the likeness of their whole geometry.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resonara.operators.neighbours import knn, present
from resonara.operators.project import covariance
from resonara.workspace import written

# --- fixed values -----------------------------------------------------------
PERSISTENCE = 0.9  # weight of each further rank in the rank-biased overlap
# ----------------------------------------------------------------------------


def write_models(embeddings: DataFrame, path: str) -> None:
    """Store ``model, item_id, embedding, ...`` with one folder per model; a model written again replaces its folder."""
    (embeddings.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model").parquet(path))


def read_model(spark: SparkSession, path: str, model: str) -> DataFrame:
    """The items of one model; other models' files are not read.  An unknown model is an error."""
    stored = spark.read.option("basePath", path).parquet(path)
    found = stored.where(F.col("model").cast("string") == model)
    if not found.inputFiles() or found.isEmpty():
        raise ValueError(f"no embeddings of model {model!r}")
    return found.drop("model")


def select_model(embeddings: DataFrame, model: str) -> DataFrame:
    """The rows of one model of a table in memory or on disk."""
    return embeddings.where(F.col("model").cast("string") == model).drop("model")


def _persistence_weights(k: int, persistence: float) -> np.ndarray:
    """Weight of a shared item by the deeper of its two ranks: it counts in the overlap of every depth from there on."""
    depths = np.arange(1, k + 1)
    steps = persistence ** (depths - 1) / depths
    return np.cumsum(steps[::-1])[::-1] * (1 - persistence) / (1 - persistence ** k)


def neighbourhood_agreement(first: DataFrame, second: DataFrame, k: int, *, persistence: float = PERSISTENCE, plan: str = "auto",
                            block_rows: int | None = None) -> DataFrame:
    """``item_id, shared, overlap, rank_biased`` for every item with a vector in both models.

    ``first`` and ``second`` have ``item_id, embedding``; their widths may differ.
    Only items of both models are neighbours, so the two lists speak of the same
    collection.  ``shared`` counts items among the k nearest in both models,
    ``overlap`` is their share, ``rank_biased`` the rank-biased overlap cut at k
    (1 for equal lists).  Each model is searched once.  Fewer than k others make the
    lists shorter and the shares relative to them.
    """
    if not 0 < persistence < 1:
        raise ValueError("persistence must lie between 0 and 1")
    both = present(first).select("item_id").join(present(second).select("item_id"), "item_id", "left_semi")
    lists = []
    for name, space in (("a", first), ("b", second)):
        # stored: the search counts its items and picks pivots before it reads their vectors
        items = written(present(space).select("item_id", "embedding").join(both, "item_id", "left_semi"), f"items-{name}")
        near = knn(items, items.withColumnRenamed("item_id", "query_id"), k, plan=plan, block_rows=block_rows)
        lists.append(near.select("query_id", "item_id", F.col("rank").alias(f"{name}_rank")))
    # a short list ends early; deeper ranks then weigh nothing, so the sum is scaled by what full agreement would reach
    weights = F.array(*[F.lit(float(w)) for w in _persistence_weights(k, persistence)])
    in_both = F.col("b_rank").isNotNull()
    found = lists[0].join(lists[1], ["query_id", "item_id"], "left").groupBy("query_id").agg(
        F.count("*").alias("size"), F.count_if(in_both).alias("shared"), F.sum(F.element_at(weights, F.col("a_rank"))).alias("most"),
        F.sum(F.when(in_both, F.element_at(weights, F.greatest("a_rank", F.coalesce("b_rank", F.lit(0)))))).alias("sum"))
    return both.join(found.withColumnRenamed("query_id", "item_id"), "item_id", "left").select(
        "item_id", F.coalesce("shared", F.lit(0)).alias("shared"),
        F.coalesce(F.try_divide("shared", "size"), F.lit(0.0)).alias("overlap"),
        F.coalesce(F.try_divide("sum", "most"), F.lit(0.0)).alias("rank_biased"))


def linear_cka(first: DataFrame, second: DataFrame) -> DataFrame:
    """One row ``items, cka``: linear centred kernel alignment of two models over their common items, 0 to 1.

    1 means equal geometry up to rotation and scale.  Needs the sums of products of
    dimensions only, so no item meets another.
    """
    pairs = present(first).select("item_id", F.col("embedding").alias("_a")).join(
        present(second).select("item_id", F.col("embedding").alias("_b")), "item_id")
    joined = pairs.select(F.size("_a").alias("_width"), F.concat(F.col("_a").cast("array<double>"), F.col("_b").cast("array<double>")).alias("embedding"))
    size = joined.agg(F.count("*").alias("items"), F.max("_width").alias("width")).first()
    spark = first.sparkSession
    if size["items"] < 2:
        return spark.createDataFrame([(size["items"], None)], "items long, cka double")
    width = size["width"]
    block = F.when((F.col("i") < width) & (F.col("j") < width), "aa").when((F.col("i") >= width) & (F.col("j") >= width), "bb").when(F.col("i") < width, "ab")
    norms = covariance(joined).where(block.isNotNull()).groupBy(block.alias("block")).agg(F.sum(F.col("cov") * F.col("cov")).alias("squares"))
    sums = norms.agg(*[F.max(F.when(F.col("block") == name, F.col("squares"))).alias(name) for name in ("aa", "bb", "ab")])
    return sums.select(F.lit(size["items"]).cast("long").alias("items"), F.try_divide(F.col("ab"), F.sqrt(F.col("aa") * F.col("bb"))).alias("cka"))
