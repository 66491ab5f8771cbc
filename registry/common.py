"""How the given tables stand in for items, catalogues and requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resonara.workspace import balanced

FRAMES_PER_ITEM = 5


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Long texts for work that is heavy per row."""
    return balanced(table(spark, folder, name).select(*columns))


def items(spark: SparkSession, folder: str) -> DataFrame:
    """``item_id, cluster, embedding``."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("item_id"), F.col("label").alias("cluster"), "embedding")


def as_queries(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("item_id", "query_id")


def frame_items(spark: SparkSession, folder: str) -> DataFrame:
    """``item_id, frames``: consecutive vectors as the frames of one item."""
    one = table(spark, folder, "embeddings").select(
        F.floor(F.col("vec_id") / FRAMES_PER_ITEM).alias("item_id"), "vec_id", "embedding")
    framed = one.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))).alias("rows"))
    return framed.select("item_id", F.col("rows.embedding").alias("frames"))


def title_of(html) -> F.Column:
    return F.regexp_extract(html, "<title>([^<]*)</title>", 1)


def footer_of(html) -> F.Column:
    return F.regexp_extract(html, "<footer>&copy; [^ ]* &middot; ([^<]*)</footer>", 1)


def rounded(column, places: int = 6):
    """Rounded, and never a negative zero."""
    return F.round(column, places) + F.lit(0.0)
