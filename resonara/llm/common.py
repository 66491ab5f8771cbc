"""Steps shared by the operators on documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from resonara.operators.lookup import keyed_lookup
from resonara.workspace import new_folder

__all__ = ["bucketed", "documents", "keyed_lookup", "table"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """Write ``df`` to the shared folder in as many buckets of ``key`` as a shuffle has partitions, and read it back.

    Grouping or joining it by ``key`` then moves only the other side.  Its entry in
    the catalogue is dropped at once; the files stay.
    """
    spark, entry = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", new_folder(spark, name)).saveAsTable(entry)
    found = spark.table(entry)
    spark.sql(f"DROP TABLE {entry}")
    return found
