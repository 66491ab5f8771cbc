"""Global positions and paging without a single-task window."""

from __future__ import annotations

import json
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from resonara.workspace import written

# monotonically_increasing_id keeps the partition number above this many bits.
_ROW_BITS = 33


def with_position(df: DataFrame, order_by: list[str | Column], name: str = "position") -> DataFrame:
    """Add the 1-based position of each row in a total order.

    Rows are range-partitioned and sorted once, and written so that both uses
    see the same partitions.  Only one count per partition is then summed up;
    no row goes through a global window.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order_by]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = written(placed.withColumn("_row", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright(F.col("_row"), _ROW_BITS)
    placed = placed.select("*", part.alias("_part"),
                           (F.col("_row") - F.shiftleft(part, _ROW_BITS)).alias("_offset"))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        placed.join(starts, "_part")
        .withColumn(name, F.col("_start") + F.col("_offset") + 1)
        .drop("_row", "_part", "_offset", "_start")
    )


def check_page(page: int, per_page: int) -> None:
    if page < 1 or per_page < 1:
        raise ValueError("page and per_page start at 1")


def page(df: DataFrame, order_by: list[str], page_number: int, per_page: int = 10) -> DataFrame:
    """One page of an ordered table; past the end it is empty."""
    check_page(page_number, per_page)
    return df.orderBy(*order_by).offset((page_number - 1) * per_page).limit(per_page)


def next_page(df: DataFrame, key: str, after, per_page: int = 10) -> DataFrame:
    """The page after key value ``after``; the cost does not grow with depth."""
    check_page(1, per_page)
    rows = df if after is None else df.where(F.col(key) > F.lit(after))
    return rows.orderBy(key).limit(per_page)


def page_numbers(df: DataFrame, order_by: list[str], per_page: int = 10) -> DataFrame:
    """The whole table with ``position`` and ``page`` of every row."""
    check_page(1, per_page)
    placed = with_position(df, order_by)
    return placed.withColumn("page", F.ceil(F.col("position") / per_page))


def page_totals(df: DataFrame, per_page: int = 10) -> DataFrame:
    """``total`` rows and number of ``pages``."""
    check_page(1, per_page)
    return df.agg(F.count("*").alias("total")).withColumn(
        "pages", F.ceil(F.col("total") / per_page))


# --- stored pages -----------------------------------------------------------

PART_ROWS = 65_536


@dataclass
class PageDirectory:
    """An ordered table stored in ranges, with the first position and the number of rows of each.

    Written once by ``store_pages``.  A page reads the one or two ranges it lies in,
    however deep; totals come from the directory.
    """

    spark: SparkSession
    path: str
    schema: StructType
    starts: list[int]  # positions before each range, ascending; a number per range
    total: int

    def pages(self, per_page: int = 10) -> int:
        check_page(1, per_page)
        return -(-self.total // per_page)

    def ranges(self, page_number: int, per_page: int = 10) -> list[int]:
        """The ranges that hold rows of a page."""
        check_page(page_number, per_page)
        first, last = (page_number - 1) * per_page, min(page_number * per_page, self.total) - 1
        return list(range(bisect_right(self.starts, first) - 1, bisect_right(self.starts, last))) if first <= last else []

    def page(self, page_number: int, per_page: int = 10) -> DataFrame:
        """One page with ``position``; past the end it is empty."""
        check_page(page_number, per_page)
        rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")
        wanted = self.ranges(page_number, per_page)
        low, high = (page_number - 1) * per_page, page_number * per_page
        # the folders of other ranges are not read
        return rows.where(F.col("_range").isin(wanted) if wanted else F.lit(False)).where((F.col("position") > low) & (F.col("position") <= high)).drop("_range")


def store_pages(df: DataFrame, order_by: list[str | Column], path: str, part_rows: int = PART_ROWS) -> PageDirectory:
    """Store ``df`` in its total order for ``PageDirectory``; equal keys of the order follow one another anyhow."""
    placed = with_position(df, order_by)
    number = F.floor((F.col("position") - 1) / part_rows).cast("int")
    rows = placed.withColumn("_range", number).repartitionByRange("_range", "position").sortWithinPartitions("_range", "position")
    rows.write.partitionBy("_range").parquet(f"{path}/rows")
    spark = df.sparkSession
    sizes = spark.read.schema(rows.schema).parquet(f"{path}/rows").groupBy("_range").agg(F.count("*").alias("rows"))
    sizes.write.parquet(f"{path}/directory")
    spark.createDataFrame([(rows.schema.json(),)], "schema string").write.parquet(f"{path}/schema")
    return open_pages(spark, path)


def open_pages(spark: SparkSession, path: str) -> PageDirectory:
    """The directory of a stored table: a row per range, none of the table's own."""
    schema = StructType.fromJson(json.loads(spark.read.parquet(f"{path}/schema").first()["schema"]))
    sizes = [row["rows"] for row in spark.read.schema("_range int, rows long").parquet(f"{path}/directory").orderBy("_range").collect()]
    return PageDirectory(spark, path, schema, list(accumulate([0, *sizes[:-1]])), sum(sizes))
