"""Pages from a stored directory of ranges."""

import pytest
from pyspark.sql import functions as F

from resonara.operators import ordering as O


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rows = spark.range(1000).select(F.col("id"), (F.col("id") * 7 % 10).alias("rank"), F.lit("x").alias("_other"))
    path = str(tmp_path_factory.mktemp("pages") / "stored")
    O.store_pages(rows, [F.col("rank").desc(), "id"], path, part_rows=64)
    return O.open_pages(spark, path)


def test_any_page(stored):
    order = sorted(range(1000), key=lambda n: (-(n * 7 % 10), n))
    assert stored.total == 1000 and stored.pages(30) == 34
    for number in (1, 2, 3, 17, 34):
        rows = sorted((r["position"], r["id"]) for r in stored.page(number, 30).collect())
        assert rows == [(at + 1, order[at]) for at in range(30 * (number - 1), min(30 * number, 1000))]
    assert stored.page(35, 30).count() == 0 and stored.page(1, 30).columns == ["id", "rank", "_other", "position"]
    with pytest.raises(ValueError):
        stored.page(0)


def test_a_page_reads_its_ranges_only(stored):
    assert stored.ranges(31, 30) == [14] and stored.ranges(33, 30) == [15] and stored.ranges(99, 30) == []
    assert stored.ranges(30, 30) == [13, 14]  # it lies across a border
    plan = stored.page(31, 30)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(_range" in plan or "PartitionFilters: [isnotnull(_range" in plan


def test_empty_table(spark, tmp_path):
    stored = O.store_pages(spark.range(0), ["id"], str(tmp_path / "none"))
    assert stored.total == 0 and stored.pages() == 0 and stored.page(1).count() == 0
