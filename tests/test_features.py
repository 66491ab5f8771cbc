"""Dictionaries of many values and totals over sets of features."""

import pytest
from pyspark.sql import functions as F

from resonara.operators import features as FT
from resonara.workspace import written

ROWS = [(1, "b", "x"), (2, "a", None), (3, None, "x"), (4, None, None), (5, "a", "y")]


def test_slots_equal_the_columns(spark):
    df = spark.createDataFrame(ROWS, "key int, one string, two string")
    dictionary = written(FT.category_dictionary(df, "one", "two"), "test-dictionary")
    names = [f"{r['feature']}_{r['value']}" for r in dictionary.orderBy("slot").collect()]
    assert names == ["one_a", "one_b", "two_x", "two_y"]
    plain = {r["key"]: r for r in FT.one_hot(df, "one", "two").collect()}
    rows = FT.one_hot_slots(df, "key", dictionary, "one", "two").collect()
    assert len(rows) == 5
    for row in rows:
        assert [names[slot] for slot in row["slots"]] == [name for name in names if plain[row["key"]][name]]


def test_more_values_than_columns_can_be(spark):
    df = spark.range(50_000).select(F.col("id").alias("key"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), "id")).alias("tag"))
    dictionary = written(FT.category_dictionary(df, "tag"), "test-dictionary")
    size, low, high = dictionary.agg(F.count("*"), F.min("slot"), F.max("slot")).first()
    assert (size, low, high) == (33_334, 0, 33_333)
    slots = FT.one_hot_slots(df, "key", dictionary, "tag")
    assert slots.where(F.size("slots") == 1).count() == 50_000
    assert slots.where("key % 3 = 0").select(F.col("slots")[0]).distinct().count() == 1
    with pytest.raises(ValueError):
        FT.categories_of(df, "tag")


def test_breakdown(spark):
    df = spark.createDataFrame(ROWS, "key int, one string, two string")
    got = {(r["one"], r["two"], r["level"]): r["items"] for r in FT.breakdown(df, ["one", "two"], [[], ["one"], ["one", "two"]]).collect()}
    assert got[(None, None, 3)] == 5 and got[(None, None, 1)] == 2 and got[("a", None, 1)] == 2
    assert got[(None, None, 0)] == 1 and got[("a", None, 0)] == 1 and got[("a", "y", 0)] == 1 and len(got) == 9
    with pytest.raises(ValueError):
        FT.breakdown(df, ["one"], [["three"]])
