"""Tabular features: one-hot, scaling, colour keys."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resonara.functions.categories import GENRE_PALETTE, SPARE_COLOURS
from resonara.operators.lookup import keyed_lookup
from resonara.operators.ordering import with_position
from resonara.workspace import written

MAX_CATEGORIES = 2000  # beyond this, categories do not become columns


def categories_of(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values; more than the bound is an error."""
    rows = df.select(F.col(column).cast("string").alias("c")).where("c is not null").distinct()
    found = [r["c"] for r in rows.orderBy("c").limit(MAX_CATEGORIES + 1).collect()]
    if len(found) > MAX_CATEGORIES:
        raise ValueError(f"{column} has more than {MAX_CATEGORIES} categories; use one_hot_vector")
    return found


def one_hot(df: DataFrame, *columns: str) -> DataFrame:
    """Replace each column by one 0/1 column ``column_value`` per value.  A NULL
    is 0 everywhere."""
    encoded = {}
    for column in columns:
        for value in categories_of(df, column):
            encoded[f"{column}_{value}"] = F.coalesce(F.col(column).cast("string") == value, F.lit(False)).cast("int")
    return df.withColumns(encoded).drop(*columns) if encoded else df


def one_hot_vector(df: DataFrame, *columns: str, name: str = "one_hot") -> DataFrame:
    """Sparse one-hot vector for columns with many values."""
    stages = []
    for column in columns:
        stages.append(StringIndexer(inputCol=column, outputCol=f"_{column}_at", stringOrderType="alphabetAsc",
                                    handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCol=f"_{column}_at", outputCol=f"_{column}_hot", dropLast=True))
    stages.append(VectorAssembler(inputCols=[f"_{c}_hot" for c in columns], outputCol=name))
    encoded = Pipeline(stages=stages).fit(df).transform(df)
    return encoded.drop(*[f"_{c}_{part}" for c in columns for part in ("at", "hot")])


def category_dictionary(df: DataFrame, *columns: str) -> DataFrame:
    """``feature, value, slot, rows``: every value of every column with a place of its own, from 0 on.

    Slots follow the order of the columns, then of the values.  The dictionary is a
    distributed table and may have any number of values; nulls have no slot.
    """
    order = F.create_map(*[part for n, column in enumerate(columns) for part in (F.lit(column), F.lit(n))])
    counted = _values(df, columns).groupBy("feature", "value").agg(F.count("*").alias("rows"))
    placed = with_position(counted.withColumn("_order", F.element_at(order, F.col("feature"))), ["_order", "value"], "slot")
    return placed.select("feature", "value", (F.col("slot") - 1).alias("slot"), "rows")


def _values(df: DataFrame, columns: tuple[str, ...], *keys: str) -> DataFrame:
    """Long form ``keys, feature, value`` of the columns that are not null."""
    cells = F.array(*[F.struct(F.lit(column).alias("feature"), F.col(column).cast("string").alias("value")) for column in columns])
    return df.select(*keys, F.inline(cells)).where("value is not null")


def one_hot_slots(df: DataFrame, key: str, dictionary: DataFrame, *columns: str) -> DataFrame:
    """``key, slots``: the filled slots of each row's one-hot vector, ascending; none for a row without values.

    ``dictionary`` is a stored ``category_dictionary``; values that it lacks fill no
    slot.  Frequent values are looked up apart, so none of them fills a task.  Keys are unique.
    """
    long = written(_values(df, columns, key), "cells")
    found = keyed_lookup(long, dictionary, ["feature", "value"], "rows").groupBy(key).agg(F.sort_array(F.collect_list("slot")).alias("slots"))
    return df.select(key).join(found, key, "left").select(key, F.coalesce("slots", F.array().cast("array<bigint>")).alias("slots"))


def breakdown(df: DataFrame, features: list[str], sets: list[list[str]]) -> DataFrame:
    """``features, level, items``: how many rows hold each combination of values, for several sets of features in one pass.

    A feature that a set leaves out is null there; ``level`` tells such nulls from
    those of the data: bit n from the right is set where the n-th last feature is left out.
    """
    unknown = {name for chosen in sets for name in chosen} - set(features)
    if unknown:
        raise ValueError(f"not among the features: {sorted(unknown)}")
    grouped = df.groupingSets([[F.col(name) for name in chosen] for chosen in sets], *[F.col(name) for name in features])
    return grouped.agg(F.grouping_id().cast("long").alias("level"), F.count("*").alias("items"))


def zscore(df: DataFrame, *columns: str) -> DataFrame:
    """Centre and divide by the population deviation; a constant becomes 0.

    Mean and deviation are two numbers per column; they return as literals, so
    the scaled table needs no join.
    """
    stats = df.agg(*[F.avg(c).alias(f"{c}_mean") for c in columns],
                   *[F.stddev_pop(c).alias(f"{c}_dev") for c in columns]).first()

    def scaled(column: str):
        mean, dev = stats[f"{column}_mean"], stats[f"{column}_dev"]
        if mean is None:
            return F.lit(None).cast("double")
        return (F.col(column) - F.lit(mean)) / F.lit(dev or 1.0)

    return df.withColumns({c: scaled(c) for c in columns})


def metadata_features(df: DataFrame, key: str, categorical: list[str], scaled: list[str],
                      numeric: list[str] = ()) -> DataFrame:
    """The numeric table behind the metadata projection: one-hot categories,
    z-scored columns, rows with a missing feature dropped, key carried along."""
    table = df.select(key, *categorical, *scaled, *numeric)
    return one_hot(zscore(table, *scaled), *categorical).dropna()


def as_vector(df: DataFrame, key: str, name: str = "embedding") -> DataFrame:
    """All columns but the key as one array, in column order."""
    return df.select(key, F.array(*[F.col(f"`{c}`").cast("double") for c in df.columns if c != key]).alias(name))


def palette(df: DataFrame, category: str, fixed: dict[str, str] = GENRE_PALETTE,
            spare: tuple[str, ...] = SPARE_COLOURS) -> DataFrame:
    """``category, colour`` for every distinct category.

    Known names keep their colour.  The others take the spare colours in turn,
    in name order, numbered across partitions without a global window.
    """
    names = df.select(F.col(category).alias("category")).where(F.col(category).isNotNull()).distinct()
    known = F.create_map(*[F.lit(x) for pair in fixed.items() for x in pair])
    coloured = names.withColumn("colour", F.try_element_at(known, F.col("category")))
    unseen = with_position(coloured.where("colour is null").select("category"), ["category"], "position")
    cycle = F.array(*[F.lit(c) for c in spare])
    index = F.pmod(F.col("position") - 1, F.lit(len(spare))).cast("int")
    return coloured.where("colour is not null").unionByName(
        unseen.select("category", F.get(cycle, index).alias("colour")))
