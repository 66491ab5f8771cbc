"""Sinks.  Each writes a new folder; no table is overwritten while it is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resonara.functions.urls import watch_url


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV; quotes are doubled so any text survives the round trip."""
    df.write.options(header=True, escape='"', quoteAll=True, emptyValue="").csv(path)


def new_rows(existing: DataFrame, incoming: DataFrame, key: str, arrival: str | None = None) -> DataFrame:
    """Incoming rows whose key is unseen, once per key.

    Of a key's rows the one with the smallest ``arrival`` counts, as it was seen
    first; among equal arrivals, or without such a column, the smallest row.  Keys
    are reduced on the map side first, so a key repeated in a third of the batch
    costs one row per task in the shuffle.
    """
    others = [c for c in incoming.columns if c != key]
    order = [*([arrival] if arrival else []), *(c for c in others if c != arrival)]
    once = incoming.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min(F.struct(*order)).alias("_row")) if others else incoming.select(key).distinct()
    fresh = once.join(existing.select(key), key, "left_anti")
    if not others:
        return fresh
    return fresh.select(key, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*incoming.columns)


def append_if_absent(existing: DataFrame, incoming: DataFrame, key: str, arrival: str | None = None) -> DataFrame:
    """The catalogue with the unseen rows added."""
    return existing.unionByName(new_rows(existing, incoming, key, arrival), allowMissingColumns=True)


def append_new(path: str, existing: DataFrame, incoming: DataFrame, key: str, arrival: str | None = None) -> None:
    """Append only the unseen rows to the stored catalogue."""
    new_rows(existing, incoming, key, arrival).write.mode("append").parquet(path)


def backfill_link(df: DataFrame, key: str = "video_id", link: str = "youtube_link") -> DataFrame:
    """Fill a missing link column, or its NULLs, from the id."""
    made = watch_url(F.col(key).cast("string"))
    return df.withColumn(link, F.coalesce(F.col(link), made) if link in df.columns else made)


def survivors(df: DataFrame, removed: DataFrame, key: str, removed_key: str | None = None) -> DataFrame:
    """Rows whose key was not removed; rows with a NULL key stay."""
    gone = removed.select(F.col(removed_key or key).alias(key))
    return df.join(gone, key, "left_anti")


def rewrite_filtered(datasets: dict[str, tuple[DataFrame, str]], removed: DataFrame, removed_key: str,
                     folder: str, version: str) -> dict[str, str]:
    """Write the survivors of each dataset to ``folder/name/version``."""
    paths = {}
    for name, (df, key) in datasets.items():
        paths[name] = f"{folder}/{name}/version={version}"
        survivors(df, removed, key, removed_key).write.parquet(paths[name])
    return paths


def json_rows(df: DataFrame, *columns: str | Column, name: str = "json") -> DataFrame:
    """One JSON object per row."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias(name))


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def plot_table(coordinates: DataFrame, details: DataFrame, key: str, colour: Column, symbol: Column,
               label: Column) -> DataFrame:
    """The rows behind a chart, joined by key: ``x, y, colour, symbol, label``."""
    joined = coordinates.join(details, key)
    return joined.select(key, "x", "y", colour.cast("string").alias("colour"),
                         symbol.cast("string").alias("symbol"), label.alias("label"))
