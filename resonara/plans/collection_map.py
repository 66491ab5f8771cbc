"""Map and cluster a collection: one row per item with everything a chart needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resonara.functions.categories import category_clean, instrumentation_bucket, voice_class
from resonara.functions.text import label, strip
from resonara.operators.catalogue import join_metadata
from resonara.operators.cluster import SWEEP, kmeans_sweep
from resonara.operators.features import palette
from resonara.operators.neighbour_map import neighbour_map
from resonara.operators.project import fit_pca, project, to_xy
from resonara.workspace import written


def clean_metadata(df: DataFrame) -> DataFrame:
    """Readable categories from the curated columns that are present."""
    rules = {
        "Instrumentation": ("instruments", instrumentation_bucket),
        "Genre": ("genre_main", category_clean),
        "Gender Voice": ("voice", voice_class),
        "Acoustic vs Electronic": ("sound", strip),
    }
    present = {new: rule(F.col(f"`{old}`").cast("string")) for old, (new, rule) in rules.items() if old in df.columns}
    return df.withColumns(present).drop(*rules)


def collection_map(items: DataFrame, metadata: DataFrame, *, ks: tuple[int, ...] = SWEEP, layout: str = "pca",
                   cluster_on: str = "coordinates", **map_options) -> DataFrame:
    """``item_id, label, population, categories, x, y, Cluster_k``.

    ``items``: item_id, artist, song, population, embedding.  ``layout`` is
    ``pca`` or ``neighbours``; K-Means runs on the ``coordinates`` or the
    ``embedding``.
    """
    joined = clean_metadata(join_metadata(items, metadata, "item_id"))
    originals = [F.col(f"{c}_original") if f"{c}_original" in joined.columns else None for c in ("artist", "song")]
    joined = joined.withColumn("label", label(F.col("artist"), F.col("song"), *originals))
    if "genre_main" in joined.columns:
        joined = joined.join(palette(joined, "genre_main").withColumnsRenamed(
            {"category": "genre_main", "colour": "genre_colour"}), "genre_main", "left")
    if layout == "pca":
        placed = to_xy(project(joined, fit_pca(items, 2)))
    else:
        placed = joined.join(neighbour_map(items, **map_options), "item_id")
    # every fit of the sweep reads the map
    placed = written(placed.withColumn("coordinates", F.array("x", "y")), "map")
    return kmeans_sweep(placed, ks, vector=cluster_on).drop("coordinates", "embedding")
