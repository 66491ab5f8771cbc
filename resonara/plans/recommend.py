"""From metadata, vectors and requests to ranked rows and map coordinates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resonara.functions.text import normalize_text
from resonara.functions.urls import classify_url, extract_video_id, watch_url
from resonara.functions.vectors import percent_label, similarity_percent
from resonara.operators import cluster as C
from resonara.operators.catalogue import default_columns
from resonara.operators.fuzzy import SERVICE_THRESHOLD, fuzzy_join, resolve_queries
from resonara.operators.neighbours import knn_widen
from resonara.operators.project import result_coordinates
from resonara.workspace import written

# --- fixed values -----------------------------------------------------------
DEFAULT_NEIGHBOURS = 5
DEFAULT_CLUSTERS = 1
# ----------------------------------------------------------------------------


@dataclass
class Collection:
    """Linked, clustered items ready to be searched.  Built once, used by every
    batch of requests."""

    items: DataFrame  # item_id, artist, song, video_id, link, cluster, embedding
    centres: DataFrame  # cluster, embedding


@dataclass
class Recommendations:
    rows: DataFrame
    coordinates: DataFrame
    errors: DataFrame


def link_metadata(vectors: DataFrame, metadata: DataFrame, threshold: float = SERVICE_THRESHOLD) -> DataFrame:
    """Items with the video of their best metadata row; items without are dropped.

    Only ids and keys go through the fuzzy join, never the vectors.
    """
    keys = vectors.select("item_id", normalize_text(F.concat_ws(" ", "artist", "song")).alias("query_key"))
    known = metadata.select("video_id", normalize_text(F.concat_ws(" ", "channel_name", "song_title")).alias("meta_key"))
    linked = fuzzy_join(keys, known, "query_key", "meta_key", "video_id", threshold, unique_right=True)
    linked = linked.select("item_id", "video_id", watch_url(F.col("video_id").cast("string")).alias("link"))
    return vectors.join(linked, "item_id")


def build_collection(vectors: DataFrame, metadata: DataFrame, k: int = DEFAULT_CLUSTERS,
                     centres: DataFrame | None = None, threshold: float = SERVICE_THRESHOLD) -> Collection:
    """Link the items and cluster them, by stored centres or by a new K-Means."""
    items = link_metadata(vectors, metadata, threshold)
    if centres is not None:
        return Collection(C.nearest_centroid(items, centres).drop("centroid_distance_sq"), centres)
    model = C.fit_kmeans(items, k)
    return Collection(C.assign_kmeans(items, model), C.model_centroids(items, model))


def _answers(collection: Collection, hits: DataFrame, queries: DataFrame, n: int, among_items: bool) -> tuple[DataFrame, DataFrame]:
    """Ranked rows and coordinates for ``hits`` (request_id, query_id).

    ``queries`` has ``query_id, cluster, embedding``, once per query.
    """
    items = collection.items
    visits = C.cluster_visits(items, queries, collection.centres, n, among_items=among_items)
    found = written(knn_widen(items, queries, visits, n, skip_self=among_items), "found")
    details = items.select("item_id", "artist", "song", "video_id", "link")
    percent = similarity_percent(F.col("distance_sq"))
    ranked = hits.join(found.join(details, "item_id"), "query_id").select(
        "request_id", "query_id", "rank", "item_id", "artist", "song", "distance_sq", "distance",
        percent.alias("percent"), percent_label(percent).alias("similarity"), "link", "video_id")
    ranked = default_columns(ranked, ["artist", "song", "link"])
    near = found.select("query_id", "item_id").join(items.select("item_id", "embedding"), "item_id").select("query_id", "item_id", "embedding")
    own = queries.select("query_id", F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id"), "embedding")
    if among_items:
        own = own.withColumn("item_id", F.col("query_id"))
    xy = result_coordinates(near.unionByName(own), "query_id", "item_id").join(details.select("item_id", "artist", "song"), "item_id", "left")
    is_query = F.col("item_id") == F.col("query_id") if among_items else F.col("item_id").isNull()
    coordinates = hits.join(xy, "query_id").select("request_id", "item_id", "artist", "song", "x", "y", is_query.alias("is_query"))
    return ranked, coordinates


def recommend_items(collection: Collection, resolved: DataFrame, n: int) -> Recommendations:
    """Answers for ``request_id, item_id``; a null item is an unknown query."""
    hits = resolved.where("item_id is not null").select("request_id", F.col("item_id").alias("query_id"))
    asked = hits.select(F.col("query_id").alias("item_id")).distinct()
    queries = collection.items.join(asked, "item_id", "left_semi").withColumnRenamed("item_id", "query_id")
    ranked, coordinates = _answers(collection, hits, queries, n, among_items=True)
    errors = resolved.where("item_id is null").select("request_id", F.lit("query not found").alias("error"))
    return Recommendations(ranked, coordinates, errors)


def recommend(collection: Collection, requests: DataFrame, n: int = DEFAULT_NEIGHBOURS,
              threshold: float = SERVICE_THRESHOLD) -> Recommendations:
    """n neighbours for every ``request_id, artist, song``.

    Requests for the same item share one search.
    """
    names = collection.items.select("item_id", "artist", "song")
    resolved = resolve_queries(requests, names, threshold=threshold)
    # what the rows, the coordinates and the errors share is computed once
    return recommend_items(collection, written(resolved, "resolved"), n)


def resolve_links(collection: Collection, requests: DataFrame) -> DataFrame:
    """``request_id, item_id`` of the item that belongs to the video a link names.

    Null where the link names no single video or one that is not in the
    collection; of several items of a video the smallest counts.
    """
    videos = (collection.items.where("video_id is not null").groupBy(F.col("video_id").cast("string").alias("video"))
              .agg(F.min("item_id").alias("item_id")))
    asked = requests.select("request_id", F.when(classify_url(F.col("url")) == "ok", extract_video_id(F.col("url"))).alias("video"))
    return asked.join(videos, "video", "left").select("request_id", "item_id")


def recommend_by_link(collection: Collection, requests: DataFrame, n: int = DEFAULT_NEIGHBOURS) -> Recommendations:
    """n neighbours for every ``request_id, url`` whose video is in the collection."""
    return recommend_items(collection, written(resolve_links(collection, requests), "resolved"), n)


def recommend_unseen(collection: Collection, requests: DataFrame, n: int = DEFAULT_NEIGHBOURS) -> Recommendations:
    """n neighbours for every ``request_id, embedding`` of an item that is not stored.

    The vector joins the collection for its own search: it is placed by the stored
    centres and mapped beside its neighbours.  Requests without a vector are errors.
    """
    asked = requests.select(F.col("request_id").alias("query_id"), "embedding")
    placed = C.nearest_centroid(asked, collection.centres, item_id="query_id").select("query_id", "cluster", "embedding")
    queries = written(placed, "unseen")
    hits = queries.select(F.col("query_id").alias("request_id"), "query_id")
    ranked, coordinates = _answers(collection, hits, queries, n, among_items=False)
    errors = requests.where("embedding is null").select("request_id", F.lit("no vector").alias("error"))
    return Recommendations(ranked, coordinates, errors)
