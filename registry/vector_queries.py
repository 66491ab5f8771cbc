"""Projections on vectors and exact neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import as_queries, frame_items, items, rounded, table
from resonara.functions import vectors as V
from resonara.operators import neighbours as N
from resonara.operators.cluster import centroids, cluster_visits, nearest_centroid
from resonara.operators.quantised import knn_quantised
from resonara.sources import readers as R

K = 5

FRAMES_SQL = """
frames as (
  select vec_id // 5 as item_id, vec_id % 5 as frame, embedding::double[] as embedding from embeddings),
cells as (
  select item_id, frame, unnest(range(64)) as dim, unnest(embedding) as value from frames)
"""


def _long(df, key="item_id"):
    return V.explode_dims(df, "embedding", key).withColumn("value", rounded("value"))


def src_embeddings(spark, sf):
    frames = frame_items(spark, sf).withColumnRenamed("frames", "embedding")
    pooled = R.tag_population(R.pooled(frames, frames="embedding"), "all")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return pooled.select("item_id", "population", F.size("embedding").cast("long").alias("dims"),
                         rounded(total).alias("total"))


def src_conform_ids(spark, sf):
    base = table(spark, sf, "embeddings")
    a = base.select(F.concat(F.lit("a"), "vec_id").alias("id"), F.concat(F.lit("artist "), "label").alias("artist"),
                    F.concat(F.lit("song "), "vec_id").alias("song"))
    b = base.select(F.concat(F.lit("b"), "vec_id").alias("video_id"), F.lit(" ").alias("youtube_link"),
                    F.concat(F.lit("channel "), "label").alias("channel_name"),
                    F.concat(F.lit("title "), "vec_id").alias("song_title"))
    both = R.union_tagged(old=a, new=b)
    return R.conform_records(both)


def src_token_rows(spark, sf):
    rows = frame_items(spark, sf).select(F.struct("frames", F.lit("x").alias("artist"),
                                                  F.col("item_id").alias("song")).alias("token"))
    rows = rows.select("token.*")
    return rows.select("song", "artist", F.size("frames").cast("long").alias("frames"),
                       F.size(F.flatten("frames")).cast("long").alias("values"))


def vec_mean_pool(spark, sf):
    df = frame_items(spark, sf)
    return _long(df.select("item_id", V.mean_pool(F.col("frames")).alias("embedding")))


def vec_pool_or_pass(spark, sf):
    matrix = frame_items(spark, sf).withColumn("kind", F.lit("matrix"))
    flat = items(spark, sf).select("item_id", F.col("embedding").alias("vector"), F.lit("vector").alias("kind"))
    pooled = R.pooled(matrix.unionByName(flat, allowMissingColumns=True))
    return V.explode_dims(pooled, "embedding", "item_id", "kind").withColumn("value", rounded("value"))


def vec_mean_squeeze(spark, sf):
    nested = frame_items(spark, sf).select("item_id", F.transform("frames", lambda f: F.array(f)).alias("batches"))
    return _long(nested.select("item_id", V.mean_and_squeeze(F.col("batches")).alias("embedding")))


def vec_flatten_truncate(spark, sf):
    df = frame_items(spark, sf)
    return _long(df.select("item_id", V.flatten_truncate(F.col("frames"), 4, 200).alias("embedding")))


def vec_select_token(spark, sf):
    return _long(V.select_token(frame_items(spark, sf), "frames", 2).select("item_id", "embedding"))


def vec_explode_dims(spark, sf):
    return _long(items(spark, sf))


def pair_similarity(spark, sf):
    base = items(spark, sf)
    pairs = base.select(F.col("item_id").alias("key1"), (F.col("item_id") + 1).alias("key2"))
    found = N.pair_similarity(base, pairs)
    return found.select("key1", "key2", rounded("cosine").alias("cosine"), rounded("euclidean").alias("euclidean"))


def _shown(df, value):
    return df.select("query_id", "item_id", "rank", rounded(value).alias(value))


def knn_l2_topn(spark, sf):
    base = items(spark, sf)
    return _shown(N.knn(base, as_queries(base), K), "distance_sq")


def knn_l2_blocks(spark, sf):
    base = items(spark, sf)
    return _shown(N.knn(base, as_queries(base), K, plan="blocks", block_rows=512), "distance_sq")


def knn_l2_pivots(spark, sf):
    """Many cells: own cell first, then those its bound cannot rule out."""
    base = items(spark, sf)
    return _shown(N.knn(base, as_queries(base), K, plan="blocks", cells=24), "distance_sq")


def knn_cosine_pivots(spark, sf):
    base = items(spark, sf)
    return _shown(N.knn(base, as_queries(base), K, metric="cosine", plan="blocks", cells=24), "similarity")


def knn_l2_quantised(spark, sf):
    """From one byte per dimension; only what its bounds leave is measured."""
    base = items(spark, sf)
    return _shown(knn_quantised(base, as_queries(base), K)[0], "distance_sq")


def knn_cosine_quantised(spark, sf):
    base = items(spark, sf)
    return _shown(knn_quantised(base, as_queries(base), K, metric="cosine", cells=24)[0], "similarity")


def nearest_centroid_shipped(spark, sf):
    base = items(spark, sf)
    return _placed(nearest_centroid(base.drop("cluster"), centroids(base)))


def nearest_centroid_joined(spark, sf):
    """The plan for many centres; the same rows."""
    base = items(spark, sf)
    return _placed(nearest_centroid(base.drop("cluster"), centroids(base), local_bytes=0))


def _placed(df):
    return df.select("item_id", "cluster", rounded("centroid_distance_sq").alias("distance_sq"))


def knn_widen_sparse(spark, sf):
    """Centres of all labels, items of every third label only: most centres are empty."""
    base, wanted = items(spark, sf), 55
    some = base.where("cluster % 3 = 0")
    visits = cluster_visits(some, as_queries(base), centroids(base), wanted, among_items=False)
    found = N.knn_widen(some, as_queries(base), visits, wanted, skip_self=False)
    return found.select("query_id", "item_id", "rank", rounded("distance_sq").alias("distance_sq"))


def knn_cosine(spark, sf):
    base = items(spark, sf)
    return _shown(N.knn(base, as_queries(base), K, metric="cosine"), "similarity")


def cosine_topn(spark, sf):
    base = items(spark, sf)
    return _shown(N.knn_in_cluster(base, as_queries(base), K, metric="cosine"), "similarity")


def knn_in_cluster(spark, sf):
    base = items(spark, sf)
    return _shown(N.knn_in_cluster(base, as_queries(base), K), "distance_sq")


def knn_widen(spark, sf):
    base, wanted = items(spark, sf), 55
    visits = cluster_visits(base, as_queries(base), centroids(base), wanted)
    found = N.knn_widen(base, as_queries(base), visits, wanted)
    return found.select("query_id", "item_id", "rank", "cell_rank", rounded("distance_sq").alias("distance_sq"))


def assign_then_knn(spark, sf):
    base = items(spark, sf)
    # unseen vectors: the mean of every item's frames
    frames = frame_items(spark, sf)
    unseen = frames.select(F.col("item_id").alias("query_id"), V.mean_pool(F.col("frames")).alias("embedding"))
    placed = nearest_centroid(unseen, centroids(base), item_id="query_id").select("query_id", "embedding", "cluster")
    return _shown(N.knn_in_cluster(base, placed, K, skip_self=False), "distance_sq")


def centroid_by_label(spark, sf):
    return V.explode_dims(centroids(items(spark, sf)), "embedding", "cluster").withColumn("value", rounded("value"))


QUERIES = {f.__name__: f for f in (
    src_embeddings, src_conform_ids, src_token_rows, vec_mean_pool, vec_pool_or_pass, vec_mean_squeeze,
    vec_flatten_truncate, vec_select_token, vec_explode_dims, pair_similarity, knn_l2_topn, knn_l2_blocks, knn_l2_pivots, knn_l2_quantised, knn_cosine_quantised,
    knn_cosine_pivots, nearest_centroid_shipped, nearest_centroid_joined, knn_widen_sparse,
    knn_cosine, cosine_topn, knn_in_cluster, knn_widen, assign_then_knn, centroid_by_label)}

_PAIRS = """
v as (select vec_id, label, embedding::double[] as e from embeddings),
pairs as (
  select q.vec_id as query_id, c.vec_id as item_id, power(list_distance(q.e, c.e), 2) as d2,
         list_cosine_similarity(q.e, c.e) as cs, q.label as ql, c.label as cl
  from v q join v c on q.vec_id <> c.vec_id)
"""


def _top(order, value, where="true"):
    return f"""
with {_PAIRS},
ranked as (
  select *, row_number() over (partition by query_id order by {order}, item_id) as rank from pairs where {where})
select query_id, item_id, rank::int as rank, round({value[0]}, 6) as {value[1]} from ranked where rank <= {K}
"""


_MEANS = "means as (select item_id, dim, avg(value) as value from cells group by all)"

_CENTROIDS = """
ctd as (select label, list(m order by dim) as m from (
  select label, dim, avg(value) as m from (
    select label, unnest(range(64)) as dim, unnest(embedding::double[]) as value from embeddings) group by all)
  group by label)
"""

_PLACED = f"""
with {_CENTROIDS}
select vec_id as item_id, ctd.label as cluster, round(power(list_distance(embedding::double[], m), 2), 6) as distance_sq
from embeddings, ctd
qualify row_number() over (partition by vec_id order by list_distance(embedding::double[], m), ctd.label) = 1"""

SQL = {
    "src_embeddings": f"""
with {FRAMES_SQL}, {_MEANS}
select item_id, 'all' as population, count(*) as dims, round(sum(value), 6) as total from means group by item_id""",
    "src_conform_ids": """
select 'a' || vec_id as item_id, 'artist ' || label as artist, 'song ' || vec_id as song, null::varchar as link,
       'old' as population from embeddings
union all
select 'b' || vec_id, 'channel ' || label, 'title ' || vec_id, null, 'new' from embeddings""",
    "src_token_rows": """
select vec_id // 5 as song, 'x' as artist, count(*) as frames, sum(len(embedding))::bigint as values
from embeddings group by 1""",
    "vec_mean_pool": f"""
with {FRAMES_SQL}, {_MEANS}
select item_id, dim::int as dim, round(value, 6) as value from means""",
    "vec_pool_or_pass": f"""
with {FRAMES_SQL}, {_MEANS}
select item_id, 'matrix' as kind, dim::int as dim, round(value, 6) as value from means
union all
select vec_id, 'vector', unnest(range(64))::int, round(unnest(embedding::double[]), 6) from embeddings""",
    "vec_mean_squeeze": f"""
with {FRAMES_SQL}, {_MEANS}
select item_id, dim::int as dim, round(value, 6) as value from means""",
    "vec_flatten_truncate": f"""
with {FRAMES_SQL}
select item_id, (frame * 64 + dim)::int as dim, round(value, 6) as value from cells
where frame < 4 and frame * 64 + dim < 200""",
    "vec_select_token": f"""
with {FRAMES_SQL}
select item_id, dim::int as dim, round(value, 6) as value from cells where frame = 2""",
    "vec_explode_dims": """
select vec_id as item_id, unnest(range(64))::int as dim, round(unnest(embedding::double[]), 6) as value
from embeddings""",
    "pair_similarity": """
select a.vec_id as key1, b.vec_id as key2,
       round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 6) as cosine,
       round(list_distance(a.embedding::double[], b.embedding::double[]), 6) as euclidean
from embeddings a join embeddings b on b.vec_id = a.vec_id + 1""",
    "knn_l2_topn": _top("d2", ("d2", "distance_sq")),
    "knn_l2_blocks": _top("d2", ("d2", "distance_sq")),
    "knn_l2_quantised": _top("d2", ("d2", "distance_sq")),
    "knn_cosine_quantised": _top("cs desc", ("cs", "similarity")),
    "knn_l2_pivots": _top("d2", ("d2", "distance_sq")),
    "knn_cosine_pivots": _top("cs desc", ("cs", "similarity")),
    "nearest_centroid_shipped": _PLACED,
    "nearest_centroid_joined": _PLACED,
    "knn_widen_sparse": f"""
with {_CENTROIDS}, v as (select vec_id, label, embedding::double[] as e from embeddings),
visit as (
  select v.vec_id as query_id, ctd.label as cl,
         row_number() over (partition by v.vec_id order by (ctd.label = v.label) desc, list_distance(v.e, ctd.m), ctd.label) as cell_rank
  from v, ctd where ctd.label % 3 = 0),
ranked as (
  select q.vec_id as query_id, c.vec_id as item_id, power(list_distance(q.e, c.e), 2) as d2,
         row_number() over (partition by q.vec_id order by cell_rank, list_distance(q.e, c.e), c.vec_id) as rank
  from v q join visit on visit.query_id = q.vec_id join v c on c.label = visit.cl)
select query_id, item_id, rank::int as rank, round(d2, 6) as distance_sq from ranked where rank <= 55""",
    "knn_cosine": _top("cs desc", ("cs", "similarity")),
    "cosine_topn": _top("cs desc", ("cs", "similarity"), "ql = cl"),
    "knn_in_cluster": _top("d2", ("d2", "distance_sq"), "ql = cl"),
    "knn_widen": f"""
with {_PAIRS}, {_CENTROIDS},
visit as (
  select v.vec_id as query_id, ctd.label as cl,
         row_number() over (partition by v.vec_id order by (ctd.label = v.label) desc,
                            list_distance(v.e, ctd.m), ctd.label) - 1 as cell_rank
  from v, ctd),
ranked as (
  select p.*, cell_rank, row_number() over (partition by p.query_id order by cell_rank, d2, item_id) as rank
  from pairs p join visit using (query_id, cl))
select query_id, item_id, rank::int as rank, cell_rank::int as cell_rank, round(d2, 6) as distance_sq
from ranked where rank <= 55""",
    "assign_then_knn": f"""
with {FRAMES_SQL}, {_MEANS}, {_CENTROIDS},
unseen as (select item_id as query_id, list(value order by dim) as e from means group by item_id),
placed as (
  select query_id, unseen.e, label, row_number() over (
    partition by query_id order by list_distance(unseen.e, m), label) as r from unseen, ctd),
ranked as (
  select query_id, vec_id as item_id, power(list_distance(placed.e, embedding::double[]), 2) as d2,
         row_number() over (partition by query_id
                            order by list_distance(placed.e, embedding::double[]), vec_id) as rank
  from placed join embeddings using (label) where r = 1)
select query_id, item_id, rank::int as rank, round(d2, 6) as distance_sq from ranked where rank <= {K}""",
    "centroid_by_label": f"""
with {_CENTROIDS}
select label as cluster, unnest(range(64))::int as dim, round(unnest(m), 6) as value from ctd""",
}
