"""Clusters, projections, features, language and text embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import as_queries, frame_items, items, rounded, table, texts
from registry.vector_queries import _CENTROIDS, _MEANS, FRAMES_SQL
from resonara.functions import vectors as V
from resonara.operators import cluster as C
from resonara.operators import embed as E
from resonara.operators import features as FT
from resonara.operators import language as L
from resonara.operators import project as P
from resonara.operators.neighbour_map import affinity_edges, lay_out, map_divergence, start_map
from resonara.operators.neighbour_map import neighbour_map as build_map
from resonara.operators.neighbour_map import perplexity_affinity as affinity
from resonara.operators.neighbours import knn
from resonara.workspace import written

# --- fixed values -----------------------------------------------------------
LATE_ERA = "After 2018"
EARLY_ERA = "Before 2012"
# ----------------------------------------------------------------------------

HASH_DIMS = 32
# Token shares such as 10/512 lie exactly between two rounded values, where the
# order of a sum would decide; both sides add this before rounding.
OFF_TIE = 1e-9


# --- clusters ---------------------------------------------------------------

def kmeans_step(spark, sf):
    base = items(spark, sf)
    stepped = C.lloyd_step(base.drop("cluster"), C.centroids(base))
    return stepped.select("cluster", "size", rounded("cost").alias("cost"),
                          rounded(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)).alias("total"))


def kmeans_assign(spark, sf):
    base = items(spark, sf).drop("cluster")
    return C.assign_kmeans(base, C.fit_kmeans(base, 8)).select("item_id", "cluster")


def kmeans_violations(spark, sf):
    """Items that are nearer to another centre than to their own, of all items in all clusters."""
    base = items(spark, sf).drop("cluster")
    model = C.fit_kmeans(base, 8)
    placed = C.assign_kmeans(base, model)
    nearest = C.nearest_centroid(base, C.model_centroids(base, model)).select("item_id", "centroid_distance_sq")
    own = C.model_centroids(base, model).withColumnRenamed("embedding", "centre")
    away = placed.join(own, "cluster").select("item_id", V.squared_l2(F.col("embedding"), F.col("centre")).alias("own"))
    worse = F.sum((F.col("own") > F.col("centroid_distance_sq") + 1e-6).cast("long"))
    return away.join(nearest, "item_id").agg(worse.alias("violations"), F.count("*").alias("items"))


def kmeans_sweep(spark, sf):
    base = items(spark, sf).drop("cluster")
    flat = written(P.project(base, P.fit_pca(base, 2)).select("item_id", "coordinates"), "plane")
    return C.kmeans_sweep(flat, vector="coordinates").drop("coordinates")


def cluster_vs_label(spark, sf):
    """Nearest label centroid against the label itself."""
    base = items(spark, sf)
    placed = C.nearest_centroid(base.withColumnRenamed("cluster", "label"), C.centroids(base))
    return C.contingency(placed).select("cluster", "label", "n", "size", rounded("share").alias("share"))


def cluster_purity(spark, sf):
    base = items(spark, sf)
    placed = C.nearest_centroid(base.withColumnRenamed("cluster", "label"), C.centroids(base))
    return C.purity(placed).select("cluster", "size", rounded("purity").alias("purity"))


def cluster_profile(spark, sf):
    found = C.cluster_profile(items(spark, sf))
    return found.select("cluster", "size", rounded("inertia").alias("inertia"), rounded("radius").alias("radius"))


def _described(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), "p_type", "p_size")
    era = F.when(F.col("p_size") > 25, LATE_ERA).otherwise(EARLY_ERA)
    return items(spark, sf).join(part, "item_id").withColumn("population", era)


def profile_by_feature(spark, sf):
    means = C.profile_by_feature(_described(spark, sf), "population", "p_type")
    return V.explode_dims(means, "embedding", "population", "p_type", "size").withColumn("value", rounded("value"))


# --- projections ------------------------------------------------------------

def covariance(spark, sf):
    return P.covariance(items(spark, sf)).select("i", "j", rounded("cov").alias("cov"))


def pca_project(spark, sf):
    base = items(spark, sf)
    placed = P.to_xy(P.project(base, P.fit_pca(base, 2)))
    return placed.select("item_id", rounded("x").alias("x"), rounded("y").alias("y"))


def pca_variance(spark, sf):
    """All components together hold the whole variance; each one's share is its coordinate's."""
    base = items(spark, sf)
    width = base.select(F.max(F.size("embedding"))).first()[0] or 0
    model = P.fit_pca(base, width)
    placed = P.project(base, model).select(F.posexplode("coordinates").alias("component", "value"))
    spread = placed.groupBy("component").agg(F.var_samp("value").alias("variance"), F.avg("value").alias("mean"))
    total = spread.agg(F.sum("variance").alias("total"))
    gap = F.abs(F.col("variance") / F.col("total") - F.col("share"))
    joined = spread.join(P.explained(spark, model), "component").withColumn("one", F.lit(1)).join(total.withColumn("one", F.lit(1)), "one")
    return joined.agg(rounded(F.first("total"), 4).alias("total"), rounded(F.max(gap)).alias("share_gap"),
                      rounded(F.max(F.abs("mean"))).alias("mean_gap"), F.count("*").alias("components"))


def pca_explained(spark, sf):
    base = items(spark, sf)
    return P.explained(spark, P.fit_pca(base, 2)).withColumn("share", rounded("share"))


def pca_top_loadings(spark, sf):
    features = _metadata_features(spark, sf)
    named = [c for c in features.columns if c != "p_partkey"]
    model = P.fit_pca(FT.as_vector(features, "p_partkey"), 2)
    return P.top_loadings(P.loadings(features, model, named)).withColumn("loading", rounded("loading"))


def place_new_point(spark, sf):
    """Pooled items placed among all items, on a map of the first two dimensions."""
    base = items(spark, sf)
    first = V.to_double(F.col("embedding"))
    on_map = base.select("item_id", first[0].alias("x"), first[1].alias("y"))
    new = frame_items(spark, sf).select(F.col("item_id").alias("query_id"), V.mean_pool(F.col("frames")).alias("embedding"))
    placed = P.place_new_points(new, base, on_map)
    return placed.select("query_id", rounded("x").alias("x"), rounded("y").alias("y"))


def pca_wide_violations(spark, sf):
    """Loadings and shares of the fit without a covariance matrix that differ from the other fit's, on dimensions of falling weight."""
    weighed = F.transform("embedding", lambda value, at: value / F.pow(F.lit(1.5), at.cast("double")))
    base = written(items(spark, sf).select("item_id", weighed.alias("embedding")), "weighed")
    one, other = P.fit_pca(base, 3), P.fit_pca_wide(base, 3)
    wrong = int((abs(one.components - other.components) > 1e-5).sum() + (abs(one.explained - other.explained) > 1e-7).sum())
    return base.agg(F.count("*").alias("items"), F.lit(wrong).cast("long").alias("violations"))


def perplexity_affinity(spark, sf):
    base = items(spark, sf)
    return affinity(knn(base, as_queries(base), 30), 10.0).withColumn("p", rounded("p"))


def neighbour_map(spark, sf):
    return build_map(items(spark, sf))


def map_violations(spark, sf):
    """What a map must not have: items left out, places that are no numbers, a worse fit than its start."""
    base = written(items(spark, sf).select("item_id", "embedding"), "map-items")
    edges, start = written(affinity_edges(base), "map-edges"), written(start_map(base), "map-start")
    found = written(lay_out(edges, start), "map")
    better = map_divergence(edges, found) < 0.95 * map_divergence(edges, start)
    joined = base.select("item_id").join(found, "item_id", "left")
    finite = F.coalesce(F.abs("x") + F.abs("y") < float("inf"), F.lit(False))
    return joined.agg(F.count("*").alias("items"), F.count_if(F.col("x").isNull()).alias("missing"), F.count_if(~finite).alias("nowhere"),
                      F.lit(int(not better)).alias("worse"))


# --- features ---------------------------------------------------------------

def one_hot(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    return FT.one_hot(part, "p_type")


def one_hot_vector(spark, sf):
    """Sparse form: the filled slots of every row."""
    from pyspark.ml.functions import vector_to_array

    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_brand")
    encoded = FT.one_hot_vector(part, "p_type", "p_brand")
    slots = encoded.select("p_partkey", F.posexplode(vector_to_array("one_hot")).alias("slot", "value"))
    return slots.where("value <> 0")


def one_hot_wide(spark, sf):
    """Slots from a distributed dictionary; names have as many values as the table has rows, nearly."""
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_name")
    dictionary = written(FT.category_dictionary(part, "p_type", "p_name"), "dictionary")
    return FT.one_hot_slots(part, "p_partkey", dictionary, "p_type", "p_name").select("p_partkey", F.posexplode("slots").alias("place", "slot"))


def feature_breakdown(spark, sf):
    """Totals by population, genre, voice and instrumentation, alone and in pairs."""
    part = table(spark, sf, "part").select(
        F.col("p_brand").alias("population"), F.col("p_type").alias("genre"),
        F.when(F.col("p_size") % 3 > 0, F.when(F.col("p_size") % 3 == 1, "low").otherwise("high")).alias("voice"),
        F.floor(F.col("p_size") / 10).alias("instrumentation"))
    names = ["population", "genre", "voice", "instrumentation"]
    sets = [[], *[[name] for name in names], ["population", "genre"], ["genre", "voice"], names]
    found = FT.breakdown(part, names, sets)
    return found.select(*[F.coalesce(F.col(name).cast("string"), F.lit("-")).alias(name) for name in names], "level", "items")


def zscore_bpm(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    scaled = FT.zscore(part, "p_size", "p_retailprice")
    return scaled.select("p_partkey", rounded("p_size").alias("p_size"), rounded("p_retailprice").alias("p_retailprice"))


def _metadata_features(spark, sf):
    part = table(spark, sf, "part").withColumn("p_size", F.when(F.col("p_size") > 3, F.col("p_size").cast("double")))
    return FT.metadata_features(part, "p_partkey", ["p_type"], ["p_retailprice"], ["p_size"])


def metadata_features(spark, sf):
    return _metadata_features(spark, sf).withColumn("p_retailprice", rounded("p_retailprice"))


# --- language ---------------------------------------------------------------

def lang_prob(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "lang", "text")
    profile = written(L.profiles(docs), "profiles")
    return L.lang_prob(docs, profile, "doc_id").withColumn("prob", rounded("prob"))


def lang_filter(spark, sf):
    """Conversation turns kept as Spanish by profiles of the documents."""
    profile = written(L.profiles(texts(spark, sf, "documents", "lang", "text")), "profiles")
    turns = table(spark, sf, "conversations").select(F.concat_ws("/", "conv_id", "turn").alias("id"), "text")
    return L.lang_filter(turns, profile, "es", "id").select("id", rounded("prob").alias("prob"), "kept")


# --- text embeddings --------------------------------------------------------

def chunk_windows(spark, sf):
    chunks = E.chunk_tokens(texts(spark, sf, "documents", "doc_id", "text"), "doc_id", E.whitespace_tokens(F.col("text")))
    return chunks.select("doc_id", "chunk", "start", F.size("tokens").alias("length"),
                         F.md5(F.array_join("tokens", " ")).alias("words"))


def hash_embed(spark, sf):
    found = E.hash_embed(texts(spark, sf, "documents", "doc_id", "text"), "doc_id", E.whitespace_tokens(F.col("text")), HASH_DIMS)
    return found.withColumn("value", rounded(F.col("value") + OFF_TIE))


def share_encoder():
    """A stand-in for a model: letter shares of each chunk."""
    import string

    import numpy as np

    def encode(chunks):
        joined = ["".join(tokens).lower() for tokens in chunks]
        return [np.array([text.count(c) for c in string.ascii_lowercase], dtype=float) / max(len(text), 1)
                for text in joined]

    return encode


def embed_text(spark, sf):
    """The pluggable encoder path, with a letter-share encoder."""
    docs = texts(spark, sf, "documents", "doc_id", "text")
    found = E.embed_text(docs, "doc_id", E.whitespace_tokens(F.col("text")), share_encoder)
    return V.explode_dims(found, "embedding", "doc_id").withColumn("value", rounded(F.col("value") + OFF_TIE))


QUERIES = {f.__name__: f for f in (
    kmeans_step, kmeans_violations, pca_variance, pca_explained, kmeans_assign, kmeans_sweep, cluster_vs_label,
    cluster_purity, cluster_profile, profile_by_feature, covariance, pca_project, pca_top_loadings, place_new_point,
    pca_wide_violations, perplexity_affinity, neighbour_map, map_violations, one_hot,
    one_hot_vector, one_hot_wide, feature_breakdown, zscore_bpm, metadata_features, lang_prob, lang_filter, chunk_windows, hash_embed, embed_text)}

_PLACED = f"""
{_CENTROIDS},
placed as (select vec_id, v.label as label, e, m, ctd.label as cluster, power(list_distance(e, m), 2) as d2
  from (select vec_id, label, embedding::double[] as e from embeddings) v, ctd
  qualify row_number() over (partition by vec_id order by list_distance(e, m), ctd.label) = 1)
"""

_GRAMS = """
w as (select lang, unnest(regexp_split_to_array(lower(text), '[^\\p{L}]+')) as word from documents),
wc as (select lang, word, count(*) as n from w where word <> '' group by all),
g as (select lang, n, substr(' ' || word || ' ', unnest(range(1, len(word) + 1)), 3) as gram from wc),
prof as (select lang, gram, sum(n) as n from g group by all),
tot as (select lang, sum(n) as t from prof group by lang),
voc as (select count(distinct gram) as v from prof)
"""
_SCORED = """
tc as (select id, word, count(*) as n from (
    select id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}]+')) as word from texts) where word <> '' group by all),
tg as (select id, n, substr(' ' || word || ' ', unnest(range(1, len(word) + 1)), 3) as gram from tc),
tgs as (select id, gram, sum(n) as n from tg group by all),
ll as (select id, tot.lang, sum(tgs.n * ln((coalesce(prof.n, 0) + 1.0) / (t + v))) as s
  from tgs cross join tot cross join voc left join prof on prof.lang = tot.lang and prof.gram = tgs.gram group by all),
prob as (select id, lang, exp(s - max(s) over (partition by id)) as e from ll)
"""
_PROB = "e / sum(e) over (partition by id)"

_TOKENS = """
tok as (select doc_id, list_filter(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' '), lambda x: x <> '') as a
  from documents),
ch as (select doc_id, a, unnest(range(0, 1 + greatest(ceil((len(a) - 512) / 256.0), 0)::bigint)) as chunk from tok),
chunks as (select doc_id, chunk, a[chunk * 256 + 1 : chunk * 256 + 512] as words from ch)
"""

SQL = {
    "pca_wide_violations": "select count(*) as items, 0::bigint as violations from embeddings",
    "map_violations": "select count(*) as items, 0::bigint as missing, 0::bigint as nowhere, 0::int as worse from embeddings",
    "kmeans_violations": "select 0::bigint as violations, count(*) as items from embeddings",
    "pca_variance": """
with v as (select unnest(range(64)) as dim, unnest(embedding::double[]) as value from embeddings),
s as (select dim, var_samp(value) as spread from v group by dim)
select round(sum(spread), 4) as total, 0.0::double as share_gap, 0.0::double as mean_gap, count(*) as components from s""",
    "kmeans_step": f"""
with {_PLACED},
sizes as (select cluster, count(*) as size, sum(d2) as cost from placed group by cluster),
sums as (select cluster, sum(v) as total from (select cluster, avg(value) as v from (
  select cluster, unnest(range(64)) as dim, unnest(e) as value from placed) group by cluster, dim) group by cluster)
select cluster, size, round(cost, 6) as cost, round(total, 6) as total from sizes join sums using (cluster)""",
    "cluster_vs_label": f"""
with {_PLACED}
select cluster, label, count(*) as n, sum(count(*)) over (partition by cluster)::bigint as size,
  round(count(*) / sum(count(*)) over (partition by cluster), 6) as share from placed group by cluster, label""",
    "cluster_purity": f"""
with {_PLACED}, c as (select cluster, label, count(*) as n from placed group by all)
select cluster, sum(n)::bigint as size, round(max(n) / sum(n), 6) as purity from c group by cluster""",
    "cluster_profile": f"""
with {_CENTROIDS}, d as (select label, power(list_distance(embedding::double[], m), 2) as d2 from embeddings join ctd using (label))
select label as cluster, count(*) as size, round(sum(d2), 6) as inertia, round(sqrt(max(d2)), 6) as radius
from d group by label""",
    "profile_by_feature": f"""
with d as (select case when p_size > 25 then '{LATE_ERA}' else '{EARLY_ERA}' end as population, p_type, embedding
           from embeddings join part on p_partkey = vec_id),
s as (select population, p_type, count(*) as size from d group by all),
l as (select population, p_type, unnest(range(64)) as dim, unnest(embedding::double[]) as value from d)
select population, p_type, size, dim::int as dim, round(avg(value), 6) as value from l join s using (population, p_type)
group by all""",
    "covariance": """
with l as (select vec_id, unnest(range(64)) as dim, unnest(embedding::double[]) as value from embeddings)
select a.dim::int as i, b.dim::int as j, round(covar_samp(a.value, b.value), 6) + 0.0 as cov
from l a join l b using (vec_id) group by a.dim, b.dim""",
    "place_new_point": f"""
with {FRAMES_SQL}, {_MEANS},
q as (select item_id as query_id, list(value order by dim) as e from means group by item_id),
r as (select query_id, embedding[1]::double as x, embedding[2]::double as y from q, embeddings
  qualify row_number() over (partition by query_id order by list_distance(q.e, embedding::double[]), vec_id) <= 5)
select query_id, round(avg(x), 6) as x, round(avg(y), 6) as y from r group by query_id""",
    "one_hot": """
select p_partkey, (p_type = 'ECONOMY')::int as "p_type_ECONOMY", (p_type = 'LARGE')::int as "p_type_LARGE",
  (p_type = 'MEDIUM')::int as "p_type_MEDIUM", (p_type = 'PROMO')::int as "p_type_PROMO",
  (p_type = 'SMALL')::int as "p_type_SMALL", (p_type = 'STANDARD')::int as "p_type_STANDARD" from part""",
    "one_hot_wide": """
with d as (select feature, value, row_number() over (order by feature desc, value) - 1 as slot from (
  select distinct 'p_type' as feature, p_type as value from part union select distinct 'p_name', p_name from part) where value is not null),
found as (select p_partkey, slot from part join d on feature = 'p_type' and value = p_type
  union all select p_partkey, slot from part join d on feature = 'p_name' and value = p_name)
select p_partkey, (row_number() over (partition by p_partkey order by slot) - 1)::int as place, slot from found""",
    "feature_breakdown": """
with f as (select p_brand as population, p_type as genre, case p_size % 3 when 1 then 'low' when 2 then 'high' end as voice,
  p_size // 10 as instrumentation from part)
select coalesce(f.population, '-') as population, coalesce(f.genre, '-') as genre, coalesce(f.voice, '-') as voice,
  coalesce(f.instrumentation::varchar, '-') as instrumentation,
  grouping_id(f.population, f.genre, f.voice, f.instrumentation)::bigint as level, count(*) as items
from f group by grouping sets ((), (f.population), (f.genre), (f.voice), (f.instrumentation), (f.population, f.genre),
  (f.genre, f.voice), (f.population, f.genre, f.voice, f.instrumentation))""",
    "one_hot_vector": """
with t as (select p_type, row_number() over (order by p_type) - 1 as i, count(*) over () as n from (select distinct p_type from part)),
b as (select p_brand, row_number() over (order by p_brand) - 1 as i from (select distinct p_brand from part))
select p_partkey, t.i::int as slot, 1.0::double as value from part join t using (p_type)
union all select p_partkey, (n + b.i)::int, 1.0 from part join t using (p_type) join b using (p_brand)""",
    "zscore_bpm": """
select p_partkey, round((p_size - avg(p_size) over ()) / stddev_pop(p_size) over (), 6) as p_size,
  round((p_retailprice - avg(p_retailprice) over ()) / stddev_pop(p_retailprice) over (), 6) as p_retailprice from part""",
    "metadata_features": """
with z as (select p_partkey, p_type, p_size, (p_retailprice - avg(p_retailprice) over ()) / stddev_pop(p_retailprice) over () as r
           from part)
select p_partkey, round(r, 6) as p_retailprice, p_size::double as p_size, (p_type = 'ECONOMY')::int as "p_type_ECONOMY",
  (p_type = 'LARGE')::int as "p_type_LARGE", (p_type = 'MEDIUM')::int as "p_type_MEDIUM",
  (p_type = 'PROMO')::int as "p_type_PROMO", (p_type = 'SMALL')::int as "p_type_SMALL",
  (p_type = 'STANDARD')::int as "p_type_STANDARD" from z where p_size > 3""",
    "lang_prob": f"""
with {_GRAMS}, texts as (select doc_id as id, text from documents), {_SCORED}
select id as doc_id, lang, round({_PROB}, 6) + 0.0 as prob from prob""",
    "lang_filter": f"""
with {_GRAMS}, texts as (select conv_id || '/' || turn as id, text from conversations), {_SCORED},
p as (select id, lang, {_PROB} as p from prob)
select texts.id, round(coalesce(p, 0.0), 6) + 0.0 as prob, coalesce(p, 0.0) > 0.5 as kept
from texts left join p on p.id = texts.id and lang = 'es'""",
    "chunk_windows": f"""
with {_TOKENS}
select doc_id, chunk::int as chunk, (chunk * 256)::int as start, len(words)::int as length,
  md5(array_to_string(words, ' ')) as words from chunks""",
    "hash_embed": f"""
with {_TOKENS},
u as (select doc_id, chunk, len(words) as n, unnest(words) as w from chunks),
h as (select doc_id, chunk, n, (('0x' || substr(md5(w), 1, 8))::ubigint % {HASH_DIMS})::int as dim from u),
s as (select doc_id, chunk, dim, count(*) / any_value(n) as share from h group by doc_id, chunk, dim),
k as (select doc_id, count(*) as c from chunks group by doc_id)
select doc_id, dim, round(sum(share) / any_value(c) + {OFF_TIE}, 6) as value from s join k using (doc_id) group by doc_id, dim""",
    "embed_text": f"""
with {_TOKENS},
t as (select doc_id, lower(array_to_string(words, '')) as s from chunks),
v as (select doc_id, unnest(range(26)) as dim, s from t)
select doc_id, dim::int as dim, round(avg((len(s) - len(replace(s, chr((97 + dim)::int), ''))) / greatest(len(s), 1)) + {OFF_TIE}, 6) as value
from v group by doc_id, dim""",
}
