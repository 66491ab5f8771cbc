"""The recommendation service, catalogue growth and their streaming twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import items, rounded, table, texts, title_of
from registry.model_queries import _GRAMS, _PROB, _SCORED
from registry.text_queries import sql_normal
from resonara.operators import language as L
from resonara.operators.cluster import centroids
from resonara.plans import catalogue_growth as G
from resonara.plans import recommend as REC
from resonara.plans.collection_map import collection_map as build_map
from resonara.plans.serving_index import build_index
from resonara.sources.writers import json_rows, new_rows
from resonara.streaming import jobs as J
from resonara.streaming.first_seen import ingest_first_seen
from resonara.streaming.reading import read_once
from resonara.workspace import new_folder, written

N = 5


# --- recommendation ---------------------------------------------------------

def _vectors(spark, sf):
    """Embeddings named by the part of the same key."""
    names = table(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_brand").alias("artist"),
                                            F.col("p_name").alias("song"))
    return items(spark, sf).drop("cluster").join(names, "item_id")


def _metadata(spark, sf):
    """Every part as a video, its name with the words swapped."""
    swapped = F.concat_ws(" ", F.split_part("p_name", F.lit(" "), F.lit(2)), F.split_part("p_name", F.lit(" "), F.lit(1)))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("video_id"), F.col("p_brand").alias("channel_name"),
                                           swapped.alias("song_title"))


def _requests(spark, sf):
    """Every customer asks for the item of the same key, spelt in capitals; some
    keys have no item."""
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("item_id"))
    names = _vectors(spark, sf).select("item_id", "artist", "song")
    return customers.join(names, "item_id", "left").select(
        F.concat(F.lit("r"), "item_id").alias("request_id"), F.upper(F.coalesce("artist", F.lit("Nobody"))).alias("artist"),
        F.upper(F.coalesce("song", F.lit("qqqq zzzz"))).alias("song"))


def _collection(spark, sf):
    base = items(spark, sf)
    built = REC.build_collection(_vectors(spark, sf), _metadata(spark, sf), centres=centroids(base))
    return REC.Collection(written(built.items, "collection"), written(built.centres, "centres"))


def _answers(spark, sf):
    return REC.recommend(_collection(spark, sf), _requests(spark, sf), N)


def recommend_items(spark, sf):
    rows = _answers(spark, sf).rows
    return rows.select("request_id", "rank", "item_id", "artist", "song", rounded("distance_sq").alias("distance_sq"),
                       "similarity", "link")


def recommend_errors(spark, sf):
    return _answers(spark, sf).errors


def recommend_coordinates(spark, sf):
    """One JSON object per point of every result."""
    points = _answers(spark, sf).coordinates
    shown = points.select("request_id", "artist", "song", rounded("x", 4).alias("x"), rounded("y", 4).alias("y"), "is_query")
    return json_rows(shown, "request_id", "artist", "song", "x", "y", "is_query")


def _linked(spark, sf):
    """The collection with videos named by 11 characters, as links name them."""
    base = items(spark, sf)
    named = _metadata(spark, sf).withColumn("video_id", F.substring(F.md5(F.col("video_id").cast("string")), 1, 11))
    built = REC.build_collection(_vectors(spark, sf), named, centres=centroids(base))
    return REC.Collection(written(built.items, "collection"), written(built.centres, "centres"))


def _link_requests(spark, sf):
    """Every part's video is asked for; some links are bad and some videos unknown."""
    part, video = table(spark, sf, "part"), F.substring(F.md5(F.col("p_partkey").cast("string")), 1, 11)
    return part.select(F.concat(F.lit("l"), "p_partkey").alias("request_id"),
                       F.when(F.col("p_size") > 45, "https://example.com/a")
                       .otherwise(F.concat(F.lit("https://www.youtube.com/watch?v="), video)).alias("url"))


def recommend_by_link(spark, sf):
    rows = REC.recommend_by_link(_linked(spark, sf), _link_requests(spark, sf), N).rows
    return rows.select("request_id", "rank", "item_id", "video_id", rounded("distance_sq").alias("distance_sq"), "similarity")


def link_errors(spark, sf):
    return REC.recommend_by_link(_linked(spark, sf), _link_requests(spark, sf), N).errors


def recommend_unseen(spark, sf):
    """Vectors that no part names are unseen; all of them are asked for."""
    stored = table(spark, sf, "part").select(F.col("p_partkey").alias("item_id"))
    odd = F.when(F.col("item_id") % 7 != 0, F.col("embedding")).alias("embedding")
    everything = items(spark, sf).join(stored.where("item_id % 2 = 0"), "item_id", "left_anti")
    requests = everything.select(F.concat(F.lit("u"), "item_id").alias("request_id"), odd)
    rows = REC.recommend_unseen(_collection(spark, sf), requests, N).rows
    return rows.select("request_id", "rank", "item_id", rounded("distance_sq").alias("distance_sq"), "similarity")


def request_statuses(spark, sf):
    """Polled state of the requests when those of every third customer are answered."""
    customers = table(spark, sf, "customer").select(F.concat(F.lit("r"), "c_custkey").alias("request_id"), "c_custkey")
    answers = customers.where("c_custkey % 3 = 0").select(
        "request_id", F.when(F.col("c_custkey") % 2 == 0, "completed").otherwise("error").alias("status"))
    return J.statuses(customers, answers)


def link_metadata(spark, sf):
    linked = REC.link_metadata(_vectors(spark, sf), _metadata(spark, sf))
    return linked.select("item_id", "video_id", "link")


def collection_map(spark, sf):
    base = _vectors(spark, sf).withColumn("population", F.lit("all"))
    metadata = table(spark, sf, "part").select(
        F.col("p_partkey").alias("item_id"), F.upper("p_name").alias("song"), F.col("p_type").alias("Genre"),
        F.col("p_size").alias("Instrumentation"))
    mapped = build_map(base, metadata)
    return mapped.withColumns({"x": rounded("x"), "y": rounded("y")})


# --- catalogue growth -------------------------------------------------------

def catalogue_growth(spark, sf):
    seen = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("video_id"))
    listed = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("id"),
                                              title_of(F.col("html")).alias("title"),
                                              F.split_part(title_of(F.col("html")), F.lit(" "), F.lit(1)).alias("uploader"))
    return G.new_entries(seen, listed).select("video_id", "song_title", "channel_name", "audio_file", "youtube_link")


def language_report(spark, sf):
    """Documents that are not Spanish, by profiles of the labelled texts."""
    docs = texts(spark, sf, "documents", "doc_id", "lang", "text")
    lyrics = docs.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("at"), F.col("text").alias("lyrics"))
    metadata = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("song_title"))
    _, _, report = G.split_by_language(lyrics, written(L.profiles(docs), "profiles"), metadata, "es", order="at")
    return report.select("id", "song_title", F.md5("lyrics").alias("lyrics"))


# --- streams ----------------------------------------------------------------

def _event_stream(spark, sf):
    """The events file as a stream, with a session-zone timestamp."""
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _finish(query):
    query.awaitTermination()


def stream_ingest(spark, sf):
    """First sight of every user among the events, apart from known customers."""
    path = new_folder(spark, "stream-ingest")
    known = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("user_id"))
    arriving = _event_stream(spark, sf).select("user_id", "ts")
    _finish(J.ingest(arriving, f"{path}/table", f"{path}/state", key="user_id", known=known))
    return J.ingested(spark, f"{path}/table", arriving.schema).select("user_id")


def stream_ingest_keyed(spark, sf):
    """The same ids, known ones from the state store, and the first event of each."""
    path = new_folder(spark, "stream-ingest")
    known = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("user_id"))
    arriving = _event_stream(spark, sf).select("user_id", "event_id", "event_type")
    _finish(ingest_first_seen(arriving, f"{path}/table", f"{path}/state", key="user_id", arrival="event_id", known=known))
    return spark.read.schema(arriving.schema).parquet(f"{path}/table")


def batch_ingest(spark, sf):
    known = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("user_id"))
    return new_rows(known, table(spark, sf, "events").select("user_id"), "user_id")


def _ratings(events):
    """Cards of ten kinds, so that they repeat within a session with other answers."""
    k = F.get_json_object("props", "$.k").cast("int")
    day = F.date_format("ts", "yyyy-MM-dd")
    return events.select("ts", F.concat_ws("/", F.col("user_id") % 50, day).alias("session"), F.col("event_type").alias("searched"),
                         (k % 10).alias("recommended"), (k >= 50).cast("int").alias("liked_item"),
                         (k % 3 == 0).cast("int").alias("liked_rec"))


def _shown_ratings(daily):
    return daily.select("day", "ratings", "liked_items", "liked_recs", rounded("approval").alias("approval"))


def ratings_daily(spark, sf):
    return _shown_ratings(J.ratings_daily(_ratings(table(spark, sf, "events"))))


def stream_ratings(spark, sf):
    path = new_folder(spark, "stream-ratings")
    arriving = _ratings(_event_stream(spark, sf))
    _finish(J.count_ratings(arriving, f"{path}/table", f"{path}/state"))
    return _shown_ratings(J.counted_ratings(spark, f"{path}/table", arriving.schema))


def _asked(spark, sf, names):
    """Every event is a request for the item named by the user's key; error events carry a bad link."""
    video = F.concat(F.lit("https://youtu.be/"), F.substring(F.md5(F.col("event_id").cast("string")), 1, 11))
    return _event_stream(spark, sf).join(names, "user_id", "left").select(
        F.concat(F.lit("e"), "event_id").alias("request_id"),
        F.when(F.col("event_type") != "error", video).otherwise("https://example.com/a").alias("url"), "artist", "song")


def _served(spark, sf, indexed):
    path = new_folder(spark, "stream-requests")
    collection = _collection(spark, sf)
    names = written(collection.items.select(F.col("item_id").alias("user_id"), "artist", "song"), "names")
    searched = build_index(collection, f"{path}/index", cell_rows=256) if indexed else collection
    _finish(J.serve_requests(_asked(spark, sf, names), searched, f"{path}/table", f"{path}/state", n=N))
    return path


def _shown_answers(answers, *extra):
    return answers.select(*extra, "request_id", "status", F.coalesce("error", F.lit("-")).alias("error"),
                          F.coalesce("video_id", F.lit("-")).alias("video_id"),
                          F.coalesce("rank", F.lit(0)).alias("rank"), F.coalesce("item_id", F.lit(-1)).alias("item_id"),
                          F.coalesce("similarity", F.lit("-")).alias("similarity"))


def stream_requests(spark, sf):
    path = _served(spark, sf, indexed=False)
    return _shown_answers(J.results(spark, f"{path}/table"))


def stream_requests_indexed(spark, sf):
    """The same rows from the stored index."""
    path = _served(spark, sf, indexed=True)
    return _shown_answers(J.results(spark, f"{path}/table"))


def stream_read_once(spark, sf):
    """Every request is read twice, and once under a name that nobody asked with."""
    path = _served(spark, sf, indexed=True)
    reads = _event_stream(spark, sf).select(F.explode(F.array(
        F.struct(F.concat(F.lit("e"), "event_id").alias("request_id"), F.lit(1).alias("read_id")),
        F.struct(F.concat(F.lit("e"), "event_id").alias("request_id"), F.lit(2).alias("read_id")),
        F.struct(F.concat(F.lit("x"), "event_id").alias("request_id"), F.lit(1).alias("read_id")))).alias("read")).select("read.*")
    _finish(read_once(J.results_stream(spark, f"{path}/table"), reads, f"{path}/handed", f"{path}/handed-state"))
    return _shown_answers(spark.read.parquet(f"{path}/handed"), "read_id")


QUERIES = {f.__name__: f for f in (
    recommend_items, recommend_errors, recommend_coordinates, recommend_by_link, link_errors, recommend_unseen,
    request_statuses, link_metadata, collection_map, catalogue_growth,
    language_report, stream_ingest, batch_ingest, ratings_daily, stream_ratings, stream_requests,
    stream_requests_indexed, stream_read_once, stream_ingest_keyed)}

_COLLECTION = f"""
named as (select vec_id as item_id, p_brand as artist, p_name as song, embedding::double[] as e,
  {sql_normal("p_brand || ' ' || p_name")} as k from embeddings join part on p_partkey = vec_id),
meta as (select {sql_normal("p_brand || ' ' || p_name")} as k, min(p_partkey) as video_id from part group by 1),
ctd as (select label, list(m order by dim) as m from (select label, dim, avg(value) as m from (
  select label, unnest(range(64)) as dim, unnest(embedding::double[]) as value from embeddings) group by all) group by label),
away as (select item_id, label, list_distance(e, m) as d from named, ctd),
own as (select item_id, label from away qualify row_number() over (partition by item_id order by d, label) = 1),
coll as (select named.*, label, video_id from named join own using (item_id) join meta using (k)),
first as (select k, min(item_id) as item_id from coll group by k)
"""
_NEAR = """
visit as (select a.item_id as query_id, a.label,
    row_number() over (partition by a.item_id order by (a.label = own.label) desc, d, a.label) as visit
  from away a join own using (item_id)),
near as (select q.item_id as query_id, c.item_id, c.artist, c.song, c.video_id, power(list_distance(q.e, c.e), 2) as d2,
    row_number() over (partition by q.item_id order by visit, list_distance(q.e, c.e), c.item_id) as rank
  from coll q join coll c on c.item_id <> q.item_id join visit v on v.query_id = q.item_id and v.label = c.label
  qualify rank <= 5)
"""
_PERCENT = """case when d2 < 10 then '100%' when d2 > 30 then '0%'
  else round_even(100.0::double - (d2 - 10) * 5, 0)::int || '%' end as similarity"""
_USERS = "asked as (select c_custkey as user_id from customer)"
_RATINGS = """
with r as (select ts, strftime(ts, '%Y-%m-%d') as day, user_id % 50 as person, event_type, (props::json->>'k')::int as k from events),
f as (select day, (k >= 50)::int as liked_item, (k % 3 = 0)::int as liked_rec from r
      qualify row_number() over (partition by person, day, event_type, k % 10 order by ts, (k >= 50)::int, (k % 3 = 0)::int) = 1)
select day, count(*) as ratings, sum(liked_item)::bigint as liked_items, sum(liked_rec)::bigint as liked_recs,
  round(sum(liked_rec) / count(*), 6) as approval from f group by day"""
_INGEST = "select distinct user_id from events where user_id not in (select s_suppkey from supplier)"

_LINKED = _COLLECTION.replace("min(p_partkey) as video_id", "min(substr(md5(p_partkey::varchar), 1, 11)) as video_id")
_ASKED = """
asked as (select 'l' || p_partkey as request_id, substr(md5(p_partkey::varchar), 1, 11) as video, p_size > 45 as bad from part),
found as (select request_id, min(item_id) as query_id from asked left join coll on not bad and video_id = video group by 1)
"""
_REQUESTS_SQL = f"""
with {_COLLECTION}, {_NEAR},
ev as (select 'e' || event_id as request_id, event_type, substr(md5(event_id::varchar), 1, 11) as video, k
  from events left join coll on coll.item_id = user_id),
good as (select request_id, video, first.item_id as query_id from ev left join first using (k) where event_type <> 'error')
select request_id, 'error' as status, 'invalid' as error, '-' as video_id, 0::int as rank, -1::bigint as item_id, '-' as similarity
from ev where event_type = 'error'
union all select request_id, 'error', 'query not found', video, 0, -1, '-' from good where query_id is null
union all select request_id, 'completed', '-', video, rank::int, near.item_id, {_PERCENT}
from good join near using (query_id)"""

SQL = {
    "recommend_by_link": f"""
with {_LINKED}, {_NEAR}, {_ASKED}
select request_id, rank::int as rank, near.item_id, near.video_id, round(d2, 6) as distance_sq, {_PERCENT}
from found join near using (query_id)""",
    "link_errors": f"""
with {_LINKED}, {_ASKED}
select request_id, 'query not found' as error from found where query_id is null""",
    "recommend_unseen": f"""
with {_COLLECTION},
new as (select vec_id as query_id, embedding::double[] as e from embeddings
        where vec_id not in (select p_partkey from part where p_partkey % 2 = 0) and vec_id % 7 <> 0),
placed as (select query_id, label, row_number() over (partition by query_id order by list_distance(e, m), label) as visit
           from new, ctd where label in (select label from coll)),
near as (select n.query_id, c.item_id, power(list_distance(n.e, c.e), 2) as d2,
    row_number() over (partition by n.query_id order by visit, list_distance(n.e, c.e), c.item_id) as rank
  from new n join placed using (query_id) join coll c using (label) qualify rank <= 5)
select 'u' || query_id as request_id, rank::int as rank, item_id, round(d2, 6) as distance_sq, {_PERCENT} from near""",
    "request_statuses": """
select 'r' || c_custkey as request_id, case when c_custkey % 3 <> 0 then 'processing' when c_custkey % 2 = 0 then 'completed'
  else 'error' end as status from customer""",
    "recommend_items": f"""
with {_COLLECTION}, {_NEAR}, {_USERS}
select 'r' || user_id as request_id, rank::int as rank, near.item_id, near.artist, near.song, round(d2, 6) as distance_sq,
  {_PERCENT}, 'https://www.youtube.com/watch?v=' || near.video_id as link
from asked join named on named.item_id = user_id join first using (k) join near on near.query_id = first.item_id""",
    "recommend_errors": f"""
with {_USERS}
select 'r' || user_id as request_id, 'query not found' as error from asked
where user_id not in (select vec_id from embeddings join part on p_partkey = vec_id)""",
    "link_metadata": f"""
with {_COLLECTION}
select item_id, video_id, 'https://www.youtube.com/watch?v=' || video_id as link from coll""",
    "catalogue_growth": """
with h as (select page_id as doc_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title from pages
           where page_id not in (select doc_id from labels)),
t as (select doc_id, split_part(title, ' ', 1) as source, case when title = '' then 'unknown_title' else title end as title
      from h),
c as (select doc_id, source, regexp_replace(regexp_replace(trim(replace(title, source, '')), '[<>:"/\\\\|?*]', '', 'g'),
      '[’"“”‘]', '', 'g') as s from t)
select doc_id::varchar as video_id, substr(regexp_replace(trim(replace(replace(s, ' - ', ' '), '—', ' ')), '\\s+', '_', 'g'), 1, 100)
    as song_title, source as channel_name, doc_id || '.mp3' as audio_file,
  'https://www.youtube.com/watch?v=' || doc_id as youtube_link from c""",
    "language_report": f"""
with {_GRAMS}, texts as (select doc_id as id, text from documents), {_SCORED}, p as (select id, lang, {_PROB} as p from prob)
select texts.id, p_name as song_title, md5(text) as lyrics
from texts join part on p_partkey = texts.id left join p on p.id = texts.id and lang = 'es' where coalesce(p, 0) <= 0.5""",
    "stream_ingest": _INGEST,
    "batch_ingest": _INGEST,
    "stream_ingest_keyed": """
select user_id, event_id, event_type from events where user_id not in (select s_suppkey from supplier)
qualify row_number() over (partition by user_id order by event_id) = 1""",
    "ratings_daily": _RATINGS,
    "stream_ratings": _RATINGS,
    "stream_requests": _REQUESTS_SQL,
    "stream_requests_indexed": _REQUESTS_SQL,
    "stream_read_once": f"""
select 1::bigint as read_id, * from ({_REQUESTS_SQL})
union all select 1, 'x' || event_id, 'processing', '-', '-', 0, -1, '-' from events""",
}
