"""Catalogue joins, set operations, counts, and fuzzy matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import footer_of, items, rounded, table, title_of
from registry.text_queries import sql_normal, sql_ratio, sql_token_sort
from resonara.functions.text import normalize_text
from resonara.operators import catalogue as CAT
from resonara.operators import fuzzy as FZ
from resonara.sources import readers as R
from resonara.sources import writers as W
from resonara.workspace import new_folder


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "source", "text")


def _labels(spark, sf):
    return table(spark, sf, "labels")


# --- joins ------------------------------------------------------------------

def join_metadata_left(spark, sf):
    docs = _docs(spark, sf).select("doc_id", "lang", F.col("source").alias("quality"))
    joined = CAT.join_metadata(docs, _labels(spark, sf), "doc_id")
    return joined.select("doc_id", "lang", "quality",
                         F.coalesce("quality_original", F.lit(-1)).alias("quality_original"))


def count_unmatched(spark, sf):
    joined = CAT.join_metadata(_docs(spark, sf), _labels(spark, sf), "doc_id")
    return CAT.missing_counts(joined, "quality")


def join_files_inner(spark, sf):
    """Orders as files, order lines as metadata; the last line of an order wins."""
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id"), "l_linenumber").agg(
        F.max("l_extendedprice").alias("price"))
    files = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_orderpriority")
    return CAT.join_files(files, lines, "id", "l_linenumber").select(
        "id", "o_orderpriority", "l_linenumber", "price")


def dedupe_last(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return CAT.keep_one(events, "user_id", "event_id").select("user_id", "event_id", "event_type", "value")


def dedupe_first(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return CAT.keep_one(events, "user_id", "event_id", last=False)


def ingest_anti(spark, sf):
    """New ids in order lines that the orders do not know, once each."""
    seen = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    batch = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    batch = batch.unionByName(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"),
                                                                 F.col("l_linestatus").alias("status")))
    return W.new_rows(seen, batch, "id")


def ids_seen(spark, sf):
    return CAT.ids_seen(table(spark, sf, "customer").select(F.col("c_custkey").alias("id")),
                        table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id")), key="id")


def sink_append_new(spark, sf):
    existing = W.backfill_link(_labels(spark, sf).select(F.col("doc_id").alias("video_id"),
                                                         F.lit("old").alias("origin")))
    incoming = _docs(spark, sf).select(F.col("doc_id").alias("video_id"), F.lit("new").alias("origin"))
    both = W.append_if_absent(existing, incoming, "video_id")
    return both.select("video_id", "origin", F.coalesce("youtube_link", F.lit("-")).alias("youtube_link"))


def sink_append_stored(spark, sf):
    """The same catalogue, grown on storage and read back."""
    path = new_folder(spark, "catalogue")
    labels = _labels(spark, sf).select(F.col("doc_id").alias("video_id"), F.lit("old").alias("origin"))
    labels.write.parquet(path)
    stored = spark.read.parquet(path)
    W.append_new(path, stored, _docs(spark, sf).select(F.col("doc_id").alias("video_id"),
                                                       F.lit("new").alias("origin")), "video_id")
    return spark.read.parquet(path)


def keep_after_removal(spark, sf):
    removed = _labels(spark, sf).where("quality = 0").select(F.col("doc_id").alias("id"))
    return W.survivors(_docs(spark, sf), removed, "doc_id", "id").withColumn("text", F.md5("text"))


def rewrite_filtered(spark, sf):
    """Survivors of two datasets, written as new versions and read back."""
    removed = _labels(spark, sf).where("quality = 0").select("doc_id")
    paths = W.rewrite_filtered(
        {"documents": (_docs(spark, sf), "doc_id"), "labels": (_labels(spark, sf), "doc_id")}, removed, "doc_id", new_folder(spark, "versions"), "1")
    content = {"documents": F.concat_ws("|", "lang", "source", F.md5("text")), "labels": F.concat_ws("|", "quality", "toxic")}
    kept = [spark.read.parquet(path).select(F.lit(name).alias("dataset"), "doc_id", content[name].alias("row"))
            for name, path in paths.items()]
    return kept[0].unionByName(kept[1])


def removed_report(spark, sf):
    removed = _labels(spark, sf).where("quality = 0").select(F.col("doc_id").alias("id"))
    metadata = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("song_title"),
                                               F.col("p_brand").alias("channel_name"))
    lyrics = _docs(spark, sf).select(F.col("doc_id").alias("id"), F.col("doc_id").alias("at"),
                                     F.col("text").alias("lyrics"))
    report = CAT.removed_report(removed, metadata, lyrics, "id", "at")
    return report.select("id", "song_title", "channel_name", F.md5("lyrics").alias("lyrics"))


def sink_csv_report(spark, sf):
    """Documents through the CSV sink and back."""
    path = new_folder(spark, "csv")
    W.write_csv(_docs(spark, sf), path)
    back = R.read_catalogue(spark, path)
    return back.select("doc_id", "lang", F.md5("text").alias("text"))


def contains_join(spark, sf):
    """Page links as file names, words and language marks of every length as ids."""
    files = table(spark, sf, "pages").select(F.col("url").alias("file_name")).distinct()
    ids = table(spark, sf, "part").select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("word"))
    words = ids.unionByName(_docs(spark, sf).select(F.col("lang").alias("word")))
    meta = words.groupBy("word").agg(F.count("*").alias("n")).withColumn("ord", F.col("word"))
    return CAT.contains_join(files, meta, "file_name", "word", "ord").select("file_name", "word", "n")


def contains_join_hash(spark, sf):
    """11-character ids inside longer file names."""
    pages = table(spark, sf, "pages")
    files = pages.select(F.concat("page_id", F.lit("_"), F.substring(F.md5("url"), 1, 11), F.lit(" x.mp3")).alias("file_name"))
    meta = pages.select(F.substring(F.md5("url"), 1, 11).alias("video_id"), F.col("page_id").alias("ord"))
    return CAT.contains_join(files, meta, "file_name", "video_id", "ord")


def rename_plan(spark, sf):
    part = table(spark, sf, "part")
    files = part.select(
        F.when(F.col("p_size") > 40, F.concat(F.lower("p_brand"), F.lit("-"), "p_name", F.lit(".mp3")))
        .otherwise(F.concat("p_partkey", F.lit(".mp3"))).alias("file"),
        "p_partkey", F.concat("p_brand", F.lit(" - Topic")).alias("channel"), F.col("p_name").alias("title"))
    return CAT.rename_plan(files, "file", "p_partkey", "channel", "title")


def backfill_worklist(spark, sf):
    lyrics = _docs(spark, sf).select(F.col("doc_id").alias("id"),
                                     F.when(F.col("lang") != "es", F.col("text")).otherwise(" ").alias("lyrics"))
    files = _labels(spark, sf).select(F.col("doc_id").alias("id")).unionByName(
        table(spark, sf, "part").select(F.col("p_partkey").alias("id"))).distinct()
    return CAT.backfill_worklist(lyrics, files, "id")


def upsert_by_id(spark, sf):
    current = _docs(spark, sf).select(F.col("doc_id").alias("id"),
                                      F.when(F.col("lang") != "es", F.col("text")).alias("lyrics"))
    incoming = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("lyrics"))
    return CAT.upsert(current, incoming, "id").select("id", F.md5("lyrics").alias("lyrics"))


def lookup_exact(spark, sf):
    wanted = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("p_partkey"), F.lit("ECONOMY").alias("p_type"))
    found = CAT.lookup(table(spark, sf, "part"), wanted, "p_partkey", "p_type")
    return found.select("p_partkey", F.coalesce("p_name", F.lit("-")).alias("p_name"), "found")


def plot_subset(spark, sf):
    base = items(spark, sf).select("item_id", "cluster")
    query = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("item_id"))
    found = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("item_id"))
    return CAT.subset(base, "item_id", query, found)


def _suggestions(spark, sf):
    part = table(spark, sf, "part")
    return part.select("p_partkey", F.when(F.col("p_size") > 5, F.col("p_name")).otherwise(" \t").alias("title"),
                       F.when(F.col("p_size") < 45, F.col("p_brand")).alias("artist"))


def complete_rows(spark, sf):
    return CAT.complete_rows(_suggestions(spark, sf), "title", "artist")


def validate_required(spark, sf):
    valid, rejected = CAT.split_valid(_suggestions(spark, sf), "title", "artist")
    return R.union_tagged(valid=valid.select("p_partkey"), rejected=rejected.select("p_partkey"))


def dropna_features(spark, sf):
    return _suggestions(spark, sf).dropna(subset=["title", "artist"]).select("p_partkey", "artist")


def union_tagged(spark, sf):
    before = table(spark, sf, "part").select(F.col("p_name").alias("song"), F.col("p_brand").alias("artist"))
    after = table(spark, sf, "supplier").select(F.col("s_name").alias("artist"))
    both = R.union_tagged(before=before, after=after)
    return both.select("population", "artist", F.coalesce("song", F.lit("-")).alias("song"))


# --- counts -----------------------------------------------------------------

def catalogue_counts(spark, sf):
    joined = CAT.join_metadata(_docs(spark, sf), _labels(spark, sf), "doc_id")
    return joined.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("quality").isNull()).alias("missing"),
                                      F.count_if(F.col("quality") == 0).alias("removed"))


def distinct_categories(spark, sf):
    return CAT.distinct_categories(table(spark, sf, "part"), "p_type", "p_brand", "p_size")


def topk_liked(spark, sf):
    liked = table(spark, sf, "events").select("user_id", (F.col("event_type") == "click").cast("int").alias("liked"))
    return CAT.top_liked(liked, "user_id", "liked", 10)


# --- fuzzy matching ---------------------------------------------------------

def _misspelt(spark, sf):
    """Every part's brand and name with words swapped and one letter lost."""
    part = table(spark, sf, "part")
    swapped = F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit(" "), "p_brand", F.lit(" "),
                       F.split_part("p_name", F.lit(" "), F.lit(1)))
    at = (F.col("p_partkey") % F.length(swapped)).cast("int")
    lost = F.concat(F.substring(swapped, F.lit(1), at), F.substring(swapped, at + 2, F.length(swapped)))
    return part.select("p_partkey", normalize_text(lost).alias("query_key"))


def _proper(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("video_id"),
                                           normalize_text(F.concat_ws(" ", "p_brand", "p_name")).alias("meta_key"))


def fuzzy_join(spark, sf):
    joined = FZ.fuzzy_join(_misspelt(spark, sf), _proper(spark, sf), "query_key", "meta_key", "video_id",
                           FZ.SERVICE_THRESHOLD)
    return joined.select("p_partkey", "query_key", "best_match", rounded("score").alias("score"), "video_id")


def fuzzy_join_unique(spark, sf):
    joined = FZ.fuzzy_join(_misspelt(spark, sf), _proper(spark, sf), "query_key", "meta_key", "video_id",
                           unique_right=True)
    return joined.select("p_partkey", "best_match", rounded("score").alias("score"), "video_id")


def bigram_candidates(spark, sf):
    """Pairs from the pruned plan that do reach the threshold: none may be missing."""
    from resonara.functions.text import token_sort

    left = _misspelt(spark, sf).select(token_sort(F.col("query_key")).alias("key")).distinct()
    right = _proper(spark, sf).select(token_sort(F.col("meta_key")).alias("key")).distinct()
    pairs = FZ.candidate_pairs(left, right, FZ.DEFAULT_THRESHOLD)
    scored = FZ.scored_pairs(pairs, FZ.DEFAULT_THRESHOLD)
    return scored.select("l_key", "r_key", rounded("score").alias("score"))


def resolve_query(spark, sf):
    """Footer titles looked up among page titles."""
    pages = table(spark, sf, "pages")
    word = F.lit(" ")

    def named(text):
        return [F.split_part(text, word, F.lit(1)).alias("artist"),
                F.regexp_replace(text, "^[^ ]* ?", "").alias("song")]

    requests = pages.select(F.col("page_id").alias("request_id"), *named(footer_of(F.col("html"))))
    known = pages.select(F.col("page_id").alias("item_id"), *named(title_of(F.col("html"))))
    found = FZ.resolve_queries(requests, known)
    return found.select("request_id", "how", F.coalesce("item_id", F.lit(-1)).alias("item_id"),
                        rounded(F.coalesce("score", F.lit(0.0))).alias("score"))


QUERIES = {f.__name__: f for f in (
    join_metadata_left, count_unmatched, join_files_inner, dedupe_last, dedupe_first, ingest_anti, ids_seen,
    sink_append_new, sink_append_stored, keep_after_removal, rewrite_filtered, removed_report, sink_csv_report,
    contains_join, contains_join_hash, rename_plan, backfill_worklist, upsert_by_id, lookup_exact, plot_subset,
    complete_rows, validate_required, dropna_features, union_tagged, catalogue_counts, distinct_categories,
    topk_liked, fuzzy_join, fuzzy_join_unique, bigram_candidates, resolve_query)}

_SUGGESTED = """
s as (select p_partkey, case when p_size > 5 then p_name else ' \t' end as title,
      case when p_size < 45 then p_brand end as artist from part)
"""
_SWAPPED = "split_part(p_name, ' ', 2) || ' ' || p_brand || ' ' || split_part(p_name, ' ', 1)"
_KEYS = f"""
w as (select p_partkey, {_SWAPPED} as s from part),
l as (select p_partkey, {sql_normal("substr(s, 1, (p_partkey % len(s))::int) || substr(s, (p_partkey % len(s))::int + 2)")}
      as query_key from w),
r as (select p_partkey as video_id, {sql_normal("p_brand || ' ' || p_name")} as meta_key from part),
ls as (select query_key, {sql_token_sort('query_key')} as a from l group by all),
rs as (select meta_key, min(video_id) as ord, {sql_token_sort('meta_key')} as b from r group by meta_key),
pairs as (select a, b, {sql_ratio('a', 'b')} as score from (select distinct a from ls), (select distinct b from rs))
"""
_BEST = """
best as (select query_key, meta_key, score from (
  select query_key, meta_key, score, row_number() over (partition by query_key order by score desc, ord) as i
  from ls join pairs using (a) join rs using (b)) where i = 1 and score >= {})
"""
_REQUESTS = f"""
p as (select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as t,
      regexp_extract(html, '<footer>&copy; [^ ]* &middot; ([^<]*)</footer>', 1) as f from pages),
asked as (select page_id as request_id, {sql_normal("split_part(f, ' ', 1)")} as a,
          {sql_normal("regexp_replace(f, '^[^ ]* ?', '')")} as s, {sql_normal('f')} as n from p),
known as (select page_id as item_id, {sql_normal("split_part(t, ' ', 1)")} as a,
          {sql_normal("regexp_replace(t, '^[^ ]* ?', '')")} as s, {sql_normal('t')} as n from p),
exact as (select request_id, min(item_id) as item_id from asked join known using (a, s) group by 1),
ns as (select n, {sql_token_sort('n')} as x from asked where request_id not in (select request_id from exact) group by n),
ks as (select n as k, min(item_id) as item_id, {sql_token_sort('n')} as y from known group by n),
pairs as (select x, y, {sql_ratio('x', 'y')} as score from (select distinct x from ns), (select distinct y from ks)),
near as (select n, item_id, score from (
  select n, item_id, score, row_number() over (partition by n order by score desc, item_id) as i
  from ns join pairs using (x) join ks using (y)) where i = 1 and score >= 85)
"""

SQL = {
    "join_metadata_left": """
select doc_id, lang, source as quality, coalesce(quality, -1)::int as quality_original
from documents left join labels using (doc_id)""",
    "count_unmatched": """
select count(*) as total, count(*) filter (quality is null) as missing_quality
from documents left join labels using (doc_id)""",
    "join_files_inner": """
with l as (select l_orderkey as id, l_linenumber, max(l_extendedprice) as price from lineitem group by 1, 2
           qualify row_number() over (partition by l_orderkey order by l_linenumber desc) = 1)
select id, o_orderpriority, l_linenumber, price from l join orders on o_orderkey = id""",
    "dedupe_last": """
select user_id, event_id, event_type, value from events
qualify row_number() over (partition by user_id order by event_id desc) = 1""",
    "dedupe_first": """
select user_id, event_id, event_type from events
qualify row_number() over (partition by user_id order by event_id) = 1""",
    "ingest_anti": """
with b as (select o_orderkey as id, o_orderstatus as status from orders union all
           select l_orderkey, l_linestatus from lineitem)
select id, min(status) as status from b where not exists (select 1 from customer where c_custkey = id) group by id""",
    "ids_seen": "select c_custkey as id from customer union select l_orderkey from lineitem",
    "sink_append_new": """
select doc_id as video_id, 'old' as origin, 'https://www.youtube.com/watch?v=' || doc_id as youtube_link from labels
union all select doc_id, 'new', '-' from documents where doc_id not in (select doc_id from labels)""",
    "sink_append_stored": """
select doc_id as video_id, 'old' as origin from labels
union all select doc_id, 'new' from documents where doc_id not in (select doc_id from labels)""",
    "keep_after_removal": """
select doc_id, lang, source, md5(text) as text from documents
where not exists (select 1 from labels l where l.doc_id = documents.doc_id and quality = 0)""",
    "rewrite_filtered": """
select 'documents' as dataset, doc_id, concat_ws('|', lang, source, md5(text)) as row from documents
where not exists (select 1 from labels l where l.doc_id = documents.doc_id and quality = 0)
union all select 'labels', doc_id, concat_ws('|', quality, toxic) from labels where quality <> 0""",
    "removed_report": """
select doc_id as id, p_name as song_title, p_brand as channel_name, md5(coalesce(text, '')) as lyrics
from labels join part on p_partkey = doc_id left join documents using (doc_id) where quality = 0""",
    "sink_csv_report": "select doc_id::varchar as doc_id, lang, md5(text) as text from documents",
    "contains_join": """
with m as (select word, count(*) as n from (
    select split_part(p_name, ' ', 2) as word from part union all select lang from documents)
  where len(word) > 0 group by word)
select url as file_name, word, n from (select distinct url from pages) join m on contains(url, word)
qualify row_number() over (partition by url order by word) = 1""",
    "contains_join_hash": """
select page_id || '_' || substr(md5(url), 1, 11) || ' x.mp3' as file_name, substr(md5(url), 1, 11) as video_id,
  page_id as ord from pages""",
    "rename_plan": """
with f as (select p_partkey as file_id, case when p_size > 40 then lower(p_brand) || '-' || p_name || '.mp3'
             else p_partkey || '.mp3' end as file_name, lower(p_brand) || '-' || p_name || '.mp3' as new_name from part)
select file_id, file_name, new_name, case when file_name = new_name then 'keep'
  when new_name in (select file_name from f) or file_id <> min(file_id) over (partition by new_name) then 'skip'
  else 'rename' end as action from f""",
    "backfill_worklist": """
with files as (select doc_id as id from labels union select p_partkey from part)
select doc_id as id, 'retry' as reason from documents where lang = 'es' and doc_id in (select id from files)
union all select id, 'new' from files where id not in (select doc_id from documents)""",
    "upsert_by_id": """
with c as (select doc_id as id, case when lang <> 'es' then text end as t from documents)
select coalesce(c.id, p_partkey) as id, md5(coalesce(t, p_name)) as lyrics from c full join part on p_partkey = c.id""",
    "lookup_exact": """
select s_suppkey as p_partkey, coalesce(p_name, '-') as p_name, p_name is not null as found
from supplier left join part on p_partkey = s_suppkey and p_type = 'ECONOMY'""",
    "plot_subset": """
select vec_id as item_id, label as cluster from embeddings
where vec_id in (select n_nationkey from nation) or vec_id in (select s_suppkey from supplier)""",
    "complete_rows": f"with {_SUGGESTED} select * from s where trim(title, ' \t') <> '' and artist is not null",
    "validate_required": f"""
with {_SUGGESTED}
select p_partkey, case when trim(title, ' \t') <> '' and artist is not null then 'valid' else 'rejected' end as population
from s""",
    "dropna_features": f"with {_SUGGESTED} select p_partkey, artist from s where artist is not null",
    "union_tagged": """
select 'before' as population, p_brand as artist, p_name as song from part
union all select 'after', s_name, '-' from supplier""",
    "catalogue_counts": """
select lang, count(*) as n, count(*) filter (quality is null) as missing, count(*) filter (quality = 0) as removed
from documents left join labels using (doc_id) group by lang""",
    "distinct_categories": """
select distinct 'p_type' as feature, p_type as category from part union all
select distinct 'p_brand', p_brand from part union all select distinct 'p_size', p_size::varchar from part""",
    "topk_liked": """
select user_id, likes, row_number() over (order by likes desc, user_id)::int as rank from (
  select user_id, count(*) filter (event_type = 'click') as likes from events group by 1)
order by likes desc, user_id limit 10""",
    "fuzzy_join": f"""
with {_KEYS}, {_BEST.format(85)}
select p_partkey, query_key, meta_key as best_match, round(score, 6) as score, video_id
from l join best using (query_key) join r using (meta_key)""",
    "fuzzy_join_unique": f"""
with {_KEYS}, {_BEST.format(90)}
select p_partkey, meta_key as best_match, round(score, 6) as score, ord as video_id
from l join best using (query_key) join rs using (meta_key)""",
    "bigram_candidates": f"""
with {_KEYS} select a as l_key, b as r_key, round(score, 6) as score from pairs where score >= 90""",
    "resolve_query": f"""
with {_REQUESTS}
select request_id, case when e.item_id is not null then 'exact' when near.item_id is not null then 'fuzzy'
    else 'unresolved' end as how, coalesce(e.item_id, near.item_id, -1) as item_id,
  case when e.item_id is not null then 100.0 else coalesce(round(score, 6), 0.0) end::double as score
from asked left join exact e using (request_id) left join near using (n)""",
}
