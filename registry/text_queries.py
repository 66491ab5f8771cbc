"""Titles, links, categories and page layouts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.common import as_queries, footer_of, items, rounded, table, texts, title_of
from resonara.functions import categories as C
from resonara.functions import text as X
from resonara.functions import urls as U
from resonara.functions import vectors as V
from resonara.operators import catalogue as CAT
from resonara.operators import ordering as O
from resonara.operators.features import palette
from resonara.operators.neighbours import knn
from resonara.operators.project import canvas_scale as scale_to_canvas
from resonara.operators.project import radial_layout as ring
from resonara.sources import readers as R
from resonara.workspace import new_folder


def _titles(spark, sf):
    """Page titles with the first title word as the channel."""
    pages = table(spark, sf, "pages").select("page_id", title_of(F.col("html")).alias("title"))
    return pages.withColumn("channel", F.split_part("title", F.lit(" "), F.lit(1)))


_TITLES = """
t as (
  select page_id, title, split_part(title, ' ', 1) as channel
  from (select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title from pages))
"""


def normalize_text(spark, sf):
    key = X.normalize_text(F.col("text"))
    return texts(spark, sf, "documents", "doc_id", "text").select("doc_id", F.md5(key).alias("key"),
                                                F.length(key).cast("long").alias("chars"))


def normalize_text_early(spark, sf):
    key = X.normalize_text(F.col("text"), hyphen_is_blank=False)
    return texts(spark, sf, "documents", "doc_id", "text").select("doc_id", F.md5(key).alias("key"))


def sanitize_title(spark, sf):
    return texts(spark, sf, "documents", "doc_id", "text").select("doc_id", F.md5(X.sanitize_title(F.col("text"))).alias("title"))


def clean_title(spark, sf):
    return _titles(spark, sf).select("page_id", X.clean_title(F.col("title"), F.col("channel")).alias("title"))


def strip_channel_prefix(spark, sf):
    rest = X.strip_channel_prefix(F.concat("channel", F.lit(" - "), "title"), F.col("channel"))
    return _titles(spark, sf).select("page_id", rest.alias("title"), X.compact_file_part(rest).alias("file_part"))


def title_to_filename(spark, sf):
    joined = F.concat("channel", F.lit(": "), "title")
    return _titles(spark, sf).select("page_id", X.title_to_filename(joined, F.col("channel")).alias("name"))


def sanitize_name(spark, sf):
    noisy = F.concat("title", F.lit(" Oficial - Topic "))
    return _titles(spark, sf).select("page_id", X.sanitize_name(noisy).alias("name"))


def make_query_id(spark, sf):
    made = X.make_query_id(F.col("p_brand"), F.col("p_name"))
    parts = X.split_query_id(made)
    return table(spark, sf, "part").select("p_partkey", made.alias("query_id"), parts["artist"].alias("artist"),
                                           parts["song"].alias("song"), parts["valid"].alias("valid"))


def split_query_id(spark, sf):
    parts = X.split_query_id(F.replace(F.col("p_name"), F.lit(" "), F.lit("::")))
    odd = X.split_query_id(F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", parts["artist"].alias("artist"), parts["song"].alias("song"),
                                           odd["valid"].alias("plain_valid"))


def label_concat(spark, sf):
    joined = CAT.join_metadata(
        table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("artist"),
                                        F.col("p_name").alias("song")),
        table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("artist")), "id")
    shown = X.label(F.col("artist"), F.col("song"), F.col("artist_original"))
    return joined.select("id", shown.alias("label"))


def parse_stem(spark, sf):
    """Every name as id, id-song and id-song-artist stem."""
    part = table(spark, sf, "part")
    stems = F.array(F.col("p_partkey").cast("string"), F.concat_ws("-", "p_partkey", "p_name"),
                    F.concat_ws("-", "p_partkey", "p_name", "p_type"),
                    F.concat_ws("-", "p_partkey", "p_brand", "p_name", "p_type"))
    rows = part.select("p_partkey", F.posexplode(stems).alias("form", "stem"))
    found = X.parse_stem(F.col("stem"))
    return rows.select("p_partkey", "form", found["id"].alias("id"), found["song"].alias("song"),
                       found["artist"].alias("artist"), X.stem_id(F.col("stem")).alias("stem_id"))


def token_sort_ratio(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", X.normalize_text(title_of(F.col("html"))).alias("a"),
                                             X.normalize_text(footer_of(F.col("html"))).alias("b"))
    return pages.select("page_id", rounded(X.token_sort_ratio(F.col("a"), F.col("b"))).alias("score"))


# --- links ------------------------------------------------------------------

def _links(spark, sf):
    """The page link itself and eight video links built from its hash."""
    page = table(spark, sf, "pages").select("page_id", "url", F.substring(F.md5("url"), 1, 11).alias("id"))
    forms = F.array(
        F.col("url"), F.concat(F.lit("https://www.youtube.com/watch?v="), "id"),
        F.concat(F.lit("https://www.youtube.com/watch?v="), "id", F.lit("&list=RD1")),
        F.concat(F.lit("youtu.be/"), "id", F.lit("?si=x")),
        F.concat(F.lit("https://www.youtube.com/embed/"), "id"),
        F.concat(F.lit("https://youtube.com/playlist?list=PL"), "id"),
        F.concat(F.lit("https://www.youtube.com/channel/UC"), "id", F.lit("/"), "id"),
        F.concat(F.lit("https://www.youtube.com/watch?list=PLx&v="), "id"),
        F.lit("  "))
    return page.select("page_id", F.posexplode(forms).alias("form", "link"))


_LINKS = """
p as (select page_id, url, substr(md5(url), 1, 11) as id from pages),
links as (
  select page_id, unnest(range(9))::int as form, unnest([url, 'https://www.youtube.com/watch?v=' || id,
    'https://www.youtube.com/watch?v=' || id || '&list=RD1', 'youtu.be/' || id || '?si=x',
    'https://www.youtube.com/embed/' || id, 'https://youtube.com/playlist?list=PL' || id,
    'https://www.youtube.com/channel/UC' || id || '/' || id,
    'https://www.youtube.com/watch?list=PLx&v=' || id, '  ']) as link from p),
ided as (
  select *, nullif(regexp_extract(link,
    '(?:youtube\\.com/(?:[^/\\n\\s]+/\\S+/|(?:v|e(?:mbed)?)/|\\S*?[?&]v=)|youtu\\.be/)([a-zA-Z0-9_-]{11})', 1), '') as video_id
  from links)
"""


def extract_video_id(spark, sf):
    found = U.extract_video_id(F.col("link"))
    return _links(spark, sf).select("page_id", "form", F.coalesce(found, F.lit("-")).alias("video_id"))


def classify_url(spark, sf):
    link = F.col("link")
    return _links(spark, sf).select("page_id", "form", U.classify_url(link).alias("class"),
                                    U.link_reason(link).alias("reason"))


def watch_url(spark, sf):
    page = table(spark, sf, "pages")
    return page.select("page_id", U.watch_url(F.col("page_id").cast("string")).alias("watch"),
                       U.strip_url_params(F.col("url")).alias("bare"))


def src_seed_urls(spark, sf):
    return R.seed_urls(table(spark, sf, "pages").withColumnRenamed("url", "playlist_url"))


def src_catalogue(spark, sf):
    return R.as_catalogue(table(spark, sf, "documents")).withColumnRenamed("source", "channel_name").withColumn("text", F.md5("text"))


def src_metadata_conform(spark, sf):
    raw = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias(" id "), F.col("p_name").alias("Song Name"),
        F.col("p_brand").alias(" Band"), F.col("p_type").alias("Genre "), F.col("p_size").alias("Instrumentation"))
    return R.conform_metadata(raw)


# --- categories and layouts -------------------------------------------------

def similarity_percent(spark, sf):
    percent = V.similarity_percent(F.col("value"))
    return table(spark, sf, "events").select("event_id", rounded(percent).alias("percent"),
                                             V.percent_label(percent).alias("label"))


def default_columns(spark, sf):
    short = F.when(F.col("s_acctbal") >= 0, F.col("s_name"))
    filled = CAT.default_columns(table(spark, sf, "supplier").select("s_suppkey", short.alias("song")),
                                 ["song", "link"])
    return filled.select("s_suppkey", "song", "link")


def bucket_int(spark, sf):
    part = table(spark, sf, "part")
    return part.select("p_partkey", C.instrumentation_bucket(F.col("p_size").cast("string")).alias("instruments"))


def category_clean(spark, sf):
    part = table(spark, sf, "part")
    dirty = F.when(F.col("p_size") > 45, F.lit(" \t ")).when(F.col("p_size") > 40, F.lit(None)).otherwise(
        F.concat(F.lit("\t"), "p_type", F.lit(" ")))
    voice = F.when(F.col("p_size") > 30, "Female & Male").when(F.col("p_size") > 15, "Male ").otherwise("Female")
    return part.select("p_partkey", C.category_clean(dirty).alias("genre"), C.voice_class(voice).alias("voice"))


def palette_index(spark, sf):
    known = {"ECONOMY": "#1f77b4", "PROMO": "#ff7f0e"}
    return palette(table(spark, sf, "part"), "p_name", known).unionByName(palette(table(spark, sf, "part"), "p_type", known))


def radial_layout(spark, sf):
    base = items(spark, sf)
    laid = ring(knn(base, as_queries(base), 5))
    return laid.select("query_id", "rank", rounded("x").alias("x"), rounded("y").alias("y"))


def canvas_scale(spark, sf):
    points = items(spark, sf).select("item_id", V.to_double(F.col("embedding"))[0].alias("x"),
                                     V.to_double(F.col("embedding"))[1].alias("y"), F.lit(3.0).alias("flat"))
    return scale_to_canvas(points, "x", "y", "flat").select(
        "item_id", rounded("x").alias("x"), rounded("y").alias("y"), "flat")


def canvas_scale_grouped(spark, sf):
    points = items(spark, sf).select("item_id", "cluster", V.to_double(F.col("embedding"))[0].alias("x"))
    return scale_to_canvas(points, "x", within=["cluster"]).select("item_id", "cluster", rounded("x").alias("x"))


def plot_table(spark, sf):
    from resonara.sources.writers import plot_table as chart

    points = items(spark, sf).select(F.col("item_id").alias("id"), rounded(F.col("embedding")[0].cast("double")).alias("x"),
                                     rounded(F.col("embedding")[1].cast("double")).alias("y"))
    details = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_type", "p_brand", "p_name")
    return chart(points, details, "id", F.col("p_type"), F.col("p_brand"), X.label(F.col("p_brand"), F.col("p_name")))


def coords_json(spark, sf):
    from resonara.sources.writers import json_rows

    points = items(spark, sf).select("item_id", F.col("cluster").cast("string").alias("artist"),
                                     (F.col("item_id") == F.col("cluster")).alias("is_query"))
    return json_rows(points, "item_id", "artist", "is_query")


# --- library ----------------------------------------------------------------

_SHOWN = ["p_name", "p_brand", "p_type"]


def library_search(spark, sf):
    return CAT.search(table(spark, sf, "part"), "Ring", *_SHOWN).select("p_partkey", *_SHOWN)


def library_page(spark, sf):
    found = CAT.search(table(spark, sf, "part"), "ring", *_SHOWN)
    return O.page(found, ["p_partkey"], 3).select("p_partkey", "p_name")


def library_pages(spark, sf):
    return O.page_numbers(table(spark, sf, "part"), ["p_name", "p_partkey"]).select("p_partkey", "position", "page")


def library_deep_pages(spark, sf):
    """Every seventh page of the library, each read by itself from the stored directory."""
    stored = O.store_pages(table(spark, sf, "part").select("p_partkey", "p_name"), ["p_name", "p_partkey"], new_folder(spark, "library"), part_rows=64)
    pages = range(1, stored.pages(20) + 1, max(1, stored.pages(20) // 7))
    found = [stored.page(number, 20).select("p_partkey", "position", F.lit(number).cast("long").alias("page")) for number in pages]
    return reduce(DataFrame.unionByName, found)


def library_totals(spark, sf):
    return O.page_totals(CAT.search(table(spark, sf, "part"), "ring", *_SHOWN))


QUERIES = {f.__name__: f for f in (
    normalize_text, normalize_text_early, sanitize_title, clean_title, strip_channel_prefix, title_to_filename,
    sanitize_name, make_query_id, split_query_id, label_concat, parse_stem, token_sort_ratio, extract_video_id,
    classify_url, watch_url, src_seed_urls, src_catalogue, src_metadata_conform, similarity_percent, default_columns,
    bucket_int, category_clean, palette_index, radial_layout, canvas_scale, canvas_scale_grouped, plot_table,
    coords_json, library_search, library_page, library_pages, library_deep_pages, library_totals)}


def sql_normal(text: str) -> str:
    plain = f"strip_accents(replace(replace({text}, '_', ' '), '-', ' '))"
    kept = f"regexp_replace({plain}, '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g')"
    return f"lower(trim(regexp_replace({kept}, '\\s+', ' ', 'g')))"


def sql_token_sort(text: str) -> str:
    return f"array_to_string(list_sort(string_split({text}, ' ')), ' ')"


def sql_ratio(a: str, b: str) -> str:
    """Bit-parallel longest common subsequence over the characters of ``b``; works
    for ``a`` of up to 62 characters."""
    full = f"((1::hugeint << len({a})::int) - 1)"
    bits = (f"list_transform(string_split({b}, ''), lambda ch: coalesce(list_sum(list_transform(range(len({a})), "
            f"lambda i: case when {a}[i + 1] = ch then 1::hugeint << i::int else 0::hugeint end))::hugeint, 0::hugeint))")
    state = f"list_reduce({bits}, lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full}, {full})"
    return (f"case when {a} = '' and {b} = '' then 100.0 when {a} = '' or {b} = '' then 0.0 "
            f"else 200.0 * (len({a}) - bit_count({state})) / (len({a}) + len({b})) end")


_NORMAL_DOC = sql_normal("text")
_UNSAFE = """'[<>:"/\\\\|?*]'"""
_STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"

SQL = {
    "normalize_text": f"select doc_id, md5({_NORMAL_DOC}) as key, length({_NORMAL_DOC}) as chars from documents",
    "normalize_text_early": f"""
select doc_id, md5(lower({_STRIP.format(
    "regexp_replace(strip_accents(replace(text, '_', ' ')), '[^\\p{L}\\p{N}_\\s]', '', 'g')")})) as key
from documents""",
    "sanitize_title": f"""
select doc_id, md5(replace({_STRIP.format(f"regexp_replace(text, {_UNSAFE}, '', 'g')")}, ' ', '_')) as title
from documents""",
    "clean_title": f"""
with {_TITLES},
a as (select page_id, regexp_replace(regexp_replace(trim(replace(case when title = '' then 'unknown_title' else title end,
      channel, '')), {_UNSAFE}, '', 'g'), '[’"“”‘]', '', 'g') as s from t)
select page_id, substr(regexp_replace(trim(replace(replace(s, ' - ', ' '), '—', ' ')), '\\s+', '_', 'g'), 1, 100) as title
from a""",
    "strip_channel_prefix": f"""
with {_TITLES}, u as (select page_id, trim(ltrim(substr(channel || ' - ' || title, len(channel) + 1), '-: ')) as s from t)
select page_id, s as title, regexp_replace(replace(s, ' ', ''), {_UNSAFE}, '', 'g') as file_part from u""",
    "title_to_filename": f"""
with {_TITLES}
select page_id, regexp_replace(regexp_replace(replace(trim(substr(channel || ': ' || title, len(channel) + 4)), ' ', '_'),
  {_UNSAFE}, '_', 'g'), '__+', '_', 'g') as name from t""",
    "sanitize_name": f"""
with {_TITLES}
select page_id, trim(replace(replace(lower(title || ' Oficial - Topic '), ' - topic', ''), ' oficial', '')) as name from t""",
    "make_query_id": f"""
with k as (select p_partkey, replace({sql_normal('p_brand')}, ' ', '_') as a, replace({sql_normal('p_name')}, ' ', '_') as s
           from part)
select p_partkey, a || '::' || s as query_id, a as artist, s as song, true as valid from k""",
    "split_query_id": """
select p_partkey, split_part(p_name, ' ', 1) as artist, split_part(p_name, ' ', 2) as song, false as plain_valid
from part""",
    "label_concat": """
select p_partkey as id, coalesce(s_name, p_brand) || ' - ' || p_name as label
from part left join supplier on s_suppkey = p_partkey""",
    "parse_stem": """
select p_partkey, 0::int as form, p_partkey::varchar as id, '' as song, 'unknown' as artist, p_partkey::varchar as stem_id
from part
union all select p_partkey, 1, p_partkey::varchar, p_name, 'unknown', p_partkey || '-' || p_name from part
union all select p_partkey, 2, p_partkey::varchar, p_name, p_type, p_partkey || '-' || p_name || '-' || p_type from part
union all select p_partkey, 3, p_partkey || '-' || p_brand, p_name, p_type,
  p_partkey || '-' || p_brand || '-' || p_name || '-' || p_type from part""",
    "token_sort_ratio": f"""
with k as (select page_id, {sql_normal("regexp_extract(html, '<title>([^<]*)</title>', 1)")} as a,
  {sql_normal("regexp_extract(html, '<footer>&copy; [^ ]* &middot; ([^<]*)</footer>', 1)")} as b from pages),
s as (select page_id, {sql_token_sort('a')} as a, {sql_token_sort('b')} as b from k)
select page_id, round({sql_ratio('a', 'b')}, 6) as score from s""",
    "extract_video_id": f"with {_LINKS} select page_id, form, coalesce(video_id, '-') as video_id from ided",
    "classify_url": f"""
with {_LINKS}, r as (
  select *, case when trim(link) = '' then 'empty'
    when not contains(link, 'youtube.com') and not contains(link, 'youtu.be') then 'host'
    when regexp_matches(link, 'playlist[?]|&list=|/playlist/|list=(PL|UU|FL|LL|WL)') then 'playlist'
    when video_id is null then 'no_id'
    when regexp_matches(link, '/channel/|/user/|/c/|@') then 'channel' else 'ok' end as reason from ided)
select page_id, form, reason, case reason when 'empty' then 'empty' when 'host' then 'invalid' when 'ok' then 'ok'
  else 'playlist' end as class from r""",
    "watch_url": """
select page_id, 'https://www.youtube.com/watch?v=' || page_id as watch, split_part(url, '&', 1) as bare from pages""",
    "src_seed_urls": "select url as playlist_url from pages where url is not null",
    "src_catalogue": """
select doc_id::varchar as doc_id, md5(text) as text, lang, source as channel_name, n_chars::varchar as n_chars from documents""",
    "src_metadata_conform": """
select p_partkey::varchar as "ID", p_name as "Song", p_brand as "Artist", p_type as "Genre", p_size as "Instrumentation"
from part""",
    "similarity_percent": """
with p as (select event_id, case when value < 10 then 100.0 when value > 30 then 0.0
           else 100.0::double - (value - 10.0) * 5.0 end::double as percent from events)
select event_id, round(percent, 6) as percent, round_even(percent, 0)::int || '%' as label from p""",
    "default_columns": """
select s_suppkey, case when s_acctbal >= 0 then s_name else 'N/A' end as song, 'N/A' as link from supplier""",
    "bucket_int": """
select p_partkey, case when p_size between 2 and 5 then 'Instruments (' || p_size || ')' else 'Unknown' end as instruments
from part""",
    "category_clean": """
select p_partkey, case when p_size > 40 then 'Unknown' else p_type end as genre,
  case when p_size > 30 then 'Male & Female' when p_size > 15 then 'Male' else 'Female' end as voice from part""",
    "palette_index": """
with spare as (select ['#8c564b', '#e377c2', '#7f7f7f', '#bcbd22', '#17becf'] as c),
names as (select 1 as kind, p_name as category from part group by all union all
          select 2, p_type from part group by all),
unseen as (select *, row_number() over (partition by kind order by category) - 1 as i from names
           where category not in ('ECONOMY', 'PROMO'))
select category, c[i % 5 + 1] as colour from unseen, spare
union all select category, case category when 'ECONOMY' then '#1f77b4' else '#ff7f0e' end from names
where category in ('ECONOMY', 'PROMO')""",
    "radial_layout": """
with r as (select vec_id as query_id, unnest(range(6))::int as rank from embeddings)
select query_id, rank, case rank when 0 then 0.0 else round(1.5 * cos((rank - 1) * 2 * pi() / 5), 6) + 0.0 end::double as x,
  case rank when 0 then 0.0 else round(1.5 * sin((rank - 1) * 2 * pi() / 5), 6) + 0.0 end::double as y from r""",
    "canvas_scale": """
with v as (select vec_id, embedding[1]::double as x, embedding[2]::double as y from embeddings),
e as (select min(x) as lx, max(x) as hx, min(y) as ly, max(y) as hy from v)
select vec_id as item_id, round((x - lx) / (hx - lx) * 80 + 10, 6) as x, round((y - ly) / (hy - ly) * 80 + 10, 6) as y,
  50.0::double as flat from v, e""",
    "canvas_scale_grouped": """
with v as (select vec_id, label, embedding[1]::double as x from embeddings),
e as (select label, min(x) as lx, max(x) as hx from v group by label)
select vec_id as item_id, label as cluster, round((x - lx) / (hx - lx) * 80 + 10, 6) as x from v join e using (label)""",
    "plot_table": """
select vec_id as id, round(embedding[1]::double, 6) as x, round(embedding[2]::double, 6) as y, p_type as colour,
  p_brand as symbol, p_brand || ' - ' || p_name as label from embeddings join part on p_partkey = vec_id""",
    "coords_json": """
select '{"item_id":' || vec_id || ',"artist":"' || label || '","is_query":' ||
  case when vec_id = label then 'true' else 'false' end || '}' as json from embeddings""",
    "library_search": """
select p_partkey, p_name, p_brand, p_type from part
where contains(lower(p_name), 'ring') or contains(lower(p_brand), 'ring') or contains(lower(p_type), 'ring')""",
    "library_page": "select p_partkey, p_name from part where p_name like '%ring%' order by p_partkey limit 10 offset 20",
    "library_pages": """
select p_partkey, row_number() over (order by p_name, p_partkey) as position,
  ((row_number() over (order by p_name, p_partkey) + 9) // 10)::bigint as page from part""",
    "library_deep_pages": """
with placed as (select p_partkey, row_number() over (order by p_name, p_partkey) as position from part),
size as (select (count(*) + 19) // 20 as pages from part)
select p_partkey, position, ((position + 19) // 20)::bigint as page from placed, size
where ((position + 19) // 20 - 1) % greatest(1, pages // 7) = 0""",
    "library_totals": "select count(*) as total, ((count(*) + 9) // 10)::bigint as pages from part where p_name like '%ring%'",
}
