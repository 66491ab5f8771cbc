"""Registered queries of this subpackage; each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resonara.llm import (
    byte_bpe, conversation_sql, fingerprints, html_text, katz, katz_sql, licenses, line_dedup, mixing, near_copies, prefix_trie, token_counts,
    top_search, toxicity, turn_repair,
)
from resonara.llm.common import documents, table
from resonara.workspace import written

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 4096
QUERY_STEP = 20
TOP = 10
LANGUAGE_FOLDS, LANGUAGE_HELD_OUT = 7, 2


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_dedup(documents(spark, folder).select("doc_id", "text"))


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encode = byte_bpe.encoder(spark, RANKS, public_tokenizers.PATTERN)
    decode = byte_bpe.decoder(spark, RANKS)
    ids = documents(spark, folder).select("doc_id", encode("text").alias("ids"))
    return ids.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(byte_bpe.id_text(F.col("ids")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(decode("ids"), 256).alias("decoded_sha256"),
    )


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(documents(spark, folder), licenses.known_licenses(spark)).withColumnRenamed("id", "doc_id")


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    count = token_counts.counter(spark, PIECES)
    return documents(spark, folder).select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), count("text").alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    prints = fingerprints.edited_fingerprints(documents(spark, folder))
    rows = written(prints.select(
        F.col("id").alias("doc_id"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        fingerprints.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        fingerprints.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    ), "prints")
    near = fingerprints.near_counts(written(rows.select("fingerprint").distinct(), "distinct"))
    return rows.join(near, "fingerprint", "left").select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next", F.coalesce("n_near", F.lit(0)).alias("n_near"))


def op6_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_copies.near_copies(documents(spark, folder))
    return found.select(F.col("id").alias("doc_id"), near_copies.hex_text(F.col("fp")).alias("fingerprint"), "component_id")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, folder), table(spark, folder, "labels")).withColumnRenamed("id", "doc_id")


def op8_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_documents(documents(spark, folder).select("doc_id", "text", "source", "lang")).select("row.doc_id", "mix.*")


def op9_top_search(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    queries = docs.where(F.col("doc_id") % QUERY_STEP == 0).select(F.col("doc_id").alias("query_id"), "text")
    return top_search.top_search(docs.select("doc_id", "text"), queries, TOP)


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", html_text.extract("html").alias("text"))
    return pages.withColumn("n_chars", F.char_length("text").cast("long"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.repair_conversations(table(spark, folder, "conversations"))


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, folder, "conversations"))


def op13_language_scores(spark: SparkSession, folder: str) -> DataFrame:
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % LANGUAGE_FOLDS
    found = katz.language_scores(documents(spark, folder), fold == LANGUAGE_HELD_OUT).withColumnRenamed("id", "doc_id")
    return found.withColumns({name: F.round(name, 6) for name in ("base_score", "score")})


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_license_scan": op3_license_scan,
    "op4_token_counts": op4_token_counts,
    "op5_fingerprints": op5_fingerprints,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_source_mixing": op8_source_mixing,
    "op9_top_search": op9_top_search,
    "op10_html_extraction": op10_html_extraction,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_language_scores": op13_language_scores,
}



def _license_sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def canonical(text: str) -> str:
        form = f"regexp_replace(lower({text}), {quoted(licenses.COPYRIGHT_LINE)}, '', 'g')"
        form = f"trim(regexp_replace({form}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
        form = f"' ' || replace({form}, ' ', '  ') || ' '"
        for written_as, standard in licenses.EQUIVALENT:
            form = f"replace({form}, {quoted(' ' + written_as.replace(' ', '  ') + ' ')}, {quoted(' ' + standard.replace(' ', '  ') + ' ')})"
        return f"trim(replace({form}, '  ', ' '))"

    values = ", ".join(f"({quoted(license_id)}, {quoted(text)})" for license_id, text in licenses.known_texts())
    return f"""
        with known as (select distinct license_id, {canonical("text")} as form from (values {values}) known(license_id, text)),
        units as (
            select doc_id, 'text' as unit, 0 as position, text as content from documents
            union all
            select doc_id, 'paragraph', generate_subscripts(parts, 1) - 1, unnest(parts)
            from (select doc_id, string_split(text, chr(10) || chr(10)) as parts from documents) where len(parts) > 1
            union all
            select doc_id, 'line', generate_subscripts(parts, 1) - 1, unnest(parts)
            from (select doc_id, string_split(text, chr(10)) as parts from documents) where len(parts) > 1)
        select u.doc_id, k.license_id, u.unit, cast(u.position as int) as position, u.content
        from (select *, {canonical("content")} as form from units) u join known k on u.form = k.form where k.form <> ''"""


SQL: dict[str, str] = {
    "op11_conversation_repair": conversation_sql.turn_repair_sql(),
    "op12_conversation_trie": conversation_sql.prefix_trie_sql(),
    "op13_language_scores": katz_sql.katz_sql(LANGUAGE_FOLDS, LANGUAGE_HELD_OUT),
    "op9_top_search": f"""
        with words as (
            select doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+')) as word
            from documents where doc_id is not null),
        counts as (select doc_id, word, count(*) as n from words group by all),
        lengths as (select d.doc_id, coalesce(sum(c.n), 0) as length from documents d left join counts c using (doc_id) group by all),
        size as (select count(*) as documents, avg(length) as mean from lengths),
        frequencies as (select word, count(*) as frequency from counts group by all),
        scores as (
            select q.doc_id as query_id, d.doc_id,
                   round(sum(ln(1 + (s.documents - f.frequency + 0.5) / (f.frequency + 0.5))
                             * d.n * ({top_search.K1} + 1) / (d.n + {top_search.K1} * (1 - {top_search.B} + {top_search.B} * l.length / s.mean))),
                         {top_search.DIGITS}) as score
            from counts q join counts d on q.word = d.word and q.doc_id <> d.doc_id
            join frequencies f on f.word = q.word join lengths l on l.doc_id = d.doc_id cross join size s
            where q.doc_id % {QUERY_STEP} = 0 group by all)
        select query_id, doc_id, cast(row_number() over (partition by query_id order by score desc, doc_id) as int) as rank, score
        from scores qualify rank <= {TOP}""",
    "op3_license_scan": _license_sql(),
    "op1_line_dedup": f"""
        with lines as (
            select doc_id, unnest(string_split(text, chr(10))) as content, generate_subscripts(string_split(text, chr(10)), 1) as line
            from documents where text is not null),
        totals as (
            select *, sum(length(content)) over (partition by doc_id order by line) as total, length(content) as chars from lines),
        spans as (
            select s.doc_id, s.line as first, e.line as last
            from totals s join totals e on s.doc_id = e.doc_id and e.line >= s.line
            where e.total - (s.total - s.chars) >= {line_dedup.MIN_CHARS}
              and (e.total - e.chars - (s.total - s.chars) < {line_dedup.MIN_CHARS} or e.total - s.total < {line_dedup.MIN_CHARS})),
        runs as (
            select p.doc_id, p.first, p.last, string_agg(l.content, chr(10) order by l.line) as content
            from spans p join lines l on l.doc_id = p.doc_id and l.line between p.first and p.last
            group by all),
        later as (
            select doc_id, first, last from runs
            qualify row_number() over (partition by content, last - first order by doc_id, first) > 1),
        gone as (
            select distinct l.doc_id, l.line from lines l join later r on l.doc_id = r.doc_id and l.line between r.first and r.last),
        kept as (
            select l.doc_id, string_agg(l.content, chr(10) order by l.line) as text
            from lines l anti join gone g on l.doc_id = g.doc_id and l.line = g.line group by l.doc_id)
        select d.doc_id, case when d.text is null then null else coalesce(k.text, '') end as text
        from documents d left join kept k on d.doc_id = k.doc_id""",
}
