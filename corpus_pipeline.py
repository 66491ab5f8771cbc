"""The document pipeline: each stage applies one operator to all that its predecessor kept.

Toxic documents go; later copies of repeated runs of lines go; one document of
each group of near copies stays, the one with the smallest id; documents are drawn
towards the target mix of sources, languages and kinds of text, with a number of
copies where a rare kind is to weigh more; the rest is
encoded by byte-level BPE and decoded again.  Each stage is written as Parquet and
read back by the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resonara.llm import byte_bpe, line_dedup, mixing, near_copies, toxicity
from resonara.workspace import new_folder, ship

#: Characters of a repeated run of lines at least; blank lines and short words alone are none.
LEAST_RUN = 15
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    ship(spark)
    return toxicity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the later copies of repeated runs of lines; ``n_chars`` follows the text."""
    found = line_dedup.line_dedup(docs, min_chars=LEAST_RUN)
    if "n_chars" not in docs.columns:
        return found
    kind = docs.schema["n_chars"].dataType
    return found.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies.

    Documents without an id form groups by text as well; of rows with one id all stay that hold it.
    """
    ship(spark)
    return near_copies.representatives(docs)


def draw_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at their calibrated rates, each once; ``copies`` is how often it stands in the mix."""
    return mixing.mix_documents(docs).where("mix.sampled").select("row.*", "mix.copies")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, the ids of the whole text, their number and the digest of the decoded bytes."""
    ship(spark)
    found = byte_bpe.round_trip(spark, RANKS, public_tokenizers.PATTERN)("text")
    return docs.withColumns({"ids": found["ids"], "n_tokens": F.size(found["ids"]).cast("long"), "decoded_sha256": F.sha2(found["decoded"], 256)})



STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_copies),
    ("source mixing", draw_mix),
    ("byte-level bpe", encode),
]

#: Scores of learnt trees and iterated fits have no SQL form; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
