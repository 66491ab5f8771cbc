"""Grow a catalogue with new entries, and clean it by language."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resonara.functions.text import clean_title
from resonara.functions.urls import watch_url
from resonara.operators.catalogue import removed_report
from resonara.operators.language import lang_filter
from resonara.sources.writers import new_rows, survivors


def new_entries(catalogue: DataFrame, listed: DataFrame) -> DataFrame:
    """Catalogue rows for listed ``id, title, uploader`` entries not seen before."""
    entries = listed.select(F.col("id").alias("video_id"), F.col("title").alias("original_title"),
                            F.col("uploader").alias("channel_name"))
    fresh = new_rows(catalogue, entries, "video_id")
    return fresh.select(
        "video_id", clean_title(F.col("original_title"), F.col("channel_name")).alias("song_title"), "channel_name",
        "original_title", F.concat("video_id", F.lit(".mp3")).alias("audio_file"),
        watch_url(F.col("video_id")).alias("youtube_link"))


def split_by_language(lyrics: DataFrame, profile: DataFrame, metadata: DataFrame, target: str, *, key: str = "id",
                      order: str, text: str = "lyrics") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(kept lyrics, removed ids, report)`` for texts in and out of a language."""
    marked = lang_filter(lyrics, profile, target, key, text)
    removed = marked.where("not kept").select(key).distinct()
    kept = survivors(lyrics, removed, key)
    return kept, removed, removed_report(removed, metadata, lyrics, key, order, text)
