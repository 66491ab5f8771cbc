"""Text and audio embeddings with pluggable encoders.

An encoder is a factory called once per task; what it returns maps a list of
chunks (token lists, or file bytes) to a list of vectors or frame matrices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resonara.functions.text import squeeze
from resonara.operators.cluster import mean_vectors

# --- fixed values -----------------------------------------------------------
WINDOW_TOKENS = 512
STRIDE_TOKENS = 256
TEXT_DIMS = 768
# ----------------------------------------------------------------------------

Encoder = Callable[[Sequence], Sequence]
VECTOR = T.ArrayType(T.DoubleType())


def whitespace_tokens(text: Column) -> Column:
    """Tokens between blanks; a blank text has none."""
    return F.filter(F.split(squeeze(F.coalesce(text, F.lit(""))), " "), lambda t: t != "")


def window_starts(size: Column, window: int = WINDOW_TOKENS, stride: int = STRIDE_TOKENS) -> Column:
    """Start of every window: the last one is the first to reach the end."""
    if not 0 < stride <= window:
        raise ValueError("stride must be between 1 and the window")
    further = F.greatest(F.ceil((size - window) / stride), F.lit(0))
    return F.transform(F.sequence(F.lit(0).cast("long"), further), lambda i: (i * stride).cast("int"))


def chunk_tokens(df: DataFrame, key: str, tokens: Column, window: int = WINDOW_TOKENS,
                 stride: int = STRIDE_TOKENS) -> DataFrame:
    """``key, chunk, start, tokens``: overlapping windows; short texts are one."""
    held = df.select(key, tokens.alias("_all"))
    starts = held.select(key, "_all", F.posexplode(window_starts(F.size("_all"), window, stride)).alias("chunk", "start"))
    return starts.select(key, "chunk", "start", F.slice("_all", F.col("start") + 1, F.lit(window)).alias("tokens"))


def bucket(token: Column, dims: int) -> Column:
    """Feature-hashing bucket of a token: leading 32 bits of its md5."""
    return F.pmod(F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("long"), F.lit(dims)).cast("int")


def hash_embed(df: DataFrame, key: str, tokens: Column, dims: int = TEXT_DIMS, window: int = WINDOW_TOKENS,
               stride: int = STRIDE_TOKENS) -> DataFrame:
    """``key, dim, value``: mean over chunks of each chunk's token shares.

    The default encoder, needing no model file and no Python.  A token at
    position p is in the windows starting at most ``window - 1`` before it, so
    its weight follows from p alone and windows are never copied out.  Dimensions
    that are zero are left out; see ``dense``.
    """
    held = df.select(key, tokens.alias("_all"))
    size = F.size("_all")
    last = F.greatest(F.ceil((size - window) / stride), F.lit(0)).cast("int")
    spelled = held.select(key, size.alias("size"), last.alias("last"), F.posexplode("_all").alias("at", "token"))
    first = F.greatest(F.ceil((F.col("at") - (window - 1)) / stride), F.lit(0)).cast("int")
    final = F.least(F.floor(F.col("at") / stride).cast("int"), F.col("last"))
    # every covering window is full except possibly the last one
    length_last = F.least(F.col("size") - F.col("last") * stride, F.lit(window))
    in_last = F.when(final == F.col("last"), 1.0 / length_last).otherwise(0.0)
    full = F.when(final == F.col("last"), final - first).otherwise(final - first + 1) / float(window)
    weight = (in_last + full) / (F.col("last") + 1)
    return spelled.select(key, bucket(F.col("token"), dims).alias("dim"), weight.alias("_w")).groupBy(key, "dim").agg(
        F.sum("_w").alias("value"))


def dense(df: DataFrame, key: str, dims: int) -> DataFrame:
    """``key, embedding`` from ``key, dim, value``."""
    entries = F.map_from_entries(F.collect_list(F.struct("dim", "value")))
    at = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)),
                     lambda i: F.coalesce(F.try_element_at(F.col("_entries"), i), F.lit(0.0)))
    return df.groupBy(key).agg(entries.alias("_entries")).select(key, at.alias("embedding"))


def _encode(df: DataFrame, key: str, content: str, factory: Callable[[], Encoder], batch_rows: int) -> DataFrame:
    schema = T.StructType([df.schema[key], T.StructField("embedding", VECTOR)])

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = factory()
        for batch in batches:
            for start in range(0, len(batch), batch_rows):
                part = batch.iloc[start:start + batch_rows]
                vectors = [np.asarray(v, dtype=np.float64) for v in encoder(list(part[content]))]
                # a frame matrix becomes its mean over time
                yield pd.DataFrame({key: part[key].to_numpy(),
                                    "embedding": [v.mean(axis=0) if v.ndim > 1 else v for v in vectors]})

    return df.select(key, content).mapInPandas(encode, schema)


def embed_text(df: DataFrame, key: str, tokens: Column, factory: Callable[[], Encoder], window: int = WINDOW_TOKENS,
               stride: int = STRIDE_TOKENS, batch_rows: int = 32) -> DataFrame:
    """``key, embedding``: encode each chunk of every text, mean over its chunks."""
    chunks = chunk_tokens(df, key, tokens, window, stride)
    return mean_vectors(_encode(chunks, key, "tokens", factory, batch_rows), key).drop("size")


def embed_audio(files: DataFrame, key: str, factory: Callable[[], Encoder], batch_rows: int = 1) -> DataFrame:
    """``key, embedding``: encode file contents, mean over time."""
    return _encode(files, key, "content", factory, batch_rows)
