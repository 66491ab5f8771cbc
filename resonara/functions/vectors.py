"""Vector expressions on array columns.  Arithmetic is in double."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
MAX_FRAMES = 100
MAX_DIMS = 1000
NEAR_DISTANCE = 10.0
FAR_DISTANCE = 30.0
# ----------------------------------------------------------------------------


def to_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def mean_pool(frames: Column) -> Column:
    """Mean over the frames of a matrix held in one row; no frames gives NULL."""
    frames = frames.cast("array<array<double>>")
    zero = F.array_repeat(F.lit(0.0), F.size(F.get(frames, 0)))
    total = F.aggregate(frames, zero, lambda acc, f: F.zip_with(acc, f, lambda x, y: x + y))
    return F.when(F.size(frames) > 0, F.transform(total, lambda x: x / F.size(frames)))


def mean_pool_or_pass(frames: Column, vector: Column) -> Column:
    """Pool the matrix when there is one, else take the vector as it is."""
    return F.coalesce(mean_pool(frames), to_double(vector))


def mean_and_squeeze(batches: Column) -> Column:
    """Mean over the first axis of a ``T x 1 x D`` array, dropping the axis of one."""
    return mean_pool(F.transform(batches, lambda batch: F.get(batch, 0)))


def flatten_truncate(frames: Column, max_frames: int = MAX_FRAMES, max_dims: int = MAX_DIMS) -> Column:
    """Concatenate the first non-empty frames and cut to a fixed width."""
    kept = F.filter(F.slice(frames, 1, max_frames), lambda f: F.size(f) > 0)
    return F.slice(F.flatten(kept), 1, max_dims)


def pad_to(vector: Column, width: int) -> Column:
    """Zero-pad a truncated vector to a constant width."""
    vector = to_double(vector)
    missing = F.greatest(F.lit(width) - F.size(vector), F.lit(0))
    return F.concat(vector, F.array_repeat(F.lit(0.0), missing))


def select_token(df: DataFrame, frames: str, token: int | None, name: str = "embedding") -> DataFrame:
    """One frame per item; items without that frame are dropped.  ``None``
    flattens and truncates instead."""
    if token is None:
        return df.withColumn(name, flatten_truncate(F.col(frames)))
    has_token = F.size(F.get(frames, F.lit(token))) > 0
    return df.where(has_token).withColumn(name, F.get(frames, F.lit(token)))


def explode_dims(df: DataFrame, vector: str, *keys: str) -> DataFrame:
    """Long form ``keys, dim, value``."""
    return df.select(*keys, F.posexplode(to_double(F.col(vector))).alias("dim", "value"))


def wide_dims(df: DataFrame, vector: str, width: int, prefix: str = "e") -> DataFrame:
    """Export form with one column per dimension."""
    kept = [c for c in df.columns if c != vector]
    return df.select(*kept, *[F.get(vector, F.lit(i)).alias(f"{prefix}{i}") for i in range(width)])


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(to_double(a), to_double(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def squared_l2(a: Column, b: Column) -> Column:
    squares = F.zip_with(to_double(a), to_double(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x)


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(squared_l2(a, b))


def cosine_similarity(a: Column, b: Column) -> Column:
    """NULL when either vector has no length."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def similarity_percent(distance: Column, near: float = NEAR_DISTANCE, far: float = FAR_DISTANCE) -> Column:
    """100 below ``near``, 0 above ``far``, linear in between."""
    slope = 100.0 / (far - near)
    return (
        F.when(distance < near, 100.0)
        .when(distance > far, 0.0)
        .otherwise(100.0 - (distance - near) * slope)
    )


def percent_label(percent: Column) -> Column:
    """Whole percent with halves rounded to even, e.g. ``62%``."""
    return F.concat(F.bround(percent, 0).cast("int").cast("string"), F.lit("%"))
