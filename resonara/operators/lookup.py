"""Lookups that stay even when few keys hold most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 2000
FEW_KEYS = 10_000


def keyed_lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], rows: str) -> DataFrame:
    """Inner join of many rows with one row per key, safe when few keys hold most rows of ``left``.

    A table of at most ``FEW_KEYS`` counted keys is broadcast whole.  Otherwise,
    ``right`` carries in column ``rows`` how many rows of ``left`` hold its key.
    A key counts as hot when it holds more than 1 in ``HOT_SHARE`` of all those
    rows, so there are never more than ``HOT_SHARE`` hot keys: that bound makes
    their broadcast safe.  All other keys are joined by a shuffle in which no key
    can outweigh a task.  ``left`` is read twice; hand over a stored table.
    """
    total, count = right.agg(F.coalesce(F.sum(rows), F.lit(0)), F.count("*")).first()
    if count <= FEW_KEYS:
        return left.join(F.broadcast(right), list(keys))
    least = max(total / HOT_SHARE, 1000)
    hot = right.where(F.col(rows) > least)
    if hot.isEmpty():
        return left.join(right, list(keys))
    names = F.broadcast(hot.select(*keys))
    return left.join(F.broadcast(hot), list(keys)).unionByName(
        left.join(names, list(keys), "left_anti").join(right.where(F.col(rows) <= least), list(keys)))
