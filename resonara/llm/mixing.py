"""Mixing sources to target weights by raking.

Documents are counted into cells of source, language and topic.  Iterative
proportional fitting scales the cells' token weights, margin after margin, until
every margin has its target share.  A cell's weight over its tokens is the rate at
which its documents are drawn.  Rates are scaled so that the largest is 1, or, where
that would keep less than ``TOKEN_BUDGET`` of all tokens, so that this share is kept:
a rate above 1 is so many whole copies and a draw for the rest.  The draw is a hash of
the document's id, so reruns draw the same documents.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from resonara.llm.common import keyed_lookup
from resonara.workspace import replaced, written

#: Exponent of each margin: target shares are proportional to tokens ** exponent.
TEMPER = {"source": 0.7, "lang": 0.9, "topic": 1.0}
TOLERANCE = 1e-6
#: Share of all tokens that a mix holds at least, copies included.
TOKEN_BUDGET = 0.6
SWEEPS_PER_STEP = 4
MOST_SWEEPS = 16_384
#: From so many sweeps on, margins have stalled if twice the sweeps bring the worst one nearer by less than ``LEAST_GAIN``.
PATIENCE = 1024
LEAST_GAIN = 0.001
DRIVER_CELLS = 1_000_000
SEED = 29

#: The marks by which a topic is told, and the share of characters from which it is.
SYMBOLS, CAPITALS = "%&$#*", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def token_count(text: Column) -> Column:
    """Words between white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def text_kind(text: Column) -> Column:
    """Topic by the make of a text: empty, table, symbols, capitals or prose."""
    size = F.char_length(text)
    share = lambda marks: (size - F.char_length(F.translate(text, marks, ""))) / size
    return (F.when(F.coalesce(size, F.lit(0)) == 0, "empty").when(share("|") >= 0.02, "table").when(share(SYMBOLS) >= 0.1, "symbols")
            .when(share(CAPITALS) >= 0.4, "capitals").otherwise("prose"))


def _key(value: Column) -> Column:
    """A text that tells null from every value."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("null"))


def tempered(cells: DataFrame, margin: str, exponent: float) -> DataFrame:
    """Target shares (margin, share) proportional to tokens ** exponent."""
    powers = cells.groupBy(margin).agg(F.pow(F.sum("tokens").cast("double"), F.lit(exponent)).alias("power")).where("power > 0")
    total = powers.agg(F.sum("power")).first()[0] or 1.0
    return powers.select(margin, (F.col("power") / total).alias("share"))


def _ends(worst: dict[int, float], sweep: int, tolerance: float) -> bool:
    """Whether the margins are met or have stalled; ``worst`` has the worst margin's miss by sweep."""
    if worst[sweep] <= tolerance or sweep >= MOST_SWEEPS:
        return True
    doubled = sweep >= 2 * PATIENCE and sweep % PATIENCE == 0 and (sweep // PATIENCE).bit_count() == 1
    return doubled and worst[sweep] > (1 - LEAST_GAIN) * worst[sweep // 2]


def _rake_array(cells: pa.Table, goal: Mapping[str, str], tolerance: float) -> pa.Table:
    """``cells`` with ``weight`` and ``miss``, raked in memory."""
    goals = {margin: np.nan_to_num(cells[name].to_numpy().astype(float)) for margin, name in goal.items()}
    tokens = np.nan_to_num(cells["tokens"].to_numpy().astype(float))
    weight = np.where(np.all([tokens > 0, *[share > 0 for share in goals.values()]], axis=0), tokens, 0.0)
    used, total = weight > 0, weight.sum()
    codes = {margin: np.unique(cells[margin].combine_chunks().dictionary_encode("encode").indices.to_numpy(), return_inverse=True)[1]
             for margin in goal}

    def misses(margin: str) -> np.ndarray:
        held = np.bincount(codes[margin], weight)[codes[margin]]
        return np.where(used, np.abs(np.divide(held / total, goals[margin], out=np.ones_like(held), where=used) - 1), 0.0)

    worst: dict[int, float] = {}
    for sweep in range(0, MOST_SWEEPS + 1 if total else 0):
        if sweep % SWEEPS_PER_STEP == 0:
            worst[sweep] = max(float(misses(margin).max()) for margin in goal)
            if _ends(worst, sweep, tolerance):
                break
        for margin in goal:
            held = np.bincount(codes[margin], weight)[codes[margin]]
            weight = np.divide(weight * total * goals[margin], held, out=np.zeros_like(held), where=held > 0)
    miss = np.max([misses(margin) for margin in goal], axis=0) if total else np.zeros_like(weight)
    return cells.drop_columns(list(goal.values())).append_column("weight", pa.array(weight)).append_column("miss", pa.array(miss))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], tolerance: float = TOLERANCE) -> DataFrame:
    """Cells with ``weight``: tokens scaled until each margin's shares are its targets'.

    ``cells`` has ``tokens`` and a column per margin; ``targets`` maps a margin to
    (margin, share).  Cells without tokens or without a target weigh 0.  Ends when
    no margin is off by more than ``tolerance`` of its target; where targets
    contradict the empty cells, when the margins have stalled (``PATIENCE``), or
    after ``MOST_SWEEPS``.  ``miss`` is what is left: by how much of its target the
    farthest of the cell's margins is off.  Up to ``DRIVER_CELLS`` cells are raked
    on the driver.  Starts Spark jobs.
    """
    goal = {margin: f"_goal_{margin}" for margin in targets}
    for margin, shares in targets.items():
        cells = cells.join(shares.withColumnRenamed("share", goal[margin]), margin, "left")
    cells = written(cells, "cells")
    if cells.count() <= DRIVER_CELLS:
        raked = _rake_array(cells.toArrow(), goal, tolerance)
        schema = cells.drop(*goal.values()).schema.add("weight", "double").add("miss", "double")
        return cells.sparkSession.createDataFrame(raked, schema)
    usable = " and ".join(f"{name} > 0" for name in goal.values())
    state = written(cells.withColumn("weight", F.when(F.expr(f"tokens > 0 and {usable}"), F.col("tokens").cast("double")).otherwise(0.0)), "cells")
    total = state.agg(F.sum("weight")).first()[0] or 0.0
    off = lambda margin: F.abs(F.sum("weight").over(W.partitionBy(margin)) / F.lit(total or 1.0) / F.col(goal[margin]) - 1)
    miss = F.when(F.col("weight") > 0, F.greatest(*[off(margin) for margin in goal], F.lit(0.0))).otherwise(0.0)
    worst: dict[int, float] = {}
    for sweep in range(0, MOST_SWEEPS + 1 if total else 0, SWEEPS_PER_STEP):
        stored = state
        worst[sweep] = state.select(miss.alias("miss")).agg(F.max("miss")).first()[0]
        if _ends(worst, sweep, tolerance):
            break
        for _ in range(SWEEPS_PER_STEP):
            for margin, share in goal.items():
                held = F.sum("weight").over(W.partitionBy(margin))
                state = state.withColumn("weight", F.when(F.col("weight") > 0, F.col("weight") * F.lit(total) * F.col(share) / held).otherwise(0.0))
        state = replaced(state, "raked", stored)
    return state.withColumn("miss", miss).drop(*goal.values())


def mix(docs: DataFrame, margins: Mapping[str, Column], temper: Mapping[str, float], tokens: Column, id_col: str = "doc_id",
        seed: int = SEED, budget: float = TOKEN_BUDGET) -> DataFrame:
    """``row``, a struct of all columns of ``docs``, and ``mix``, a struct on its draw.

    ``mix`` has the margins' values, ``tokens``, ``probability`` and ``sampled``,
    ``rate`` (expected copies), ``copies`` (how often the document stands in the
    mix) and ``miss`` (see ``rake``).  The expected tokens of the mix, copies
    included, are ``budget`` of all tokens, or more if no rate needs to be over 1.
    Nulls in a margin are a value of their own.  Documents without tokens have
    probability 0.  Rows of one id share their draw.  Starts Spark jobs.
    """
    keys = [f"of_{margin}" for margin in margins]
    keyed = docs.select(F.struct(*docs.columns).alias("row"), tokens.alias("tokens"), F.col(id_col).alias("id"),
                        *[_key(value).alias(f"of_{margin}") for margin, value in margins.items()])
    cells = written(keyed.groupBy(*keys).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "cells")
    targets = {f"of_{margin}": tempered(cells, f"of_{margin}", temper[margin]) for margin in margins}
    rates = written(rake(cells, targets).withColumn("rate", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0))
                    .select(*keys, "rows", "rate", "miss"), "rates")
    # raking keeps the sum of the tokens, so the scale is the share of them that is kept
    largest = rates.agg(F.max("rate")).first()[0] or 1.0
    rate = F.least(F.lit(1.0), F.col("rate") / F.lit(largest)) if 1 / largest >= budget else F.col("rate") * F.lit(budget)
    chance = F.least(F.lit(1.0), rate)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id"), 11).cast("double") / F.lit(float(2 ** 53))
    values = [F.when(F.col(key) != "null", F.substring(key, 2, 1 << 30)).alias(margin) for key, margin in zip(keys, margins)]
    copies = (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")
    return keyed_lookup(keyed, rates, keys, "rows").select(
        "row", F.struct(*values, "tokens", chance.alias("probability"), (draw < chance).alias("sampled"),
                        rate.alias("rate"), copies.alias("copies"), "miss").alias("mix"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """``mix`` of a documents table by source, language and kind of text."""
    margins = {"source": F.col("source"), "lang": F.col("lang"), "topic": text_kind(F.col("text"))}
    return mix(docs, margins, TEMPER, token_count(F.col("text")))
