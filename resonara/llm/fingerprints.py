"""Document fingerprints by SimHash, and the search for all within a Hamming radius.

The terms of a text are its pairs of neighbouring lower-cased words (the word
itself where there is only one), weighted by 1 + ln(count).  Each term's hash
votes with its weight on every bit, set bits for and clear bits against; a bit of
the fingerprint is the sign of its sum.  Equal texts have equal fingerprints; a
text without words has the zero fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from resonara.llm.common import keyed_lookup
from resonara.llm.simhash import packed, set_weights
from resonara.workspace import written

WORDS = 4
BITS = 64 * WORDS
TABLE_WORDS = 400_000
WEIGHT_UNIT = 16
NEAR_RADIUS = 3
CELL_MEMBERS = 512


def _mixed(values: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values in which every bit depends on all bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _term_hashes(words: list[str], table: dict[str, int]) -> np.ndarray:
    for word in set(words):
        if word not in table:
            table[word] = xxhash.xxh3_64_intdigest(word)
    single = np.array(list(map(table.__getitem__, words)), np.uint64)
    if len(single) < 2:
        return single
    return _mixed(single[:-1] + np.uint64(0x9E3779B97F4A7C15)) + single[1:]


def _fingerprint(text: str, table: dict[str, int]) -> bytes:
    terms = _term_hashes(text.lower().split(), table)
    if not len(terms):
        return bytes(BITS // 8)
    terms, counts = np.unique(terms, return_counts=True)
    # whole weights keep the sums exact, whatever their order
    weights = np.rint(WEIGHT_UNIT * (1 + np.log(counts)))
    lanes = np.stack([_mixed(terms + np.uint64(lane * 0xD1342543DE82EF95 % 2**64)) for lane in range(WORDS)], axis=1)
    return packed(2 * set_weights(lanes, weights) > weights.sum())


@F.arrow_udf(BinaryType())
def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Fingerprint of each whole text, ``BITS`` bits; null counts as empty."""
    table: dict[str, int] = {}
    for batch in batches:
        found = []
        for value in batch:
            found.append(_fingerprint(value.as_py() or "", table))
            if len(table) > TABLE_WORDS:
                table.clear()
        yield pa.array(found, pa.binary())


def distance(left: Column, right: Column) -> Column:
    """Number of differing bits of two fingerprints."""
    def word(of, number):
        return F.conv(F.substring(F.hex(of), 16 * number + 1, 16), 16, -10).cast("long")

    return sum((F.bit_count(word(left, n).bitwiseXOR(word(right, n))) for n in range(1, WORDS)),
               F.bit_count(word(left, 0).bitwiseXOR(word(right, 0))))


def likeness(left: Column, right: Column) -> Column:
    """Estimated cosine of the weighted terms, 0 to 1: 1 for equal fingerprints, 0 at half the bits or more."""
    return F.greatest(F.lit(0.0), F.cos(F.lit(np.pi) * distance(left, right) / F.lit(float(BITS))))


def within(probes: DataFrame, table: DataFrame, radius: int, blocks: int | None = None, spare: int = 1) -> DataFrame:
    """All rows of ``table`` whose fingerprint differs from a probe's in at most ``radius`` bits.

    Both frames have ``id`` and ``fingerprint``; the result has ``probe_id``,
    ``id``, ``distance``.  The bits are cut into ``radius + 1 + spare`` blocks;
    fingerprints within the radius agree in at least ``1 + spare`` of them.  For
    every choice of that many blocks, a permuted table leads with them, and
    probes look them up by an equi-join; the full distance decides.  A pair is
    reported by the first choice of blocks in which it agrees, hence once.  Equal
    fingerprints are joined once for all their rows.  Nulls match nothing.
    """
    blocks = blocks or radius + 1 + spare
    agree = blocks - radius
    if agree < 1:
        raise ValueError("the number of blocks must exceed the radius")
    edges = [round(BITS / 4 * n / blocks) for n in range(blocks + 1)]  # in hex digits

    def block(of, n):
        return F.substring(F.hex(of), edges[n] + 1, edges[n + 1] - edges[n])

    def keyed(frame, name):
        choices = F.array(*[F.struct(F.lit(n).alias("choice"), F.concat(*[block(F.col(name), b) for b in chosen]).alias("lead"))
                            for n, chosen in enumerate(combinations(range(blocks), agree))])
        return frame.select(name, F.inline(choices))

    left = keyed(probes.select(F.col("fingerprint").alias("probe")).dropna().distinct(), "probe")
    right = keyed(table.select(F.col("fingerprint").alias("found")).dropna().distinct(), "found")
    equal = [(block(F.col("probe"), n) == block(F.col("found"), n)).cast("int") for n in range(blocks)]
    # the first choice in which both agree consists of the first blocks in which they agree
    rank, before = F.lit(0), F.lit(0)
    for n in range(blocks):
        takes = (before < agree) & (equal[n] == 1)
        rank = rank + F.when((before < agree) & (equal[n] == 0), _choices_after(blocks, agree, n, before)).otherwise(0)
        before = before + takes.cast("int")
    pairs = (left.join(right, ["choice", "lead"]).where(F.col("choice") == rank)
             .withColumn("distance", distance(F.col("probe"), F.col("found"))).where(F.col("distance") <= radius)
             .select("probe", "found", "distance"))
    return (probes.select(F.col("id").alias("probe_id"), F.col("fingerprint").alias("probe"))
            .join(pairs, "probe").join(table.select("id", F.col("fingerprint").alias("found")), "found")
            .select("probe_id", "id", "distance"))


def _choices_after(blocks: int, agree: int, n: int, before: Column) -> Column:
    """Number of choices, in order, that take block ``n`` after ``before`` earlier ones."""
    counts = [comb(blocks - n - 1, agree - taken - 1) for taken in range(agree)] + [0]
    return F.element_at(F.array(*map(F.lit, counts)), before + 1)


def _cell_counter(radius: int, edges: list[int]):
    """For the members of a cell, how many others within the radius first agree with them in the cell's block.

    Members come in one or two parts; of two parts only pairs across them count.
    """
    kind = pa.list_(pa.struct([("fingerprint", pa.binary()), ("n_near", pa.int64())]))

    def near(left: np.ndarray, right: np.ndarray, block: int) -> np.ndarray:
        bits = np.bitwise_count(left.view(np.uint64)[:, None] ^ right.view(np.uint64)[None]).sum(axis=2) <= radius
        for start, end in zip(edges[:block], edges[1:]):
            bits &= (left[:, None, start:end] != right[None, :, start:end]).any(axis=2)
        return bits

    @F.arrow_udf("array<struct<fingerprint: binary, n_near: bigint>>")
    def counts(blocks: pa.Array, cells: pa.Array) -> pa.Array:
        found = []
        for block, members in zip(blocks.to_pylist(), cells.to_pylist()):
            parts = sorted({member["own"] for member in members})
            left, right = ([member["fingerprint"] for member in members if member["own"] == part] for part in (parts[0], parts[-1]))
            one, other = (np.frombuffer(b"".join(side), np.uint8).reshape(-1, BITS // 8) for side in (left, right))
            held = near(one, other, block)
            if len(parts) == 1:
                np.fill_diagonal(held, False)
                pairs = list(zip(left, held.sum(axis=1)))
            else:
                pairs = [*zip(left, held.sum(axis=1)), *zip(right, held.sum(axis=0))]
            found.append([{"fingerprint": of, "n_near": int(n)} for of, n in pairs if n])
        return pa.array(found, kind)

    return counts


def near_counts(prints: DataFrame, radius: int = NEAR_RADIUS) -> DataFrame:
    """``fingerprint`` and ``n_near``: how many other distinct fingerprints differ in at most ``radius`` bits; none, no row.

    ``prints`` has distinct fingerprints, a stored table.  Of ``radius + 1`` blocks two
    near fingerprints agree in one at least: for each block there is a permuted
    table that leads with it.  Only counts leave a cell of equal leads, not pairs.
    A large cell is cut into parts, and every two of its parts meet in a task of
    their own.  Starts Spark jobs.
    """
    edges = [round(BITS / 8 * n / (radius + 1)) for n in range(radius + 2)]
    leads = F.array(*[F.struct(F.lit(n).alias("block"), F.substring("fingerprint", start + 1, end - start).alias("lead"))
                      for n, (start, end) in enumerate(zip(edges, edges[1:]))])
    keyed = prints.select("fingerprint", F.inline(leads))
    sizes = written(keyed.groupBy("block", "lead").agg(F.count("*").alias("members")).where("members > 1"), "cells")
    parts = F.ceil(F.col("members") / CELL_MEMBERS).cast("int")
    meetings = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.expr(
        "transform(sequence(0, parts - 1), p -> least(p, own) * parts + greatest(p, own))"))
    cells = (keyed_lookup(keyed, sizes, ["block", "lead"], "members").withColumn("parts", parts)
             .withColumn("own", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
             .select("block", "lead", "own", "fingerprint", F.explode(meetings).alias("meeting"))
             .groupBy("block", "lead", "meeting").agg(F.collect_list(F.struct("own", "fingerprint")).alias("members")))
    return (cells.select(F.inline(_cell_counter(radius, edges)("block", "members")))
            .groupBy("fingerprint").agg(F.sum("n_near").alias("n_near")))


def with_next(docs: DataFrame, carried: tuple[str, ...] = (), buckets: int | None = None) -> DataFrame:
    """Each document with the text of the next one by descending id; after the last comes the first.

    Takes ``id``, ``text`` and the ``carried`` columns; adds ``next_`` to the
    names of what it fetches.  Ids are
    cut into ranges of equal counts; the first row of each range is also sent to
    the range before it, so every range finds its successors in one shuffle and no
    task holds more than a range.  Null ids come last; rows of equal id follow in
    the order of their texts.  A single document is its own next.
    """
    rows, fetched = docs.select("id", "text", *carried), ("text", *carried)
    spark = docs.sparkSession
    buckets = buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [n / buckets for n in range(1, buckets)]
    cuts = sorted(set(rows.select(F.col("id").cast("double").alias("id")).approxQuantile("id", shares, 0.1 / buckets) or []))
    cut = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<double>")
    number = F.when(F.col("id").isNull(), len(cuts) + 1).otherwise(F.size(F.filter(cut, lambda c: c > F.col("id").cast("double"))))
    firsts = rows.select("id", number.alias("bucket")).groupBy("bucket").agg(F.max("id").alias("id")).orderBy("bucket").collect()
    # one row per range: to the range before it goes the first row of each, to the last that of the first
    lent = [(first["id"], firsts[at - 1]["bucket"]) for at, first in enumerate(firsts)]
    starts = F.broadcast(spark.createDataFrame(lent, StructType([StructField("_first", rows.schema["id"].dataType), StructField("_to", IntegerType())])))
    rows = rows.withColumn("bucket", number).join(starts, F.col("id").eqNullSafe(F.col("_first")), "left")
    own, other = (F.struct(F.col(name).alias("bucket"), F.lit(is_lent).alias("lent")) for name, is_lent in (("bucket", False), ("_to", True)))
    places = F.when(F.col("_to").isNull(), F.array(own)).otherwise(F.array(own, other))
    rows = rows.withColumn("places", places).drop("bucket", "_first", "_to").select("*", F.inline("places")).drop("places")
    order = W.partitionBy("bucket").orderBy("lent", F.col("id").desc_nulls_last(), "text")
    return (rows.withColumns({f"next_{name}": F.lead(name).over(order) for name in fetched})
            .where(~F.col("lent")).drop("bucket", "lent"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text and of the next document's text.

    The edited text has its last floor(n/2) code points replaced by as many of the
    next document's first (or all of them).  Columns ``id``, ``text``, ``edited``,
    ``fingerprint``, ``edited_fingerprint``, ``next_fingerprint``.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    half = F.expr("cast(floor(char_length(text) / 2) as int)")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.char_length("text") - half),
                      F.substring(F.col("next_text"), F.lit(1), half))
    return (with_next(rows.withColumn("fingerprint", fingerprint("text")), ("fingerprint",))
            .select("id", "text", edited.alias("edited"), "fingerprint", "next_fingerprint")
            .withColumn("edited_fingerprint", fingerprint("edited")))
