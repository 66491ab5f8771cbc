"""Near copies by SimHash: segment popcounts, a grid join below their Manhattan distance, exact check.

A fingerprint is embedded as the bit counts of its two-bit segments.  One
differing bit moves one count by one, so the Manhattan distance of two embeddings
never exceeds the Hamming distance of the fingerprints.  The segments are dealt
into ``b`` blocks; embeddings within distance ``r`` agree in at least ``b - r``
blocks, so the cells of the grid are the counts of every choice of ``b - r``
blocks, and every pair within the radius meets in a cell.  The members of a cell
are compared exactly.  A cell reports not its pairs but, for each of its groups,
every member's link to the group's smallest: as many links as members at most,
and no two fingerprints within the radius end in different components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resonara.llm.common import keyed_lookup
from resonara.llm.simhash import packed, set_weights
from resonara.workspace import replaced, written

SEED = 42
RADIUS = 3
SEGMENT_BITS = 2
CELL_MEMBERS = 2048
LOW_BITS = 0x5555555555555555


def _shingle_fingerprint(text: str, size: int) -> bytes:
    words = text.encode().lower().split()  # of bytes: A-Z and ASCII white space alone
    if not words:
        return bytes(8)
    shingles = map(b" ".join, zip(*(words[n:] for n in range(size)))) if len(words) >= size else [b" ".join(words)]
    hashes = np.array([xxhash.xxh64_intdigest(shingle, SEED) for shingle in shingles], np.uint64)
    return packed(2 * set_weights(hashes) > len(hashes))


def shingle_fingerprint(size: int = 3):
    """64 bits as a signed long: each is set in over half of the hashes of the word shingles.

    Null or wordless texts have the zero fingerprint; fewer words than a shingle make one shingle.
    """
    @F.arrow_udf("long")
    def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = b"".join(_shingle_fingerprint(value.as_py() or "", size) for value in batch)
            yield pa.array(np.frombuffer(found, np.int64))

    return fingerprint


def hex_text(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _forest(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(member, smallest of its group) for members joined by steps of at most ``radius`` bits."""
    bits, links = members.view(np.uint64), []
    left = np.arange(len(bits))
    while len(left) > 1:
        group, frontier, left = [left[0]], [left[0]], left[1:]
        while frontier and len(left):
            near = np.bitwise_count(bits[left] ^ bits[frontier.pop()]) <= radius
            if near.any():
                group.extend(left[near])
                frontier.extend(left[near])
                left = left[~near]
        if len(group) > 1:
            own = members[group]
            links.extend((int(member), int(own.min())) for member in own if member != own.min())
    return links


def _linker(radius: int):
    @F.arrow_udf("array<struct<a: bigint, b: bigint>>")
    def links(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        for batch in batches:
            yield pa.array([[{"a": a, "b": b} for a, b in _forest(np.array(members.values), radius)] for members in batch], kind)

    return links


def _block_count(classes: int, radius: int) -> int:
    """More blocks make finer cells; the links do not depend on the number."""
    blocks = radius + 3
    while blocks < 12 and 2.0 ** (1.4 * 32 * (blocks - radius) / blocks) < 64.0 * classes:
        blocks += 1
    return blocks


def fingerprint_links(classes: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """Links (a, b) that join exactly the fingerprints which steps of at most ``radius`` bits join.

    ``classes`` has distinct longs in column ``fp``.  Starts Spark jobs.
    """
    blocks = blocks or _block_count(classes.count(), radius)
    segments = 64 // SEGMENT_BITS
    masks = [sum(3 << (SEGMENT_BITS * s) for s in range(segments) if s % blocks == b) for b in range(blocks)]
    signed = [mask - 2 ** 64 if mask >= 2 ** 63 else mask
              for mask in (sum(masks[b] for b in chosen) for chosen in combinations(range(blocks), blocks - radius))]
    # the counts of all segments at once: 1 where the two bits differ, 2 where both are set
    high = F.shiftrightunsigned("fp", 1)
    differ, both = (of.bitwiseAND(F.lit(LOW_BITS)) for of in (F.col("fp").bitwiseXOR(high), F.col("fp").bitwiseAND(high)))
    counts = differ.bitwiseOR(F.shiftleft(both, 1))
    cells = F.array(*[F.struct(F.lit(n).cast("short").alias("grid"), F.col("counts").bitwiseAND(F.lit(mask)).alias("cell"))
                      for n, mask in enumerate(signed)])
    keyed = classes.select("fp", counts.alias("counts")).select("fp", F.inline(cells))
    sizes = written(keyed.groupBy("grid", "cell").agg(F.count("*").alias("members")).where("members > 1"), "cells")
    members = keyed_lookup(keyed, sizes, ["grid", "cell"], "members")
    # a large cell is cut into parts, and every two of its parts meet in a task of their own
    parts = F.ceil(F.col("members") / CELL_MEMBERS).cast("int")
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    meetings = F.when(parts == 1, F.array(F.lit(0))).otherwise(F.expr(
        "transform(sequence(0, parts - 1), p -> least(p, own) * parts + greatest(p, own))"))
    lists = (members.withColumn("parts", parts).withColumn("own", own).select("grid", "cell", "fp", F.explode(meetings).alias("meeting"))
             .groupBy("grid", "cell", "meeting").agg(F.collect_list("fp").alias("fps")))
    return lists.select(F.inline(_linker(radius)("fps"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the smallest node that can be reached.

    Alternates two steps until nothing changes: every node hands its larger
    neighbours, then its smaller ones, to the smallest node it knows.  Each step
    is a pre-aggregated minimum and a skew-safe lookup, stored in the shared folder.
    """
    def stars(edges: DataFrame, larger: bool) -> DataFrame:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if larger:
            both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("rows")), "least")
        pairs = keyed_lookup(both, least, ["u"], "rows")
        moved = pairs.where("v > u" if larger else "v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        if not larger:
            moved = moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        moved = moved.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        return replaced(moved, "edges", edges, least)

    def state(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    before, now = None, state(edges)
    while now != before:
        edges = stars(stars(edges, True), False)
        before, now = now, state(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = RADIUS) -> DataFrame:
    """Each row's ``id``, fingerprint ``fp`` and ``component_id``, the smallest id it reaches.

    Exact copies share a fingerprint and take part as one class.  Rows with a null
    id are members too and have a null component only where no member has an id.
    Other columns of ``docs`` are not read.  Starts Spark jobs.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = written(rows.select("id", shingle_fingerprint(size)("text").alias("fp")), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("rows")), "classes")
    linked = components(fingerprint_links(classes.select("fp"), radius))
    rooted = classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", "rows", F.coalesce("root", "fp").alias("root"))
    # a component's classes differ in text but may be many, so its minimum is looked up skew-safe as well
    rooted = written(rooted, "rooted")
    least = written(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("classes")), "least")
    named = written(keyed_lookup(rooted, least, ["root"], "classes").select("fp", "rows", "component_id"), "named")
    return keyed_lookup(rows, named, ["fp"], "rows").select("id", "fp", "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their group; repeated rows of that id stay together.

    Where no member has an id, all rows of the group stay.  Ids are unique in a
    documents table, so the ids to drop are joined by id.
    """
    found = written(near_copies(docs, id_col, text_col).select("id", "component_id"), "components")
    gone = found.where("id is not null and id != component_id").select(F.col("id").alias(id_col)).distinct()
    nameless = found.where("id is null and component_id is not null")
    kept = docs.join(gone, id_col, "left_anti")
    return kept if nameless.isEmpty() else _without_nameless(kept, docs, id_col, text_col)


def _without_nameless(kept: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``kept`` less the rows without id whose text is that of a group with an id."""
    named = near_copies(docs, id_col, text_col).where("id is null and component_id is not null").select(F.col("fp").alias("_fp")).distinct()
    prints = kept.select(F.struct(*kept.columns).alias("row"), F.when(F.col(id_col).isNull(), shingle_fingerprint()(
        F.coalesce(F.col(text_col), F.lit("")))).alias("_fp"))
    return prints.join(named, "_fp", "left_anti").select("row.*")
