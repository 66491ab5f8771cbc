"""Trie of conversation prefixes by vertical bitmaps.

Every turn is named by a hash of its position, role and text; the exclusive or of
the names up to a position is the key of the prefix that ends there.  A shard holds
a bounded number of conversations, and of long ones a bounded stretch.  Its index
maps (position, turn) to the bitset of the conversations that have the turn there.
Depth first, a parent's bitset is intersected with the postings of its members'
next turns: that gives the children, their popcounts and the lists of those that
end.  Shards meet by prefix key in grouped sums.

Sums over subtrees need no pass from the leaves up, because they add up over
members.  The smallest member stands for a node, and from the first depth on at
which a conversation stands for its node, it does so for all its deeper ones.  So
the distinct nodes of a subtree are its members' positions from that depth on, and
a second walk of the shards sums what the members bring.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from resonara.llm.common import keyed_lookup
from resonara.operators.ordering import with_position
from resonara.workspace import written

#: Conversations and turns of a shard, and positions of a stretch.
SHARD_CONVERSATIONS = 4096
SHARD_TURNS = 200_000
STRETCH = 1024
#: Fixed values of the damage that the query asks for: borrowed turns come from every fifth conversation, up to eight.
STEP, BORROWED = 5, 9
_KEY = ["key1", "key2"]


def placed_turns(conversations: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """``conv_id``, ``position`` in a total order, two lanes of the turn's hash and the ``bytes`` of its text.

    Turns are read by number, null first; rows of one turn by role, then by MD5 of
    the text.  Null roles and texts are empty; rows without ``conv_id`` are left out.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), "turn", role.alias("role"), F.md5(text).alias("digest"),
        F.xxhash64(F.lit(1), role, text).alias("name1"), F.xxhash64(F.lit(2), role, text).alias("name2"),
        F.octet_length(text).cast("long").alias("bytes"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    return with_position(rows, order).select("conv_id", "position", "name1", "name2", "bytes")


def rebuilt(conversations: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Every conversation c with its first turns borrowed: ``conv_id``, ``depth``, ``name1``, ``name2``, ``bytes``.

    The first h = crc32(c) % 9 turns are those of conversation c - c % 5 (all it has,
    if fewer), the others c's own after its first h.  Depth 0 has a row without a
    turn for every conversation.  Starts Spark jobs.
    """
    placed = written(placed_turns(conversations, conv_col), "placed")
    sizes = placed.groupBy("conv_id").agg(F.min("position").alias("start"), F.count("*").alias("rows"))
    sizes = written(sizes.withColumn("own", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED).cast("long")), "sizes")
    place = F.col("position") - F.col("start") + 1
    fields = ("name1", "name2", "bytes")
    heads = (keyed_lookup(placed, sizes, ["conv_id"], "rows").withColumn("place", place).where(F.col("place") < BORROWED).groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("place", *fields))).alias("head")).withColumnRenamed("conv_id", "base"))
    taken = (sizes.withColumn("base", F.col("conv_id") - F.col("conv_id") % STEP).join(heads, "base", "left")
             .select("conv_id", "start", "rows", "own", F.expr("slice(coalesce(head, array()), 1, cast(own as int))").alias("head")))
    taken = written(taken, "taken")
    lent = taken.select("conv_id", F.inline("head")).select("conv_id", F.col("place").alias("depth"), *fields)
    kept = (keyed_lookup(placed, taken.withColumn("lent", F.size("head")).drop("head"), ["conv_id"], "rows").where(place > F.col("own"))
            .select("conv_id", (place - F.col("own") + F.col("lent")).alias("depth"), *fields))
    nothing = F.lit(0).cast("long")
    roots = taken.select("conv_id", nothing.alias("depth"), *(nothing.alias(name) for name in fields))
    return roots.unionByName(lent).unionByName(kept)


def _stretches(turns: DataFrame, stretch: int) -> DataFrame:
    """Turns of a conversation in lists of at most ``stretch``, with the prefix key before and whether it is the last."""
    named = lambda lane: F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64("depth", lane))
    rows = turns.select("conv_id", "depth", named("name1").alias("key1"), named("name2").alias("key2"), "bytes",
                        F.floor(F.col("depth") / stretch).alias("stretch"))
    lists = rows.groupBy("conv_id", "stretch").agg(
        F.sort_array(F.collect_list(F.struct("depth", *_KEY, "bytes"))).alias("turns"), *(F.bit_xor(key).alias(key) for key in _KEY))
    before = W.partitionBy("conv_id").orderBy("stretch")
    earlier = before.rowsBetween(W.unboundedPreceding, -1)
    return lists.select("conv_id", "stretch", "turns", *(F.coalesce(F.bit_xor(key).over(earlier), F.lit(0)).alias(key) for key in _KEY),
                        F.lead("stretch").over(before).isNull().alias("last"))


class Shard:
    """Bitmaps of some conversations over the positions of one stretch; bit n is the n-th smallest id."""

    def __init__(self, rows: list[dict]):
        rows.sort(key=lambda row: row["conv_id"])
        self.rows, self.ids = rows, [row["conv_id"] for row in rows]
        self.turns = [[(turn["key1"], turn["key2"]) for turn in row["turns"]] for row in rows]
        self.first = rows[0]["turns"][0]["depth"]
        depth = max(map(len, self.turns))
        self.postings: list[dict] = [{} for _ in range(depth)]
        self.stop = [0] * (depth + 1)  # by number of positions: the members that have no more here
        for n, turns in enumerate(self.turns):
            bit = 1 << n
            for held, turn in zip(self.postings, turns):
                held[turn] = held.get(turn, 0) | bit
            self.stop[len(turns)] |= bit

    def roots(self) -> dict[tuple, int]:
        """Members by the key of the prefix that they bring along."""
        found: dict[tuple, int] = {}
        for n, row in enumerate(self.rows):
            key = (row["key1"], row["key2"])
            found[key] = found.get(key, 0) | 1 << n
        return found

    def children(self, at: int, members: int) -> Iterator[tuple[tuple, int]]:
        """Each turn that follows for some of the members, and for which."""
        left = members & ~self.stop[at]
        while left:
            turn = self.turns[(left & -left).bit_length() - 1][at]
            child = left & self.postings[at][turn]
            left ^= child
            yield turn, child

    def walk(self) -> Iterator[tuple]:
        """Depth first, every node: (number of positions, members, key, parent's key, bytes)."""
        stack = [(0, members, key) for key, members in self.roots().items()]
        while stack:
            at, members, key = stack.pop()
            for turn, child in self.children(at, members):
                below = (key[0] ^ turn[0], key[1] ^ turn[1])
                size = self.rows[(child & -child).bit_length() - 1]["turns"][at]["bytes"]
                yield at + 1, child, below, key, size
                stack.append((at + 1, child, below))

    def members(self, bits: int) -> Iterator[int]:
        while bits:
            low = bits & -bits
            yield low.bit_length() - 1
            bits ^= low


_NODES = pa.schema([("depth", pa.int64()), ("key1", pa.int64()), ("key2", pa.int64()), ("parent1", pa.int64()), ("parent2", pa.int64()),
                    ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("bytes", pa.int64()), ("ends", pa.list_(pa.int64()))])


def _shard_nodes(table: pa.Table) -> pa.Table:
    """The nodes of a shard: smallest member, popcount and the ids that end there."""
    shard = Shard(table.to_pylist())
    last = sum(1 << n for n, row in enumerate(shard.rows) if row["last"])
    found = []
    for at, members, key, parent, size in shard.walk():
        ends = [shard.ids[n] for n in shard.members(members & shard.stop[at] & last)]
        low = (members & -members).bit_length() - 1
        found.append((shard.first + at - 1, *key, *parent, shard.ids[low], members.bit_count(), size, ends))
    return pa.table(list(map(list, zip(*found))), schema=_NODES)


_SUMS = pa.schema([("key1", pa.int64()), ("key2", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64())])


def _shard_sums(table: pa.Table) -> pa.Table:
    """For each node of a shard, what its members add to the sums over its subtree."""
    shard = Shard(table.to_pylist())
    leaves = sum(1 << n for n, row in enumerate(shard.rows) if row["leaf"])
    late = [0] * len(shard.postings)  # by position: members that do not stand for their node yet
    for n, row in enumerate(shard.rows):
        for at in range(len(row["turns"]) if row["stands"] is None else max(0, min(row["stands"] - shard.first, len(row["turns"])))):
            late[at] |= 1 << n
    nodes = list(shard.walk())
    saved: dict[tuple, int] = {}
    for at, members, key, _, size in nodes:
        later = sum(shard.rows[n]["after"] for n in shard.members(members & shard.stop[at]))
        saved[key] = later + size * (members & late[at - 1]).bit_count()
    for _, _, key, parent, _ in sorted(nodes, key=lambda node: -node[0]):
        if parent in saved and parent != key:
            saved[parent] += saved[key]
    found = [(*key, (members & leaves).bit_count(), saved[key]) for _, members, key, _, _ in nodes]
    return pa.table(list(map(list, zip(*found))), schema=_SUMS)


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each key's ids, joined by commas; rows come ordered, and only one hash is held."""
    of, digest = None, hashlib.sha256()
    names = [*_KEY, "ends_sha256"]
    for batch in batches:
        done = []
        for key1, key2, conv in zip(*(batch[name].to_pylist() for name in (*_KEY, "conv_id"))):
            if (key1, key2) == of:
                digest.update(b",%d" % conv)
                continue
            if of is not None:
                done.append((*of, digest.hexdigest()))
            of, digest = (key1, key2), hashlib.sha256(b"%d" % conv)
        kinds = (pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([row[n] for row in done], kind) for n, kind in enumerate(kinds)], names)
    if of is not None:
        yield pa.RecordBatch.from_arrays([pa.array([value]) for value in (*of, digest.hexdigest())], names)


def trie(turns: DataFrame, shard_conversations: int = SHARD_CONVERSATIONS, shard_turns: int = SHARD_TURNS, stretch: int = STRETCH) -> DataFrame:
    """The nodes of the trie of ``turns``: one row per distinct prefix, the empty one included.

    ``turns`` has ``conv_id`` (whole numbers, not null), ``depth`` from 0 (a row
    without a turn) without gaps, the two lanes ``name1``, ``name2`` of the turn's
    hash, and the ``bytes`` of its text.  Columns ``conv_id`` (the smallest member),
    ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``.  No conversations, no rows.  The list of a
    node's ends passes through one task as a stream.  Starts Spark jobs.
    """
    parts = written(_stretches(turns, stretch), "stretches")
    size = parts.agg(F.count_if(F.col("stretch") == 0).alias("conversations"), F.sum(F.size("turns")).alias("turns")).first()
    shards = max(1, ceil(size["conversations"] / shard_conversations), ceil((size["turns"] or 0) / shard_turns))
    shard = ["stretch", "shard"]
    sharded = parts.withColumn("shard", F.pmod(F.xxhash64("conv_id"), F.lit(shards)))
    found = written(sharded.groupBy(*shard).applyInArrow(_shard_nodes, _ddl(_NODES)), "found")
    nodes = found.groupBy("depth", *_KEY).agg(
        F.min("parent1").alias("parent1"), F.min("parent2").alias("parent2"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"))
    nodes = written(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("parent1").alias("key1"), F.col("parent2").alias("key2")).agg(F.count("*").alias("n_children"))
    nodes = written(nodes.join(children, _KEY, "left").na.fill(0, ["n_children"]), "children")

    stands = nodes.groupBy("conv_id").agg(F.min("depth").alias("stands"), F.max(F.col("n_children") == 0).alias("leaf"))
    here = F.expr("aggregate(filter(turns, t -> stands is null or t.depth < stands), 0L, (total, t) -> total + t.bytes)")
    later = W.partitionBy("conv_id").orderBy("stretch").rowsBetween(1, W.unboundedFollowing)
    weighed = (sharded.join(stands, "conv_id", "left").withColumn("leaf", F.coalesce("leaf", F.lit(False)))
               .withColumn("after", F.coalesce(F.sum(here).over(later), F.lit(0))))
    sums = weighed.groupBy(*shard).applyInArrow(_shard_sums, _ddl(_SUMS)).groupBy(*_KEY).agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    ends = (found.select(*_KEY, F.explode("ends").alias("conv_id")).repartition(*_KEY).sortWithinPartitions(*_KEY, "conv_id")
            .mapInArrow(_end_digests, "key1 long, key2 long, ends_sha256 string"))
    whole = nodes.join(sums, _KEY).join(ends, _KEY, "left").drop(*_KEY)
    parents = nodes.where("n_children > 0").select(F.col("key1").alias("parent1"), F.col("key2").alias("parent2"), "n_children",
                                                   F.col("conv_id").alias("parent_conv_id"))
    whole = written(whole, "whole")
    below = keyed_lookup(whole.where("depth > 0"), parents.withColumnRenamed("n_children", "_rows"), ["parent1", "parent2"], "_rows")
    root = whole.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
               F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")]
    return below.select(*columns).unionByName(root.select(*columns))


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{field.name} {'array<bigint>' if pa.types.is_list(field.type) else 'bigint'}" for field in schema)


def conversation_trie(conversations: DataFrame, conv_col: str = "conv_id", **bounds: int) -> DataFrame:
    """``trie`` of the rebuilt conversations; other columns are not read."""
    return trie(rebuilt(conversations, conv_col), **bounds)
