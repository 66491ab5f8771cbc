"""Byte-level BPE encoding and decoding by replaying all merges over blocks of words.

Merges never cross the borders that the splitting pattern sets, so equal words
have equal ids wherever they stand.  A task therefore gathers the distinct words
of its rows in blocks and replays the merges once for a whole block: an inverted
index holds, for each merge, the positions at which its pair stands; merges are
taken in rank order, and each one touches only the neighbours of its positions.
Nothing is shuffled, and a task holds one block and a bounded word table.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 18
TABLE_WORDS = 400_000
TABLE_WORD_CHARS = 64


class MergeReplay:
    """Ranks, the pairs that form them, and the replay over a block of words."""

    def __init__(self, ranks: dict[bytes, int]):
        self.width = max(ranks.values(), default=0) + 1
        self.byte_ids = [ranks[bytes([b])] for b in range(256)]
        self.pieces: list[bytes] = [b""] * self.width
        self.merged: dict[int, int] = {}
        for token, rank in ranks.items():
            self.pieces[rank] = token
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.merged[left * self.width + right] = rank
        first = ((left * self.width + right) for left in self.byte_ids for right in self.byte_ids)
        self.byte_pairs = np.array([self.merged.get(pair, -1) for pair in first], np.int32).reshape(256, 256)

    def encode(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each word, as merging its lowest-ranked, leftmost pair again and again gives them."""
        ids, ends = self.replay(words)
        return [tuple(ids[start:end].tolist()) for start, end in zip([0, *ends], ends)]

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """Ids of all words one after another, and where each word's ids end."""
        data = b"".join(words)
        raw = np.frombuffer(data, np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends, held_by = np.cumsum(sizes), np.repeat(np.arange(len(words)), sizes)
        places = np.arange(len(raw))
        last = np.zeros(len(raw), bool)
        last[ends[sizes > 0] - 1] = True
        after = np.where(last, -1, places + 1).tolist()
        before = np.where(np.concatenate([[True], last])[:len(raw)], -1, places - 1).tolist()
        pairs = np.full(len(raw), -1, np.int32)
        pairs[:-1] = self.byte_pairs[raw[:-1], raw[1:]]
        pairs[last] = -1
        positions = self._positions(pairs)
        byte_ids = self.byte_ids
        symbols, pair, word_of = [byte_ids[b] for b in data], pairs.tolist(), held_by.tolist()
        merged, width = self.merged.get, self.width
        ranks = list(positions)
        heapq.heapify(ranks)
        while ranks:
            rank = heapq.heappop(ranks)
            waiting: list[int] = []
            held = -1
            for at in sorted(positions.pop(rank, ())):
                if pair[at] != rank:
                    continue
                if word_of[at] == held:  # a lower rank has arisen in this word and goes first
                    waiting.append(at)
                    continue
                right = after[at]
                symbols[at], symbols[right], pair[right] = rank, -1, -1
                beyond = after[at] = after[right]
                new = None
                if beyond >= 0:
                    before[beyond] = at
                    new = merged(rank * width + symbols[beyond])
                if new is None:
                    pair[at] = -1
                else:
                    pair[at] = new
                    if new in positions:
                        positions[new].append(at)
                    else:
                        heapq.heappush(ranks, new)
                        positions[new] = [at]
                    if new < rank:
                        held = word_of[at]
                previous = before[at]
                if previous >= 0:
                    new = merged(symbols[previous] * width + rank)
                    if new is None:
                        pair[previous] = -1
                    else:
                        pair[previous] = new
                        if new in positions:
                            positions[new].append(previous)
                        else:
                            heapq.heappush(ranks, new)
                            positions[new] = [previous]
                        if new < rank:
                            held = word_of[at]
            if waiting:
                if rank not in positions:
                    heapq.heappush(ranks, rank)
                positions.setdefault(rank, []).extend(waiting)
        left = np.array(symbols, np.int32)
        kept = left >= 0
        return left[kept], np.concatenate([[0], np.cumsum(kept)])[ends].tolist()

    @staticmethod
    def _positions(pairs: np.ndarray) -> dict[int, list[int]]:
        """Inverted index from a merge to the positions at which its pair stands."""
        places = np.flatnonzero(pairs >= 0)
        places = places[np.argsort(pairs[places], kind="stable")]
        starts = np.flatnonzero(np.diff(pairs[places], prepend=-1))
        return {int(pairs[places[start]]): places[start:end].tolist() for start, end in zip(starts, [*starts[1:], len(places)])}


def read_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


@lru_cache(maxsize=2)
def _replay(data: bytes) -> MergeReplay:
    return MergeReplay(read_ranks(data))


@lru_cache(maxsize=2)
def _pieces(data: bytes) -> pa.Array:
    return pa.array(_replay(data).pieces, pa.large_binary())


def _blocks(batch: pa.Array) -> Iterator[pa.Array]:
    """Slices of about ``BLOCK_BYTES`` of text, or of one row."""
    block = np.cumsum(pc.binary_length(batch).fill_null(0).to_numpy(), dtype=np.int64) // BLOCK_BYTES
    starts = np.flatnonzero(np.diff(block, prepend=-1))
    for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(batch)]):
        yield batch.slice(start, end - start)


def _encoded(data: bytes, pattern: str, batches: Iterator[pa.Array]) -> Iterator[pa.ListArray]:
    """Ids of the texts, a block at a time: Spark takes an iterator's rows in any cuts, and so neither side holds those of a batch."""
    replay, split = _replay(data), regex.compile(pattern).findall
    table: dict[str, bytes] = {}  # ids as 32-bit numbers
    for block in chain.from_iterable(map(_blocks, batches)):
        words = [split(text or "") for text in block.to_pylist()]
        new = list(set(chain.from_iterable(words)).difference(table))
        found, ends = replay.replay([word.encode() for word in new])
        found = found.tobytes()
        table.update(zip(new, [found[4 * start:4 * end] for start, end in zip([0, *ends], ends)]))
        ids = [b"".join(map(table.__getitem__, own)) for own in words]
        lengths = [0, *(len(own) // 4 for own in ids)]
        for word in new:
            if len(word) > TABLE_WORD_CHARS:
                del table[word]
        if len(table) > TABLE_WORDS:
            table.clear()
        yield pa.ListArray.from_arrays(pa.array(np.cumsum(lengths), pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def _decoded(pieces: pa.Array, batch: pa.ListArray) -> pa.Array:
    """Bytes of each list of ids."""
    batch = batch.fill_null([]) if batch.null_count else batch
    offsets = np.concatenate([[0], np.cumsum(batch.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    taken = pieces.take(batch.flatten())
    starts = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset:][offsets] if len(taken) else np.zeros(len(offsets), np.int64)
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(batch), [None, pa.py_buffer(starts.copy()), taken.buffers()[2]])
    return whole.cast(pa.binary())


def _shared(spark: SparkSession, ranks_path: str) -> Broadcast:
    with open(ranks_path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encoder(spark: SparkSession, ranks_path: str, pattern: str):
    """Function from a text column to its token ids, ``array<int>``; no special tokens.

    A null or an empty text has no ids.  Texts are taken whole, whatever their length.
    """
    data = _shared(spark, ranks_path)

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _encoded(data.value, pattern, batches)

    return encode


def decoder(spark: SparkSession, ranks_path: str):
    """Function from a column of token ids to the bytes they stand for; null ids give no bytes."""
    data = _shared(spark, ranks_path)

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = _pieces(data.value)
        for batch in batches:
            yield _decoded(pieces, batch)

    return decode


def round_trip(spark: SparkSession, ranks_path: str, pattern: str):
    """Function from a text column to ``ids`` as of ``encoder`` and ``decoded``, the bytes that ``decoder`` finds for these.

    Both in one Python worker: ids that are kept and decoded as well would take a second worker beside it.
    """
    data = _shared(spark, ranks_path)

    @F.arrow_udf("struct<ids: array<int>, decoded: binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = _pieces(data.value)
        for ids in _encoded(data.value, pattern, batches):
            yield pa.StructArray.from_arrays([ids, _decoded(pieces, ids)], ["ids", "decoded"])

    return both


def id_text(ids: Column) -> Column:
    """Decimal ids joined by one space."""
    return F.array_join(ids.cast("array<string>"), " ")
