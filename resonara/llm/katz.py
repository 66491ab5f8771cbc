"""Language model of word n-grams with Katz backoff and Good-Turing discounts; scores of whole texts.

The corpus is cut into blocks of whole documents, each with a table of its words.
What a block needs to know of all others it asks for by key: it sends its distinct
n-grams with their counts, sorted by a 64-bit hash and cut by ranges of it.  A part
of the range adds up what all blocks sent and answers each in the order in which it
asked.  These parts are the model's stored tables.  An n-gram belongs to the first
block that sent it; the owners sum, by context, the discounted counts and the
lower-order probabilities of what has been seen, and the parts add these up.  That
gives every context its exact backoff weight, so probabilities of the known words
and of one unknown word sum to 1 after every context.  Blocks then walk from order
1 upward through their tokens.

    P(w | h) = d(c) c(hw) / c(h)                     if hw was seen
             = a(h) P(w | h')                        else, h' = h without its first word
    a(h) = (1 - sum of seen P(w | h)) / (1 - sum of seen P(w | h'))
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resonara.llm.common import bucketed
from resonara.workspace import written

ORDER = 2
#: Counts up to this one are discounted.
DISCOUNTED = 5
BLOCK_TOKENS = 2_000_000
PART_TOKENS = 1_000_000
#: Tokens of a block that are worked on at once.
STRETCH = 1 << 18
#: Keys of the end of a text and of what stands before its first word: no word has blanks.
END, BEFORE = (np.uint64(xxhash.xxh3_64_intdigest(mark)) for mark in (b" ", b"\t"))


def _packed(values: np.ndarray) -> bytes:
    """Compressed, all first bytes first, then all second ones."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T if len(values) else values
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, kind: type, size: int) -> np.ndarray:
    raw = pa.decompress(data, size * np.dtype(kind).itemsize, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(-1, size).T).view(kind).ravel()


@dataclass
class Tallies:
    """By order, the tally of its n-grams (see ``_add_counts``); and the number of texts learnt from."""

    of: dict[int, list[int]]
    texts: int


class _Numbers(dict):
    """Words in the order in which they first come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _block_schema(docs: DataFrame) -> str:
    return (f"block long, ids array<{docs.schema['id'].dataType.simpleString()}>, held array<boolean>, sizes array<int>, "
            "n_words int, n_tokens long, words binary, tokens binary")


def _blocks(docs: DataFrame, block_tokens: int) -> DataFrame:
    """Blocks of the columns ``id``, ``held``, ``text``: whole documents up to about ``block_tokens`` tokens."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, number = TaskContext.get().partitionId() << 32, 0
        ids, held, tokens, table = [], [], [], _Numbers({b" ": 0})

        def block():
            keys = np.array([xxhash.xxh3_64_intdigest(word) for word in table], np.uint64)
            order = np.argsort(keys)
            rank = np.empty(len(keys), np.uint32)
            rank[order] = np.arange(len(keys))
            flat = np.concatenate(tokens)
            row = [place + number, pa.concat_arrays(ids), held, [len(own) for own in tokens], len(keys), len(flat), _packed(keys[order]), _packed(rank[flat])]
            kinds = [pa.int64(), None, pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            columns = [pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), value) if kind is None else pa.array([value], kind)
                       for value, kind in zip(row, kinds)]
            return pa.RecordBatch.from_arrays(columns, ["block", "ids", "held", "sizes", "n_words", "n_tokens", "words", "tokens"])

        waiting = 0
        for batch in batches:
            start = 0
            for n, (text, apart) in enumerate(zip(batch["text"], batch["held"].to_pylist())):
                words = text.as_py().encode().lower().split()  # of bytes: A-Z and ASCII white space alone
                tokens.append(np.fromiter(map(table.__getitem__, words + [b" "]), np.uint32, len(words) + 1))
                held.append(apart)
                waiting += len(words) + 1
                if waiting >= block_tokens:
                    ids.append(batch["id"].slice(start, n + 1 - start))
                    yield block()
                    number, start, waiting = number + 1, n + 1, 0
                    ids, held, tokens, table = [], [], [], _Numbers({b" ": 0})
            ids.append(batch["id"].slice(start))
        if tokens:
            yield block()

    return docs.select("id", "held", "text").mapInArrow(cut, _block_schema(docs))


class Block:
    """The tokens of a block and, by order, its distinct n-grams.

    ``keys[n]`` are those of order n, sorted; ``index[n]`` tells each token which of
    them ends there, -1 for none; ``context[n]`` which key of ``contexts(n)`` comes before.
    """

    def __init__(self, row: dict, order: int):
        self.sizes = np.asarray(row["sizes"])
        self.held = np.asarray(row["held"], bool)
        words = _unpacked(row["words"], np.uint64, row["n_words"])
        # 32-bit places, and 64-bit arrays as long as the block only while they are worked on: two of these make most of a task's memory
        tokens = _unpacked(row["tokens"], np.uint32, row["n_tokens"]).view(np.int32)
        first = np.cumsum(self.sizes) - self.sizes
        self.keys, self.index, self.context = {1: words}, {1: tokens}, {}
        self.starts = int(np.searchsorted(words, BEFORE))
        last, here, key = tokens + (tokens >= self.starts), np.ones(len(tokens), bool), None
        for n in range(2, order + 1):
            key = np.roll(words[tokens] if key is None else key, 1)
            if n == 2:
                key[first] = BEFORE
            else:
                here = np.roll(here, 1)
                here[first] = False
            for part in _stretches(len(tokens)):
                key[part] = _mixed(key[part] * np.uint64(0x9E3779B97F4A7C15) + words[tokens[part]])
            self.index[n] = np.full(len(tokens), -1, np.int32)
            self.keys[n], self.index[n][here] = _numbered(key if here.all() else key[here])
            context = np.roll(last, 1)
            if n == 2:
                context[first] = self.starts
            self.context[n] = context
            last = self.index[n]

    def times(self, n: int, counts: np.ndarray, texts: int) -> np.ndarray:
        """How often each of ``contexts(n)`` has been followed, from the counts of order n - 1."""
        return np.insert(counts, self.starts, texts) if n == 2 else counts

    def contexts(self, n: int) -> np.ndarray:
        return np.insert(self.keys[1], self.starts, BEFORE) if n == 2 else self.keys[n - 1]

    def counts(self, n: int) -> np.ndarray:
        """How often each n-gram stands in documents to learn from."""
        learnt, counts = ~np.repeat(self.held, self.sizes) & (self.index[n] >= 0), np.zeros(len(self.keys[n]), np.int64)
        for part in _stretches(len(learnt)):
            np.add.at(counts, self.index[n][part][learnt[part]], 1)
        return counts


def _stretches(size: int) -> list[slice]:
    """Slices of ``STRETCH`` places, one after the other."""
    return [slice(start, start + STRETCH) for start in range(0, size, STRETCH)]


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the place among them of each."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    unique = ordered[new]
    del ordered
    number = np.cumsum(new, dtype=np.int32)
    number -= 1
    at = np.empty(len(keys), np.int32)
    at[order] = number
    return unique, at


def _mixed(values: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values in which every bit depends on all bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_ASK = pa.schema([("level", pa.int32()), ("part", pa.int32()), ("block", pa.int64()), ("size", pa.int32()), ("keys", pa.binary()),
                  ("amounts", pa.list_(pa.binary()))])
_ASK_DDL = "level int, part int, block long, size int, keys binary, amounts array<binary>"
_REPLY = pa.schema([("level", pa.int32()), ("part", pa.int32()), ("block", pa.int64()), ("size", pa.int32()), ("values", pa.list_(pa.binary())),
                    ("tally", pa.list_(pa.int64()))])
_REPLY_DDL = "level int, part int, block long, size int, values array<binary>, tally array<bigint>"
#: What is asked and answered of n-grams, and of contexts: their times, kinds of followers by count, lower mass, whether the weight is needed.
_COUNTS, _COUNTED = (np.int64,), (np.int64, np.uint8)
_CONTEXTS, _WEIGHED = (*[np.int64] * (1 + DISCOUNTED), np.float64, np.uint8), (np.float64, np.uint8)


def _asked(level: int, block: int, keys: np.ndarray, amounts: Sequence[np.ndarray], parts: int) -> list[tuple]:
    """Rows of a block's request, one for each part of the range of keys that it holds something of."""
    cuts = np.array([(part << 64) // parts for part in range(1, parts)], np.uint64)
    edges = [0, *np.searchsorted(keys, cuts).tolist(), len(keys)]
    return [(level, part, block, end - start, _packed(keys[start:end]), [_packed(of[start:end]) for of in amounts])
            for part, (start, end) in enumerate(zip(edges, edges[1:])) if start < end]


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array([row[n] for row in rows], field.type) for n, field in enumerate(schema)], schema=schema)


def _merged(table: pa.Table, kinds: Sequence[type]) -> tuple[list[dict], list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """A part's requests by block, their amounts end to end, its distinct keys' first and their number at every request's place."""
    rows = sorted(table.to_pylist(), key=lambda row: row["block"])
    keys = np.concatenate([_unpacked(row["keys"], np.uint64, row["size"]) for row in rows])
    amounts = [np.concatenate([_unpacked(row["amounts"][n], kind, row["size"]) for row in rows]) for n, kind in enumerate(kinds)]
    unique, first, at = np.unique(keys, return_index=True, return_inverse=True)
    return rows, amounts, unique, first, at


def _answered(rows: list[dict], values: Sequence[np.ndarray], tally: list[int] | None = None) -> pa.Table:
    """Each block's stretch of the values, which lie end to end; the first row carries the tally."""
    found, end = [], 0
    for row in rows:
        start, end = end, end + row["size"]
        found.append((row["level"], row["part"], row["block"], row["size"], [_packed(of[start:end]) for of in values], tally if start == 0 else None))
    return _table(found, _REPLY)


def _add_counts(table: pa.Table) -> pa.Table:
    """Add up a part's counts over all blocks; answer each block its keys' sums, and which of them it sent first.

    The tally is the sum, the number of keys above 0, and how many of them sum to 1, 2, ...
    """
    rows, (counts,), unique, first, at = _merged(table, _COUNTS)
    sums = np.bincount(at, counts, len(unique)).astype(np.int64)
    owned = np.zeros(len(at), np.uint8)
    owned[first] = 1
    seen = np.bincount(np.minimum(sums, DISCOUNTED + 2), minlength=DISCOUNTED + 3)
    return _answered(rows, [sums[at], owned], [int(sums.sum()), int(seen[1:].sum()), *map(int, seen[1:DISCOUNTED + 2])])


def _weigh_contexts(kept: np.ndarray):
    """Function that adds up what a part's contexts were followed by and answers the backoff weights asked for.

    A context none of whose followers is discounted counts once more, so that some
    mass is left for others; the second value marks it.
    """
    def weigh(table: pa.Table) -> pa.Table:
        rows, amounts, unique, _, at = _merged(table, _CONTEXTS)
        times, *kinds, lower = (np.bincount(at, of, len(unique)) for of in amounts[:-1])
        lost = sum((r * (1 - kept[r]) * of for r, of in enumerate(kinds, 1)), np.zeros(len(unique)))
        lifted = (times > 0) & (lost == 0)
        total = times + lifted
        weight = np.where(times > 0, (lost + lifted) / np.maximum(total, 1) / (1 - lower), 1.0)
        return _answered(rows, [np.where(amounts[-1] > 0, weight[at], 0.0), lifted[at].astype(np.uint8)])

    return weigh


def _joined(rows: list[dict], kind: str, level: int) -> list[np.ndarray]:
    """The answers of one kind and level in the order of the block's keys."""
    own = sorted((row for row in rows if row["kind"] == kind and row["level"] == level), key=lambda row: row["part"])
    kinds = _COUNTED if kind == "count" else _WEIGHED
    return [np.concatenate([_unpacked(row["values"][n], of, row["size"]) for row in own]) for n, of in enumerate(kinds)]


def discounts(tally: Sequence[int]) -> np.ndarray:
    """By count from 0 on, what is left of one occurrence; 1 from ``DISCOUNTED`` + 1 on.

    ``tally`` has the number of n-grams seen once, twice, ... up to ``DISCOUNTED`` + 1
    times.  Good-Turing's estimates hold up to the largest k of 5 to 2 for which all
    are above 0 and below 1; the tallies of small corpora may allow none, and then
    each count up to ``DISCOUNTED`` loses the same part of one occurrence.
    """
    seen = [0, *tally]
    kept = np.ones(DISCOUNTED + 2)
    for k in range(DISCOUNTED, 1, -1):
        if min(seen[1:k + 2]) > 0:
            most = (k + 1) * seen[k + 1] / seen[1]
            found = [((r + 1) * seen[r + 1] / (r * seen[r]) - most) / (1 - most) if most != 1 else 0.0 for r in range(1, k + 1)]
            if min(found) > 0 and max(found) < 1:
                kept[1:k + 1] = found
                return kept
    part = seen[1] / (seen[1] + 2 * seen[2]) if seen[1] and seen[2] else 0.5
    kept[1:DISCOUNTED + 1] = [(r - part) / r for r in range(1, DISCOUNTED + 1)]
    return kept


def _probabilities(block: Block, order: int, replies: list[dict], model: Tallies) -> tuple[np.ndarray, np.ndarray]:
    """Probability of every token by the model up to ``order``, and the counts of the block's words."""
    tally, kept = model.of[1], discounts(model.of[1][2:])
    lost = sum(r * tally[1 + r] * (1 - kept[r]) for r in range(1, DISCOUNTED + 1))
    total = tally[0] + (lost == 0)  # where no count is discounted, one more occurrence leaves some for the unknown
    counts, _ = _joined(replies, "count", 1)
    by_word = np.where(counts > 0, kept[np.minimum(counts, DISCOUNTED + 1)] * counts / total, (lost + (lost == 0)) / total)
    found, lower = by_word[block.index[1]], counts
    for n in range(2, order + 1):
        kept = discounts(model.of[n][2:])
        held, _ = _joined(replies, "count", n)
        weight, lifted = _joined(replies, "context", n)
        total = np.maximum(block.times(n, lower, model.texts) + lifted, 1)
        for part in _stretches(len(found)):
            here = part.start + np.flatnonzero(block.index[n][part] >= 0)
            seen, before = held[block.index[n][here]], block.context[n][here]
            found[here] = np.where(seen > 0, kept[np.minimum(seen, DISCOUNTED + 1)] * seen / total[before], weight[before] * found[here])
        lower = held
    return found, counts


def _ask_contexts(n: int, parts: int, model: Tallies):
    """Function from a block and its replies to what its own n-grams add to their contexts, and which weights it needs."""
    def ask(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        row, rows = blocks.to_pylist()[0], replies.to_pylist()
        block = Block(row, n)
        held, owned = _joined(rows, "count", n)
        lower, _ = _probabilities(block, n - 1, rows, model)
        keys, place = block.contexts(n), np.zeros(len(held), np.int32)
        needed = np.zeros(len(keys), np.uint8)
        for part in _stretches(len(lower)):
            here = part.start + np.flatnonzero(block.index[n][part] >= 0)
            place[block.index[n][here]] = here
            needed[block.context[n][here[held[block.index[n][here]] == 0]]] = 1
        own = np.flatnonzero((owned > 0) & (held > 0))
        of, times = block.context[n][place[own]], held[own]
        amounts = [np.bincount(of, times, len(keys)).astype(np.int64), *(np.bincount(of[times == r], minlength=len(keys)) for r in range(1, DISCOUNTED + 1)),
                   np.bincount(of, lower[place[own]], len(keys)), needed]
        return _table(_asked(n, row["block"], keys, amounts, parts), _ASK)

    return ask


_SCORES = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def _score(order: int, model: Tallies):
    tokens, kinds = model.of[1][:2]

    def score(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(blocks.drop_columns("ids").to_pylist()[0], order)
        found, counts = _probabilities(block, order, replies.to_pylist(), model)
        starts, words = np.cumsum(block.sizes) - block.sizes, block.index[1]
        base = np.log10((counts + 1) / (tokens + kinds + 1))
        per_text = [block.sizes.astype(np.int64), np.add.reduceat((counts > 0)[words], starts, dtype=np.int64), np.full(len(starts), tokens),
                    np.add.reduceat(base[words], starts), np.add.reduceat(np.log10(found, out=found), starts)]
        return pa.table([blocks["ids"].combine_chunks().flatten(), pa.array(block.held), *map(pa.array, per_text)], names=_SCORES)

    return score


def language_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
                    block_tokens: int = BLOCK_TOKENS, part_tokens: int = PART_TOKENS) -> DataFrame:
    """Score every row by a model learnt from the rows that ``held_out`` does not name.

    Columns ``id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (words by add-one counts) and ``score`` (log10 probability of the
    text).  Tokens are words between ASCII white space, A-Z lower-cased, and one end.
    All unknown words are one word.  Null texts are empty, a null flag is false; rows
    with equal or null ids are rows like others, and other columns are not read.
    Words and n-grams are told apart by 64-bit hashes.  Starts Spark jobs.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    blocks = bucketed(_blocks(rows, block_tokens), "blocks", "block")
    learnt = F.aggregate("held", F.lit(0).cast("long"), lambda total, apart: total + (~apart).cast("long"))
    size = blocks.agg(F.sum("n_tokens").alias("tokens"), F.sum(learnt).alias("texts")).first()
    parts = max(1, ceil((size["tokens"] or 0) / part_tokens))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, order)
                for n in range(1, order + 1):
                    yield from _table(_asked(n, row["block"], block.keys[n], [block.counts(n)], parts), _ASK).to_batches()
                del block  # before the next one is built

    table = blocks.drop("ids")
    asked = table.mapInArrow(ask, _ASK_DDL).groupBy("level", "part")
    replies = written(asked.applyInArrow(_add_counts, _REPLY_DDL).withColumn("kind", F.lit("count")), "counts")
    cells = [F.sum(F.col("tally")[n]).alias(f"t{n}") for n in range(DISCOUNTED + 3)]
    model = Tallies({n: [0] * (DISCOUNTED + 3) for n in range(1, order + 1)}, size["texts"] or 0)
    for row in replies.where("tally is not null").groupBy("level").agg(*cells).collect():
        model.of[row["level"]] = [row[f"t{n}"] for n in range(DISCOUNTED + 3)]
    replies = replies.drop("tally")
    for n in range(2, order + 1):
        asked = table.groupBy("block").cogroup(replies.where(F.col("level") <= n).groupBy("block")).applyInArrow(_ask_contexts(n, parts, model), _ASK_DDL)
        weights = asked.groupBy("level", "part").applyInArrow(_weigh_contexts(discounts(model.of[n][2:])), _REPLY_DDL)
        replies = replies.unionByName(written(weights.drop("tally").withColumn("kind", F.lit("context")), "contexts"))
    schema = (f"id {rows.schema['id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_score(order, model), schema)
