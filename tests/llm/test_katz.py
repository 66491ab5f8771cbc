"""The language model against a plain form of it, and its probabilities against 1."""

import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from resonara.llm import katz, katz_sql, queries

END, BEFORE = " ", "\t"


def fold(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 7 == 2


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) + [END]


class Plain:
    """Katz backoff over dicts."""

    def __init__(self, texts, order):
        self.order = order
        self.counts = {n: Counter() for n in range(1, order + 1)}
        for words in texts:
            padded = [BEFORE, *words]
            for at in range(1, len(padded)):
                for n in range(1, min(order, at + 1) + 1):
                    self.counts[n][tuple(padded[at - n + 1:at + 1])] += 1
        self.kept = {n: katz.discounts([sum(c == r for c in self.counts[n].values()) for r in range(1, katz.DISCOUNTED + 2)]) for n in self.counts}
        self.total, self.mass, self.after = defaultdict(float), defaultdict(float), defaultdict(list)
        for n, grams in self.counts.items():
            for gram, count in grams.items():
                self.total[gram[:-1]] += count
                self.mass[gram[:-1]] += self.discounted(n, count)
                self.after[gram[:-1]].append(gram[-1])
        for context in list(self.total):
            self.total[context] += self.mass[context] == self.total[context]

    def discounted(self, n, count):
        return count * self.kept[n][min(count, katz.DISCOUNTED + 1)]

    def p(self, word, context):
        n = len(context) + 1
        count = self.counts[n][(*context, word)]
        if count:
            return self.discounted(n, count) / self.total[context]
        left = 1 - self.mass[context] / self.total[context] if context in self.total else 1.0
        if n == 1:
            return left
        if context in self.total:
            left /= 1 - sum(self.p(seen, context[1:]) for seen in self.after[context])
        return left * self.p(word, context[1:])

    def score(self, words):
        padded = [BEFORE, *words]
        return sum(math.log10(self.p(padded[at], tuple(padded[max(0, at - self.order + 1):at]) if self.order > 1 else ())) for at in range(1, len(padded)))


@pytest.fixture(scope="module")
def corpus(small_texts):
    return {key: (text or "")[:1500] for key, text in list(small_texts.items())[:60]}


@pytest.mark.parametrize("order, bounds", [(1, {}), (2, {}), (2, {"block_tokens": 300, "part_tokens": 500}), (3, {"block_tokens": 900, "part_tokens": 2000})])
def test_scores(spark, corpus, order, bounds):
    frame = spark.createDataFrame([(key, text, "x") for key, text in corpus.items()], "doc_id long, text string, held string").repartition(3)
    held = F.col("doc_id").isin([key for key in corpus if fold(key)])
    model = Plain([split(text) for key, text in corpus.items() if not fold(key)], order)
    size, kinds = sum(model.counts[1].values()), len(model.counts[1])
    rows = katz.language_scores(frame, held, order=order, **bounds).collect()
    assert sorted(row["id"] for row in rows) == sorted(corpus)
    for row in rows:
        words = split(corpus[row["id"]])
        known = [model.counts[1][(word,)] for word in words]
        assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (fold(row["id"]), len(words), sum(c > 0 for c in known), size)
        assert row["base_score"] == pytest.approx(sum(math.log10((c + 1) / (size + kinds + 1)) for c in known), abs=1e-8)
        assert row["score"] == pytest.approx(model.score(words), abs=1e-6)


def test_probabilities_sum_to_one(corpus):
    model = Plain([split(text)[-40:] for text in list(corpus.values())[:12]], 3)
    words = [gram[0] for gram in model.counts[1]] + ["<unknown>"]
    for context in [(), (BEFORE,), ("never",), *list(model.total)[::37]]:
        assert sum(model.p(word, context) for word in words) == pytest.approx(1, abs=1e-9)
        assert all(model.p(word, context) > 0 for word in words)


def test_discounts():
    assert np.all(katz.discounts([0] * 6)[1:] > 0) and katz.discounts([0] * 6)[0] == 1
    for tally in ([1000, 300, 120, 60, 35, 20], [10, 30, 1, 0, 0, 0], [5, 0, 0, 0, 0, 0], [100, 40, 25, 1, 30, 2]):
        kept = katz.discounts(tally)
        assert np.all((kept[1:] > 0) & (kept[1:] <= 1)) and kept[1] < 1 and kept[-1] == 1


def test_odd_rows(spark, odd, empty):
    held = F.col("doc_id") == 7
    rows = katz.language_scores(odd.withColumn("tokens", F.lit(1)), held, block_tokens=50).collect()
    assert len(rows) == odd.count() and all(np.isfinite(row["score"]) and row["n_tokens"] >= 1 for row in rows)
    assert {row["held_out"] for row in rows if row["id"] != 7} == {False}
    assert katz.language_scores(empty, held).count() == 0
    nothing = katz.language_scores(odd, F.lit(True)).collect()
    assert all((row["train_tokens"], row["n_known"], row["score"], row["base_score"]) == (0, 0, 0, 0) for row in nothing)


def test_query(spark, small_folder):
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{small_folder}/documents.parquet'")
    got = sorted(map(repr, map(tuple, queries.op13_language_scores(spark, small_folder).collect())))
    assert got == sorted(map(repr, connection.execute(katz_sql.katz_sql(7, 2)).fetchall()))


def test_memory_of_a_block():
    """Two blocks are held by an executor at once: what is made of a block stays a small number of its tokens' size."""
    size, rng = 1 << 20, np.random.default_rng(5)
    words = np.sort(rng.integers(0, 1 << 63, 100_000).astype(np.uint64))
    tokens = (len(words) * rng.random(size) ** 3).astype(np.uint32)
    row = {"block": 0, "held": [False] * 1024, "sizes": [1024] * 1024, "n_words": len(words), "n_tokens": size,
           "words": katz._packed(words), "tokens": katz._packed(tokens)}
    tracemalloc.start()
    try:
        block = katz.Block(row, 2)
        kept, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert block.counts(2).sum() == size
    assert most < 80 * size and kept < 32 * size, (most / size, kept / size)
