import numpy as np
import pytest
from pyspark.sql import functions as F

from resonara.operators import embed as E
from resonara.operators import language as L

SAMPLES = [("ca", "amunt si encara hi ets és un plaer haver aguantat la vida amb tu"),
           ("ca", "qualsevol nit pot sortir el sol i bon dia a tothom"),
           ("en", "the night is young and the sun will rise again with you"),
           ("en", "what a wonderful day this is my love and my life")]


@pytest.fixture(scope="module")
def profile(spark):
    return L.profiles(spark.createDataFrame(SAMPLES, "lang string, text string"))


def test_language(spark, profile):
    texts = [(1, "bon dia amb el sol"), (2, "the day and the night"), (3, ""), (4, None), (5, "123 !!")]
    df = spark.createDataFrame(texts, "id int, text string")
    marked = {r["id"]: (r["prob"], r["kept"]) for r in L.lang_filter(df, profile, "ca", "id").collect()}
    assert marked[1][1] and not marked[2][1]
    assert marked[3] == marked[4] == marked[5] == (0.0, False)
    sums = L.lang_prob(df, profile, "id").groupBy("id").agg(F.sum("prob").alias("p")).collect()
    assert sorted(r["id"] for r in sums) == [1, 2] and all(r["p"] == pytest.approx(1.0) for r in sums)


def test_windows(spark):
    def starts(size, window=512, stride=256):
        df = spark.createDataFrame([(["w"] * size,)], "t array<string>").withColumn("k", F.lit(1))
        return [(r["start"], len(r["tokens"])) for r in E.chunk_tokens(df, "k", F.col("t"), window, stride).orderBy("chunk").collect()]

    assert starts(1000) == [(0, 512), (256, 512), (512, 488)]
    assert starts(512) == [(0, 512)]
    assert starts(513) == [(0, 512), (256, 257)]
    assert starts(0) == [(0, 0)]
    assert starts(10, 4, 3) == [(0, 4), (3, 4), (6, 4)]
    with pytest.raises(ValueError):
        starts(5, 4, 5)


@pytest.mark.parametrize("window, stride", [(512, 256), (7, 3), (6, 6), (5, 1)])
def test_hash_embed_equals_chunk_means(spark, window, stride):
    rng = np.random.default_rng(window)
    texts = [(i, " ".join(f"w{x}" for x in rng.integers(0, 9, n))) for i, n in enumerate([1, 5, 6, 7, 8, 23, 60])]
    df = spark.createDataFrame(texts, "id int, text string")
    tokens = E.whitespace_tokens(F.col("text"))
    got = {(r["id"], r["dim"]): r["value"] for r in E.hash_embed(df, "id", tokens, 4, window, stride).collect()}
    dims = {r["t"]: r["d"] for r in spark.createDataFrame([(f"w{x}",) for x in range(9)], "t string").select(
        "t", E.bucket(F.col("t"), 4).alias("d")).collect()}
    for i, text in texts:
        words = text.split()
        chunks, start = [], 0
        while True:
            chunks.append(words[start:start + window])
            if start + window >= len(words):
                break
            start += stride
        want = np.mean([[sum(dims[w] == d for w in c) / len(c) for d in range(4)] for c in chunks], axis=0)
        assert [got.get((i, d), 0.0) for d in range(4)] == pytest.approx(list(want))
    dense = E.dense(E.hash_embed(df, "id", tokens, 4, window, stride), "id", 4)
    assert all(sum(r["embedding"]) == pytest.approx(1.0) for r in dense.collect())


def test_pluggable_encoder(spark):
    df = spark.createDataFrame([(1, "a b c d e")], "id int, text string")

    def factory():
        return lambda chunks: [[float(len(c)), 1.0] for c in chunks]

    found = E.embed_text(df, "id", E.whitespace_tokens(F.col("text")), factory, 4, 2).first()
    assert list(found["embedding"]) == [3.5, 1.0]
