"""Byte-level BPE and token counts against the libraries."""

import base64
import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from resonara.llm import byte_bpe, queries, token_counts

RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.RANKS, "rb"))}
ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PIECES = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
TEXTS = st.text(st.one_of(st.sampled_from("ab thein \n\t▁'é中😀0<s>"), st.characters(exclude_categories=["Cs"])), max_size=80)


@pytest.fixture(scope="module")
def replay():
    return byte_bpe.MergeReplay(RANKS)


@pytest.fixture(scope="module")
def transducer():
    return token_counts._transducer(open(queries.PIECES, "rb").read())


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(TEXTS, max_size=4))
def test_replay_equals_library(replay, texts):
    import regex
    words = [regex.findall(public_tokenizers.PATTERN, text) for text in texts]
    flat = [word.encode() for found in words for word in found]
    ids = iter(replay.encode(flat))
    assert [[i for _ in found for i in next(ids)] for found in words] == ENCODING.encode_ordinary_batch(texts)


@pytest.mark.parametrize("word", ["a" * 3000, " " * 2001, "ab" * 2000, "\n" * 500, "the" * 1500])
def test_long_words(replay, word):
    assert [list(ids) for ids in replay.encode([word.encode()])] == [ENCODING._core_bpe.encode_single_piece(word.encode())]


def test_replay_looks_up_only_pairs_that_a_merge_makes(monkeypatch):
    asked = []

    class Counted(dict):
        def get(self, *key):
            asked.append(key)
            return dict.get(self, *key)

    own, words = byte_bpe.MergeReplay(RANKS), [b" the", b"aaaaaaa", b" unbelievable", b"xqzt", b""]
    monkeypatch.setattr(own, "merged", Counted(own.merged))
    merges = sum(map(len, words)) - sum(map(len, own.encode(words)))
    assert 0 < len(asked) <= 2 * merges


@settings(max_examples=300, deadline=None)
@given(text=TEXTS)
def test_counts_equal_library(transducer, text):
    machine, leading = transducer
    got = sum(machine.run(token_counts._spelt(chunk)) for chunk in token_counts._chunks(text, leading)) if text else 0
    assert got == len(PIECES.encode(text))


def test_reset_keeps_counts(transducer):
    machine, _ = transducer
    before = machine.run("▁unbelievable")
    machine.reset()
    assert machine.run("▁unbelievable") == before == len(PIECES.encode("unbelievable"))


def test_bpe_query(spark, small_folder, small_texts):
    for row in queries.op2_byte_bpe(spark, small_folder).collect():
        text = small_texts[row["doc_id"]]
        ids = ENCODING.encode_ordinary(text)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_count_query(spark, small_folder, small_texts):
    for row in queries.op4_token_counts(spark, small_folder).collect():
        text = small_texts[row["doc_id"]]
        assert (row["n_bytes"], row["n_tokens"]) == (len(text.encode()), len(PIECES.encode(text)))
        assert row["over_limit"] == (row["n_tokens"] > 4096)


def test_odd_texts(spark, odd, empty):
    encode, decode = byte_bpe.encoder(spark, queries.RANKS, public_tokenizers.PATTERN), byte_bpe.decoder(spark, queries.RANKS)
    count = token_counts.counter(spark, queries.PIECES)
    rows = odd.withColumn("ids", encode("text")).withColumn("back", decode("ids")).withColumn("tokens", count("text")).collect()
    for row in rows:
        text = row["text"] or ""
        assert row["ids"] == ENCODING.encode_ordinary(text)
        assert bytes(row["back"]) == text.encode()
        assert row["tokens"] == len(PIECES.encode(text))
    assert empty.select(encode("text"), count("text")).count() == 0
    nulls = spark.createDataFrame([(None,)], "ids array<int>")
    assert bytes(nulls.select(decode("ids").alias("b")).first()["b"]) == b""


def test_one_worker_encodes_and_decodes(spark, odd, empty, small_folder):
    """The pipeline keeps ids and decodes them as well: one evaluation, as each takes a worker of its own in every task."""
    both = byte_bpe.round_trip(spark, queries.RANKS, public_tokenizers.PATTERN)
    for row in odd.select("text", both("text").alias("found")).collect():
        text = row["text"] or ""
        assert (row["found"]["ids"], bytes(row["found"]["decoded"])) == (ENCODING.encode_ordinary(text), text.encode())
    assert empty.select(both("text")).count() == 0
    encoded = corpus_pipeline.encode(spark, odd.withColumn("ids", F.lit("replaced")), small_folder)
    assert encoded.columns == [*odd.columns, "ids", "n_tokens", "decoded_sha256"]
    assert str(encoded._jdf.queryExecution().executedPlan()).count("ArrowEvalPython") == 1
    for row in encoded.collect():
        text = row["text"] or ""
        ids = ENCODING.encode_ordinary(text)
        assert (row["ids"], row["n_tokens"], row["decoded_sha256"]) == (ids, len(ids), hashlib.sha256(text.encode()).hexdigest())


def test_ids_of_a_batch_leave_in_blocks(monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", 40)
    texts = ["the words of a text, " * 3, None, "", "é中😀 and more"] * 5
    with open(queries.RANKS, "rb") as file:
        data = file.read()
    # the second batch begins inside its buffers, the last one has no rows
    batches = [pa.array(texts), pa.array(texts).slice(3, 9), pa.array([None, None], pa.string()), pa.array([], pa.string())]
    found = list(byte_bpe._encoded(data, public_tokenizers.PATTERN, iter(batches)))
    assert max(map(len, found)) <= 4
    given = [text for batch in batches for text in batch.to_pylist()]
    assert [ids for block in found for ids in block.to_pylist()] == ENCODING.encode_ordinary_batch([text or "" for text in given])
    pieces = byte_bpe._pieces(data)
    assert [text for block in found for text in byte_bpe._decoded(pieces, block).to_pylist()] == [(text or "").encode() for text in given]
