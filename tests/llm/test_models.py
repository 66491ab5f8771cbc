"""Toxicity, mixing, search and the pipeline."""

import hashlib
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from resonara.llm import mixing, near_copies, queries, top_search, toxicity
from tests_llm_helpers import bm25, raked


@pytest.mark.parametrize("text, insults, disguised", [
    ("", 0, 0), ("You are an idiot.", 1, 0), ("you 1d10t !", 0, 1), ("an i d i o t", 0, 1), ("i***t", 0, 1), ("stuuuupid", 0, 1),
    ("s.t.u.p.i.d", 0, 1), ("IDIOT!!!", 1, 0), ("a b c d e f", 0, 0), ("the&&& that*** whsh.###", 0, 0), ("word%%% 4541 12.03.2001", 0, 0)])
def test_features(text, insults, disguised):
    values = dict(zip(toxicity.FEATURES, toxicity.features(text)))
    assert (values["insults"], values["disguised"]) == (insults, disguised)
    assert len(values) == len(toxicity.FEATURES)


@pytest.fixture(scope="module")
def written_texts(spark):
    source = random.Random(11)
    words = "tree house water garden window morning letter you music vile".split()
    rows = []
    for key in range(900):
        text = source.choices(words, k=source.randint(5, 60))
        toxic = key % 5 == 0
        if toxic:
            for word in source.choices(["idiot", "scum", "m0ron", "l o s e r"], k=2):
                text.insert(source.randrange(len(text)), word)
        rows.append((key, " ".join(text), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_on_held_out_rows(spark, written_texts):
    labels = written_texts.select("doc_id", "toxic").withColumn(
        "toxic", F.when(toxicity.fold(F.col("doc_id")) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))  # must not be learnt from
    rows = toxicity.toxicity(written_texts.select("doc_id", "text"), labels).collect()
    assert len(rows) == 900
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["id"]).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.7) == int(row["id"] % 5 == 0)
    kept = toxicity.accepted(written_texts, labels)
    assert kept.columns == written_texts.columns and kept.where("doc_id % 5 = 0").count() == 0 and kept.count() == 720


def test_toxicity_learns_words_of_every_language(spark):
    source = random.Random(4)
    syllables = {"a": "ka lo mi tu re", "b": "scho ver ung ein lich", "c": "quo ñe lla ción os", "d": "é è eau ment que"}
    rows = []
    for key in range(1600):
        lang = "abcd"[key % 4]
        own = syllables[lang].split()
        text = ["".join(source.choices(own, k=source.randint(1, 4))) for _ in range(source.randint(20, 60))]
        toxic = key % 7 == 0
        if toxic:  # a family of words that no list holds, told by their beginnings
            for _ in range(2):
                text.insert(source.randrange(len(text)), f"{lang}zrakk" + "".join(source.choices(own, k=2)))
        rows.append((key, " ".join(text), int(toxic), lang))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int, lang string")
    found = {row["id"]: row for row in toxicity.toxicity(frame.select("doc_id", "text"), frame.select("doc_id", "toxic")).collect()}
    for lang in "abcd":
        held = [found[key] for key, _, toxic, of in rows if of == lang and toxic and found[key]["held_out"]]
        assert len(held) > 10 and sum(row["predicted"] for row in held) >= 0.9 * len(held)
    assert sum(found[key]["predicted"] for key, _, toxic, _ in rows if not toxic) <= 2


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    found = toxicity.toxicity(docs, labels).where("held_out").withColumnRenamed("id", "doc_id")
    rows = found.join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").collect()
    for lang in ("en", "de", "fr", "es"):
        toxic = [row["score"] for row in rows if row["lang"] == lang and row["toxic"]]
        clean = [row["score"] for row in rows if row["lang"] == lang and not row["toxic"]]
        ranked = sum((t > c) + 0.5 * (t == c) for t in toxic for c in clean) / (len(toxic) * len(clean))
        assert ranked >= 0.95 and sum(score >= 0.7 for score in clean) <= 0.02 * len(clean)
    assert sum(row["predicted"] for row in rows if row["toxic"]) >= 0.8 * sum(row["toxic"] for row in rows)


def test_lexicon_leaves_out_a_rows_own_part(spark):
    rows = [(n, "zrakkon here" if n < 9 else "other text", float(n < 9), n % 3 if n >= 9 else 0) for n in range(60)]
    frame = spark.createDataFrame(rows, "key long, text string, label double, part int")
    sizes = {}
    for _, _, label, part in rows:
        sizes[(part, label)] = sizes.get((part, label), 0) + 1
    lexicons = toxicity.learn_lexicons(frame, sizes)
    assert "^zrakkon$" not in lexicons[0] and all("^zrakkon$" in lexicons[n] and "^zrak" in lexicons[n] for n in (1, 2, 3))
    assert toxicity.Lexicon(lexicons[3])["zrakka"] >= 1 and toxicity.Lexicon(lexicons[3])["other"] == 0


def test_toxicity_odd_rows(spark, odd, empty, labels):
    rows = toxicity.toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and len({row["score"] for row in rows if row["id"] in (3, 4)}) == 1
    assert toxicity.toxicity(empty, labels).count() == 0
    assert toxicity.toxicity(odd, labels.limit(0)).where("score = 0").count() == odd.count()
    assert toxicity.accepted(odd, labels.limit(0)).columns == odd.columns


def test_raking_equals_plain_fit(spark):
    source = random.Random(2)
    cells = {(s, t): source.choice([5, 50, 700]) for s in "abcd" for t in "xyz"}
    cells[("b", "y")] = 0
    targets = {"s": {"a": 0.4, "b": 0.3, "c": 0.2, "d": 0.1}, "t": {"x": 0.4, "y": 0.3, "z": 0.3}}
    frame = spark.createDataFrame([(s, t, n) for (s, t), n in cells.items()], "s string, t string, tokens long")
    shares = {m: spark.createDataFrame(list(of.items()), f"{m} string, share double") for m, of in targets.items()}
    got = {(row["s"], row["t"]): row["weight"] for row in mixing.rake(frame, shares).collect()}
    want = raked(cells, ["s", "t"], targets)
    total = sum(cells.values())
    for at, margin in enumerate(targets):
        for value, share in targets[margin].items():
            assert abs(sum(w for cell, w in got.items() if cell[at] == value) / total - share) < 1e-5
    assert all(abs(got[cell] - want[cell]) < 1e-3 * total for cell in cells)


@pytest.mark.parametrize("driver_cells", [0, 1000])
def test_raking_that_is_slow_at_first(spark, monkeypatch, driver_cells):
    monkeypatch.setattr(mixing, "DRIVER_CELLS", driver_cells)
    cells = {("a", "x"): 100_000, ("a", "y"): 10, ("b", "x"): 10, ("b", "y"): 100_000}
    targets = {"s": {"a": 0.55, "b": 0.45}, "t": {"x": 0.45, "y": 0.55}}
    frame = spark.createDataFrame([(s, t, n) for (s, t), n in cells.items()], "s string, t string, tokens long")
    shares = {m: spark.createDataFrame(list(of.items()), f"{m} string, share double") for m, of in targets.items()}
    rows = mixing.rake(frame, shares, tolerance=1e-3).collect()
    assert max(row["miss"] for row in rows) <= 1e-3
    assert abs(sum(row["weight"] for row in rows if row["s"] == "a") / 200_020 - 0.55) < 1e-3


def test_raking_reports_contradictory_margins(spark):
    frame = spark.createDataFrame([("a", "x", 100), ("b", "x", 50), ("b", "y", 50)], "s string, t string, tokens long")
    shares = {"s": spark.createDataFrame([("a", 0.8), ("b", 0.2)], "s string, share double"),
              "t": spark.createDataFrame([("x", 0.5), ("y", 0.5)], "t string, share double")}
    rows = {(row["s"], row["t"]): row for row in mixing.rake(frame, shares).collect()}
    held = sum(row["weight"] for (s, _), row in rows.items() if s == "a") / 200
    assert abs(rows["a", "x"]["miss"] - (1 - held / 0.8)) < 1e-9 and rows["a", "x"]["miss"] > 0.3


def test_one_odd_document_leaves_the_mix_whole(spark):
    docs = spark.range(2401).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 2400, "odd").when(F.col("id") < 800, "hot").otherwise(
        F.concat(F.lit("s"), F.col("id") % 16)).alias("source"), F.when(F.col("id") == 2400, 400).otherwise(100_000).cast("long").alias("tokens"))
    rows = mixing.mix(docs, {"source": F.col("source")}, mixing.TEMPER, F.col("tokens")).select("row.doc_id", "mix.*").collect()
    total = sum(row["tokens"] for row in rows)
    assert len(rows) == 2401 and abs(sum(row["rate"] * row["tokens"] for row in rows) / total - mixing.TOKEN_BUDGET) < 1e-6
    assert abs(sum(row["copies"] * row["tokens"] for row in rows) / total - mixing.TOKEN_BUDGET) < 0.05
    assert all(row["copies"] in (int(row["rate"]), int(row["rate"]) + 1) and row["sampled"] == (row["copies"] > 0) for row in rows)
    odd = next(row for row in rows if row["source"] == "odd")
    power = {s: sum(row["tokens"] for row in rows if row["source"] == s) ** mixing.TEMPER["source"] for s in {row["source"] for row in rows}}
    assert odd["rate"] > 1 and abs(odd["rate"] * 400 / total / mixing.TOKEN_BUDGET - power["odd"] / sum(power.values())) < 1e-6


def test_mix_of_the_documents(spark, small_folder):
    docs = queries.documents(spark, small_folder)
    rows = queries.op8_source_mixing(spark, small_folder).collect()
    assert len(rows) == docs.count() and max(row["probability"] for row in rows) == 1.0
    again = {row["doc_id"]: row["sampled"] for row in queries.op8_source_mixing(spark, small_folder).collect()}
    assert again == {row["doc_id"]: row["sampled"] for row in rows}
    cells = {}
    for row in rows:
        cell = (row["source"], row["lang"], row["topic"])
        cells[cell] = cells.get(cell, 0) + row["tokens"]
    drawn = {}
    for row in rows:
        drawn[row["source"]] = drawn.get(row["source"], 0.0) + row["probability"] * row["tokens"]
    power = {s: sum(n for cell, n in cells.items() if cell[0] == s) ** mixing.TEMPER["source"] for s in drawn}
    for s in drawn:
        assert abs(drawn[s] / sum(drawn.values()) - power[s] / sum(power.values())) < 1e-4


def test_mix_odd_rows(spark, odd, empty):
    rows = mixing.mix_documents(odd).select("row.doc_id", "mix.*").collect()
    assert len(rows) == odd.count()
    assert {row["doc_id"]: row["topic"] for row in rows}[3] == "empty"
    assert all(row["probability"] == 0 and not row["sampled"] for row in rows if row["tokens"] == 0)
    assert any(row["lang"] is None for row in rows)
    assert mixing.mix_documents(empty).count() == 0


def test_search_equals_brute_force(spark, small_texts, monkeypatch):
    monkeypatch.setattr(top_search, "SHARD_TERMS", 9_000)
    monkeypatch.setattr(top_search, "QUERY_BLOCK_TERMS", 700)
    texts = {key: text[:1500] for key, text in small_texts.items()}
    asked = [key for key in texts if key % 20 == 0]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    wanted = docs.where("doc_id % 20 = 0").withColumnRenamed("doc_id", "query_id")
    got = {}
    for row in top_search.top_search(docs, wanted, 7).orderBy("query_id", "rank").collect():
        got.setdefault(row["query_id"], []).append((row["doc_id"], row["score"]))
    assert got == bm25(texts, asked, 7)


def test_search_packs_queries_for_shards():
    """A shard gets a block's queries in under 8 bytes a term; rows of terms and frequencies take 16."""
    rng = np.random.default_rng(3)
    words = rng.integers(-(1 << 63), 1 << 63, 3_000)
    own = {query * 20: rng.choice(words, 300, replace=False) for query in range(400)}
    rows = pa.table({"block": np.zeros(120_000, np.int32), "query_id": np.repeat(list(own), 300), "term": np.concatenate(list(own.values()))})
    rows = rows.append_column("frequency", pa.array(np.abs(rows["term"].to_numpy()) % 500 + 1))
    rows = pa.concat_tables([rows, rows.slice(0, 1000)])  # rows that stand twice are one
    block = top_search._packer(10_000)(rows)
    assert block.num_rows == 1 and block.nbytes < 8 * 120_000
    ids, terms, weights, term, asked = top_search._unpacked(block)
    found = [query for batch in top_search._batches(ids, weights, term, asked) for query in batch]
    assert [query_id for query_id, _, _ in found] == list(own)
    for query_id, places, weighed in found:
        assert terms[places].tolist() == sorted(own[query_id].tolist())
        held = np.abs(terms[places]) % 500 + 1.0
        assert np.array_equal(weighed, np.log1p((10_000 - held + 0.5) / (held + 0.5)))


def test_search_packs_in_little_memory():
    """Beside the batch that it reads, under 36 bytes a row; the rows held whole and sorted took 59 of resident memory in a full block."""
    rng = np.random.default_rng(4)
    words, rows = rng.integers(-(1 << 63), 1 << 63, 50_000), 1_000_000

    def batches():
        for start in range(0, rows, 10_000):
            at = rng.integers(0, 50_000, 10_000)
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in (
                np.zeros(10_000, np.int32), np.arange(start, start + 10_000) // 300 * 20, words[at], at + 1)], ["block", "query_id", "term", "frequency"])

    tracemalloc.start()
    try:
        block, = top_search._stream_packer(100_000)(batches())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert block.num_rows == 1 and peak < 36 * rows


def test_search_words_are_those_of_the_pattern():
    table = top_search._Hashes()
    for text in ("", "_a_b a\u2014b \u00dcn\u00ef\u2026x \u0391\u03a3 \u00bd\u00b2 \u0663\u00a0a B\u0301b \u0130 \u2014 \u2014", "a\x00b\x85c \u3001\u4e00\u3002\u4e8c", "a\u2014b"):
        words = Counter(top_search._word.findall(text.lower()))
        found, counts = top_search._counts(text, table)
        assert dict(zip(found, counts)) == {int(np.uint64(xxhash.xxh3_64_intdigest(word)).view(np.int64)): n for word, n in words.items()}


def test_search_hashes_ascii_words_without_a_table():
    table = top_search._Hashes()
    found, counts = top_search._counts("The end, the b-side: The END", table)
    assert not table
    words = {b"the": 3, b"end": 2, b"b": 1, b"side": 1}
    assert list(zip(found, counts)) == sorted((int(np.uint64(xxhash.xxh3_64_intdigest(word)).view(np.int64)), n) for word, n in words.items())


def test_search_odd_rows(spark, odd, empty):
    asked = odd.select(F.col("doc_id").alias("query_id"), "text").distinct()
    rows = top_search.top_search(odd, asked, 3).collect()
    assert {(row["query_id"], row["doc_id"]) for row in rows if row["query_id"] == 1} == {(1, 2)}
    assert all(row["query_id"] not in (None, 3, 4, 5) for row in rows)
    assert top_search.top_search(empty, asked, 3).count() == 0
    assert top_search.top_search(odd, asked.limit(0), 3).count() == 0


def test_stages_on_odd_rows(spark, odd, empty, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for frame in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, frame, str(tmp_path))
            assert set(frame.columns) <= set(found.columns), name
            assert found.count() <= frame.count()
    encoded = corpus_pipeline.STAGES[-1][1](spark, odd, str(tmp_path))
    assert encoded.count() == odd.count()


def test_short_boilerplate_goes(spark):
    own = ["alpha beta gamma", "delta epsilon zeta", "eta theta iota kappa"]
    texts = [f"{line} one\nAll rights reserved.\n\nYes\n{line} two" for line in own]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {row["doc_id"]: row["text"] for row in corpus_pipeline.drop_repeated_lines(spark, docs, "").collect()}
    assert found[0] == texts[0]
    assert all("All rights reserved." not in found[n] and found[n].startswith(f"{own[n]} one\n") and found[n].endswith(f"{own[n]} two") for n in (1, 2))


def test_pipeline(spark, small_folder, small_texts):
    rows = {row["doc_id"]: row for row in corpus_pipeline.run(spark, small_folder).collect()}
    assert 0 < len(rows) < len(small_texts)
    for row in rows.values():
        assert row["decoded_sha256"] == hashlib.sha256(row["text"].encode()).hexdigest()
        assert row["n_chars"] == len(row["text"]) and row["n_tokens"] == len(row["ids"])
    left = near_copies.near_copies(spark.createDataFrame([(key, row["text"]) for key, row in rows.items()], "doc_id long, text string"))
    assert left.where("id != component_id").count() == 0
    toxic = {row["doc_id"] for row in spark.read.parquet(f"{small_folder}/labels.parquet").where("toxic = 1").collect()}
    insulting = {key for key in toxic if toxicity.features(small_texts[key])[0] > 0}
    assert not insulting & set(rows)


def test_search_names_fewer_documents_than_shards_hold(spark, monkeypatch):
    """What leaves 16 shards grows with the logarithm of their number, and the best stay the best, equal scores included."""
    rng = np.random.default_rng(11)
    texts = {key: " ".join(f"w{n}" for n in rng.integers(0, 40, 12)) for key in range(640)} | {key: "w1 w2 w3" for key in range(640, 700)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    size = sum(len(set(text.split())) for text in texts.values())
    monkeypatch.setattr(top_search, "SHARD_TERMS", size / 16)
    left = spark.sparkContext.accumulator(0)
    searcher = top_search._searcher

    def counted(k, mean_length):
        search = searcher(k, mean_length)

        def run(docs, block):
            found = search(docs, block)
            left.add(found.num_rows)
            return found

        return run

    monkeypatch.setattr(top_search, "_searcher", counted)
    wanted = docs.where("doc_id % 20 = 0").withColumnRenamed("doc_id", "query_id")
    got = {}
    for row in top_search.top_search(docs, wanted, 5).orderBy("query_id", "rank").collect():
        got.setdefault(row["query_id"], []).append((row["doc_id"], row["score"]))
    asked = [key for key in texts if key % 20 == 0]
    assert got == bm25(texts, asked, 5)
    assert left.value < 9.5 * 5 * len(asked), left.value / len(asked)
