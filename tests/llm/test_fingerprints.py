"""Fingerprints, their search, and near copies against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from resonara.llm import fingerprints, near_copies, queries
from tests_llm_helpers import union_find


def test_edited_texts(spark, small_folder, small_texts):
    rows = queries.op5_fingerprints(spark, small_folder).collect()
    order = sorted(small_texts, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    prints = {row["doc_id"]: row["fingerprint"] for row in rows}
    assert sorted(prints) == sorted(small_texts)
    for row in rows:
        text, following = small_texts[row["doc_id"]], small_texts[after[row["doc_id"]]]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["edited_fingerprint"] == fingerprints._fingerprint(edited, {}).hex()
        bits = (int(row["fingerprint"], 16) ^ int(prints[after[row["doc_id"]]], 16)).bit_count()
        assert abs(row["near_next"] - max(0.0, np.cos(np.pi * bits / fingerprints.BITS))) < 1e-9
    values = {int(of, 16) for of in prints.values()}
    assert all(row["n_near"] == sum(0 < (int(row["fingerprint"], 16) ^ of).bit_count() <= fingerprints.NEAR_RADIUS for of in values) for row in rows)
    near = [row["near_edited"] > row["near_next"] for row in rows]
    assert sum(near) > 0.95 * len(near)


def test_equal_texts_have_equal_fingerprints():
    text = "Some words, some more words and some others."
    assert fingerprints._fingerprint(text, {}) == fingerprints._fingerprint(text, {"some": xxhash.xxh3_64_intdigest("some")})
    assert fingerprints._fingerprint("", {}) == bytes(32)


def test_next_over_odd_rows(spark, odd, empty):
    rows = fingerprints.edited_fingerprints(odd).collect()
    texts = {row["id"]: row["text"] for row in rows}
    assert len(rows) == odd.count() and texts[3] == "" and None in texts
    edited = {row["id"]: row["edited"] for row in rows}
    assert edited[None] == texts[None][:10] + texts[9][:10]  # the first follows the last
    assert fingerprints.edited_fingerprints(empty).count() == 0
    single = fingerprints.edited_fingerprints(odd.where("doc_id = 1")).first()
    half = len(single["text"]) // 2
    assert single["edited"] == single["text"][:len(single["text"]) - half] + single["text"][:half]


@pytest.mark.parametrize("partitions", [8, 200, 2000])
def test_next_at_any_number_of_partitions(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        rows = fingerprints.with_next(spark.range(20_000).selectExpr("id", "cast(id as string) as text")).select("text", "next_text").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {int(row["text"]): int(row["next_text"]) for row in rows} == {n: (n - 1) % 20_000 for n in range(20_000)}


@pytest.mark.parametrize("radius, members", [(3, 512), (3, 7), (6, 512), (0, 4)])
def test_near_counts(spark, monkeypatch, radius, members):
    monkeypatch.setattr(fingerprints, "CELL_MEMBERS", members)
    source = random.Random(8)
    base = [source.getrandbits(256) for _ in range(12)]
    prints = {b ^ sum(1 << n for n in source.sample(range(256), source.randint(0, 4))) for b in base for _ in range(30)}
    frame = spark.createDataFrame([(value.to_bytes(32, "big"),) for value in prints], "fingerprint binary")
    got = {int.from_bytes(row["fingerprint"], "big"): row["n_near"] for row in fingerprints.near_counts(frame, radius).collect()}
    want = {x: sum(x != y and (x ^ y).bit_count() <= radius for y in prints) for x in prints}
    assert got == {x: n for x, n in want.items() if n}


def test_within_finds_all(spark):
    source = random.Random(3)
    base = [source.getrandbits(256) for _ in range(30)]
    prints = base + [b ^ sum(1 << n for n in source.sample(range(256), source.randint(0, 9))) for b in base * 3]
    frame = spark.createDataFrame([(n, value.to_bytes(32, "big")) for n, value in enumerate(prints)] + [(999, None)], "id long, fingerprint binary")
    for radius, spare in ((5, 1), (7, 0), (3, 2)):
        got = fingerprints.within(frame, frame, radius, spare=spare).collect()
        found = [(row["probe_id"], row["id"], row["distance"]) for row in got]
        want = {(a, b, (x ^ y).bit_count()) for a, x in enumerate(prints) for b, y in enumerate(prints) if (x ^ y).bit_count() <= radius}
        assert len(found) == len(set(found)) and set(found) == want


def _reference_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[n:n + 3]) for n in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def _components(prints):
    pairs = [(a, b) for a, x in prints.items() for b, y in prints.items() if a < b and (x ^ y).bit_count() <= 3]
    return union_find(prints, pairs)


def test_near_copies_query(spark, small_folder, small_texts):
    prints = {key: _reference_fingerprint(text) for key, text in small_texts.items()}
    want = _components(prints)
    for row in queries.op6_simhash_near_dedup(spark, small_folder).collect():
        assert row["fingerprint"] == f"{prints[row['doc_id']]:016x}"
        assert row["component_id"] == want[row["doc_id"]]


def test_links_in_a_crowded_ball(spark, monkeypatch):
    """Cells that are cut into parts join what a comparison of all pairs joins."""
    monkeypatch.setattr(near_copies, "CELL_MEMBERS", 16)
    source = random.Random(5)
    start = source.getrandbits(64)
    prints = {start ^ sum(1 << n for n in source.sample(range(64), source.randint(0, 6))) for _ in range(250)}
    prints |= {source.getrandbits(64) for _ in range(100)}
    signed = {value: value - 2 ** 64 if value >= 2 ** 63 else value for value in prints}
    classes = spark.createDataFrame([(value,) for value in signed.values()], "fp long")
    want = _components(dict(zip(signed.values(), signed)))
    for blocks in (5, 6, 8):
        links = near_copies.fingerprint_links(classes, blocks=blocks)
        got = {row["node"]: row["root"] for row in near_copies.components(links).collect()}
        assert {value: got.get(value, value) for value in signed.values()} == want


def test_components_of_a_path_and_a_star(spark):
    path = [(n, n + 1) for n in range(60)] + [(100, n) for n in range(101, 200)]
    links = spark.createDataFrame(path, "a long, b long")
    got = {row["node"]: row["root"] for row in near_copies.components(links).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 200), 100)}


def test_odd_rows(spark, odd, empty):
    rows = near_copies.near_copies(odd).collect()
    found = {row["id"]: row["component_id"] for row in rows}
    assert len(rows) == odd.count()
    assert found[3] == found[4] == found[5] == 3  # no words: the zero fingerprint
    assert found[1] == 1 and found[2] in (1, 2) and found[None] is None
    assert near_copies.near_copies(empty).count() == 0
    kept = near_copies.representatives(odd)
    assert kept.columns == odd.columns
    ids = sorted(row["doc_id"] or -1 for row in kept.collect())
    assert 4 not in ids and 5 not in ids and -1 in ids
    copies = odd.where("doc_id is null").unionByName(odd.where("doc_id is null").withColumn("doc_id", F.lit(50)))
    assert [row["doc_id"] for row in near_copies.representatives(copies).collect()] == [50]
