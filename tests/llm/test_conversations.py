"""Repair and prefix trie of conversations against plain forms."""

import itertools
import random
import re

import duckdb
import pytest

from resonara.llm import conversation_sql, prefix_trie, turn_repair

SCHEMA = "conv_id long, turn long, role string, text string, `key` string, cost double"
#: Nulls in every column, blank and long texts, ties, repeated rows, clashing names.
ODD = [
    (1, 0, "system", "Be brief.", "x", 1.0), (1, 1, "user", "Why?", "x", 1.0), (1, 2, "assistant", "Because.", "x", None),
    (1, 2, "assistant", "Because.", "x", None), (1, 2, "tool", "No end", None, 2.0), (1, None, "user", " \n ", "x", 1.0),
    (2, 5, None, None, "y", 1.0), (2, 9, "", "", "y", 1.0), (2, 9, "user", "Open", "y", 1.0),
    (None, 0, "user", "Who?", "z", 1.0), (None, None, "assistant", "Me.\n", "z", 1.0), (3, None, "user", "word " * 40_000, "z", 1.0),
    (4, 0, "user", "ä 中 😀?", "z", 1.0), (4, 1, "user", "ä 中 😀?", "z", 1.0), (-7, 3, "assistant", "x ", "z", 1.0),
]


def random_turns(seed, conversations, most):
    source = random.Random(seed)
    texts = ["Yes.", "No.", "Well", "", " ", "Why?", "A. B"]
    return [(conv, turn, source.choice(["system", "user", "user", "assistant", "assistant", "tool"]), source.choice(texts), "k", 0.0)
            for conv in range(conversations) for turn in range(source.randint(1, most))]


def oracle(frame, sql):
    connection = duckdb.connect()
    connection.register("conversations", frame.toArrow())
    return sorted(map(repr, connection.execute(sql).fetchall()))


def plain(frame):
    return sorted(repr(tuple(row)) for row in frame.collect())


def cheapest(codes):
    """Least (cost, audit) over all sequences of edits with up to two insertions in a place."""
    found = []
    inserted = [("", 0), ("u", 1), ("a", 1), ("ua", 2), ("au", 2)]
    edits = []
    for code in codes:
        late = turn_repair.TRUNCATED * (code == "!" or code.isupper())
        own = [("D", "", turn_repair.DELETE)]
        if code not in " =":
            own += [("K", "?" if code == "!" else code.lower(), late)] + [("R", role, turn_repair.REROLE + late) for role in "ua"]
        edits.append(own)
    for chosen in itertools.product(*edits):
        for between in itertools.product(inserted, repeat=len(codes) + 1):
            roles = between[0][0] + "".join(edit[1] + more[0] for edit, more in zip(chosen, between[1:]))
            if re.fullmatch(r"(s?(ua)+)?", roles):
                audit = "I" * between[0][1] + "".join(edit[0] + "I" * more[1] for edit, more in zip(chosen, between[1:]))
                found.append((sum(edit[2] for edit in chosen) + turn_repair.INSERT * audit.count("I"), audit))
    return min(found)


def test_cheapest_edits():
    source = random.Random(5)
    for _ in range(60):
        codes = "".join(source.choice("suaSUA?! =") for _ in range(source.randint(0, 4)))
        assert turn_repair.best(turn_repair.read(codes, {0: (0, "")})) == cheapest(codes), codes


def test_stacks_are_the_grammars():
    def accepts(roles):
        tops = [turn_repair.FIRST]
        for role in roles:
            tops = [after for top in tops for after in turn_repair.shifted(top, role)]
        return any(map(turn_repair.accepted, tops))

    for length in range(7):
        for roles in itertools.product("sua", repeat=length):
            assert accepts(roles) == bool(re.fullmatch(r"(s?(ua)+)?", "".join(roles)))


@pytest.mark.parametrize("segment", [turn_repair.SEGMENT, 1, 3])
def test_repair(spark, segment):
    frame = spark.createDataFrame(ODD + random_turns(1, 30, 14), SCHEMA).repartition(3)
    assert plain(turn_repair.repair_conversations(frame, segment=segment)) == oracle(frame, conversation_sql.turn_repair_sql())


def test_repair_of_nothing(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert turn_repair.repair_conversations(frame).count() == 0
    gone = spark.createDataFrame([(conv, 0, "user", "Hm", None, None) for conv in range(60)], SCHEMA)
    rows = turn_repair.repair_conversations(gone).where("audit = ''").collect()
    assert rows and all(row["cost"] == 0 and row["repaired_sha256"].startswith("e3b0c442") for row in rows)


@pytest.mark.parametrize("bounds", [{}, {"shard_conversations": 4, "shard_turns": 30, "stretch": 2}, {"stretch": 1}])
def test_trie(spark, bounds):
    # many conversations share turns, whole copies and ends among them
    source = random.Random(2)
    shared = [(conv, turn, "user" if turn % 2 == 0 else "assistant", "abc"[source.random() < 0.2], "k", 0.0)
              for conv in range(100, 220) for turn in range(source.randint(0, 12))]
    frame = spark.createDataFrame(ODD + random_turns(3, 30, 14) + shared, SCHEMA).repartition(3)
    rows = prefix_trie.conversation_trie(frame, **bounds)
    assert plain(rows) == oracle(frame, conversation_sql.prefix_trie_sql())
    assert plain(rows.where("depth = 0").select("n_convs")) == plain(frame.selectExpr("count(distinct conv_id)"))


def test_trie_of_nothing(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 1, "user", "x", None, None)], SCHEMA)).count() == 0
