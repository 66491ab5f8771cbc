import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from resonara.functions import text as X
from resonara.functions import urls as U
from resonara.functions.accents import fold


@pytest.fixture(scope="module")
def cases(spark):
    def run(build, rows, schema):
        df = spark.createDataFrame(rows, schema)
        return [r["v"] for r in df.select(build(*[F.col(c) for c in df.columns]).alias("v")).collect()]

    return run


def test_normalize_text(cases):
    rows = [("L'Empordà",), ("Els_Catarres  -  Jenifer!",), ("Qualsevol_nit-pot",), (None,), ("ﬁ ½ Ⅳ ①",), ("a b\tc d",)]
    assert cases(X.normalize_text, rows, "a string") == [
        "lemporda", "els catarres jenifer", "qualsevol nit pot", "", "fi 12 iv 1", "a b c d"]
    early = cases(lambda a: X.normalize_text(a, hyphen_is_blank=False), [("Qualsevol_nit-pot",)], "a string")
    assert early == ["qualsevol nitpot"]


def expected_key(text):
    import re

    text = unicodedata.normalize("NFKD", text.replace("_", " ").replace("-", " "))
    text = "".join(c for c in text if not unicodedata.combining(c))
    return " ".join(re.sub(r"[^\w\s]", "", text).split()).lower()


def test_normalize_text_over_many_characters(cases):
    """Every character of the common blocks, between two letters."""
    chars = [chr(c) for c in [*range(0x20, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2190), *range(0xFB00, 0xFB07),
                              *range(0xFF01, 0xFF5F)] if unicodedata.category(chr(c)) not in ("Cn", "Cf")]
    found = cases(X.normalize_text, [(f"a{c}b",) for c in chars], "a string")
    # Greek final sigma and other context-dependent lower-casing aside, all agree
    wrong = [(hex(ord(c)), got, expected_key(f"a{c}b")) for c, got in zip(chars, found) if got != expected_key(f"a{c}b")]
    assert wrong == []


def test_fold_is_idempotent():
    assert all(fold(f) == f for f in map(fold, "àéîõüçñŀﬁ½"))


@pytest.mark.parametrize("build, rows, schema, expected", [
    (X.sanitize_title, [('Què? "Sí": A/B',)], "a string", ["Què_Sí_AB"]),
    (X.clean_title, [("The Tyets - Coti x Coti", "The Tyets"), (None, None), ("a — b’s \\ c", ""), ("x" * 150, None)],
     "a string, b string", ["-_Coti_x_Coti", "unknown_title", "a_bs_c", "x" * 100]),
    (X.strip_channel_prefix, [("The Tyets - Coti x Coti", "The Tyets"), ("Other", "The Tyets"), (None, None)],
     "a string, b string", ["Coti x Coti", "Other", "unknown_title"]),
    (lambda a, b: X.compact_file_part(X.strip_channel_prefix(a, b)), [("The Tyets - Coti x Coti", "The Tyets")],
     "a string, b string", ["CotixCoti"]),
    (X.title_to_filename, [("The Tyets - Coti x Coti", "The Tyets"), ("Band: Song", "Band"), ("Band- So/ng", "Band"),
                           ("a  b", None)],
     "a string, b string", ["Coti_x_Coti", "ong", "So_ng", "a_b"]),
    (X.sanitize_name, [("Sau Oficial - Topic",)], "a string", ["sau"]),
    (X.make_query_id, [("Els Pets", "Bon dia")], "a string, b string", ["els_pets::bon_dia"]),
    (X.token_sort, [("red  bolt",), (" b a ",), ("",)], "a string", ["bolt red", "a b", ""]),
    (X.strip, [("\t x \n",), (" y",)], "a string", ["x", "y"]),
])
def test_cleaning(cases, build, rows, schema, expected):
    assert cases(build, rows, schema) == expected


def test_split_query_id(cases):
    found = cases(X.split_query_id, [("a::b",), ("a::b::c",), ("ab",), (None,)], "a string")
    assert [tuple(r) for r in found] == [("a", "b", True), (None, None, False), (None, None, False), (None, None, False)]


def test_parse_stem(cases):
    found = cases(X.parse_stem, [("12-my song-band",), ("12-my song",), ("12",), ("a-b-c-d",)], "a string")
    assert [tuple(r) for r in found] == [
        ("12", "my song", "band"), ("12", "my song", "unknown"), ("12", "", "unknown"), ("a-b", "c", "d")]
    assert cases(X.stem_id, [("id_rest_x",), ("plain",)], "a string") == ["id", "plain"]


def test_token_sort_ratio(cases):
    rows = [("bolt red", "red bolt"), ("abcde", "axcye"), ("", ""), ("", "a"), (None, "a")]
    assert cases(X.token_sort_ratio, rows, "a string, b string") == [100.0, 60.0, 100.0, 0.0, None]


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = [0] + [0] * len(b) if False else _next(row, x, b)
    return row[-1]


def _next(row, x, b):
    new = [0]
    for j, y in enumerate(b, 1):
        new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
    return new


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("abcé 𝄞", max_size=90), st.text("abcé 𝄞", max_size=90)), min_size=1, max_size=8))
def test_indel_scores_against_dynamic_programming(pairs):
    import pandas as pd

    got = X.indel_scores(pd.Series([a for a, _ in pairs], dtype=object), pd.Series([b for _, b in pairs], dtype=object))
    want = [100.0 if not a and not b else 200.0 * slow_lcs(a, b) / (len(a) + len(b)) for a, b in pairs]
    assert got.tolist() == pytest.approx(want)


ID = "Kx73OzRj7qE"


def test_video_ids(cases):
    links = [f"youtu.be/{ID}?si=x", f"https://www.youtube.com/watch?list=PLx&v={ID}", "", "https://example.com/a", None,
             f"https://youtube.com/embed/{ID}", f"http://youtube.com/v/{ID}", f"youtube.com/watch?v={ID}&t=3",
             "https://www.youtube.com/watch?v=short"]
    assert cases(U.extract_video_id, [(x,) for x in links], "a string") == [
        ID, ID, None, None, None, ID, ID, ID, None]


def test_link_classes(cases):
    links = ["https://youtube.com/playlist?list=PLabc", f"https://www.youtube.com/watch?v={ID}&list=RD1",
             "https://example.com/a", " ", None, f"https://youtu.be/{ID}", "https://www.youtube.com/watch",
             f"https://www.youtube.com/@me/{ID}"]
    assert cases(U.classify_url, [(x,) for x in links], "a string") == [
        "playlist", "playlist", "invalid", "empty", "empty", "ok", "playlist", "playlist"]
    assert cases(U.strip_url_params, [("a?v=1&b=2",)], "a string") == ["a?v=1"]
    assert cases(U.watch_url, [(ID,)], "a string") == [f"https://www.youtube.com/watch?v={ID}"]
