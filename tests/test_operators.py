import pytest
from pyspark.sql import functions as F

from resonara.functions import categories as K
from resonara.functions import vectors as V
from resonara.operators import catalogue as CAT
from resonara.operators import features as FT
from resonara.operators import ordering as O
from resonara.operators import project as P


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_buckets_and_categories(spark):
    df = spark.createDataFrame([("2",), ("5",), ("1",), (None,), ("x",), ("3.0",)], "v string")
    assert [r[0] for r in df.select(K.instrumentation_bucket(F.col("v"))).collect()] == [
        "Instruments (2)", "Instruments (5)", "Unknown", "Unknown", "Unknown", "Instruments (3)"]
    df = spark.createDataFrame([("\tUrbà/Pop",), (" ",), (None,)], "v string")
    assert [r[0] for r in df.select(K.category_clean(F.col("v"))).collect()] == ["Urbà/Pop", "Unknown", "Unknown"]
    df = spark.createDataFrame([("Male ",), ("Female & Male",), ("Female",)], "v string")
    assert [r[0] for r in df.select(K.voice_class(F.col("v"))).collect()] == ["Male", "Male & Female", "Female"]


def test_palette_cycles_in_name_order(spark):
    names = ["Pop", "z1", "z2", "z3", "z4", "z5", "z6", None]
    found = dict(rows(FT.palette(spark.createDataFrame([(n,) for n in names], "g string"), "g")))
    assert found["Pop"] == "#1f77b4" and found["z1"] == "#8c564b" and found["z6"] == "#8c564b"
    assert len(found) == 7


def test_similarity_percent(spark):
    df = spark.createDataFrame([(9.9,), (10.0,), (20.0,), (30.0,), (31.0,), (19.5,)], "d double")
    percent = V.similarity_percent(F.col("d"))
    assert [r[0] for r in df.select(V.percent_label(percent)).collect()] == ["100%", "100%", "50%", "0%", "0%", "52%"]


def test_frames(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 6.0]],), ([[1.0, 2.0], [], [3.0]],), ([],)], "f array<array<float>>")
    assert df.select(V.mean_pool(F.col("f"))).first()[0] == [2.0, 4.0]
    assert df.select(V.mean_pool(F.col("f"))).collect()[2][0] is None
    assert [r[0] for r in df.select(V.flatten_truncate(F.col("f"))).collect()] == [[1, 2, 3, 6], [1, 2, 3], []]
    assert df.select(V.flatten_truncate(F.col("f"), 1, 1)).first()[0] == [1.0]
    assert [list(r["embedding"]) for r in V.select_token(df, "f", 1).collect()] == [[3.0, 6.0]]
    assert V.select_token(df, "f", None).count() == 3
    nested = spark.createDataFrame([([[[1.0, 2.0]], [[3.0, 6.0]]],)], "f array<array<array<float>>>")
    assert nested.select(V.mean_and_squeeze(F.col("f"))).first()[0] == [2.0, 4.0]
    padded = spark.createDataFrame([([1.0],)], "v array<float>").select(V.pad_to(F.col("v"), 3))
    assert padded.first()[0] == [1.0, 0.0, 0.0]
    wide = V.wide_dims(spark.createDataFrame([(1, [5.0, 6.0])], "id int, v array<float>"), "v", 2)
    assert wide.columns == ["id", "e0", "e1"] and tuple(wide.first()) == (1, 5.0, 6.0)


def test_canvas_and_ring(spark):
    scaled = P.canvas_scale(spark.createDataFrame([(0.0, 3.0), (5.0, 3.0), (10.0, 3.0)], "x double, c double"), "x", "c")
    assert rows(scaled, "x") == [(10.0, 50.0), (50.0, 50.0), (90.0, 50.0)]
    ring = P.radial_layout(spark.createDataFrame([(7, r) for r in (1, 2, 3, 4)], "query_id int, rank int"))
    assert [(r, round(x, 6) + 0.0, round(y, 6) + 0.0) for _, r, x, y in rows(ring, "rank")] == [
        (0, 0.0, 0.0), (1, 1.5, 0.0), (2, 0.0, 1.5), (3, -1.5, 0.0), (4, 0.0, -1.5)]


def test_zscore_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (4.0, 1.0)], "x double, flat double")
    found = rows(FT.zscore(df, "x", "flat"))
    assert found[0][0] == pytest.approx((1 - 7 / 3) / 1.247219, abs=1e-6)
    assert [f for _, f in found] == [0.0, 0.0, 0.0]


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, g string")
    assert rows(FT.one_hot(df, "g"), "id") == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]


def test_positions_and_pages(spark):
    df = spark.createDataFrame([(i * 7 % 60,) for i in range(60)], "id int").repartition(7)
    placed = O.with_position(df, ["id"])
    assert rows(placed, "id") == [(i, i + 1) for i in range(60)]
    assert [r[0] for r in O.page(df, ["id"], 6).collect()] == list(range(50, 60))
    assert O.page(df, ["id"], 7).count() == 0
    assert tuple(O.page_totals(df).first()) == (60, 6)
    assert [r[0] for r in O.next_page(df, "id", 9).collect()] == list(range(10, 20))
    assert O.page_numbers(df, ["id"]).where("page = 6").count() == 10
    with pytest.raises(ValueError):
        O.page(df, ["id"], 0)


def test_keep_one(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "y"), ("b", 1, "z"), (None, 1, "n")], "id string, at int, v string")
    assert rows(CAT.keep_one(df, "id", "at")) == [("a", 2, "y"), ("b", 1, "z")]
    assert rows(CAT.keep_one(df, "id", "at", last=False)) == [("a", 1, None), ("b", 1, "z")]


def test_joins(spark):
    items = spark.createDataFrame([(1, "A"), (2, "B")], "id int, artist string")
    meta = spark.createDataFrame([(1, "orig", "Pop")], "id int, artist string, genre string")
    joined = CAT.join_metadata(items, meta, "id")
    assert joined.columns == ["id", "artist", "artist_original", "genre"]
    assert tuple(CAT.missing_counts(joined, "genre").first()) == (2, 1)
    wanted = spark.createDataFrame([(1,), (9,)], "id int")
    assert [(r["id"], r["found"]) for r in CAT.lookup(items, wanted, "id").orderBy("id").collect()] == [(1, True), (9, False)]


def test_rename_plan(spark):
    files = spark.createDataFrame([
        ("vid1.mp3", "1", "Sau - Topic", "Boig Oficial"), ("vid2.mp3", "2", "Sau", "Boig"), ("a-b.mp3", "3", "A", "B"),
        ("vid4.mp3", "4", "A", "b"), ("x.wav", "5", "C", "D")], "f string, id string, c string, t string")
    plan = {r["file_id"]: (r["new_name"], r["action"]) for r in CAT.rename_plan(files, "f", "id", "c", "t").collect()}
    assert plan == {"1": ("sau-boig.mp3", "rename"), "2": ("sau-boig.mp3", "skip"), "3": ("a-b.mp3", "keep"),
                    "4": ("a-b.mp3", "skip"), "5": ("c-d.wav", "rename")}


def test_contains_join_against_all_pairs(spark):
    import random

    source = random.Random(9)
    names = ["".join(source.choices("abc", k=source.randint(0, 30))) for _ in range(80)] + [None, "", "aaaa", "aaaaaaaa"]
    ids = [("".join(source.choices("abc", k=source.randint(0, 9))), n, f"w{n}") for n in range(60)] + [(None, 90, "w"), ("aaaa", 91, "w"), ("aaaa", 4, "v")]
    files = spark.createDataFrame([(n,) for n in names], "f string")
    meta = spark.createDataFrame(ids, "id string, o int, w string")
    got = {r["f"]: (r["id"], r["w"]) for r in CAT.contains_join(files, meta, "f", "id", "o").collect()}
    want = {}
    for name in filter(None, names):
        hits = sorted((o, key) for key, o, _ in ids if key and key in name)
        if hits:
            key = hits[0][1]
            want[name] = (key, min((o, w) for other, o, w in ids if other == key)[1])
    assert got == want
    assert CAT.contains_join(files, meta.limit(0), "f", "id", "o").count() == 0


def test_contains_join(spark):
    files = spark.createDataFrame([("xxabcxx",), ("abd-abc",), ("no",), ("",)], "f string")
    meta = spark.createDataFrame([("abc", 2, "p"), ("abd", 1, "q"), ("zz", 0, "r")], "id string, o int, v string")
    assert rows(CAT.contains_join(files, meta, "f", "id", "o")) == [("abd-abc", "abd", 1, "q"), ("xxabcxx", "abc", 2, "p")]


def test_search_is_literal(spark):
    df = spark.createDataFrame([("100%", "x"), ("Àbc", None), ("a_c", "Y")], "a string, b string")
    assert CAT.search(df, "%", "a", "b").count() == 1
    assert CAT.search(df, "àB", "a", "b").count() == 1
    assert CAT.search(df, "y", "a", "b").count() == 1
    assert CAT.search(df, "", "a", "b").count() == 3


def test_defaults_and_validation(spark):
    df = spark.createDataFrame([("s", None), (" ", "x")], "song string, artist string")
    assert rows(CAT.default_columns(df, ["artist", "link"]), "song") == [(" ", "x", "N/A"), ("s", "N/A", "N/A")]
    valid, rejected = CAT.split_valid(df, "song", "artist")
    assert (valid.count(), rejected.count()) == (0, 2)
    assert CAT.complete_rows(df, "artist").count() == 1


def test_upsert_and_worklist(spark):
    lyrics = spark.createDataFrame([("a", " "), ("b", "text"), ("c", None)], "id string, lyrics string")
    files = spark.createDataFrame([("a",), ("b",), ("d",)], "id string")
    assert rows(CAT.backfill_worklist(lyrics, files, "id")) == [("a", "retry"), ("d", "new")]
    incoming = spark.createDataFrame([("a", "A"), ("b", "B"), ("d", "D")], "id string, lyrics string")
    assert rows(CAT.upsert(lyrics, incoming, "id"), "id") == [("a", "A"), ("b", "text"), ("c", None), ("d", "D")]
    removed = spark.createDataFrame([("a",), ("zz",)], "id string")
    meta = spark.createDataFrame([("a", "Song")], "id string, song string")
    texts = spark.createDataFrame([("a", 2, "second"), ("a", 1, "first")], "id string, at int, lyrics string")
    assert rows(CAT.removed_report(removed, meta, texts, "id", "at")) == [("a", "Song", "first")]


def test_pca_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    data = rng.normal(size=(80, 6)) @ rng.normal(size=(6, 6)) + 3.0
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(data)], "id int, embedding array<double>")
    model = P.fit_pca(df, 3)
    centred = data - data.mean(axis=0)
    _, singular, axes = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(np.abs(model.components), np.abs(axes[:3]), atol=1e-8)
    assert np.allclose(model.explained, singular[:3] ** 2 / (singular ** 2).sum())
    assert (model.components[np.arange(3), np.abs(model.components).argmax(axis=1)] > 0).all()
    found = np.array([r["coordinates"] for r in P.project(df, model).orderBy("id").collect()])
    assert np.allclose(found, centred @ model.components.T)
    assert np.allclose(found.mean(axis=0), 0.0, atol=1e-9)
    top = P.top_loadings(P.loadings(df, model), 2)
    assert top.count() == 6


def test_result_coordinates(spark):
    df = spark.createDataFrame([(1, 1, [0.0, 0.0, 1.0]), (1, 2, [2.0, 0.0, 1.0]), (2, 5, [1.0, 1.0, 1.0])],
                               "q int, id int, embedding array<double>")
    assert rows(P.result_coordinates(df, "q", "id"), "q", "id") == [(1, 1, -1.0, 0.0), (1, 2, 1.0, 0.0), (2, 5, 0.0, 0.0)]
