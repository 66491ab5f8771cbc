import numpy as np
import pytest
from pyspark.sql import functions as F

from resonara.operators.language import profiles
from resonara.plans import catalogue_growth as G
from resonara.plans import recommend as REC
from resonara.plans.collection_map import collection_map
from resonara.streaming import jobs as J


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(9)
    rows = [(i, f"Band {i % 7}", f"Song número {i}", [float(x) for x in rng.normal(i % 3 * 4, 1, 6)]) for i in range(60)]
    return spark.createDataFrame(rows, "item_id long, artist string, song string, embedding array<float>")


@pytest.fixture(scope="module")
def collection(spark, vectors):
    metadata = vectors.where("item_id <> 59").select(
        F.concat(F.lit("vid"), "item_id").alias("video_id"), F.lower("artist").alias("channel_name"),
        F.replace("song", F.lit("ú"), F.lit("u")).alias("song_title"))
    return REC.build_collection(vectors, metadata, k=3)


def test_collection(collection):
    assert collection.items.select("cluster").distinct().count() == 3
    kept = {r["item_id"]: r["video_id"] for r in collection.items.collect()}
    assert kept[3] == "vid3"


def test_recommend(spark, collection):
    requests = spark.createDataFrame([("r1", "band_3", "SONG NÚMERO 10"), ("r2", "band 3", "song numero 10"), ("r3", "zz", "qq")],
                                     "request_id string, artist string, song string")
    result = REC.recommend(collection, requests, 5)
    found = result.rows.orderBy("request_id", "rank").collect()
    assert [r["rank"] for r in found] == [1, 2, 3, 4, 5] * 2
    assert [r["item_id"] for r in found[:5]] == [r["item_id"] for r in found[5:]]
    assert 10 not in {r["item_id"] for r in found} and all(r["link"].startswith("https://") for r in found)
    points = result.coordinates.where("request_id = 'r1'").collect()
    assert len(points) == 6 and [r["item_id"] for r in points if r["is_query"]] == [10]
    assert [tuple(r) for r in result.errors.collect()] == [("r3", "query not found")]


def test_collection_map(spark, vectors):
    metadata = spark.createDataFrame([(1, "Original", "\tPop ", 3, "Female & Male")],
                                     "item_id long, song string, Genre string, Instrumentation int, `Gender Voice` string")
    mapped = collection_map(vectors.withColumn("population", F.lit("x")), metadata, ks=(2, 3))
    assert mapped.count() == 60 and {"x", "y", "Cluster_2", "Cluster_3", "genre_colour"} <= set(mapped.columns)
    row = mapped.where("item_id = 1").first()
    assert (row["label"], row["genre_main"], row["instruments"], row["voice"]) == (
        "Band 1 - Original", "Pop", "Instruments (3)", "Male & Female")


def test_growth_and_language(spark):
    seen = spark.createDataFrame([("a",)], "video_id string")
    listed = spark.createDataFrame([("a", "T", "C"), ("b", "C - New one", "C"), ("b", "C - New one", "C"), (None, "x", "y")],
                                   "id string, title string, uploader string")
    new = G.new_entries(seen, listed).collect()
    assert [tuple(r) for r in new] == [
        ("b", "-_New_one", "C", "C - New one", "b.mp3", "https://www.youtube.com/watch?v=b")]
    profile = profiles(spark.createDataFrame([("ca", "bon dia amb el sol"), ("en", "the day and the night")], "lang string, text string"))
    lyrics = spark.createDataFrame([("1", 1, "bon sol amb el dia"), ("2", 2, "the night"), ("3", 3, "")], "id string, at int, lyrics string")
    meta = spark.createDataFrame([("2", "Night")], "id string, song_title string")
    kept, removed, report = G.split_by_language(lyrics, profile, meta, "ca", order="at")
    assert [r["id"] for r in kept.collect()] == ["1"]
    assert sorted(r["id"] for r in removed.collect()) == ["2", "3"]
    assert [tuple(r) for r in report.collect()] == [("2", "Night", "the night")]


# --- streams ----------------------------------------------------------------

def write_parts(spark, rows, schema, path, parts):
    for i in range(parts):
        spark.createDataFrame(rows[i::parts], schema).coalesce(1).write.mode("append").parquet(path)


def streamed(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_ingest_over_batches_and_runs(spark, tmp_path):
    import datetime as dt

    start = dt.datetime(2024, 1, 1)
    schema = "video_id string, ts timestamp"
    rows = [(f"v{i % 40}", start + dt.timedelta(minutes=7 * i)) for i in range(200)]
    write_parts(spark, rows, schema, f"{tmp_path}/in", 4)
    known = spark.createDataFrame([("v0",)], "video_id string")

    def run():
        J.ingest(streamed(spark, schema, f"{tmp_path}/in"), f"{tmp_path}/table", f"{tmp_path}/state", key="video_id",
                 known=known).awaitTermination()
        found = J.ingested(spark, f"{tmp_path}/table", spark.createDataFrame([], schema).schema)
        return sorted(r["video_id"] for r in found.collect())

    expected = sorted(f"v{i}" for i in range(1, 40))
    assert run() == expected
    write_parts(spark, [("v5", start), ("late", start)], schema, f"{tmp_path}/in", 1)
    # however late a new id arrives, it is taken, once
    assert run() == sorted([*expected, "late"])
    assert run() == sorted([*expected, "late"])


def test_ratings_stream_equals_batch(spark, tmp_path):
    import datetime as dt

    start = dt.datetime(2024, 1, 1)
    schema = "ts timestamp, session string, searched string, recommended int, liked_item int, liked_rec int"
    rows = [(start + dt.timedelta(hours=i), f"s{i // 24}", "q", i % 9, i % 2, i % 3 % 2) for i in range(96)]
    # cards are rated again in a session with other answers, and arrive out of order
    rows = rows[::-1]
    write_parts(spark, rows, schema, f"{tmp_path}/in", 1)
    J.count_ratings(streamed(spark, schema, f"{tmp_path}/in"), f"{tmp_path}/table", f"{tmp_path}/state").awaitTermination()
    got = sorted(map(tuple, J.counted_ratings(spark, f"{tmp_path}/table", spark.createDataFrame([], schema).schema).collect()))
    want = sorted(map(tuple, J.ratings_daily(spark.createDataFrame(rows, schema)).collect()))
    assert got == want and [r[1] for r in want] == [9, 9, 9, 9]


def test_requests_stream(spark, tmp_path, collection):
    video = "Kx73OzRj7qE"
    schema = "request_id string, url string, artist string, song string"
    rows = [("ok", f"https://youtu.be/{video}", "Band 3", "Song numero 10"), ("bad", "https://example.com", "x", "y"),
            ("none", f"https://youtu.be/{video}", "zz", "qq"), ("empty", None, "x", "y")]
    write_parts(spark, rows, schema, f"{tmp_path}/in", 2)
    J.serve_requests(streamed(spark, schema, f"{tmp_path}/in"), collection, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    answers = J.results(spark, f"{tmp_path}/out")
    errors = {r["request_id"]: r["error"] for r in answers.where("status = 'error'").collect()}
    assert errors == {"bad": "invalid", "none": "query not found", "empty": "empty"}
    good = answers.where("request_id = 'ok'").collect()
    assert len(good) == 5 and {r["video_id"] for r in good} == {video}
    asked = spark.createDataFrame([("ok",), ("bad",), ("later",)], "request_id string")
    assert {tuple(r) for r in J.statuses(asked, answers).collect()} == {
        ("ok", "completed"), ("bad", "error"), ("later", "processing")}
