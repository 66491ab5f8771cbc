import json

import pytest
from pyspark.sql import functions as F

from resonara.sources import readers as R
from resonara.sources import writers as W
from resonara import workspace


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_frame_json(spark, tmp_path):
    path = tmp_path / "frames.json"
    path.write_text(json.dumps([{"artist": "a", "song": "s", "embedding": [[1, 2], [3, 6]]}]))
    assert rows(R.read_frame_json(spark, str(path), "Before")) == [("a", "s", [2.0, 4.0], "Before")]


def test_records_of_both_schemes(spark, tmp_path):
    spark.createDataFrame([("1", "A", "S", [[1.0, 2.0], [3.0, 4.0]])],
                          "id string, artist string, song string, embedding array<array<float>>").write.parquet(f"{tmp_path}/a")
    spark.createDataFrame([("2", "T", "C", "", [5.0, 6.0])], "video_id string, song_title string, channel_name string, "
                          "youtube_link string, embedding array<float>").write.parquet(f"{tmp_path}/b")
    a = R.read_records(spark, f"{tmp_path}/a", "old")
    b = R.read_records(spark, f"{tmp_path}/b", "new")
    assert rows(a.unionByName(b), "item_id") == [("1", "A", "S", None, [2.0, 3.0], "old"), ("2", "C", "T", None, [5.0, 6.0], "new")]


def test_token_rows(spark, tmp_path):
    spark.createDataFrame([([[1.0]], "A", "S", 9)], "frames array<array<float>>, artist string, song string, x int").write.parquet(
        f"{tmp_path}/t")
    assert rows(R.read_token_rows(spark, f"{tmp_path}/t", "p")) == [([[1.0]], "A", "S", "p")]


def test_metadata_csv(spark, tmp_path):
    path = tmp_path / "meta.csv"
    path.write_text('ID,Song Name,Band,Instrumentation,Genre,Acoustic vs Electronic,Gender Voice,Bpm,YT Link\n'
                    'a1,"One, two",Els Pets,4,\tUrbà/Pop,Acoustic,Male ,120,http://x\n'
                    'a2,"He said ""hi""",Sau,,,,,,\n', encoding="utf-8")
    found = R.read_metadata_csv(spark, str(path), mode="FAILFAST")
    assert found.columns[:3] == ["ID", "Song", "Artist"]
    assert [(r["ID"], r["Song"], r["Instrumentation"], r["Bpm"]) for r in found.orderBy("ID").collect()] == [
        ("a1", "One, two", 4, 120), ("a2", 'He said "hi"', None, None)]
    clean = R.conform_strings(found, "Genre", "Gender Voice").orderBy("ID").collect()
    assert (clean[0]["Genre"], clean[0]["Gender Voice"], clean[1]["Genre"]) == ("Urbà/Pop", "Male", None)
    dirty = R.conform_metadata(spark.createDataFrame([(1, "x")], " id  int, ` Band` string").toDF(" id ", " Band"))
    assert dirty.columns == ["ID", "Artist"]


def test_catalogue_and_seeds(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("playlist_url,n\nhttp://a,1\n,2\n")
    assert R.read_catalogue(spark, str(path)).dtypes == [("playlist_url", "string"), ("n", "string")]
    assert rows(R.read_seed_urls(spark, str(path))) == [("http://a",)]
    with pytest.raises(Exception):
        R.read_catalogue(spark, str(tmp_path / "missing.csv")).count()


def test_audio_listing_and_embedding(spark, tmp_path):
    from resonara.operators.embed import embed_audio

    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "id1 x.mp3").write_bytes(bytes([1, 2, 3, 4]))
    (tmp_path / "id2.MP3").write_bytes(bytes([5, 7]))
    (tmp_path / "note.txt").write_text("no")
    found = R.list_audio(spark, str(tmp_path))
    assert rows(found.select("file_name", "stem", "length")) == [("id1 x.mp3", "id1 x", 4), ("id2.MP3", "id2", 2)]
    assert R.list_audio(spark, str(tmp_path), recursive=False).count() == 1

    def factory():
        import numpy as np

        # frames of two values per file
        return lambda contents: [np.frombuffer(c, dtype=np.uint8).reshape(-1, 2) for c in contents]

    files = R.list_audio(spark, str(tmp_path), content=True)
    assert rows(embed_audio(files, "stem", factory)) == [("id1 x", [2.0, 3.0]), ("id2", [5.0, 7.0])]


def test_csv_round_trip(spark, tmp_path):
    texts = [("1", 'a "quoted", text'), ("2", "two\nlines\\n"), ("3", "end\\")]
    W.write_csv(spark.createDataFrame(texts, "id string, t string"), f"{tmp_path}/out")
    assert rows(R.read_catalogue(spark, f"{tmp_path}/out")) == texts


def test_append_and_rewrite(spark, tmp_path):
    old = spark.createDataFrame([("a", "old")], "video_id string, v string")
    new = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", "y2"), (None, "z")], "video_id string, v string")
    assert rows(W.append_if_absent(old, new, "video_id")) == [("a", "old"), ("b", "y")]
    old.write.parquet(f"{tmp_path}/cat")
    W.append_new(f"{tmp_path}/cat", spark.read.parquet(f"{tmp_path}/cat"), new, "video_id")
    W.append_new(f"{tmp_path}/cat", spark.read.parquet(f"{tmp_path}/cat"), new, "video_id")
    assert rows(spark.read.parquet(f"{tmp_path}/cat")) == [("a", "old"), ("b", "y")]
    linked = W.backfill_link(old).first()["youtube_link"]
    assert linked == "https://www.youtube.com/watch?v=a"
    paths = W.rewrite_filtered({"cat": (new, "video_id")}, old, "video_id", str(tmp_path), "2")
    assert sorted((r["video_id"] or "-") for r in spark.read.parquet(paths["cat"]).collect()) == ["-", "b", "b"]


def test_json_and_plot_rows(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, 2.0, True)], "artist string, x double, y double, is_query boolean")
    assert W.json_rows(df).first()["json"] == '{"artist":"a","x":1.0,"y":2.0,"is_query":true}'
    W.write_json(df, f"{tmp_path}/j")
    assert spark.read.json(f"{tmp_path}/j").count() == 1
    points = spark.createDataFrame([(1, 0.0, 1.0)], "id int, x double, y double")
    details = spark.createDataFrame([(1, "Pop", "Sau")], "id int, genre string, artist string")
    assert rows(W.plot_table(points, details, "id", F.col("genre"), F.col("artist"), F.col("artist"))) == [
        (1, 0.0, 1.0, "Pop", "Sau", "Sau")]


class Session:
    """As much of a session as the shared folder needs."""

    def __init__(self, master, named=None):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.master, self.used = master, None
        self.sparkContext = self

    def getCheckpointDir(self):
        return self.used

    def setCheckpointDir(self, folder):
        self.used = folder


def test_shared_folder_follows_the_session(spark):
    assert workspace.shared_folder(Session("yarn", "hdfs://x/y")) == "hdfs://x/y"
    with pytest.raises(RuntimeError):
        workspace.shared_folder(Session("yarn"))
    local = Session("local[2]")
    assert workspace.shared_folder(local) == workspace.shared_folder(local)
    kept = workspace.written(spark.range(3).toDF("id"), "t")
    assert kept.count() == 3 and workspace.shared_folder(spark) in kept.inputFiles()[0]
