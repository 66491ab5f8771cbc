"""Catalogue growth: the first row of an id by arrival, across batches and runs."""

from pyspark.sql import functions as F

from resonara.sources.writers import append_if_absent, new_rows
from resonara.streaming.first_seen import ingest_first_seen

SCHEMA = "id string, title string, at long"


def test_first_by_arrival(spark):
    rows = spark.createDataFrame([("a", "z first", 1), ("a", "a later", 2), ("b", None, 5), ("b", "x", None), (None, "y", 0)], SCHEMA)
    nothing = spark.createDataFrame([("c",)], "id string")
    got = {r["id"]: (r["title"], r["at"]) for r in new_rows(nothing, rows, "id", "at").collect()}
    assert got == {"a": ("z first", 1), "b": ("x", None)}
    assert {r["id"]: r["title"] for r in new_rows(nothing, rows, "id").where("id = 'a'").collect()} == {"a": "a later"}
    assert append_if_absent(rows.where("id = 'b'").limit(1), rows, "id", "at").where("id = 'a'").first()["title"] == "z first"


def test_state_store_takes_each_id_once(spark, tmp_path):
    known = spark.createDataFrame([("k",), ("k",), (None,)], "id string")

    def run(number, rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{number}")
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
        ingest_first_seen(stream, f"{tmp_path}/out", f"{tmp_path}/state", key="id", arrival="at", known=known).awaitTermination()
        return sorted((r["id"], r["title"]) for r in spark.read.schema(SCHEMA).parquet(f"{tmp_path}/out").collect())

    assert run(0, [("a", "z first", 1), ("a", "a later", 2), ("k", "old", 0), (None, "x", 0), ("b", None, 4), ("b", "y", 4)]) == [("a", "z first"), ("b", None)]
    assert run(1, [("a", "again", 0), ("c", "new", 9), ("k", "old", 0)]) == [("a", "z first"), ("b", None), ("c", "new")]
