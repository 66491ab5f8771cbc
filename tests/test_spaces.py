"""Choice of an embedding model and comparison of two."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from resonara.operators import spaces as S


def frame(spark, matrix, ids=None):
    ids = range(len(matrix)) if ids is None else ids
    return spark.createDataFrame([(int(n), [float(v) for v in row]) for n, row in zip(ids, matrix)], "item_id long, embedding array<double>")


def plain_agreement(a, b, k, p):
    def near(matrix):
        away = np.square(matrix[:, None] - matrix[None]).sum(axis=2)
        np.fill_diagonal(away, np.inf)
        return np.argsort(away, axis=1, kind="stable")[:, :k]

    found = {}
    for n, (one, two) in enumerate(zip(near(a), near(b))):
        depths = [len(set(one[:d]) & set(two[:d])) / d * p ** (d - 1) for d in range(1, k + 1)]
        found[n] = (len(set(one) & set(two)), sum(depths) * (1 - p) / (1 - p ** k))
    return found


@pytest.mark.parametrize("k, plan", [(1, "scan"), (4, "scan"), (7, "blocks")])
def test_agreement(spark, k, plan):
    random = np.random.default_rng(3)
    a = random.normal(size=(60, 8))
    b = a[:, :5] + random.normal(scale=0.4, size=(60, 5))
    rows = S.neighbourhood_agreement(frame(spark, a), frame(spark, b), k, plan=plan).collect()
    want = plain_agreement(a, b, k, S.PERSISTENCE)
    assert len(rows) == 60
    for row in rows:
        shared, biased = want[row["item_id"]]
        assert row["shared"] == shared and row["overlap"] == shared / k and row["rank_biased"] == pytest.approx(biased)


def test_agreement_of_equal_and_partial_models(spark):
    a = np.random.default_rng(1).normal(size=(30, 4))
    rows = S.neighbourhood_agreement(frame(spark, a), frame(spark, a * 3 + 1).where("item_id < 20"), 5).collect()
    assert len(rows) == 20 and all(row["shared"] == 5 and row["rank_biased"] == pytest.approx(1) for row in rows)
    two = S.neighbourhood_agreement(frame(spark, a[:3]), frame(spark, a[:3]), 5).collect()
    assert all(row["shared"] == 2 and row["overlap"] == 1 and row["rank_biased"] == pytest.approx(1) for row in two)
    one = S.neighbourhood_agreement(frame(spark, a[:1]), frame(spark, a[:1]), 5).collect()
    assert [tuple(row) for row in one] == [(0, 0, 0.0, 0.0)]
    assert S.neighbourhood_agreement(frame(spark, a).limit(0), frame(spark, a), 2).count() == 0


def test_likeness(spark):
    random = np.random.default_rng(2)
    a = random.normal(size=(80, 6))
    turn, _ = np.linalg.qr(random.normal(size=(6, 6)))
    same = S.linear_cka(frame(spark, a), frame(spark, 2 * a @ turn + 5)).first()
    assert same["items"] == 80 and same["cka"] == pytest.approx(1)
    b = random.normal(size=(80, 3))
    ac, bc = a - a.mean(axis=0), b - b.mean(axis=0)
    want = np.square(ac.T @ bc).sum() / np.sqrt(np.square(ac.T @ ac).sum() * np.square(bc.T @ bc).sum())
    assert S.linear_cka(frame(spark, a), frame(spark, b)).first()["cka"] == pytest.approx(want)
    assert tuple(S.linear_cka(frame(spark, a[:1]), frame(spark, b)).first()) == (1, None)


def test_one_model_reads_its_folder_only(spark, tmp_path):
    a = np.random.default_rng(4).normal(size=(10, 3))
    path = str(tmp_path / "models")
    S.write_models(frame(spark, a).withColumn("model", F.lit("a")).unionByName(frame(spark, a * 2).withColumn("model", F.lit("b"))), path)
    S.write_models(frame(spark, a * 5).withColumn("model", F.lit("b")), path)  # replaces b, leaves a
    plan = S.read_model(spark, path, "b")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(model" in plan and "PushedFilters: []" in plan
    assert {file.rsplit("/", 2)[1] for file in S.read_model(spark, path, "b").inputFiles()} >= {"model=b"}
    assert S.read_model(spark, path, "b").where("item_id = 0").first()["embedding"] == [float(v) * 5 for v in a[0]]
    assert S.read_model(spark, path, "a").count() == 10
    with pytest.raises(ValueError):
        S.read_model(spark, path, "c")


def test_models_are_searched_from_a_stored_table(spark):
    """A search reads its items several times; when it read the models anew each time, a row was computed 18 times."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    random = np.random.default_rng(3)
    first = frame(spark, random.normal(size=(60, 8))).repartition(3)
    first = first.mapInPandas(count, first.schema)
    rows = S.neighbourhood_agreement(first, frame(spark, random.normal(size=(60, 5))), 3, plan="blocks").collect()
    assert len(rows) == 60 and seen.value <= 5 * 60
