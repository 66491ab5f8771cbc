"""Neighbours from quantised vectors against the full scan."""

import os

import numpy as np
import pytest

from resonara.operators import quantised as Q
from resonara.operators.neighbours import knn
from resonara.workspace import shared_folder


def shown(df, value):
    return sorted((r["query_id"], r["rank"], r["item_id"], round(r[value], 9)) for r in df.collect())


def frame(spark, matrix):
    return spark.createDataFrame([(n, None if row is None else [float(v) for v in row]) for n, row in enumerate(matrix)],
                                 "item_id long, embedding array<double>").repartition(3)


@pytest.mark.parametrize("metric, cells, k", [("l2", None, 5), ("l2", 12, 3), ("cosine", 5, 4)])
def test_equals_the_scan(spark, metric, cells, k):
    rng = np.random.default_rng(7)
    rows = list(rng.normal(size=(300, 24)) * rng.uniform(0.1, 30, size=24))
    rows += [rows[3], rows[3], rows[9] * 1e6, np.zeros(24), None]  # ties, one far out, one of no length, one without a vector
    items = frame(spark, rows)
    queries = items.withColumnRenamed("item_id", "query_id")
    found, report = Q.knn_quantised(items, queries, k, metric=metric, cells=cells, block_rows=64)
    value = "similarity" if metric == "cosine" else "distance_sq"
    assert shown(found, value) == shown(knn(items, queries, k, metric=metric, plan="scan"), value)
    if metric == "l2" and cells is None:
        counts = [row["candidates"] for row in report.collect() if row["query_id"] < 300]
        assert np.median(counts) < 8 * k  # of 300, of which one widens the last level of every dimension


def test_rings_are_left_out_where_the_data_have_cells(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(scale=50, size=(20, 16))
    items = frame(spark, [centres[n % 20] + rng.normal(size=16) for n in range(800)])
    queries = items.where("item_id < 60").withColumnRenamed("item_id", "query_id")
    found, report = Q.knn_quantised(items, queries, 4, cells=40)
    assert shown(found, "distance_sq") == shown(knn(items, queries, 4, plan="scan"), "distance_sq")
    rows = report.collect()
    assert len(rows) == 60 and np.mean([row["rings"] / row["all_rings"] for row in rows]) < 0.5
    assert all(row["candidates"] <= row["compared"] for row in rows)


def test_few_and_no_items(spark):
    items = frame(spark, [[1.0, 2.0], [1.0, 2.0], [3.0, 0.0]])
    queries = items.withColumnRenamed("item_id", "query_id")
    found, _ = Q.knn_quantised(items, queries, 9)
    assert shown(found, "distance_sq") == shown(knn(items, queries, 9, plan="scan"), "distance_sq")
    assert Q.knn_quantised(items.limit(0), queries, 2)[0].count() == 0
    assert Q.knn_quantised(items, queries.limit(0), 2)[0].count() == 0
    with pytest.raises(ValueError):
        Q.knn_quantised(items, queries, 0)


def test_queries_are_not_copied_for_every_ring(spark):
    """No stored table has a row for each query and ring."""
    matrix = np.random.default_rng(3).normal(size=(500, 16))
    items = frame(spark, matrix)
    queries = items.withColumnRenamed("item_id", "query_id")
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    found, report = Q.knn_quantised(items, queries, 3, cells=40)
    assert shown(found, "distance_sq") == shown(knn(items, queries, 3, plan="scan"), "distance_sq")
    assert report.count() == 500
    new = [os.path.join(folder, name) for name in set(os.listdir(folder)) - before]
    rows = [spark.read.parquet(path).count() for path in new]
    assert max(rows) < 50 * 500
