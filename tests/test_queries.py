"""Every registered query against its SQL on the smallest tables."""

import glob
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

FOLDER = entry.ENTRY_FOLDER
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def comparable(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple(repr(v) for v in row) for row in frame[columns].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, tables, name):
    got = comparable(entry.queries()[name](spark, FOLDER).toPandas())
    assert got == comparable(tables.execute(entry.oracle_sql()[name]).df())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_rows_only(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


@pytest.mark.parametrize("name", ["fuzzy_join", "knn_l2_blocks", "knn_widen", "recommend_items", "contains_join", "lang_prob",
                                  "canvas_scale", "removed_report", "rename_plan", "cluster_vs_label"])
def test_no_nested_loops(spark, name):
    """No plan compares every row of one side with every row of the other."""
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) == sum(len(m.QUERIES) for m in entry.MODULES)
