import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from resonara.workspace import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, app_name="resonara-tests", memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column expression over one row of named values."""
    def evaluate(column, schema="a string", **values):
        return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("v")).first()["v"]

    return evaluate
