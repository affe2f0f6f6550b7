import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tabwright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def table(spark):
    """Rows to a DataFrame: table("a int, b string", [(1, "x")], parts=3)."""

    def make(schema, rows, parts=None):
        df = spark.createDataFrame(rows, schema)
        return df.repartition(parts) if parts else df

    return make
