import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[*]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a DataFrame from tuples and a DDL schema."""

    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make
