"""Every registered query against its SQL counterpart."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as entry_points
from tidemark import queries as registered
from tidemark.operators import skew

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registered.QUERIES, registered.SQL


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert differences(result, duck, SQL[name]) == []
    else:
        assert result.count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


# Those whose joins or look-backs take another path on large tables.
SPLIT = [
    "country_resolution", "hierarchy_ascent", "normalize_bars", "validate_rejects", "symbol_return",
    "country_map_roll", "normalized_change", "overlay", "topic_tagging_by_join", "stream_previous_close",
]


@pytest.mark.parametrize("name", SPLIT)
def test_query_with_hot_keys_split(spark, duck, name, monkeypatch):
    for limit, value in (("group_rows", 20), ("broadcast_bytes", 0), ("plain_bytes", 0)):
        monkeypatch.setattr(skew.LIMITS, limit, value)
    assert differences(QUERIES[name](spark, FOLDER), duck, SQL[name]) == []
