"""What the plans must and must not contain."""

import os

import pytest

from tidemark import queries as registered
from tidemark.operators import skew

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {n: q for n, q in registered.QUERIES.items() if not n.startswith("stream_")}


def _plan(spark, name, capsys):
    capsys.readouterr()
    QUERIES[name](spark, FOLDER).explain("formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_row_meets_every_other(spark, capsys, name):
    plan = _plan(spark, name, capsys)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert bad not in plan


@pytest.mark.parametrize("name", ["recent_events_topk", "recent_prices", "country_map_roll"])
def test_time_filter_reaches_the_scan(spark, capsys, name):
    assert "GreaterThanOrEqual(ts,2024-01-" in _plan(spark, name, capsys)


def test_only_needed_columns_are_read(spark, capsys):
    plan = _plan(spark, "country_minute_counts", capsys)
    scans = [line for line in plan.splitlines() if line.startswith("ReadSchema") and "event_type" in line]
    assert scans and all("props" not in line for line in scans)


def test_top_k_is_not_a_full_sort(spark, capsys):
    assert "TakeOrderedAndProject" in _plan(spark, "recent_events_topk", capsys)


def test_large_sides_are_not_broadcast(spark, capsys, monkeypatch):
    """Beyond the limit nothing is broadcast by a hint."""
    monkeypatch.setattr(skew.LIMITS, "broadcast_bytes", 0)
    monkeypatch.setattr(skew.LIMITS, "plain_bytes", 0)
    monkeypatch.setattr(skew.LIMITS, "group_rows", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(spark, "normalized_change", capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize(("name", "scans"), [("validate_rejects", 4), ("country_markers", 6)])
def test_a_large_plan_does_not_read_a_table_again(spark, capsys, monkeypatch, name, scans):
    """Joins whose sides are large read the fact once, as the small plan does."""
    for limit, value in (("group_rows", 20), ("broadcast_bytes", 0), ("plain_bytes", 0)):
        monkeypatch.setattr(skew.LIMITS, limit, value)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(spark, name, capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.split("\n\n")[0].count("Scan parquet") <= scans
