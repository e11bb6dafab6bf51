"""The split paths against the plain ones, with limits low enough to split."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import skew


@pytest.fixture(scope="module")
def fact(spark):
    rng = random.Random(7)
    rows = [(n, 1 if rng.random() < 0.5 else rng.randrange(40), rng.random()) for n in range(4000)]
    rows += [(n, None, 0.5) for n in range(4000, 4300)]
    return spark.createDataFrame(rows, "id int, key int, value double").repartition(4)


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([(k, f"name {k}") for k in range(0, 60, 2)] + [(1, "one")], "key int, name string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join(fact, dim, how):
    plain = fact.join(dim, ["key"], how)
    limits = skew.Limits(100, 0, 0)
    split = skew.fact_dim_join(fact, dim, ["key"], how, ["id"], limits, skew.hot_keys(fact, ["key"], limits))
    assert split.columns == plain.columns
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()


def test_hot_keys(fact):
    found = {r.key: r._parts for r in skew.hot_keys(fact, ["key"], skew.Limits(500)).collect()}
    rows = fact.where("key = 1").count()
    assert found == {1: -(-rows // 500)}


def test_planner_picks_the_join(fact, dim, capsys):
    skew.fact_dim_join(fact, dim, ["key"]).explain()
    out = capsys.readouterr().out
    assert "SortMergeJoin" in out and "_parts" not in out and "Expand" not in out


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(11)
    rows = []
    for n in range(3000):
        key = 1 if rng.random() < 0.6 else rng.randrange(20)
        second = rng.randrange(200_000)
        rows.append((n, key, second, None if rng.random() < 0.1 else rng.random()))
    df = spark.createDataFrame(rows, "id int, key int, second int, value double").repartition(4)
    return df.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("second")))


@pytest.mark.parametrize("group_rows", [50, 1000, 10_000])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_split_lag(series, group_rows, kind):
    df = series.withColumn("ts", F.col("ts").cast(kind))
    window = Window.partitionBy("key").orderBy("ts", "id")
    plain = df.withColumns({"before": F.lag("value").over(window), "when": F.lag("ts").over(window)})
    split = skew.previous_values(
        df, ["key"], "ts", {"before": "value", "when": "ts"}, ["id"], skew.Limits(group_rows, 0, 0)
    )
    assert split.columns == plain.columns
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()


def test_split_lag_on_one_instant(spark):
    df = spark.createDataFrame([(1, n) for n in range(100)], "key int, id int").withColumn(
        "ts", F.lit("2024-01-01").cast("timestamp")
    )
    split = skew.previous_values(df, ["key"], "ts", {"before": "id"}, ["id"], skew.Limits(10, 0, 0))
    assert {(r.id, r.before) for r in split.collect()} == {(n, n - 1 if n else None) for n in range(100)}


def test_a_burst_is_split_by_rows(spark):
    """Nearly all rows within an hour, one long before."""
    df = spark.range(20_001).selectExpr("1 as key", "cast(if(id = 0, 0, 1700000000 + id % 3600) as timestamp) as ts", "id")
    cut, _ = skew._segments(df, ["key"], F.struct("ts", "id"), ["ts", "id"], skew.Limits(1000, 0, 0))
    sizes = [r["count"] for r in cut.groupBy("_seg").count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 2000


@pytest.mark.parametrize("group_rows", [40, 700])
def test_carried(series, group_rows):
    some = series.withColumn("value", F.when(F.col("id") % 7 == 0, F.col("value")))
    plain = skew.carried(some, ["key"], "ts", "value", "last", ["id"])
    split = skew.carried(some, ["key"], "ts", "value", "last", ["id"], skew.Limits(group_rows, 0, 0))
    assert split.columns == plain.columns
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()


def test_latest_filters_before_the_shuffle(spark, tmp_path, capsys):
    spark.range(100).selectExpr("id % 3 as key", "id").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    latest = skew.latest_per_key(df, ["key"], [F.desc("id")])
    latest.explain()
    assert capsys.readouterr().out.count("WindowGroupLimit") == 2
    assert {tuple(r) for r in latest.collect()} == {(0, 99), (1, 97), (2, 98)}
    ties = df.unionByName(df.where("id = 99"))
    assert skew.at_latest(ties, ["key"], "id").count() == 4
