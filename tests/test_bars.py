from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.times import is_final, local_to_utc
from tidemark.operators import bars as B
from tidemark.operators.quality import bar_rules, validate
from tidemark.operators.upsert import insert_if_absent, overlay, upsert, with_defaults
from tidemark.sources import sinks

NEW_YORK = "America/New_York"


def test_local_to_utc(rows):
    cases = [
        ("2025-11-02 01:30:00", NEW_YORK, "2025-11-02 06:30:00"),
        ("2025-11-02 00:30:00", NEW_YORK, "2025-11-02 04:30:00"),
        ("2025-11-02 02:30:00", NEW_YORK, "2025-11-02 07:30:00"),
        ("2025-03-09 02:30:00", NEW_YORK, "2025-03-09 07:30:00"),
        ("2025-07-01 09:30:00", "Europe/Berlin", "2025-07-01 07:30:00"),
        ("2025-10-26 02:15:00", "Europe/Berlin", "2025-10-26 01:15:00"),
        ("2025-01-01 00:00:00", "UTC", "2025-01-01 00:00:00"),
    ]
    df = rows(cases, "wall string, zone string, utc string")
    got = df.select(local_to_utc(F.col("wall").cast("timestamp_ntz"), F.col("zone")).cast("string").alias("got"), "utc")
    assert all(r.got == r.utc for r in got.collect())


def test_finality(rows):
    df = rows(
        [
            ("1m", "11:58:00", False, True), ("1m", "11:57:59", True, True), ("1h", "11:57:00", True, False),
            ("1d", "12:00:00", True, False), ("1h", "11:00:00", True, True), ("3m", "12:00:00", True, True),
        ],
        "interval string, at string, final boolean, strict boolean",
    ).withColumn("ts", F.concat(F.lit("2024-01-01 "), "at").cast("timestamp"))
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    got = df.select(
        "final", "strict",
        is_final(F.col("interval"), F.col("ts"), now).alias("a"),
        is_final(F.col("interval"), F.col("ts"), now, strict=True).alias("b"),
    )
    assert all(r.final == r.a and r.strict == r.b for r in got.collect())


def test_normalize(rows):
    tickers = rows([(1, "A", NEW_YORK), (2, "B", None)], "id int, symbol string, tz string")
    raw = rows(
        [
            ("A", "1m", "2024-01-09 10:00:00", float("nan"), 2.0, 1.0, 1.5, 7.0),
            ("B", "1m", "2024-01-09 10:00:00", 1.0, 2.0, 1.0, None, float("nan")),
            ("A", "1m", "2024-01-01 10:00:00", 1.0, 2.0, 1.0, 1.5, 7.0),
            ("A", "5m", "2024-01-01 10:00:00", 1.0, 2.0, 1.0, 1.5, 7.0),
            ("C", "1m", "2024-01-09 10:00:00", 1.0, 2.0, 1.0, 1.5, 7.0),
            ("A", "1d", "2019-01-11 00:00:00", 1.0, 2.0, 1.0, 1.5, 7.0),
            ("A", "1d", "2019-01-09 00:00:00", 1.0, 2.0, 1.0, 1.5, 7.0),
        ],
        "symbol string, interval string, at string, open double, high double, low double, close double, volume double",
    ).withColumn("ts_local", F.col("at").cast("timestamp_ntz"))
    bars = B.normalize_bars(raw, tickers, "2024-01-10 12:00:00")
    assert dict(bars.dtypes) == dict(rows([], schemas.BAR).dtypes)
    got = {(r.ticker_id, r.interval, str(r.ts_utc)): (r.open, r.close, r.volume) for r in bars.collect()}
    assert got == {
        (1, "1m", "2024-01-09 15:00:00"): (None, 1.5, 7),
        (2, "1m", "2024-01-09 10:00:00"): (1.0, None, None),
        (1, "5m", "2024-01-01 15:00:00"): (1.0, 1.5, 7),
        (1, "1d", "2019-01-11 05:00:00"): (1.0, 1.5, 7),
    }
    assert B.normalize_bars(raw, tickers, "2024-01-10 12:00:00", ["5m"]).count() == 1


def test_validate(rows):
    bars = rows(
        [
            ("ok", 1, "1m", 1.0, 5), ("interval", 1, "3m", 1.0, 5), ("low", 1, "5m", -1.0, 5),
            ("volume", 1, "15m", 1.0, -5), ("ticker", 9, "1m", 1.0, 5), ("none", None, "1m", 1.0, 5),
            ("twice", 2, "1m", 1.0, 5), ("twice", 2, "1m", 2.0, 5), ("nulls", 3, "1m", None, None),
        ],
        "name string, ticker_id int, interval string, low double, volume bigint",
    ).withColumns({"ts_utc": F.lit("2024-01-01").cast("timestamp"), **{c: F.lit(1.0) for c in ("open", "high", "close")}})
    tickers = rows([(1,), (2,), (3,)], "id int")
    good, bad = validate(bars, bar_rules(), unique=B.BAR_KEY, references={"ticker_id": (tickers, "id")})
    assert sorted(r.name for r in good.collect()) == ["nulls", "ok"]
    assert good.columns == bars.columns
    assert sorted((r.name, tuple(r.reasons)) for r in bad.collect()) == [
        ("interval", ("interval not allowed",)), ("low", ("low is negative",)), ("none", ("ticker_id is null",)),
        ("ticker", ("ticker_id is unknown",)), ("twice", ("key is repeated",)), ("twice", ("key is repeated",)),
        ("volume", ("volume is negative",)),
    ]


SCHEMA = "k int, close double, source string, at int"


def test_upsert(rows):
    target = rows([(1, 1.0, "a", 0), (2, 2.0, "a", 0), (3, 3.0, "a", 0)], SCHEMA)
    updates = rows([(2, 9.0, "x", 1), (2, 8.0, "y", 2), (3, None, "x", 1), (4, 4.0, "x", 1)], SCHEMA)
    once = upsert(target, updates, ["k"], ["close", "at"], ["at"])
    assert sorted(map(tuple, once.collect())) == [
        (1, 1.0, "a", 0), (2, 8.0, "a", 2), (3, None, "a", 1), (4, 4.0, "x", 1),
    ]
    twice = upsert(once, updates, ["k"], ["close", "at"], ["at"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_insert_overlay_defaults(rows):
    target = rows([(1, "a"), (2, "b")], "k int, v string")
    added = insert_if_absent(target, rows([(2, "x"), (3, "z"), (3, "y")], "k int, v string"), ["k"])
    assert sorted(map(tuple, added.collect())) == [(1, "a"), (2, "b"), (3, "y")]
    patched = overlay(target, rows([(2, None), (5, "e")], "k int, v string"), ["k"], ["v"])
    assert sorted(map(tuple, patched.collect()), key=str) == [(1, "a"), (2, None)]
    filled = with_defaults(rows([(1, None), (2, "5m")], "k int, interval string"), B.bar_defaults("2024-01-01"))
    got = {r.k: (r.interval, r.prepost, r.is_final) for r in filled.collect()}
    assert got == {1: ("1m", False, True), 2: ("5m", False, True)}


def test_bar_upsert_keeps_source(rows):
    now = datetime(2024, 1, 1, 12)
    bar = (1, datetime(2024, 1, 1), "1m", 1.0, 1.0, 1.0, 1.0, 5, False, "first", now, False)
    newer = (1, datetime(2024, 1, 1), "1m", 1.0, 1.0, 1.0, 2.0, 6, True, "x", now.replace(hour=13), True)
    row = B.upsert_bars(rows([bar], schemas.BAR), rows([newer], schemas.BAR)).first()
    assert (row.close, row.volume, row.source, row.prepost, row.is_final) == (2.0, 6, "first", False, True)


@pytest.mark.parametrize("repeat", [1, 2])
def test_staged_upsert(spark, rows, tmp_path, repeat):
    path, staged = str(tmp_path / "bars"), str(tmp_path / "staged")
    schema = "k int, v int, at int, day string"
    first = rows([(1, 1, 0, "mon"), (2, 2, 0, "tue")], schema)
    second = rows([(2, 5, 1, "tue"), (3, 3, 1, "wed")], schema)
    for name, updates in (("a", first), ("b", second)):
        sinks.stage_upsert(updates, path, staged + name, ["k", "day"], ["v", "at"], ["at"], "day")
        for _ in range(repeat):
            sinks.apply_staged(spark, staged + name, path, "day", updates.schema)
    got = {(r.k, r.v, r.day) for r in spark.read.parquet(path).collect()}
    assert got == {(1, 1, "mon"), (2, 5, "tue"), (3, 3, "wed")}


def test_upsert_keeps_the_null_partition(spark, rows, tmp_path):
    path = str(tmp_path / "bars")
    schema = "k int, v int, at int, day string"
    stages = ([(1, 1, 0, None), (2, 2, 0, "tue")], [(3, 3, 1, None), (4, 4, 1, "tue")], [(1, 9, 2, None)])
    for n, data in enumerate(stages):
        updates = rows(data, schema)
        sinks.stage_upsert(updates, path, str(tmp_path / f"staged{n}"), ["k"], ["v", "at"], ["at"], "day")
        sinks.apply_staged(spark, str(tmp_path / f"staged{n}"), path, "day", updates.schema)
    stored = sinks.read_stored(spark, path, updates.schema)
    assert {(r.k, r.v, r.day) for r in stored.collect()} == {(1, 9, None), (2, 2, "tue"), (3, 3, None), (4, 4, "tue")}
