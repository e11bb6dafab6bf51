from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.plans import dashboard, signals, views

NOON = datetime(2024, 1, 1, 12)
AS_OF = "2024-01-01 12:00:00"


def _at(minutes):
    return NOON + timedelta(minutes=minutes)


EDIT = "meta_id string, dt timestamp, page_country_code string, topics array<string>"


@pytest.fixture
def bars(rows):
    data = [
        (1, -20, 10.0), (1, -19, None), (1, -18, 20.0), (1, -17, 30.0),
        (2, -18, 0.0), (2, -17, 5.0), (3, -18, 1.0), (3, -17, 2.0),
    ]
    return rows(
        [(t, _at(m), "1m", c) for t, m, c in data] + [(1, _at(0), "5m", 99.0)],
        "ticker_id int, ts_utc timestamp, interval string, close double",
    ).withColumns(
        {
            **{c: F.col("close") for c in ("open", "high", "low")}, "volume": F.lit(1).cast("bigint"),
            "prepost": F.lit(False), "source": F.lit("s"), "ingested_at": F.col("ts_utc"), "is_final": F.lit(True),
        }
    )


@pytest.fixture
def tickers(rows):
    return rows(
        [(1, "A", "B"), (2, "Z", "B"), (3, "N", None)], "id int, symbol string, iso2 string"
    ).withColumns({c: F.lit(None).cast("string") for c in ("name", "exchange", "currency", "mic", "tz")})


def test_returns(bars, tickers):
    returns = views.symbol_return(bars, tickers)
    assert returns.count() == 8
    got = {str(r.ts_minute_utc)[11:16]: (r.avg_return_1m, r.symbols_count) for r in views.country_return_minute(returns).collect()}
    # 11:41 has a null close, so 11:42 has no previous one; the zero of ticker 2 gives a null return at 11:43.
    assert got == {"11:41": (None, 1), "11:43": (0.5, 2)}
    near = views.symbol_return(bars, tickers, max_gap="30 seconds")
    assert near.where("prev_close is not null").count() == 0


@pytest.mark.parametrize("max_gap", [None, "1 minute", "2 minutes"])
def test_returns_from_a_start(bars, tickers, max_gap):
    for minutes in (-30, -19, -18, -17, 5):
        start = F.lit(_at(minutes))
        whole = views.symbol_return(bars, tickers, max_gap=max_gap).where(F.col("ts_minute_utc") >= start)
        part = views.symbol_return(bars, tickers, max_gap=max_gap, start=start)
        assert sorted(map(str, part.collect())) == sorted(map(str, whole.collect()))


def test_latest(bars, tickers):
    assert {(r.ticker_id, r.close) for r in views.stock_latest(bars).collect()} == {(1, 30.0), (2, 5.0), (3, 2.0)}
    enriched = views.stock_latest_enriched(bars, tickers)
    assert {(r.symbol, r.close) for r in enriched.collect()} == {("A", 30.0), ("Z", 5.0), ("N", 2.0)}
    assert "interval" not in enriched.columns


def test_country_signal(rows):
    def minute(country, at, count):
        return (country, _at(at), count)

    activity = rows(
        [
            minute("A", -5, 2), minute("A", -25, 3), minute("C", -61, 9), minute("D", 5, 1), minute("E", -10, 4),
        ],
        "iso2 string, ts_minute_utc timestamp, event_count int",
    )
    returns = rows(
        [("B", _at(-20), 0.5, 1)], "iso2 string, ts_minute_utc timestamp, avg_return_1m double, symbols_count int"
    )
    rolled = views.country_map_roll(returns, activity, AS_OF)
    got = {r.iso2: (r.events_10m, r.events_30m, r.ret_avg_10m, r.ret_avg_30m, r.symbols_seen) for r in rolled.collect()}
    assert got == {
        "A": (2, 5, None, None, None), "B": (None, 0, None, 0.5, 1), "D": (1, 1, None, None, None),
        "E": (4, 4, None, None, None),
    }


def test_country_minute_and_filter(rows):
    edits = rows(
        [
            ("1", NOON, "USA", ["a"]), ("2", NOON + timedelta(seconds=59), "US", ["a", "b"]), ("3", NOON, "US", []),
            ("4", NOON, None, ["a"]), ("5", NOON, "US", None),
        ],
        EDIT,
    )
    assert [tuple(r) for r in views.country_minute(edits).collect()] == [(NOON, "US", 2)]


def test_recent_events(rows):
    edits = rows(
        [
            ("old", _at(-61), "US", ["a"]), ("edge", _at(-60), "US", ["a"]), ("new", _at(0), "US", ["b", None]),
            ("late", _at(9), "US", ["a"]), ("lost", _at(0), None, ["a"]), ("none", _at(-1), "US", None),
        ],
        EDIT,
    ).withColumns({c: F.col("meta_id") for c in ("wiki", "title", "user_text", "type", "added", "removed")})
    def shown(**options):
        return [r.title for r in dashboard.recent_events(edits, AS_OF, 60, **options).collect()]

    assert shown() == ["late", "new", "none", "edge"]
    assert shown(topics=["a"]) == ["late", "edge"]
    assert shown(topics=["b", "a"], cap=2) == ["late", "new"]


def test_markers_and_kpis(rows):
    events = rows(
        [("US", ["b", "a"]), ("US", ["a"]), ("DE", []), ("XX", ["c"])], "iso2 string, topics array<string>"
    )
    points = rows([("US", 1.0, 2.0), ("DE", 3.0, 4.0)], "iso2 string, lon double, lat double")
    markers = {r.iso2: (r["count"], r.topics, r.lon, r.radius) for r in dashboard.country_markers(events, points).collect()}
    assert markers == {"US": (2, "a, b", 1.0, 10), "DE": (1, "", 3.0, 8)}
    assert tuple(dashboard.kpis(events).first()) == (3, 4)


def test_prices(bars, tickers):
    prices = dashboard.recent_prices(bars, tickers, AS_OF, 60)
    assert prices.count() == 8
    assert dashboard.recent_prices(bars, tickers, AS_OF, 60, ["A"]).count() == 4
    change = dashboard.normalized_change(prices)
    got = {(r.symbol, str(r.ts_utc)[14:16]): r.p_close for r in change.collect()}
    assert got[("A", "43")] == pytest.approx(200.0) and got[("A", "41")] is None
    assert got[("Z", "43")] is None
    assert dashboard.axis_bounds(prices).first().y_max == pytest.approx(30.3)


def test_correlation_of_a_constant_is_null(rows):
    returns = rows(
        [("A", _at(m), v) for m, v in ((0, 1.0), (1, 2.0), (2, 3.0))] + [("B", _at(0), 1.0), ("B", _at(1), 2.0)],
        "iso2 string, ts_minute_utc timestamp, avg_return_1m double",
    )
    activity = rows(
        [("A", _at(0), 1), ("A", _at(1), 2), ("A", _at(2), 3)], "iso2 string, ts_minute_utc timestamp, event_count int"
    )
    found = {r.iso2: r.correlation for r in signals.country_correlation(returns, activity).collect()}
    assert found["A"] == pytest.approx(1.0) and found["B"] is None
    lagged = {(r.iso2, r.lag): r.pairs for r in signals.lead_lag_correlation(returns, activity, 1, 60).collect()}
    assert lagged[("A", 1)] == 3 and len(lagged) == 6


def test_surges_fill_gaps_with_zero(rows):
    counts = rows([("t", 0, 2), ("t", 1, 4), ("t", 4, 30)], "topic string, step bigint, event_count bigint")
    got = {r.step: r for r in signals.topic_surges(counts, 3).collect()}
    assert got[0].baseline_mean is None and got[0].score is None
    assert got[1].baseline_mean == 2.0 and got[1].score is None
    # Steps 1, 2, 3 have 4, 0, 0 edits.
    assert got[4].baseline_mean == pytest.approx(4 / 3)
    assert got[4].baseline_stddev == pytest.approx((32 / 9) ** 0.5)
    assert signals.surge_alerts(signals.topic_surges(counts, 3), 3.0).count() == 1


def test_registered_views(spark, rows, bars, tickers):
    edits = rows([("1", _at(-1), "B", ["a"])], EDIT)
    views.register_views(edits, bars, tickers, AS_OF)
    row = spark.sql("select * from country_map_roll where iso2 = 'B'").first()
    assert (row.events_10m, row.symbols_seen) == (1, 2)
