"""The derived tables: activity, latest prices, returns and the joined signal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import simple_return
from tidemark.functions.times import moment, since, truncated
from tidemark.operators.skew import at_latest, fact_dim_join, latest_per_key, previous_values

BAR_COLUMNS = [
    "ticker_id", "ts_utc", "open", "high", "low", "close", "volume",
    "prepost", "source", "interval", "ingested_at", "is_final",
]
INSTRUMENT_COLUMNS = ["symbol", "name", "exchange", "currency", "mic", "tz"]


def edits_enabled(edits: DataFrame) -> DataFrame:
    """Edits with a country and at least one topic."""
    return edits.where(F.col("page_country_code").isNotNull() & (F.size("topics") > 0))


def country_minute(edits: DataFrame, unit: str = "minute") -> DataFrame:
    """Edits per country and minute (or another ``date_trunc`` unit)."""
    return (
        edits_enabled(edits)
        .groupBy(
            truncated(edits, "dt", unit).alias("ts_minute_utc"),
            F.left("page_country_code", F.lit(2)).alias("iso2"),
        )
        .agg(F.count(F.lit(1)).cast("int").alias("event_count"))
    )


def stock_latest(bars: DataFrame, interval: str = "1m") -> DataFrame:
    """The newest bar of each ticker."""
    rows = bars.where(F.col("interval") == interval).select(*BAR_COLUMNS)
    return latest_per_key(rows, ["ticker_id"], [F.col("ts_utc").desc_nulls_first()])


def stock_latest_enriched(bars: DataFrame, tickers: DataFrame, interval: str = "1m") -> DataFrame:
    """Every bar at its ticker's newest time, with the instrument's attributes."""
    rows = bars.where(F.col("interval") == interval)
    instruments = tickers.select(F.col("id").alias("ticker_id"), *INSTRUMENT_COLUMNS)
    values = [c for c in BAR_COLUMNS if c not in ("ticker_id", "interval")]
    return (
        at_latest(rows, ["ticker_id"], "ts_utc")
        .join(instruments, "ticker_id")
        .select(*INSTRUMENT_COLUMNS, *values)
    )


def symbol_return(
    bars: DataFrame,
    tickers: DataFrame,
    interval: str = "1m",
    ties: list[str] | None = None,
    max_gap: str | None = None,
    start: Column | None = None,
) -> DataFrame:
    """Each bar's close beside the previous close of its ticker.

    ``ties`` orders bars of one ticker and time, if the table allows them. The
    previous bar may be any time ago; ``max_gap`` leaves out older ones. With a
    ``start`` only bars from then on are given: of the older ones just the last
    of each ticker is shuffled, and with both none older than the gap are read.
    """
    ties = ties or []
    rows = bars.where(F.col("interval") == interval).select("ticker_id", "ts_utc", "close", *ties)
    gap = F.expr(f"INTERVAL {max_gap}") if max_gap else None
    if start is not None and gap is not None:
        rows = rows.where(F.col("ts_utc") >= start - gap)
    if start is not None:
        newest = [F.col("ts_utc").desc(), *[F.col(t).desc() for t in ties]]
        before = latest_per_key(rows.where(F.col("ts_utc") < start), ["ticker_id"], newest)
        rows = rows.where(F.col("ts_utc") >= start).unionByName(before)
    looked = previous_values(rows, ["ticker_id"], "ts_utc", {"prev_close": "close", "prev_ts": "ts_utc"}, ties)
    if start is not None:
        looked = looked.where(F.col("ts_utc") >= start)
    if gap is not None:
        near = F.col("ts_utc") - gap <= F.col("prev_ts")
        looked = looked.withColumn("prev_close", F.when(near, F.col("prev_close")))
    instruments = tickers.select(F.col("id").alias("ticker_id"), "symbol", F.left("iso2", F.lit(2)).alias("iso2"))
    return fact_dim_join(looked, instruments, ["ticker_id"], spread_by=["ticker_id", "ts_utc", *ties]).select(
        "ticker_id", "symbol", "iso2", F.col("ts_utc").alias("ts_minute_utc"), "close", "prev_close", *ties
    )


def country_return_minute(returns: DataFrame, unit: str | None = None) -> DataFrame:
    """Mean return per country and time.

    ``symbols_count`` also counts rows whose return is null. Times are used as
    they are; ``unit`` truncates them first.
    """
    ts = F.col("ts_minute_utc") if unit is None else truncated(returns, "ts_minute_utc", unit)
    return (
        returns.where(F.col("iso2").isNotNull() & F.col("prev_close").isNotNull())
        .groupBy("iso2", ts.alias("ts_minute_utc"))
        .agg(
            F.avg(simple_return(F.col("close"), F.col("prev_close"))).alias("avg_return_1m"),
            F.count(F.lit(1)).cast("int").alias("symbols_count"),
        )
    )


def joined_signals(country_returns: DataFrame, activity: DataFrame) -> DataFrame:
    """Returns and activity side by side; a missing edit count reads as zero."""
    return (
        country_returns.join(activity, ["iso2", "ts_minute_utc"], "full_outer")
        .withColumn("event_count", F.coalesce("event_count", F.lit(0)))
        .select("iso2", "ts_minute_utc", "event_count", "avg_return_1m", "symbols_count")
    )


def country_map_roll(
    country_returns: DataFrame,
    activity: DataFrame,
    as_of: str,
    windows: tuple[str, str, str] = ("10 minutes", "30 minutes", "60 minutes"),
) -> DataFrame:
    """Edits and mean return of each country over the last short and long window.

    Both inputs are cut to the widest window before the join: its keys are the
    very columns the window is about. Windows have no upper end.
    """
    short, long, widest = windows
    recent = joined_signals(
        country_returns.where(since(country_returns, "ts_minute_utc", as_of, widest)),
        activity.where(since(activity, "ts_minute_utc", as_of, widest)),
    )

    def within(window: str, value: str):
        return F.when(since(recent, "ts_minute_utc", as_of, window), F.col(value))

    return recent.groupBy("iso2").agg(
        F.max("ts_minute_utc").alias("ts_latest_utc"),
        F.sum(within(short, "event_count")).alias("events_10m"),
        F.sum(within(long, "event_count")).alias("events_30m"),
        F.avg(within(short, "avg_return_1m")).alias("ret_avg_10m"),
        F.avg(within(long, "avg_return_1m")).alias("ret_avg_30m"),
        F.max("symbols_count").alias("symbols_seen"),
    )


def country_signal(
    edits: DataFrame,
    bars: DataFrame,
    tickers: DataFrame,
    as_of: str,
    windows: tuple[str, str, str] = ("10 minutes", "30 minutes", "60 minutes"),
    unit: str | None = None,
    ties: list[str] | None = None,
    max_gap: str | None = None,
) -> DataFrame:
    """``country_map_roll`` from the stored tables, reading edits of the window only.

    Truncating never makes a time later, so what is before the window before
    truncation is before it afterwards. ``unit`` is the step of both signals, by
    default the minute for edits and the bar times as they are.
    """
    widest = windows[2]
    start = moment(bars, "ts_utc", as_of) - F.expr(f"INTERVAL {widest}")
    returns = symbol_return(bars, tickers, ties=ties, max_gap=max_gap, start=start)
    recent = edits.where(since(edits, "dt", as_of, widest))
    return country_map_roll(
        country_return_minute(returns, unit), country_minute(recent, unit or "minute"), as_of, windows
    )


def register_views(edits: DataFrame, bars: DataFrame, tickers: DataFrame, as_of: str) -> None:
    """Make every derived table available to SQL under its function's name."""
    returns = symbol_return(bars, tickers)
    by_country = country_return_minute(returns)
    activity = country_minute(edits)
    views = {
        "edits": edits,
        "bars": bars,
        "tickers": tickers,
        "edits_enabled": edits_enabled(edits),
        "stock_latest": stock_latest(bars),
        "stock_latest_enriched": stock_latest_enriched(bars, tickers),
        "country_minute": activity,
        "symbol_return": returns,
        "country_return_minute": by_country,
        "country_map_roll": country_signal(edits, bars, tickers, as_of),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
