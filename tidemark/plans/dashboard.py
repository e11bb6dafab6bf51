"""The questions an analyst asks of events and prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import seeds
from tidemark.functions.numbers import marker_radius, percent_change
from tidemark.functions.text import sorted_text
from tidemark.functions.times import since
from tidemark.operators.skew import fact_dim_join

EVENT_COLUMNS = ["dt", "iso2", "wiki", "title", "user_text", "type", "added", "removed", "topics"]


def recent_events(
    edits: DataFrame,
    as_of: str,
    minutes: int = 60,
    topics: list[str] | None = None,
    cap: int | None = seeds.EVENT_CAP,
    ties: tuple[str, ...] = ("meta_id",),
) -> DataFrame:
    """The newest ``cap`` edits with a country, all without one; no topics means any topic.

    The cap is for the list that is shown. Figures are worked out with ``cap=None``.
    """
    rows = edits.where(since(edits, "dt", as_of, f"{minutes} minutes") & F.col("page_country_code").isNotNull())
    if topics:
        rows = rows.where(F.arrays_overlap(F.array_compact("topics"), F.array(*[F.lit(t) for t in topics])))
    shown = rows.withColumn("iso2", F.left("page_country_code", F.lit(2)))
    if cap is not None:
        shown = shown.orderBy(F.col("dt").desc_nulls_first(), *[F.col(t) for t in ties]).limit(cap)
    return shown.select(*EVENT_COLUMNS)


def recent_prices(
    bars: DataFrame,
    tickers: DataFrame,
    as_of: str,
    minutes: int = 60,
    symbols: list[str] | None = None,
    interval: str = "1m",
) -> DataFrame:
    """Prices in the window by time; no symbols means every symbol."""
    rows = bars.where((F.col("interval") == interval) & since(bars, "ts_utc", as_of, f"{minutes} minutes"))
    instruments = tickers.select(F.col("id").alias("ticker_id"), "symbol")
    if symbols:
        instruments = instruments.where(F.col("symbol").isin(symbols))
    return (
        fact_dim_join(rows, instruments, ["ticker_id"], spread_by=["ticker_id", "ts_utc"])
        .select("symbol", "ts_utc", "open", "high", "low", "close", "volume")
        .orderBy("ts_utc")
    )


def events_per_country(events: DataFrame) -> DataFrame:
    return events.where(F.col("iso2").isNotNull()).groupBy("iso2").agg(F.count(F.lit(1)).alias("count"))


def topics_per_country(events: DataFrame) -> DataFrame:
    """Distinct topics of each country as sorted text."""
    return (
        events.select("iso2", F.explode("topics").alias("topic"))
        .where(F.col("iso2").isNotNull() & F.col("topic").isNotNull())
        .groupBy("iso2")
        .agg(sorted_text(F.collect_set("topic")).alias("topics"))
    )


def country_markers(events: DataFrame, centroids: DataFrame) -> DataFrame:
    """One map marker per country that has a point."""
    return (
        events_per_country(events)
        .join(topics_per_country(events), "iso2", "left")
        .join(centroids, "iso2")
        .select(
            "iso2",
            "count",
            F.coalesce("topics", F.lit("")).alias("topics"),
            "lon",
            "lat",
            marker_radius(F.col("count")).alias("radius"),
        )
    )


def kpis(events: DataFrame) -> DataFrame:
    """Countries and events of a window."""
    return events.agg(F.countDistinct("iso2").alias("countries"), F.count(F.lit(1)).alias("events"))


def normalized_change(prices: DataFrame, key: str = "symbol", ts: str = "ts_utc", ties: list[str] | None = None) -> DataFrame:
    """Change in percent against the first close of each symbol that is not null."""
    ties = ties or []
    order = F.struct(ts, *ties) if ties else F.col(ts)
    first = (
        prices.where(F.col("close").isNotNull()).groupBy(key).agg(F.min_by("close", order).alias("_first"))
    )
    changes = {f"p_{c}": percent_change(F.col(c), F.col("_first")) for c in ("low", "high", "close")}
    return (
        fact_dim_join(prices, first, [key], "left", [key, ts, *ties])
        .withColumns(changes)
        .drop("_first")
    )


def axis_bounds(prices: DataFrame) -> DataFrame:
    """Lower and upper end of the price axis."""
    return prices.agg((F.min("low") * 0.99).alias("y_min"), (F.max("high") * 1.01).alias("y_max"))


def change_bounds(changes: DataFrame) -> DataFrame:
    """Lower and upper end of the percent axis."""
    return changes.agg((F.min("p_low") * 1.05).alias("y_min"), (F.max("p_high") * 1.05).alias("y_max"))
