"""Streams over the table files, run until all is read, then read back.

Each run writes below the shared folder in a folder of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import sorted_text
from tidemark.operators import geo
from tidemark.plans import views
from tidemark.queries.edits import BASELINE, ENTITIES, PLACED, SURGES
from tidemark.queries.registry import (
    ACTIVITY_HOUR,
    BARS,
    COUNTRY_RETURNS_HOUR,
    EDITS,
    RETURNS,
    TICKERS,
    query,
    with_,
)
from tidemark.session import run_dir
from tidemark.sources import star
from tidemark.sources.edits import messages, parse_edits
from tidemark.streaming import edits as stream_edits
from tidemark.streaming import finals
from tidemark.streaming import prices as stream_prices
from tidemark.streaming import windows

_TOPICS = {"attention": ["click", "VIEW"], "trade": ["purchase"], "sixty-nine": ["69"]}


@query("""
SELECT CAST(event_id AS VARCHAR) AS meta_id, date_trunc('second', ts) AS dt,
       lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS page_country_code,
       array_to_string(list_filter([
         CASE WHEN event_type IN ('click', 'view') THEN 'attention' END,
         CASE WHEN json_extract_string(props, '$.k') = '69' OR user_id = 69 THEN 'sixty-nine' END,
         CASE WHEN event_type = 'purchase' THEN 'trade' END], lambda x: x IS NOT NULL), ', ') AS topics
FROM events JOIN customer ON c_custkey = user_id
WHERE event_type IN ('click', 'view', 'purchase') OR json_extract_string(props, '$.k') = '69' OR user_id = 69
""")
def stream_edits_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Enriched text with repeats, tagged and stored once per id."""
    home = run_dir(spark, "edits")
    feed = star.enriched_feed(spark, folder, star.table_stream(spark, folder, "events"))

    def topics() -> DataFrame:
        rows = [(key, key, True, words) for key, words in _TOPICS.items()]
        return spark.createDataFrame(rows, "key string, label string, enabled boolean, keywords array<string>")

    stream_edits.store_edits(feed, topics, f"{home}/stored", f"{home}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{home}/stored").select(
        "meta_id", F.col("dt").cast("timestamp_ntz").alias("dt"), "page_country_code", sorted_text(F.col("topics")).alias("topics")
    )


@query(
    with_(ENTITIES, PLACED)
    + """SELECT meta_id, page_qid, page_country_qid, page_country_code, geo_method, geo_confidence
FROM placed WHERE skip_reason IS NULL"""
)
def stream_enriched_events(spark: SparkSession, folder: str) -> DataFrame:
    """The raw feed with countries added, stored as message text and read back."""
    home = run_dir(spark, "enriched")
    countries = geo.entity_countries(star.claims(spark, folder))
    pages = (
        geo.place_pages(star.page_entities(spark, folder), countries),
        geo.place_pages(star.sitelinks(spark, folder), countries),
    )
    feed = star.feed(spark, folder, star.table_stream(spark, folder, "events"))
    stream_edits.enrich_stream(feed, lambda: pages, f"{home}/out", f"{home}/checkpoint").awaitTermination()
    sent = parse_edits(spark.read.parquet(f"{home}/out"))
    return sent.select(F.col("meta.id").alias("meta_id"), *geo.GEO_COLUMNS)


@query(
    with_(ENTITIES, PLACED)
    + """SELECT date_trunc('minute', ts) AS ts_minute_utc, page_country_code AS iso2, CAST(count(*) AS INTEGER) AS event_count
FROM placed JOIN events ON CAST(event_id AS VARCHAR) = meta_id
WHERE skip_reason IS NULL AND event_type IN ('click', 'view', 'purchase') GROUP BY 1, 2"""
)
def stream_feed_to_minutes(spark: SparkSession, folder: str) -> DataFrame:
    """End to end: a feed of two kinds, placed, sent as text, tagged, stored once and counted per minute."""
    home = run_dir(spark, "pipeline")
    countries = geo.entity_countries(star.claims(spark, folder))
    pages = (
        geo.place_pages(star.page_entities(spark, folder), countries),
        geo.place_pages(star.sitelinks(spark, folder), countries),
    )
    feed = star.feed(spark, folder, star.table_stream(spark, folder, "events"))
    kinds = feed.withColumn("kind", F.explode(F.array(F.lit("message"), F.lit("ping"))))
    stream_edits.enrich_stream(
        messages(kinds).select("value"), lambda: pages, f"{home}/sent", f"{home}/sent_ck"
    ).awaitTermination()
    sent = spark.readStream.schema("value string, batch_id string").parquet(f"{home}/sent").select("value")

    def topics() -> DataFrame:
        rows = [("attention", "Attention", True, ["click", "VIEW"]), ("trade", "Trade", True, ["purchase"])]
        return spark.createDataFrame(rows, "key string, label string, enabled boolean, keywords array<string>")

    stream_edits.store_edits(
        sent, topics, f"{home}/stored", f"{home}/stored_ck", quarantine=f"{home}/keyless"
    ).awaitTermination()
    counts = views.country_minute(spark.read.parquet(f"{home}/stored"))
    return counts.select(F.col("ts_minute_utc").cast("timestamp_ntz").alias("ts_minute_utc"), "iso2", "event_count")


def _edit_stream(spark: SparkSession, folder: str) -> DataFrame:
    edits = star.edits(spark, folder, star.table_stream(spark, folder, "events"))
    return edits.withColumn("dt", F.col("dt").cast("timestamp"))


@query(
    with_(EDITS)
    + """SELECT date_trunc('minute', dt) AS ts_minute_utc, page_country_code AS iso2, CAST(count(*) AS INTEGER) AS event_count
FROM edits WHERE page_country_code IS NOT NULL AND len(topics) > 0 GROUP BY 1, 2"""
)
def stream_country_minute(spark: SparkSession, folder: str) -> DataFrame:
    home = run_dir(spark, "counts")
    windows.store_sums(_edit_stream(spark, folder), home, f"{home}/checkpoint", windows.country_counts).awaitTermination()
    return windows.stored_counts(spark, home).withColumn("ts_minute_utc", F.col("ts_minute_utc").cast("timestamp_ntz"))


@query(
    with_(EDITS)
    + """SELECT date_trunc('hour', dt) - to_hours(back) AS ts_minute_utc, page_country_code AS iso2,
CAST(count(*) AS INTEGER) AS event_count
FROM edits, (SELECT unnest(range(0, 3)) AS back)
WHERE page_country_code IS NOT NULL AND len(topics) > 0 GROUP BY 1, 2"""
)
def stream_rolling_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of three hours, a new one every hour."""
    home = run_dir(spark, "rolling")
    panes = lambda edits: windows.country_counts(edits, "1 hour")
    windows.store_sums(_edit_stream(spark, folder), home, f"{home}/checkpoint", panes).awaitTermination()
    return _rolling(spark, home, 3 * 3600, 3600)


def _rolling(spark: SparkSession, home: str, length: int, slide: int) -> DataFrame:
    rows = windows.rolling_counts(windows.stored_counts(spark, home), length, slide)
    return rows.select(
        F.col("ts_minute_utc").cast("timestamp_ntz").alias("ts_minute_utc"), "iso2", F.col("event_count").cast("int").alias("event_count")
    )


@query(
    with_(EDITS)
    + """SELECT date_trunc('minute', dt) - to_minutes(back) AS ts_minute_utc, page_country_code AS iso2,
CAST(count(*) AS INTEGER) AS event_count
FROM edits, (SELECT unnest(range(0, 30)) AS back)
WHERE page_country_code IS NOT NULL AND len(topics) > 0 GROUP BY 1, 2"""
)
def stream_rolling_half_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of thirty minutes, a new one every minute, from one-minute panes."""
    home = run_dir(spark, "half-hours")
    windows.store_sums(_edit_stream(spark, folder), home, f"{home}/checkpoint", windows.country_counts).awaitTermination()
    return _rolling(spark, home, 30 * 60, 60)


@query(
    with_(BARS)
    + """SELECT ticker_id, ts_utc, event_id, close, lag(close) OVER (PARTITION BY ticker_id ORDER BY ts_utc, event_id) AS prev_close
FROM bars WHERE "interval" = '1m'"""
)
def stream_previous_close(spark: SparkSession, folder: str) -> DataFrame:
    home = run_dir(spark, "returns")
    bars = star.bars(spark, folder, star.table_stream(spark, folder, "events")).where("interval = '1m'")
    rows = bars.select("ticker_id", "ts_utc", "event_id", "close")
    stream_prices.store_returns(rows, home, f"{home}/checkpoint", ["event_id"]).awaitTermination()
    found = stream_prices.stored_returns(spark, home, ["event_id"])
    return found.select("ticker_id", "ts_utc", "event_id", "close", "prev_close")


@query(
    with_(EDITS, SURGES)
    + """SELECT topic, step, event_count, round((event_count - baseline_mean) / nullif(baseline_stddev, 0), 6) AS score
FROM surges WHERE present AND (event_count - baseline_mean) / nullif(baseline_stddev, 0) >= 2"""
)
def stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    home = run_dir(spark, "alerts")
    windows.store_alerts(_edit_stream(spark, folder), home, f"{home}/checkpoint", 3600, BASELINE).awaitTermination()
    alerts = windows.stored_alerts(spark, home, 2.0)
    return alerts.select("topic", "step", "event_count", F.round("score", 6).alias("score"))


_JOINED = (
    with_(EDITS, BARS, TICKERS, RETURNS, COUNTRY_RETURNS_HOUR, ACTIVITY_HOUR)
    + """SELECT coalesce(r.iso2, a.iso2) AS iso2, coalesce(r.ts_minute_utc, a.ts_minute_utc) AS ts_minute_utc,
coalesce(event_count, 0) AS event_count, round(avg_return_1m, 6) AS avg_return_1m, symbols_count
FROM country_returns r FULL OUTER JOIN activity a ON r.iso2 = a.iso2 AND r.ts_minute_utc = a.ts_minute_utc"""
)


def _both_streams(spark: SparkSession, folder: str, home: str) -> tuple[DataFrame, DataFrame]:
    """Edits, and returns that were stored before, as streams."""
    returns = views.symbol_return(star.bars(spark, folder), star.tickers(spark, folder), ties=["event_id"])
    returns.select("iso2", F.col("ts_minute_utc").cast("timestamp").alias("ts_minute_utc"), "close", "prev_close").write.parquet(
        f"{home}/returns"
    )
    schema = spark.read.parquet(f"{home}/returns").schema
    moves = spark.readStream.schema(schema).option("maxFilesPerTrigger", str(star.FILES_PER_BATCH)).parquet(f"{home}/returns")
    return _edit_stream(spark, folder).select("dt", "page_country_code", "topics"), moves


def _rounded(joined: DataFrame) -> DataFrame:
    return joined.withColumns(
        {"ts_minute_utc": F.col("ts_minute_utc").cast("timestamp_ntz"), "avg_return_1m": F.round("avg_return_1m", 6)}
    )


@query(_JOINED)
def stream_joined_signals(spark: SparkSession, folder: str) -> DataFrame:
    """The stored sums of two streams joined by window."""
    home = run_dir(spark, "joined")
    edits, moves = _both_streams(spark, folder, home)
    runs = [
        windows.store_sums(edits, f"{home}/edits", f"{home}/edits_ck", lambda rows: windows.country_counts(rows, "1 hour")),
        windows.store_sums(
            moves, f"{home}/moves", f"{home}/moves_ck", lambda rows: windows.country_moves(rows, "1 hour"), ts="ts_minute_utc"
        ),
    ]
    for run in runs:
        run.awaitTermination()
    return _rounded(windows.joined_signals(spark, f"{home}/edits", f"{home}/moves"))


@query(_JOINED)
def stream_join_of_streams(spark: SparkSession, folder: str) -> DataFrame:
    """Two windowed streams with watermarks joined in one query; open windows come from its state."""
    home = run_dir(spark, "stream-join")
    edits, moves = _both_streams(spark, folder, home)
    # The tables' files are in no order of time: nothing is late within their span.
    finals.store_joined(edits, moves, home, f"{home}/checkpoint", "100 days", "1 hour").awaitTermination()
    return _rounded(finals.stored_joined(spark, home, f"{home}/checkpoint"))


@query(
    with_(EDITS)
    + """SELECT date_trunc('minute', dt) AS ts_minute_utc, page_country_code AS iso2, CAST(count(*) AS INTEGER) AS event_count
FROM edits WHERE page_country_code IS NOT NULL AND len(topics) > 0 GROUP BY 1, 2"""
)
def stream_final_minutes(spark: SparkSession, folder: str) -> DataFrame:
    """Windows given out once by a watermark, corrected for late edits, with the open ones from the state."""
    home = run_dir(spark, "finals")
    edits = _edit_stream(spark, folder).select("dt", "page_country_code", "topics")
    runs = [
        finals.store_finals(edits, home, f"{home}/checkpoint", "10 minutes"),
        windows.store_sums(edits, f"{home}/sums", f"{home}/sums_ck", windows.country_counts),
    ]
    for run in runs:
        run.awaitTermination()
    finals.store_corrections(spark, home, f"{home}/sums", f"{home}/checkpoint", "first_0")
    return finals.all_counts(spark, home, f"{home}/checkpoint").select(
        F.col("ts_minute_utc").cast("timestamp_ntz").alias("ts_minute_utc"), "iso2", F.col("event_count").cast("int").alias("event_count")
    )
