"""Bars, returns, the joined signal and the price questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import bars as B
from tidemark.operators.quality import bar_rules, with_reasons
from tidemark.operators.skew import at_latest, latest_per_key
from tidemark.plans import dashboard, signals, views
from tidemark.queries.registry import (
    ACTIVITY_HOUR,
    AS_OF,
    BARS,
    COUNTRY_RETURNS_HOUR,
    EDITS,
    RETURNS,
    TICKERS,
    query,
    with_,
)
from tidemark.sources import star

_BARS_AS_OF = "1998-06-01 00:00:00"

_ZONES = "[" + ", ".join(f"'{zone}'" for zone in star.ZONES) + "]"

LANDED = f"""
landed AS (
  SELECT 'S' || l_suppkey AS symbol, CAST(l_suppkey AS INTEGER) AS ticker_id,
         CASE l_returnflag || l_linestatus WHEN 'RO' THEN '1m' WHEN 'RF' THEN '5m' WHEN 'AO' THEN '1h'
              WHEN 'AF' THEN '1d' WHEN 'NO' THEN '30m' WHEN 'NF' THEN '3m' END AS "interval",
         l_shipdate + to_minutes(l_linenumber * 30) AS ts_local,
         l_extendedprice AS open, l_extendedprice * 1.02::DOUBLE AS high,
         l_extendedprice * (1 - 12 * l_discount) AS low,
         CASE WHEN l_tax <> 0 THEN l_extendedprice END AS close,
         CASE WHEN l_discount <> 0 THEN CAST(l_quantity AS BIGINT) END AS volume,
         l_orderkey, l_linenumber, l_partkey
  FROM lineitem
),
clocks AS (
  SELECT CAST(s_suppkey AS INTEGER) AS id, 'S' || s_suppkey AS symbol,
         coalesce(CASE WHEN s_nationkey < 24 THEN {_ZONES}[s_nationkey % 16 + 1] END, 'UTC') AS tz
  FROM supplier
)"""

_NORMAL = f"""
dated AS (
  SELECT clocks.id AS ticker_id, timezone('UTC', timezone(tz, ts_local)) AS ts_utc,
         "interval", open, high, low, close, volume
  FROM landed JOIN clocks USING (symbol)
),
normal AS (
  SELECT *, CASE WHEN "interval" IN ('1m', '2m', '5m', '15m', '30m', '1h')
                 THEN ts_utc < TIMESTAMP '{_BARS_AS_OF}' - INTERVAL 2 MINUTE ELSE true END AS is_final
  FROM dated
  WHERE ts_utc >= TIMESTAMP '{_BARS_AS_OF}' - CASE "interval"
      WHEN '1m' THEN INTERVAL 7 DAY WHEN '1h' THEN INTERVAL 730 DAY
      WHEN '1d' THEN INTERVAL 5 YEAR ELSE INTERVAL 60 DAY END
)"""


def _normal(spark: SparkSession, folder: str) -> DataFrame:
    return B.normalize_bars(
        star.landed_bars(spark, folder),
        star.exchange_tickers(spark, folder),
        _BARS_AS_OF,
        spread_by=["l_orderkey", "l_linenumber", "l_partkey"],
    )


@query(
    with_(LANDED, _NORMAL)
    + """SELECT ticker_id, ts_utc, "interval", open, round(high, 4) AS high, round(low, 4) AS low, close, volume, is_final
FROM normal"""
)
def normalize_bars(spark: SparkSession, folder: str) -> DataFrame:
    rows = _normal(spark, folder).withColumns(
        {"ts_utc": F.col("ts_utc").cast("timestamp_ntz"), "high": F.round("high", 4), "low": F.round("low", 4)}
    )
    return rows.drop("prepost", "source", "ingested_at")


@query(
    with_(LANDED, _NORMAL)
    + """SELECT "interval", is_final, count(*) AS bars FROM normal GROUP BY 1, 2"""
)
def bar_finality(spark: SparkSession, folder: str) -> DataFrame:
    return _normal(spark, folder).groupBy("interval", "is_final").agg(F.count(F.lit(1)).alias("bars"))


_CHECKED = """
checked AS (
  SELECT l_orderkey, l_linenumber, l_partkey, list_filter([
    CASE WHEN "interval" NOT IN ('1m', '2m', '5m', '15m', '30m', '1h', '1d') THEN 'interval not allowed' END,
    CASE WHEN low < 0 THEN 'low is negative' END,
    CASE WHEN count(*) OVER (PARTITION BY ticker_id, ts_local, "interval") > 1 THEN 'key is repeated' END,
    CASE WHEN s_suppkey IS NULL THEN 'ticker_id is unknown' END], lambda x: x IS NOT NULL) AS reasons
  FROM landed LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) ON s_suppkey = ticker_id
)"""


def _checked(spark: SparkSession, folder: str) -> DataFrame:
    landed = star.landed_bars(spark, folder).withColumn("ts_utc", F.col("ts_local"))
    known = star.table(spark, folder, "supplier").where("s_acctbal >= 0").select(F.col("s_suppkey").cast("int").alias("id"))
    return with_reasons(
        landed,
        bar_rules(),
        unique=B.BAR_KEY,
        references={"ticker_id": (known, "id")},
        spread_by=["l_orderkey", "l_linenumber", "l_partkey"],
    )


@query(
    with_(LANDED, _CHECKED)
    + """SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(reasons, '; ') AS reasons
FROM checked WHERE len(reasons) > 0"""
)
def validate_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rejected = _checked(spark, folder).where(F.size("reasons") > 0)
    return rejected.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("reasons", "; ").alias("reasons"))


@query(
    with_(LANDED, _CHECKED)
    + """SELECT reason, count(*) AS bars
FROM (SELECT unnest(CASE WHEN len(reasons) = 0 THEN ['good'] ELSE reasons END) AS reason FROM checked) GROUP BY 1"""
)
def validate_counts(spark: SparkSession, folder: str) -> DataFrame:
    reasons = F.when(F.size("reasons") == 0, F.array(F.lit("good"))).otherwise(F.col("reasons"))
    return (
        _checked(spark, folder)
        .select(F.explode(reasons).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("bars"))
    )


_BAR_VALUES = "ts_utc, open, round(high, 6) AS high, round(low, 6) AS low, close, volume, prepost, source"


def _rounded(bars: DataFrame) -> DataFrame:
    return bars.withColumns({"high": F.round("high", 6), "low": F.round("low", 6)})


@query(
    with_(BARS)
    + f"""SELECT ticker_id, {_BAR_VALUES}, "interval", ingested_at, is_final FROM (
SELECT DISTINCT ON (ticker_id) * FROM bars WHERE "interval" = '1m' ORDER BY ticker_id, ts_utc DESC)"""
)
def stock_latest(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(views.stock_latest(star.bars(spark, folder)))


@query(
    with_(BARS, TICKERS)
    + f"""SELECT symbol, name, exchange, currency, mic, tz, {_BAR_VALUES}, ingested_at, is_final
FROM bars JOIN tickers ON id = ticker_id
WHERE "interval" = '1m' AND (ticker_id, ts_utc) IN
  (SELECT (ticker_id, max(ts_utc)) FROM bars WHERE "interval" = '1m' GROUP BY ticker_id)"""
)
def stock_latest_enriched(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(views.stock_latest_enriched(star.bars(spark, folder), star.tickers(spark, folder)))


@query("""
SELECT DISTINCT ON (user_id) user_id, event_id, ts, value FROM events ORDER BY user_id, ts DESC, event_id DESC
""")
def latest_per_user(spark: SparkSession, folder: str) -> DataFrame:
    events = star.table(spark, folder, "events").select("user_id", "event_id", "ts", "value")
    return latest_per_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
WHERE (l_orderkey, l_shipdate) IN (SELECT (l_orderkey, max(l_shipdate)) FROM lineitem GROUP BY l_orderkey)
""")
def latest_semi(spark: SparkSession, folder: str) -> DataFrame:
    """All line items shipped on the last day of their order."""
    items = star.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return at_latest(items, ["l_orderkey"], "l_shipdate")


def _returns(spark: SparkSession, folder: str, max_gap: str | None = None) -> DataFrame:
    return views.symbol_return(
        star.bars(spark, folder), star.tickers(spark, folder), ties=["event_id"], max_gap=max_gap
    )


@query(with_(BARS, TICKERS, RETURNS) + "SELECT * FROM returns")
def symbol_return(spark: SparkSession, folder: str) -> DataFrame:
    return _returns(spark, folder)


@query(
    with_(BARS, TICKERS)
    + """SELECT ticker_id, ts_utc AS ts_minute_utc, event_id,
CASE WHEN lag(ts_utc) OVER w >= ts_utc - INTERVAL 12 HOUR THEN lag(close) OVER w END AS prev_close
FROM bars JOIN tickers ON id = ticker_id WHERE "interval" = '1m'
WINDOW w AS (PARTITION BY ticker_id ORDER BY ts_utc, event_id)"""
)
def symbol_return_max_gap(spark: SparkSession, folder: str) -> DataFrame:
    returns = _returns(spark, folder, max_gap="12 hours")
    return returns.select("ticker_id", "ts_minute_utc", "event_id", "prev_close")


def _country_returns(spark: SparkSession, folder: str, unit: str | None = "hour") -> DataFrame:
    return views.country_return_minute(_returns(spark, folder), unit)


def _activity(spark: SparkSession, folder: str) -> DataFrame:
    return views.country_minute(star.edits(spark, folder), "hour")


@query(
    with_(BARS, TICKERS, RETURNS, COUNTRY_RETURNS_HOUR)
    + "SELECT iso2, ts_minute_utc, round(avg_return_1m, 6) AS avg_return_1m, symbols_count FROM country_returns"
)
def country_return_hour(spark: SparkSession, folder: str) -> DataFrame:
    return _country_returns(spark, folder).withColumn("avg_return_1m", F.round("avg_return_1m", 6))


@query(
    with_(BARS, TICKERS, RETURNS, COUNTRY_RETURNS_HOUR.replace("date_trunc('hour', ts_minute_utc)", "ts_minute_utc"))
    + "SELECT iso2, ts_minute_utc, round(avg_return_1m, 6) AS avg_return_1m, symbols_count FROM country_returns"
)
def country_return_minute(spark: SparkSession, folder: str) -> DataFrame:
    """Bar times as they are, not truncated."""
    return _country_returns(spark, folder, None).withColumn("avg_return_1m", F.round("avg_return_1m", 6))


_SIGNALS = (EDITS, BARS, TICKERS, RETURNS, COUNTRY_RETURNS_HOUR, ACTIVITY_HOUR)


@query(
    with_(*_SIGNALS)
    + f""", recent AS (
  SELECT coalesce(r.iso2, w.iso2) AS iso2, coalesce(r.ts_minute_utc, w.ts_minute_utc) AS ts,
         coalesce(w.event_count, 0) AS event_count, avg_return_1m, symbols_count
  FROM country_returns r FULL OUTER JOIN activity w ON r.iso2 = w.iso2 AND r.ts_minute_utc = w.ts_minute_utc
  WHERE coalesce(r.ts_minute_utc, w.ts_minute_utc) >= TIMESTAMP '{AS_OF}' - INTERVAL 60 HOUR
)
SELECT iso2, max(ts) AS ts_latest_utc,
  CAST(sum(event_count) FILTER (WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 10 HOUR) AS BIGINT) AS events_10m,
  CAST(sum(event_count) FILTER (WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 30 HOUR) AS BIGINT) AS events_30m,
  round(avg(avg_return_1m) FILTER (WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 10 HOUR), 6) AS ret_avg_10m,
  round(avg(avg_return_1m) FILTER (WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 30 HOUR), 6) AS ret_avg_30m,
  max(symbols_count) AS symbols_seen
FROM recent GROUP BY iso2"""
)
def country_map_roll(spark: SparkSession, folder: str) -> DataFrame:
    """The signal with hours for minutes, as the events are sparse."""
    rolled = views.country_signal(
        star.edits(spark, folder), star.bars(spark, folder), star.tickers(spark, folder),
        AS_OF, ("10 hours", "30 hours", "60 hours"), "hour", ["event_id"],
    )
    return rolled.withColumns({c: F.round(c, 6) for c in ("ret_avg_10m", "ret_avg_30m")})


_PAIRS = """
, pairs AS (
  SELECT r.iso2, lag, coalesce(w.event_count, 0) AS x, r.avg_return_1m AS y
  FROM country_returns r, (SELECT CAST(unnest(range(-{steps}, {steps} + 1)) AS INTEGER) AS lag)
  LEFT JOIN activity w ON w.iso2 = r.iso2 AND w.ts_minute_utc = r.ts_minute_utc - to_hours(lag)
  WHERE r.avg_return_1m IS NOT NULL
)
SELECT iso2, {lag} count(*) AS pairs,
       round(covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0), 6) AS correlation
FROM pairs GROUP BY iso2, lag"""


@query(with_(*_SIGNALS) + _PAIRS.format(steps=0, lag=""))
def country_correlation(spark: SparkSession, folder: str) -> DataFrame:
    found = signals.country_correlation(_country_returns(spark, folder), _activity(spark, folder))
    return found.withColumn("correlation", F.round("correlation", 6))


@query(with_(*_SIGNALS) + _PAIRS.format(steps=3, lag="lag,"))
def lead_lag_corr(spark: SparkSession, folder: str) -> DataFrame:
    found = signals.lead_lag_correlation(_country_returns(spark, folder), _activity(spark, folder), 3, 3600)
    return found.withColumn("correlation", F.round("correlation", 6))


@query(
    with_(*_SIGNALS)
    + """SELECT a.iso2, a.ts_minute_utc, event_count, r.ts_minute_utc AS return_ts, round(avg_return_1m, 6) AS avg_return_1m
FROM activity a ASOF LEFT JOIN country_returns r ON a.iso2 = r.iso2 AND a.ts_minute_utc >= r.ts_minute_utc"""
)
def as_of_returns(spark: SparkSession, folder: str) -> DataFrame:
    found = signals.as_of_returns(_activity(spark, folder), _country_returns(spark, folder))
    return found.withColumn("avg_return_1m", F.round("avg_return_1m", 6))


_PRICE_MINUTES = 10 * 24 * 60
_SYMBOLS = ["Customer#000000003", "Customer#000000017", "Customer#000000042"]

_PRICES = f"""
prices AS (
  SELECT symbol, ts_utc, open, high, low, close, volume FROM bars JOIN tickers ON id = ticker_id
  WHERE "interval" = '1m' AND ts_utc >= TIMESTAMP '{AS_OF}' - INTERVAL {_PRICE_MINUTES} MINUTE
)"""
_PRICE_COLUMNS = "symbol, ts_utc, open, round(high, 6) AS high, round(low, 6) AS low, close, volume"


def _prices(spark: SparkSession, folder: str, symbols: list[str] | None = None) -> DataFrame:
    return dashboard.recent_prices(
        star.bars(spark, folder), star.tickers(spark, folder), AS_OF, _PRICE_MINUTES, symbols
    )


@query(with_(BARS, TICKERS, _PRICES) + f"SELECT {_PRICE_COLUMNS} FROM prices")
def recent_prices(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_prices(spark, folder))


@query(
    with_(BARS, TICKERS, _PRICES)
    + f"SELECT {_PRICE_COLUMNS} FROM prices WHERE symbol IN ('" + "', '".join(_SYMBOLS) + "')"
)
def recent_prices_of(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_prices(spark, folder, _SYMBOLS))


_CHANGES = """
firsts AS (
  SELECT ticker_id, arg_min(close, (ts_utc, event_id)) AS first FROM bars WHERE close IS NOT NULL GROUP BY ticker_id
),
changes AS (
  SELECT ticker_id, event_id, (low / nullif(first, 0) - 1) * 100 AS p_low,
         (high / nullif(first, 0) - 1) * 100 AS p_high, (close / nullif(first, 0) - 1) * 100 AS p_close
  FROM bars LEFT JOIN firsts USING (ticker_id)
)"""


def _changes(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.normalized_change(star.bars(spark, folder), "ticker_id", "ts_utc", ["event_id"])


@query(
    with_(BARS, _CHANGES)
    + """SELECT ticker_id, event_id, round(p_low, 6) AS p_low, round(p_high, 6) AS p_high, round(p_close, 6) AS p_close
FROM changes"""
)
def normalized_change(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("p_low", "p_high", "p_close")
    return _changes(spark, folder).select("ticker_id", "event_id", *[F.round(c, 6).alias(c) for c in columns])


@query(
    with_(BARS, TICKERS, _PRICES)
    + "SELECT round(min(low) * 0.99::DOUBLE, 6) AS y_min, round(max(high) * 1.01::DOUBLE, 6) AS y_max FROM prices"
)
def axis_bounds(spark: SparkSession, folder: str) -> DataFrame:
    bounds = dashboard.axis_bounds(_prices(spark, folder))
    return bounds.select(F.round("y_min", 6).alias("y_min"), F.round("y_max", 6).alias("y_max"))


@query(
    with_(BARS, _CHANGES)
    + "SELECT round(min(p_low) * 1.05::DOUBLE, 6) AS y_min, round(max(p_high) * 1.05::DOUBLE, 6) AS y_max FROM changes"
)
def change_bounds(spark: SparkSession, folder: str) -> DataFrame:
    bounds = dashboard.change_bounds(_changes(spark, folder))
    return bounds.select(F.round("y_min", 6).alias("y_min"), F.round("y_max", 6).alias("y_max"))
