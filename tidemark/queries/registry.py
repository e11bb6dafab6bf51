"""Named queries over a folder of tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name; ``sql`` gives the same rows in DuckDB."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


# The derived tables of ``sources.star`` in SQL.
EDITS = """
edits AS (
  SELECT CAST(event_id AS VARCHAR) AS meta_id, ts AS dt, event_type || 'wiki' AS wiki,
         'User ' || user_id AS title, CAST(user_id AS VARCHAR) AS user_text,
         event_type AS type, props AS comment,
         greatest(CAST(trunc(value) AS INTEGER) - 50, 0) AS added,
         greatest(50 - CAST(trunc(value) AS INTEGER), 0) AS removed,
         list_filter([CASE WHEN value >= 1 THEN event_type END, CASE WHEN value >= 100 THEN 'large' END],
                     lambda x: x IS NOT NULL) AS topics,
         lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS page_country_code, event_id
  FROM events LEFT JOIN customer ON c_custkey = user_id
  WHERE event_type IN ('click', 'signup', 'error')
)"""

BARS = """
bars AS (
  SELECT CAST(user_id AS INTEGER) AS ticker_id, ts AS ts_utc,
         CASE event_type WHEN 'view' THEN '1m' WHEN 'purchase' THEN '1m' WHEN 'click' THEN '5m'
                         WHEN 'signup' THEN '1h' ELSE '1d' END AS "interval",
         value AS open, value * 1.01::DOUBLE AS high, value * 0.99::DOUBLE AS low,
         CASE WHEN value >= 0.5 THEN value END AS close, event_id AS volume,
         false AS prepost, 'yfinance' AS source, ts AS ingested_at, true AS is_final, event_id
  FROM events
)"""

TICKERS = """
tickers AS (
  SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS symbol, lower(c_name) AS name,
         c_mktsegment AS exchange, 'USD' AS currency, CAST(NULL AS VARCHAR) AS mic, 'UTC' AS tz,
         CASE WHEN c_acctbal >= 0 THEN lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS iso2
  FROM customer
)"""

RETURNS = """
returns AS (
  SELECT ticker_id, symbol, iso2, ts_utc AS ts_minute_utc, close,
         lag(close) OVER (PARTITION BY ticker_id ORDER BY ts_utc, event_id) AS prev_close, event_id
  FROM bars JOIN tickers ON id = ticker_id
  WHERE "interval" = '1m'
)"""

COUNTRY_RETURNS_HOUR = """
country_returns AS (
  SELECT iso2, date_trunc('hour', ts_minute_utc) AS ts_minute_utc,
         avg((close - prev_close) / nullif(prev_close, 0)) AS avg_return_1m,
         CAST(count(*) AS INTEGER) AS symbols_count
  FROM returns WHERE iso2 IS NOT NULL AND prev_close IS NOT NULL
  GROUP BY 1, 2
)"""

ACTIVITY_HOUR = """
activity AS (
  SELECT date_trunc('hour', dt) AS ts_minute_utc, page_country_code AS iso2,
         CAST(count(*) AS INTEGER) AS event_count
  FROM edits WHERE page_country_code IS NOT NULL AND len(topics) > 0
  GROUP BY 1, 2
)"""

AS_OF = "2024-01-30 00:00:00"


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"
