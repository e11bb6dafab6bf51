"""Price bars: from landed files to canonical rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import seeds
from tidemark.functions.numbers import nan_to_null
from tidemark.functions.times import is_final, local_to_utc, oldest_retained
from tidemark.operators.skew import fact_dim_join
from tidemark.operators.upsert import upsert

PRICES = ("open", "high", "low", "close")
BAR_KEY = ["ticker_id", "ts_utc", "interval"]
# The other columns keep the value they were first stored with.
BAR_UPDATES = [*PRICES, "volume", "is_final", "ingested_at"]


def normalize_bars(
    raw: DataFrame,
    tickers: DataFrame,
    as_of: str,
    intervals: list[str] | None = None,
    strict: bool = False,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Bars of known tickers within their retention, in UTC and with nulls for NaN.

    ``raw`` has symbol, interval, prices, volume and either ``ts`` (an instant)
    or ``ts_local`` (wall clock at the ticker's exchange).
    """
    now = F.lit(as_of).cast("timestamp")
    known = tickers.select("symbol", F.col("id").alias("_id"), F.coalesce("tz", F.lit("UTC")).alias("_tz"))
    wanted = raw if intervals is None else raw.where(F.col("interval").isin(intervals))
    instants = []
    if "ts" in raw.columns:
        instants.append(F.col("ts").cast("timestamp"))
    if "ts_local" in raw.columns:
        instants.append(local_to_utc(F.col("ts_local"), F.col("_tz")))
    oldest = oldest_retained(F.col("interval"), now)
    for column in ("ts", "ts_local"):
        # No clock is a day off, so this drops most old bars before the join.
        if column in raw.columns:
            early = F.col(column).cast("timestamp") < oldest - F.expr("INTERVAL 1 DAY")
            wanted = wanted.where(~F.coalesce(early, F.lit(False)))
    rows = fact_dim_join(wanted, known, ["symbol"], "inner", spread_by)
    # Generating the instant keeps the filter on it from working it out again.
    kept = F.filter(F.array(F.coalesce(*instants)), lambda start: start >= oldest)
    return rows.withColumn("ts_utc", F.explode(kept)).select(
        F.col("_id").alias("ticker_id"),
        "ts_utc",
        "interval",
        *[nan_to_null(F.col(c)).alias(c) for c in PRICES],
        nan_to_null(F.col("volume")).cast("bigint").alias("volume"),
        F.lit(False).alias("prepost"),
        F.lit(seeds.BAR_SOURCE).alias("source"),
        now.alias("ingested_at"),
        is_final(F.col("interval"), F.col("ts_utc"), now, strict).alias("is_final"),
    )


def upsert_bars(target: DataFrame, updates: DataFrame) -> DataFrame:
    return upsert(target, updates, BAR_KEY, BAR_UPDATES, ["ingested_at"])


def bar_defaults(as_of: str) -> dict[str, object]:
    """Values a stored bar takes where none is given."""
    return {
        "interval": "1m",
        "prepost": False,
        "source": seeds.BAR_SOURCE,
        "ingested_at": F.lit(as_of).cast("timestamp"),
        "is_final": True,
    }


def edit_defaults(as_of: str) -> dict[str, object]:
    return {
        "topics": F.array().cast("array<string>"),
        "ingested_at": F.lit(as_of).cast("timestamp"),
    }
