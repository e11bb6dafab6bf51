"""Previous closes on a stream of bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.skew import fact_dim_join, latest_per_key, previous_values
from tidemark.sources.sinks import BATCH, read_stored, write_batch
from tidemark.streaming.batches import for_each_batch

KEY, TS = "ticker_id", "ts_utc"


def _place(ties: list[str]) -> Column:
    return F.struct(TS, *ties)


def batch_returns(batch: DataFrame, last: DataFrame, ties: list[str] | None = None) -> DataFrame:
    """Bars with their previous close, and ``late`` for those before their ticker's last bar.

    ``last`` has the columns of ``batch`` and one row per ticker. A late bar gets no
    previous close here; ``stored_returns`` works it out from the store.
    """
    ties = ties or []
    rows = batch.withColumn("_new", F.lit(True)).unionByName(last.withColumn("_new", F.lit(False)))
    last_place = last.select(KEY, _place(ties).alias("_last"))
    timed = fact_dim_join(rows, last_place, [KEY], "left", [KEY, TS, *ties])
    looked = previous_values(timed, [KEY], TS, {"prev_close": "close"}, ties)
    late = F.coalesce(_place(ties) < F.col("_last"), F.lit(False))
    return (
        looked.where("_new")
        .withColumn("late", late)
        .withColumn("prev_close", F.when(~F.col("late"), F.col("prev_close")))
        .drop("_new", "_last")
    )


def store_returns(
    bars: DataFrame, path: str, checkpoint: str, ties: list[str] | None = None, **trigger
) -> StreamingQuery:
    """Store each bar with the previous close of its ticker.

    The batch is worked out once; the new last bars are taken from what was
    written. Two slots hold them in turn: a batch reads the slot of the batch before
    and overwrites the other, so replaying it gives the same result. An empty batch
    copies the slot. ``path`` belongs to one checkpoint.
    """
    schema = bars.schema

    def write(batch: DataFrame, name: str) -> None:
        number = int(name.rsplit("_", 1)[1])
        spark: SparkSession = batch.sparkSession
        before = read_stored(spark, f"{path}/last_{(number - 1) % 2}", schema)
        write_batch(batch_returns(batch, before, ties), f"{path}/returns", name)
        written = spark.read.schema(schema).parquet(f"{path}/returns/{BATCH}={name}")
        newest = [F.col(TS).desc(), *[F.col(t).desc() for t in ties or []]]
        last = latest_per_key(before.unionByName(written), [KEY], newest)
        last.write.mode("overwrite").parquet(f"{path}/last_{number % 2}")

    return for_each_batch(bars, write, checkpoint, skip_empty=False, **trigger)


def stored_returns(spark: SparkSession, path: str, ties: list[str] | None = None) -> DataFrame:
    """All stored bars with their exact previous close.

    The tickers that had a late bar are looked back at anew; all other rows are
    as they were stored.
    """
    rows = spark.read.parquet(f"{path}/returns").drop(BATCH)
    tickers = rows.where("late").select(KEY).distinct()
    again = previous_values(rows.drop("prev_close").join(tickers, KEY, "left_semi"), [KEY], TS, {"prev_close": "close"}, ties)
    return rows.join(tickers, KEY, "left_anti").unionByName(again.select(rows.columns))
