"""Windows that are given out once, when the watermark has passed them.

``windows`` keeps sums that may change for ever; here a window's row is final when no
row younger than ``delay`` behind the newest can change it. Rows that come later still
are in the complete sums, and ``store_corrections`` takes the final row back and adds
the right one. Windows that are open when a query stops are read from its state, so
no made-up row is needed to close them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.numbers import simple_return
from tidemark.sources.sinks import write_batch
from tidemark.sources.stored import BATCH, read_stored
from tidemark.streaming.batches import for_each_batch
from tidemark.streaming.windows import WINDOW_KEYS, country_counts, stored_sums

COUNTS = "event_count bigint"
MOVES = "move_sum double, moves bigint, symbols_count bigint"
FINAL = f"ts_minute_utc timestamp, iso2 string, {COUNTS}, {BATCH} string"
JOINED = f"ts_minute_utc timestamp, iso2 string, {COUNTS}, {MOVES}, {BATCH} string"


def store_finals(edits: DataFrame, path: str, checkpoint: str, delay: str = "1 hour", length: str = "1 minute", **trigger) -> StreamingQuery:
    """Store the count of each country and window once, when the watermark has passed it."""
    counts = country_counts(edits.withWatermark("dt", delay), length)
    return for_each_batch(counts, lambda batch, name: write_batch(batch, f"{path}/final", name), checkpoint, **trigger)


def _aggregates(spark: SparkSession, checkpoint: str) -> list[int]:
    """The ids of a query's windowed aggregates, in the order of its sources."""
    operators = spark.read.format("state-metadata").load(checkpoint).where("operatorName = 'stateStoreSave'")
    return sorted(r[0] for r in operators.select("operatorId").distinct().collect())


def _open(spark: SparkSession, checkpoint: str, operator: int, values: str) -> DataFrame:
    """Window start, country and values in the state of one aggregate."""
    state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    named = F.col("value").cast(f"struct<{', '.join(v.replace(' ', ':') for v in values.split(', '))}>").alias("v")
    # The key's second field is the country, whatever its expression was called.
    country = state.schema["key"].dataType.names[1]
    return state.select(F.col("key.window.start").alias("ts_minute_utc"), F.col(f"key.`{country}`").alias("iso2"), named).select(
        *WINDOW_KEYS, "v.*"
    )


def open_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Counts of the windows that a query of ``store_finals`` has not given out yet, as of its last batch."""
    return _open(spark, checkpoint, _aggregates(spark, checkpoint)[0], COUNTS)


def corrected(spark: SparkSession, path: str) -> DataFrame:
    """Final rows with all corrections applied; ``rows`` is 1 for every window that stands."""
    final = read_stored(spark, f"{path}/final", FINAL).select(*WINDOW_KEYS, F.lit(1).alias("sign"), "event_count")
    changes = read_stored(spark, f"{path}/corrections", f"sign int, {FINAL}").select(*WINDOW_KEYS, "sign", "event_count")
    signed = final.unionByName(changes).groupBy(*WINDOW_KEYS)
    return signed.agg(F.sum("sign").alias("rows"), F.sum(F.col("sign") * F.col("event_count")).alias("event_count"))


def store_corrections(spark: SparkSession, path: str, sums: str, checkpoint: str, name: str) -> DataFrame:
    """Retract-and-add rows for the closed windows whose complete sums differ from what was given out.

    ``sums`` is the store of ``windows.store_sums`` over the same edits, ``checkpoint``
    that of ``store_finals``. A window no row of which came in time is only added. The
    rows are stored under ``name``; without late rows since the last call there are none.
    """
    given = corrected(spark, path).where("rows > 0").select(*WINDOW_KEYS, F.col("event_count").alias("_given"))
    closed = stored_sums(spark, sums, list(WINDOW_KEYS)).join(open_counts(spark, checkpoint), list(WINDOW_KEYS), "left_anti")
    differing = closed.join(given, list(WINDOW_KEYS), "left").where(~F.col("event_count").eqNullSafe(F.col("_given")))
    signed = F.filter(
        F.array(
            F.struct(F.lit(-1).alias("sign"), F.col("_given").alias("event_count")),
            F.struct(F.lit(1).alias("sign"), F.col("event_count").alias("event_count")),
        ),
        lambda r: r.event_count.isNotNull(),
    )
    write_batch(differing.select(*WINDOW_KEYS, F.inline(signed)), f"{path}/corrections", name)
    return read_stored(spark, f"{path}/corrections", f"sign int, {FINAL}").where(F.col(BATCH) == name).drop(BATCH)


def all_counts(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """Corrected final rows and the windows still open: every window once."""
    final = corrected(spark, path).where("rows > 0").drop("rows")
    return final.withColumn("final", F.lit(True)).unionByName(open_counts(spark, checkpoint).withColumn("final", F.lit(False)))


def _windowed(rows: DataFrame, ts: str, delay: str, length: str, country: Callable[[], object]) -> DataFrame:
    return rows.withWatermark(ts, delay).groupBy(F.window(ts, length).alias("window"), country().alias("iso2"))


def store_joined(
    edits: DataFrame, returns: DataFrame, path: str, checkpoint: str, delay: str = "1 hour", length: str = "1 minute", **trigger
) -> StreamingQuery:
    """Join two streams by country and window, each side's window when the watermark has passed it.

    ``returns`` has iso2, ts_minute_utc, close and prev_close. Both inputs have their
    own watermark, and the older one holds; sides that meet nothing are given out
    alone. State holds the windows between watermark and newest row.
    """
    kept = edits.where(F.col("page_country_code").isNotNull() & (F.size("topics") > 0))
    counts = _windowed(kept, "dt", delay, length, lambda: F.left("page_country_code", F.lit(2))).agg(
        F.count(F.lit(1)).alias("event_count")
    )
    move = simple_return(F.col("close"), F.col("prev_close"))
    known = returns.where(F.col("iso2").isNotNull() & F.col("prev_close").isNotNull())
    moves = _windowed(known, "ts_minute_utc", delay, length, lambda: F.col("iso2")).agg(
        F.sum(move).alias("move_sum"), F.count(move).alias("moves"), F.count(F.lit(1)).alias("symbols_count")
    )
    joined = counts.join(moves, ["window", "iso2"], "full_outer").select(
        F.col("window.start").alias("ts_minute_utc"), "iso2", "event_count", "move_sum", "moves", "symbols_count"
    )
    return for_each_batch(joined, lambda batch, name: write_batch(batch, f"{path}/joined", name), checkpoint, **trigger)


def stored_joined(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """All windows: those given out, and those in the state of a query that has stopped."""
    keys = list(WINDOW_KEYS)
    given = read_stored(spark, f"{path}/joined", JOINED).drop(BATCH)
    left, right = _aggregates(spark, checkpoint)
    sides = []
    for side, operator, values in (("left", left, COUNTS), ("right", right, MOVES)):
        waiting = spark.read.format("statestore").option("operatorId", 0).option("joinSide", side).load(checkpoint)
        named = [f"value.{v.split()[0]}" for v in values.split(", ")]
        held = waiting.select(F.col("value.window.start").alias("ts_minute_utc"), "value.iso2", *named)
        # Rows that the join keeps for a match may have been given out with one.
        sides.append(held.join(given, keys, "left_anti").unionByName(_open(spark, checkpoint, operator, values)))
    rows = given.unionByName(sides[0].join(sides[1], keys, "full_outer").select(given.columns))
    return rows.select(
        "iso2",
        "ts_minute_utc",
        F.coalesce("event_count", F.lit(0)).cast("int").alias("event_count"),
        F.try_divide("move_sum", "moves").alias("avg_return_1m"),
        F.col("symbols_count").cast("int").alias("symbols_count"),
    )
