"""Windowed counts, alerts and the join of both signals, kept in stores of partial sums.

A micro-batch adds its own sums to a store and never waits for a watermark: a row
that comes late changes the sums it belongs to, however late it is. Readers add up
what is stored, so the answer does not depend on how the rows fell into batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.numbers import simple_return
from tidemark.operators.skew import latest_per_key
from tidemark.plans.signals import topic_surges
from tidemark.sources.levels import Levels, Run
from tidemark.sources.sinks import write_batch
from tidemark.sources.stored import BATCH, read_stored
from tidemark.streaming.batches import for_each_batch

def country_counts(edits: DataFrame, length: str = "1 minute", slide: str | None = None) -> DataFrame:
    """Edits per country and event-time window, overlapping ones with a ``slide``."""
    kept = edits.where(F.col("page_country_code").isNotNull() & (F.size("topics") > 0))
    return (
        kept.groupBy(F.window("dt", length, slide).alias("window"), F.left("page_country_code", F.lit(2)).alias("iso2"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(F.col("window.start").alias("ts_minute_utc"), "iso2", "event_count")
    )


def country_moves(returns: DataFrame, length: str = "1 minute") -> DataFrame:
    """Sums and counts of the returns per country and window, from iso2, ts_minute_utc, close and prev_close."""
    move = simple_return(F.col("close"), F.col("prev_close"))
    return (
        returns.where(F.col("iso2").isNotNull() & F.col("prev_close").isNotNull())
        .groupBy(F.window("ts_minute_utc", length).alias("window"), "iso2")
        .agg(F.sum(move).alias("move_sum"), F.count(move).alias("moves"), F.count(F.lit(1)).alias("symbols_count"))
        .select(F.col("window.start").alias("ts_minute_utc"), "iso2", "move_sum", "moves", "symbols_count")
    )


def topic_steps(edits: DataFrame, step_seconds: int) -> DataFrame:
    """Edits per topic and time step, numbered as in ``topic_counts``."""
    step = F.floor(F.unix_seconds("dt") / step_seconds)
    return edits.select(F.explode("topics").alias("topic"), step.alias("step")).groupBy("topic", "step").agg(
        F.count(F.lit(1)).alias("event_count")
    )


def rolling_counts(panes: DataFrame, length: int, slide: int) -> DataFrame:
    """Overlapping windows of ``length`` seconds, one every ``slide``, from counts per country and pane.

    Panes are windows without overlap whose length divides both. An edit is counted
    into its pane once; only the panes' sums go to the length / slide windows they are
    part of. Windows begin at multiples of ``slide`` since 1970.
    """
    at = F.unix_seconds("ts_minute_utc")
    last = at - F.pmod(at, F.lit(slide))
    starts = F.sequence(F.lit(0), F.lit(-(-length // slide) - 1))
    begin = last - F.col("_back") * slide
    copies = panes.withColumn("_back", F.explode(starts)).where(begin + length > at)
    return copies.groupBy(F.timestamp_seconds(begin).alias("ts_minute_utc"), "iso2").agg(F.sum("event_count").alias("event_count"))


def _merged_sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    values = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in values])


def _newest(runs: list[Run]) -> int | None:
    return max((r.note for r in runs if r.note is not None), default=None)


def _store_sums(
    batch: DataFrame, name: str, path: str, sums: Callable[[DataFrame], DataFrame], keys: list[str], ts: str, lateness: str
) -> Levels:
    """Store a micro-batch's sums and, from the same pass, one row of progress.

    A run's note is the newest time in it (microseconds). Full levels are merged.
    """
    spark = batch.sparkSession
    store = Levels(spark, f"{path}/sums")
    before = _newest([r for r in store.runs() if not r.holds(name)])
    observed = Observation()
    time = F.col(ts).cast("timestamp")
    late = F.lit(False) if before is None else time < F.timestamp_micros(F.lit(before)) - F.expr(f"INTERVAL {lateness}")
    rows = batch.observe(
        observed, F.count(F.lit(1)).alias("seen"), F.count_if(late).alias("late"), F.max(F.unix_micros(time)).alias("newest")
    )
    store.add(name, sums(rows), lambda: observed.get["newest"])
    found = observed.get
    row = spark.range(1).select(
        F.lit(found["seen"]).cast("bigint").alias("seen"),
        F.lit(found["late"]).cast("bigint").alias("late"),
        F.timestamp_micros(F.lit(found["newest"])).alias("newest"),
    )
    write_batch(row, f"{path}/progress", name)
    store.compact(lambda rows: _merged_sums(rows, keys), _newest)
    return store


WINDOW_KEYS = ("ts_minute_utc", "iso2")


def store_sums(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    sums: Callable[[DataFrame], DataFrame],
    ts: str = "dt",
    lateness: str = "1 hour",
    keys: tuple[str, ...] = WINDOW_KEYS,
    **trigger,
) -> StreamingQuery:
    """Add the sums of each micro-batch to a levelled store, so that n batches leave about log(n) runs.

    ``path``/progress has rows seen, rows late (more than ``lateness`` behind the
    newest row of the batches before) and the newest time of each batch. Late rows
    are counted there and summed like all others. ``keys`` are the columns that are
    no sums. ``path`` belongs to one checkpoint.
    """

    def write(batch: DataFrame, name: str) -> None:
        _store_sums(batch, name, path, sums, list(keys), ts, lateness)

    return for_each_batch(stream, write, checkpoint, **trigger)


def stored_sums(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """All that is stored, added up per key; sums keep their names."""
    return _merged_sums(Levels(spark, f"{path}/sums").read(), keys)


def stored_counts(spark: SparkSession, path: str, keys: list[str] | None = None) -> DataFrame:
    """Stored counts per country and window."""
    counts = stored_sums(spark, path, keys or ["ts_minute_utc", "iso2"])
    return counts.withColumn("event_count", F.col("event_count").cast("int"))


def joined_signals(spark: SparkSession, edits_path: str, moves_path: str) -> DataFrame:
    """Edits and mean return per country and window, from the stores of two streams."""
    keys = ["ts_minute_utc", "iso2"]
    moves = stored_sums(spark, moves_path, keys).select(
        *keys,
        F.try_divide("move_sum", "moves").alias("avg_return_1m"),
        F.col("symbols_count").cast("int").alias("symbols_count"),
    )
    return moves.join(stored_counts(spark, edits_path), keys, "full_outer").select(
        "iso2", "ts_minute_utc", F.coalesce("event_count", F.lit(0)).alias("event_count"), "avg_return_1m", "symbols_count"
    )


def store_alerts(
    edits: DataFrame, path: str, checkpoint: str, step_seconds: int, baseline_steps: int, lateness: str = "1 hour", **trigger
) -> StreamingQuery:
    """Score the steps that a micro-batch changes against the stored steps before them.

    Of the sums only steps from the batch's first one, less the baseline, are read;
    the first step of each topic lies in two slots that batches use in turn. A late
    row makes the steps after it be scored anew; ``stored_alerts`` reads the last
    score of each. ``path`` belongs to one checkpoint.
    """

    def write(batch: DataFrame, name: str) -> None:
        spark, number = batch.sparkSession, int(name.rsplit("_", 1)[1])
        steps = lambda rows: topic_steps(rows, step_seconds)
        store = _store_sums(batch, name, path, steps, ["topic", "step"], "dt", lateness)
        sums = store.read()
        # The newest batch is still a run of its own.
        own = store.read([r for r in store.runs() if r.level == 0 and r.holds(name)])
        fresh = own.groupBy("topic").agg(F.min("step").alias("since"))
        schema = T.StructType.fromDDL("topic string, first bigint")
        before = read_stored(spark, f"{path}/first_{(number - 1) % 2}", schema)
        firsts = before.unionByName(fresh.select("topic", F.col("since").alias("first"))).groupBy("topic")
        firsts.agg(F.min("first").alias("first")).write.mode("overwrite").parquet(f"{path}/first_{number % 2}")
        known = spark.read.schema(schema).parquet(f"{path}/first_{number % 2}")
        low = fresh.agg(F.min("since")).first()[0]
        if low is None:
            return
        counts = sums.where(F.col("step") >= low - baseline_steps).join(fresh, "topic")
        counts = counts.groupBy("topic", "step", "since").agg(F.sum("event_count").alias("event_count")).join(known, "topic")
        scored = topic_surges(counts, baseline_steps, first="first").join(fresh, "topic").where("step >= since").drop("since")
        write_batch(scored, f"{path}/scores", name)

    # Slots are passed on by every batch, so none is skipped.
    return for_each_batch(edits, write, checkpoint, skip_empty=False, **trigger)


def stored_alerts(spark: SparkSession, path: str, min_score: float, min_count: int = 1) -> DataFrame:
    """Steps whose last score is at least ``min_score``."""
    scores = latest_per_key(spark.read.parquet(f"{path}/scores"), ["topic", "step"], [F.col(BATCH).desc()]).drop(BATCH)
    return scores.where((F.col("score") >= min_score) & (F.col("event_count") >= min_count))
