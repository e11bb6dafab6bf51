"""Signals on top of the derived tables: correlation, surges, growth, as-of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import carried

from tidemark.functions.numbers import pearson


def _epoch(df: DataFrame, column: str) -> Column:
    return F.unix_seconds(F.col(column).cast("timestamp"))


def country_correlation(country_returns: DataFrame, activity: DataFrame) -> DataFrame:
    """Pearson correlation of edits and mean return over each country's times.

    Times with a return but no edits count as zero edits; times without a
    return take no part.
    """
    return lead_lag_correlation(country_returns, activity, 0, 1).drop("lag")


def lead_lag_correlation(country_returns: DataFrame, activity: DataFrame, steps: int, step_seconds: int) -> DataFrame:
    """The same with edits shifted by -steps..steps; a positive lag means edits lead."""
    returns = (
        country_returns.where(F.col("avg_return_1m").isNotNull())
        .select("iso2", _epoch(country_returns, "ts_minute_utc").alias("_at"), "avg_return_1m")
        .withColumn("lag", F.explode(F.sequence(F.lit(-steps), F.lit(steps))))
        .withColumn("_edits_at", F.col("_at") - F.col("lag") * step_seconds)
    )
    edits = activity.select("iso2", _epoch(activity, "ts_minute_utc").alias("_edits_at"), "event_count")
    pairs = returns.join(edits, ["iso2", "_edits_at"], "left").withColumn(
        "event_count", F.coalesce("event_count", F.lit(0))
    )
    return pairs.groupBy("iso2", "lag").agg(
        F.count(F.lit(1)).alias("pairs"),
        pearson(F.col("event_count"), F.col("avg_return_1m")).alias("correlation"),
    )


def topic_counts(edits: DataFrame, step_seconds: int, ts: str = "dt") -> DataFrame:
    """Edits per topic and time step; ``step`` numbers the steps since 1970."""
    return (
        edits.select(F.explode("topics").alias("topic"), F.floor(_epoch(edits, ts) / step_seconds).alias("step"))
        .groupBy("topic", "step")
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def topic_surges(counts: DataFrame, baseline_steps: int, first: str | None = None) -> DataFrame:
    """Each step's count against the mean and spread of the steps before it.

    Steps without edits count as zero from the topic's first step on. A step
    with no history has a null score, and so has one after a constant history.
    ``first`` names a column with the topic's first step, for counts that begin later.
    """
    by_topic = Window.partitionBy("topic").orderBy("step")
    trailing = by_topic.rangeBetween(-baseline_steps, -1)
    begin = F.col(first) if first else F.min("step").over(by_topic)
    seen = F.least(F.col("step") - begin, F.lit(baseline_steps))
    total = F.coalesce(F.sum("event_count").over(trailing), F.lit(0))
    squares = F.coalesce(F.sum(F.col("event_count") * F.col("event_count")).over(trailing), F.lit(0))
    known = counts.select(
        "topic", "step", "event_count", seen.alias("_seen"), total.alias("_sum"), squares.alias("_squares")
    )
    # seen * squares - sum^2 is whole-numbered, so a constant history gives 0.
    spread = F.sqrt(F.try_divide(F.col("_seen") * F.col("_squares") - F.col("_sum") * F.col("_sum"), F.col("_seen") * F.col("_seen")))
    mean = F.try_divide(F.col("_sum"), F.col("_seen"))
    return known.select(
        "topic",
        "step",
        "event_count",
        mean.alias("baseline_mean"),
        spread.alias("baseline_stddev"),
        F.try_divide(F.col("event_count") - mean, spread).alias("score"),
    )


def surge_alerts(surges: DataFrame, min_score: float, min_count: int = 1) -> DataFrame:
    return surges.where((F.col("score") >= min_score) & (F.col("event_count") >= min_count))


def page_growth(edits: DataFrame, step_seconds: int, top: int, page: str = "title", ts: str = "dt") -> DataFrame:
    """Pages whose edits grew most from one time step to the next."""
    counts = (
        edits.where(F.col(page).isNotNull())
        .groupBy(page, F.floor(_epoch(edits, ts) / step_seconds).alias("step"))
        .agg(F.count(F.lit(1)).alias("event_count"))
    )
    # A page's steps are as many as the time range has, however many edits.
    by_page = Window.partitionBy(page).orderBy("step")
    adjacent = F.lag("step").over(by_page) == F.col("step") - 1
    previous = F.when(adjacent, F.lag("event_count").over(by_page)).otherwise(0)
    grown = counts.withColumn("previous_count", previous).withColumn(
        "growth", F.col("event_count") - F.col("previous_count")
    )
    order = [F.desc("growth"), F.desc("event_count"), F.asc(page), F.asc("step")]
    return grown.orderBy(*order).limit(top)


def country_topic_counts(edits: DataFrame) -> DataFrame:
    """Edits per country and topic."""
    return (
        edits.where(F.col("page_country_code").isNotNull())
        .select(F.left("page_country_code", F.lit(2)).alias("iso2"), F.explode("topics").alias("topic"))
        .groupBy("iso2", "topic")
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def as_of_returns(activity: DataFrame, country_returns: DataFrame) -> DataFrame:
    """Each activity row with the last return of its country at or before its time.

    A country with very many rows is split by rows (see ``skew.carried``).
    """
    found = F.struct(F.col("ts_minute_utc").alias("return_ts"), "avg_return_1m").alias("_return")
    returns = country_returns.select("iso2", "ts_minute_utc", F.lit(None).cast("int").alias("event_count"), found, F.lit(0).alias("_order"))
    kind = returns.schema["_return"].dataType
    edits = activity.select("iso2", "ts_minute_utc", "event_count", F.lit(None).cast(kind).alias("_return"), F.lit(1).alias("_order"))
    last = carried(returns.unionByName(edits), ["iso2"], "ts_minute_utc", "_return", "_last", ["_order"])
    return last.where("_order = 1").select("iso2", "ts_minute_utc", "event_count", "_last.return_ts", "_last.avg_return_1m")
