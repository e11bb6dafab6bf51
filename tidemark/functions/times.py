"""Timestamps, windows relative to ``as_of`` and bar finality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import seeds
from tidemark.functions.text import let, lookup


def moment(df: DataFrame, column: str, as_of: str) -> Column:
    """``as_of`` as a literal of the column's own type, so filters push down."""
    return F.lit(as_of).cast(df.schema[column].dataType)


def since(df: DataFrame, column: str, as_of: str, lookback: str) -> Column:
    """Lower bound only and inclusive: rows after ``as_of`` pass as well."""
    return F.col(column) >= moment(df, column, as_of) - F.expr(f"INTERVAL {lookback}")


def truncated(df: DataFrame, column: str, unit: str) -> Column:
    """``date_trunc`` that keeps the column's timestamp type."""
    return F.date_trunc(unit, F.col(column)).cast(df.schema[column].dataType)


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to a timestamp, null where it cannot be read."""
    return F.try_to_timestamp(text)


def local_to_utc(wall: Column, zone: Column) -> Column:
    """Wall-clock time to UTC; a repeated hour is read as standard time."""
    wall = wall.cast("timestamp")

    def settled(first: Column) -> Column:
        later = first + F.expr("INTERVAL 1 HOUR")
        return F.when(F.from_utc_timestamp(later, zone) == wall, later).otherwise(first)

    return let(F.to_utc_timestamp(wall, zone), settled)


def is_final(interval: Column, start: Column, as_of: Column, strict: bool = False) -> Column:
    """Whether a bar is closed.

    By default an intraday bar counts as final two minutes after it starts and
    any other bar always; ``strict`` waits for the end of the bar instead.
    """
    if strict:
        length = {name: F.expr(f"INTERVAL {size}") for name, size in seeds.BAR_LENGTHS.items()}
        return F.coalesce(start + lookup(interval, length) <= as_of, F.lit(True))
    return F.when(
        interval.isin(seeds.INTRADAY_INTERVALS), start < as_of - F.expr(f"INTERVAL {seeds.FINAL_AFTER}")
    ).otherwise(F.lit(True))


def oldest_retained(interval: Column, as_of: Column) -> Column:
    """The earliest start a bar of this interval is kept with."""
    bounds = {name: as_of - F.expr(f"INTERVAL {age}") for name, age in seeds.RETENTION.items()}
    return F.coalesce(lookup(interval, bounds), as_of - F.expr(f"INTERVAL {seeds.RETENTION_OTHER}"))
