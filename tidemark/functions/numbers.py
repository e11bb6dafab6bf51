"""Arithmetic that stays null instead of failing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import seeds


def bytes_added(old: Column, new: Column) -> Column:
    """Growth, never negative; zero where a length is missing."""
    return F.greatest(new - old, F.lit(0))


def bytes_removed(old: Column, new: Column) -> Column:
    return F.greatest(old - new, F.lit(0))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def simple_return(close: Column, previous: Column) -> Column:
    """Relative change; null on a zero or missing previous value."""
    return F.try_divide(close - previous, previous)


def percent_change(value: Column, base: Column) -> Column:
    return (F.try_divide(value, base) - 1) * 100


def marker_radius(count: Column) -> Column:
    return F.least(F.lit(seeds.RADIUS_BASE) + F.lit(seeds.RADIUS_STEP) * count, F.lit(seeds.RADIUS_MAX))


def pearson(x: Column, y: Column) -> Column:
    """Correlation aggregate over pairs without null; null if one side is constant."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x).cast("double"), F.when(both, y).cast("double")
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
