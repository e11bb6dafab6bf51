"""Joins and ordered look-backs that stay balanced when one key is hot.

A key is *hot* when it has more than ``group_rows`` rows. N rows hold at most
N / group_rows hot keys, and each is cut into about ``rows / group_rows`` parts.
Tables of hot keys and of their parts are joined without a hint: adaptive
execution broadcasts them while they are small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NULL_PARTS = 4096


@dataclass
class Limits:
    """When a side is broadcast, and when a table may hold hot keys at all."""

    group_rows: int = 1_000_000
    broadcast_bytes: int = 10 * 1024 * 1024
    # A table this small on disk holds no group that one task could not take.
    plain_bytes: int = 64 * 1024 * 1024


LIMITS = Limits()


def at_most(df: DataFrame, limit: int) -> bool:
    """Whether the planner's estimate is within ``limit``; no job is run.

    The planner counts file sizes and takes joins and groups as larger than they
    come out, so it errs on the safe side, but for rows that are generated.
    """
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
    except AttributeError:
        return False
    return int(str(plan.stats().sizeInBytes())) <= limit


def generates_rows(df: DataFrame) -> bool:
    try:
        return "Generate " in df._jdf.queryExecution().optimizedPlan().toString()
    except AttributeError:
        return True


def hot_keys(df: DataFrame, keys: list[str], limits: Limits | None = None) -> DataFrame:
    """Keys with too many rows for one task and the parts to cut each into."""
    group_rows = (limits or LIMITS).group_rows
    counted = df.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.where(F.col("_rows") > group_rows).select(
        *keys, F.ceil(F.col("_rows") / group_rows).cast("int").alias("_parts")
    )


def fact_dim_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "inner",
    spread_by: list[str] | None = None,
    limits: Limits | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join a large table to one whose ``on`` columns are unique.

    A dimension the planner estimates below the limit is broadcast, unless rows
    of it are generated, which the estimate leaves out. A larger one is shuffled;
    adaptive execution splits partitions that come out skewed, at no further read
    of the fact. Where that is not enough, ``hot`` names the hot keys, as
    ``hot_keys`` counts them once for all joins of a fact: those are cut into parts
    and only the matching dimension rows are repeated, once per part. ``spread_by``
    then names fact columns that tell rows of one key apart (by default all).
    ``how`` is any of inner, left, left_semi and left_anti.
    """
    limits = limits or LIMITS
    if at_most(dim, limits.broadcast_bytes) and not generates_rows(dim):
        return fact.join(F.broadcast(dim), on, how)
    if hot is None:
        return fact.join(dim, on, how)
    # The partition tells copies of a row apart and stays the same on a retry.
    spread = F.xxhash64(*(spread_by or fact.columns), F.spark_partition_id())
    keyless = F.lit(False)
    for key in on:
        keyless = keyless | F.col(key).isNull()
    # Rows without a key match nothing; they are only kept from piling up.
    part = (
        F.when(keyless, F.pmod(spread, F.lit(NULL_PARTS)))
        .when(F.col("_parts").isNotNull(), F.pmod(spread, F.col("_parts")))
        .otherwise(0)
        .cast("int")
    )
    left = fact.join(hot, on, "left").withColumn("_part", part).drop("_parts")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    right = dim.join(hot, on, "left").withColumn("_part", F.explode(copies)).drop("_parts")
    return left.join(right, [*on, "_part"], how).drop("_part")


# So many sampled places stand for the rows of one segment.
SEGMENT_SAMPLES = 64


def _segments(df: DataFrame, keys: list[str], place: Column, parts: list[str], limits: Limits) -> tuple[DataFrame, DataFrame]:
    """(``df`` with ``_seg``, the hot keys): hot keys cut into about ``group_rows`` rows each.

    The cuts are quantiles of a sample of each hot key's places, taken by the
    place's hash, so segments hold like numbers of rows however these lie in time.
    One read of the narrow columns counts and samples.
    """
    every = max(1, limits.group_rows // SEGMENT_SAMPLES)
    step = max(1, limits.group_rows // every)
    sampled = F.when(F.pmod(F.xxhash64(*parts), F.lit(every)) == 0, place)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.collect_set(sampled).alias("_places"))
    hot = counted.where(F.col("_rows") > limits.group_rows).select(*keys, F.sort_array("_places").alias("_places"))
    places = F.when(F.size("_places") > step, F.sequence(F.lit(step), F.size("_places") - 1, F.lit(step)))
    hot = hot.select(
        *keys, F.coalesce(F.transform(places, lambda i: F.get("_places", i)), F.slice("_places", 1, 0)).alias("_cuts")
    )
    # Places at a cut and after it belong to the next segment.
    segment = F.coalesce(F.size(F.filter("_cuts", lambda cut: cut <= place)), F.lit(0))
    return df.join(hot, keys, "left").withColumn("_seg", segment).drop("_cuts"), hot.drop("_cuts")


def previous_values(
    df: DataFrame,
    keys: list[str],
    ts: str,
    values: dict[str, str],
    ties: list[str] | None = None,
    limits: Limits | None = None,
) -> DataFrame:
    """``lag`` over ``keys`` in ``ts`` order that splits hot keys by rows.

    ``values`` maps each new column to the column it looks back at. Keys and
    ``ts`` must not be null. The first row of a segment takes the last row of the
    segment before it.
    """
    ties = ties or []
    limits = limits or LIMITS
    order = [F.col(ts), *[F.col(t) for t in ties]]
    if at_most(df, limits.plain_bytes):
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({new: F.lag(old).over(window) for new, old in values.items()})

    place = F.struct(ts, *ties)
    cut, hot = _segments(df, keys, place, [ts, *ties], limits)
    columns = list(dict.fromkeys(values.values()))
    ends = cut.join(hot, keys, "left_semi").groupBy(*keys, "_seg").agg(F.max_by(F.struct(*columns), place).alias("_end"))
    starts = ends.withColumn("_before", F.lag("_end").over(Window.partitionBy(*keys).orderBy("_seg"))).drop("_end")
    window = Window.partitionBy(*keys, "_seg").orderBy(*order)
    looked = cut.withColumns(
        {
            "_first": F.row_number().over(window) == 1,
            **{new: F.lag(old).over(window) for new, old in values.items()},
        }
    ).join(starts, [*keys, "_seg"], "left")
    filled = {
        new: F.when(F.col("_first"), F.col(f"_before.{old}")).otherwise(F.col(new))
        for new, old in values.items()
    }
    return looked.withColumns(filled).select(*df.columns, *values)


def carried(
    df: DataFrame, keys: list[str], ts: str, value: str, new: str, ties: list[str], limits: Limits | None = None
) -> DataFrame:
    """``df`` with ``new``: the last ``value`` that is not null at or before the row's place.

    Hot keys are split by rows as in ``previous_values``.
    """
    limits = limits or LIMITS
    order = [F.col(ts), *[F.col(t) for t in ties]]
    if at_most(df, limits.plain_bytes):
        return df.withColumn(new, F.last(value, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order)))
    place = F.struct(ts, *ties)
    cut, hot = _segments(df, keys, place, [ts, *ties], limits)
    known = F.when(F.col(value).isNotNull(), place)
    ends = cut.join(hot, keys, "left_semi").groupBy(*keys, "_seg").agg(F.max_by(value, known).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.withColumn("_before", F.last("_end", ignorenulls=True).over(before)).drop("_end")
    inside = F.last(value, ignorenulls=True).over(Window.partitionBy(*keys, "_seg").orderBy(*order))
    looked = cut.withColumn("_inside", inside).join(starts, [*keys, "_seg"], "left")
    return looked.withColumn(new, F.coalesce("_inside", "_before")).select(*df.columns, new)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``.

    The rank filter is also applied before the shuffle, so each task sends at
    most one row per key however many rows the key has.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def at_latest(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """All rows at the greatest ``ts`` of their key, ties included.

    Like ``latest_per_key`` this filters before the shuffle, where a semi join
    with the maxima would shuffle every row.
    """
    window = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    ranked = df.where(F.col(ts).isNotNull()).withColumn("_rank", F.rank().over(window))
    return ranked.where(F.col("_rank") == 1).drop("_rank")
