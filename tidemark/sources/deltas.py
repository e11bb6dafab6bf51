"""A keyed table that is written by adding updates and merged when it is read.

A batch stores one row per key it updates: the columns that only an insert sets, and
those that every update overwrites, each with the batch's number. Of all stored rows of
a key the oldest gives the former and the newest the latter, which may be worked out in
any order, so batches are merged level by level (see ``levels``) or on reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.skew import latest_per_key
from tidemark.operators.upsert import last_first
from tidemark.sources.levels import Levels, split_name


def _merged(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.min("_first_seq").alias("_first_seq"),
        F.min_by("_kept", "_first_seq").alias("_kept"),
        F.max("_last_seq").alias("_last_seq"),
        F.max_by("_updated", "_last_seq").alias("_updated"),
    )


def add_updates(
    updates: DataFrame, path: str, batch: str, keys: list[str], update_cols: list[str], order_by: list[str], fan: int = 8
) -> None:
    """Store a batch of updates and nothing else; full levels are merged.

    The result is that of ``upsert`` batch by batch: of several updates to a key in a
    batch the newest by ``order_by`` counts, of batches the later one, and a null in an
    update overwrites. Null keys are equal to each other. Batches are numbered by the
    end of their names; one that is replayed replaces what it had stored before.
    """
    kept = [c for c in updates.columns if c not in keys and c not in update_cols]
    number = split_name(batch)[1]
    newest = latest_per_key(updates, keys, last_first(updates, keys, order_by))

    def bound(columns: list[str]):
        return F.struct(*columns) if columns else F.struct(F.lit(None).cast("int").alias("_none"))

    rows = newest.select(
        *keys,
        F.lit(number).cast("bigint").alias("_first_seq"),
        bound(kept).alias("_kept"),
        F.lit(number).cast("bigint").alias("_last_seq"),
        bound(update_cols).alias("_updated"),
    )
    store = Levels(updates.sparkSession, path, fan)
    store.add(batch, rows)
    store.compact(lambda stored: _merged(stored, keys))


def merged_table(spark: SparkSession, path: str, keys: list[str], columns: list[str]) -> DataFrame:
    """The table as of the last batch, one row per key."""
    rows = _merged(Levels(spark, path).read(), keys)
    names = {name: part for part in ("_kept", "_updated") for name in rows.schema[part].dataType.names}
    return rows.select(*[F.col(c) if c in keys else F.col(f"{names[c]}.{c}") for c in columns])
