"""Keyed inserts and updates as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import fact_dim_join, latest_per_key


def last_first(df: DataFrame, keys: list[str], order_by: list[str]) -> list[Column]:
    """Newest first by ``order_by``, then by every other column to be certain."""
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    return [F.col(c).desc_nulls_last() for c in [*order_by, *rest]]


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    update_cols: list[str],
    order_by: list[str],
) -> DataFrame:
    """Insert new keys; on known ones overwrite ``update_cols`` only.

    Of several updates to a key the newest by ``order_by`` counts. A null in an
    update overwrites. ``target`` must be unique in ``keys``; the result is.
    """
    newest = latest_per_key(updates.select(target.columns), keys, last_first(target, keys, order_by))
    old = target.select(F.lit(True).alias("_old"), F.struct(*target.columns).alias("_o"), *keys)
    new = newest.select(F.lit(True).alias("_new"), F.struct(*target.columns).alias("_n"), *keys)

    def merged(name: str) -> Column:
        before, after = F.col(f"_o.{name}"), F.col(f"_n.{name}")
        if name in update_cols:
            return F.when(F.col("_new"), after).otherwise(before).alias(name)
        return F.when(F.col("_old"), before).otherwise(after).alias(name)

    columns = [F.col(c) if c in keys else merged(c) for c in target.columns]
    return old.join(new, keys, "full_outer").select(*columns)


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """Add rows with new keys and leave known keys as they are."""
    order = [F.col(c).asc_nulls_last() for c in order_by or [c for c in rows.columns if c not in keys]]
    first = latest_per_key(rows.select(target.columns), keys, order or [F.lit(1)])
    return target.unionByName(first.join(target.select(*keys), keys, "left_anti"))


def overlay(target: DataFrame, changes: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Replace ``columns`` where ``changes`` has the key; rows are never added.

    ``changes`` must be unique in ``keys``.
    """
    patch = changes.select(*keys, F.struct(*columns).alias("_patch"))
    joined = fact_dim_join(target, patch, keys, "left")
    replaced = {
        c: F.when(F.col("_patch").isNotNull(), F.col(f"_patch.{c}")).otherwise(F.col(c)) for c in columns
    }
    return joined.withColumns(replaced).select(*target.columns)


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill missing columns and nulls with their defaults."""
    filled = {}
    for name, value in defaults.items():
        default = value if isinstance(value, Column) else F.lit(value)
        filled[name] = F.coalesce(F.col(name), default) if name in df.columns else default
    return df.withColumns(filled)
