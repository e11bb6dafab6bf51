"""One row per event id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import latest_per_key


def split_keyless(edits: DataFrame, key: str = "meta_id") -> tuple[DataFrame, DataFrame]:
    """Rows with an id, and the rows to quarantine because they have none."""
    return edits.where(F.col(key).isNotNull()), edits.where(F.col(key).isNull())


def one_per_id(edits: DataFrame, key: str = "meta_id", ts: str = "dt", ties: tuple[str, ...] = ("raw",)) -> DataFrame:
    """The latest row of each id, chosen the same way on every run."""
    order = [F.col(ts).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]]
    return latest_per_key(edits.where(F.col(key).isNotNull()), [key], order)


def absent_from(rows: DataFrame, stored: DataFrame, key: str = "meta_id") -> DataFrame:
    """Rows whose id is not among the stored ones."""
    return rows.join(stored.select(key), key, "left_anti")
