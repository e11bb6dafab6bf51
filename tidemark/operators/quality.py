"""Row rules that say why a row is rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import seeds
from tidemark.operators.skew import fact_dim_join


def not_null(*columns: str) -> dict[str, Column]:
    return {f"{c} is null": F.col(c).isNull() for c in columns}


def one_of(column: str, allowed: list[str]) -> dict[str, Column]:
    return {f"{column} not allowed": F.col(column).isNotNull() & ~F.col(column).isin(allowed)}


def non_negative(*columns: str) -> dict[str, Column]:
    return {f"{c} is negative": F.coalesce(F.col(c) < 0, F.lit(False)) for c in columns}


def bar_rules() -> dict[str, Column]:
    return {
        **not_null("ticker_id", "ts_utc", "interval"),
        **one_of("interval", seeds.BAR_INTERVALS),
        **non_negative("open", "high", "low", "close", "volume"),
    }


def with_reasons(
    df: DataFrame,
    rules: dict[str, Column],
    unique: list[str] | None = None,
    references: dict[str, tuple[DataFrame, str]] | None = None,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Add ``reasons``: the names of the broken rules, empty for a good row.

    ``unique`` names key columns; every row of a repeated key is rejected.
    ``references`` maps a column to (table, column) it must occur in unless null.
    """
    checks = dict(rules)
    out = df
    if unique:
        repeated = df.groupBy(*unique).agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
        out = fact_dim_join(out, repeated, unique, "left", spread_by)
        checks["key is repeated"] = F.col("_copies").isNotNull()
    for column, (table, referenced) in (references or {}).items():
        found = f"_found_{column}"
        known = table.select(F.col(referenced).alias(column)).distinct().withColumn(found, F.lit(True))
        out = fact_dim_join(out, known, [column], "left", spread_by)
        checks[f"{column} is unknown"] = F.col(column).isNotNull() & F.col(found).isNull()
    reasons = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in checks.items()]))
    return out.select(*df.columns, reasons.alias("reasons"))


def validate(df: DataFrame, rules: dict[str, Column], **options) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their ``reasons``)."""
    checked = with_reasons(df, rules, **options)
    good = checked.where(F.size("reasons") == 0).drop("reasons")
    return good, checked.where(F.size("reasons") > 0)
