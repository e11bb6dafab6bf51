"""Dimension tables and the stored edits and bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, format: str = "parquet", path: str | None = None, **options: str) -> DataFrame:
    """A table from files, or over JDBC with ``url``, ``dbtable`` and so on.

    Filters and column choices made on the result reach both kinds of source.
    JDBC needs the database's driver on the class path.
    """
    reader = spark.read.format(format).options(**options)
    return reader.load(path) if path else reader.load()


def load_topics(spark: SparkSession, **source) -> DataFrame:
    return read_table(spark, **source).select("key", "label", "enabled", "keywords")


def load_tickers(spark: SparkSession, **source) -> DataFrame:
    """Tickers by symbol; one without a time zone is taken to be in UTC."""
    return read_table(spark, **source).withColumn("tz", F.coalesce("tz", F.lit("UTC"))).orderBy("symbol")


def append_jdbc(rows: DataFrame, url: str, table: str, **options: str) -> None:
    """Append to a database table; array and JSON columns go as the driver allows."""
    rows.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()
