"""Keeping the topic, instrument and country tables up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.upsert import insert_if_absent, overlay, upsert


def merge_topics(stored: DataFrame, topics: DataFrame) -> DataFrame:
    """Add topics by key; known ones take the new label, keywords and switch."""
    return upsert(stored, topics, ["key"], ["label", "keywords", "enabled"], [])


def replace_keywords(stored: DataFrame, lists: DataFrame) -> DataFrame:
    """Swap whole keyword lists; ``lists`` has key and keywords."""
    return overlay(stored, lists, ["key"], ["keywords"])


def merge_tickers(stored: DataFrame, tickers: DataFrame, as_of: str) -> DataFrame:
    """Add instruments by symbol; known ones keep their id and country.

    ``stored`` has ``last_updated``, which becomes ``as_of`` where a row changed.
    """
    changed = tickers.withColumn("last_updated", F.lit(as_of).cast(stored.schema["last_updated"].dataType))
    attributes = ["name", "exchange", "currency", "mic", "tz", "last_updated"]
    return upsert(stored, changed, ["symbol"], attributes, [])


def add_countries(stored: DataFrame, countries: DataFrame) -> DataFrame:
    """Add countries by code and leave known ones alone."""
    return insert_if_absent(stored, countries, ["iso2"])


def assign_countries(tickers: DataFrame, mapping: DataFrame) -> DataFrame:
    """Set the country of the symbols in ``mapping`` (symbol, iso2)."""
    return overlay(tickers, mapping, ["symbol"], ["iso2"])


def unknown_countries(tickers: DataFrame, countries: DataFrame) -> DataFrame:
    """Instruments whose country code is not in the country table."""
    return tickers.where(F.col("iso2").isNotNull()).join(countries.select("iso2"), "iso2", "left_anti")
