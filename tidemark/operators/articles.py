"""Which raw events are article edits, and why others are dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import seeds
from tidemark.functions.numbers import bytes_added, bytes_removed
from tidemark.functions.text import without_scheme
from tidemark.functions.times import parse_iso


def _filled(name: str) -> Column:
    return F.when(F.length(name) > 0, F.col(name))


def server() -> Column:
    """Host of the event: its name, else its address without the scheme."""
    return F.coalesce(_filled("server_name"), without_scheme(F.col("server_url")), F.lit(""))


def article_reason() -> Column:
    """The first reason that applies, null for an article edit.

    A null ``ns`` or ``namespace`` is taken as missing, and a missing one as 0.
    """
    namespace = F.coalesce(F.col("ns"), F.col("namespace"), F.lit(0))
    return (
        F.when(~F.endswith(server(), F.lit(seeds.ARTICLE_HOST_SUFFIX)), "non-wikipedia")
        .when(namespace != 0, "non-article")
        .when(_filled("title").isNull(), "no-title")
    )


def mark_articles(raw: DataFrame) -> DataFrame:
    return raw.withColumn("skip_reason", article_reason())


def drop_counts(marked: DataFrame) -> DataFrame:
    """Events per reason; those that are kept count under ``kept``."""
    reason = F.coalesce(F.col("skip_reason"), F.lit("kept")).alias("skip_reason")
    return marked.groupBy(reason).agg(F.count(F.lit(1)).alias("events"))


def edit_rows(events: DataFrame) -> DataFrame:
    """Enriched events as the flat stored row, without topics."""
    old, new = F.col("length.old"), F.col("length.new")
    same = ["wiki", "server_name", "server_url", "server_script_path", "title", "namespace", "type", "comment"]
    return events.select(
        F.col("meta.id").alias("meta_id"),
        parse_iso(F.col("meta.dt")).alias("dt"),
        F.col("timestamp").alias("timestamp_unix"),
        *same,
        F.col("user").alias("user_text"),
        "bot",
        "minor",
        "patrolled",
        old.alias("old_len"),
        new.alias("new_len"),
        bytes_added(old, new).alias("added"),
        bytes_removed(old, new).alias("removed"),
        "page_qid",
        "page_country_qid",
        "page_country_code",
        "geo_method",
        F.col("geo_confidence").cast("smallint").alias("geo_confidence"),
        # Filled by no step so far.
        F.lit(None).cast("bigint").alias("page_id"),
        F.lit(None).cast("double").alias("page_lat"),
        F.lit(None).cast("double").alias("page_lon"),
        F.lit(None).cast("string").alias("page_geohash"),
        "raw",
    )


def with_country(events: DataFrame) -> DataFrame:
    return events.where(F.col("page_country_code").isNotNull())
