"""Edit feeds: files or a Kafka topic, as a stream or as a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas


def kafka_options(
    servers: str, topic: str, starting_offsets: str = "latest", group: str | None = None, **more: str
) -> dict[str, str]:
    """Options of the Kafka source; lost offsets do not stop the query."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
        **more,
    }
    if group:
        options["kafka.group.id"] = group
    return options


def read_edit_stream(spark: SparkSession, format: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """A stream with the event text in ``value``.

    ``kafka`` takes ``kafka_options``; ``text`` reads JSON lines from ``path``.
    The Kafka source needs its connector on the class path.
    """
    reader = spark.readStream.format(format).options(**options)
    source = reader.load(path) if path else reader.load()
    return source.select(F.col("value").cast("string").alias("value"))


def read_edits(spark: SparkSession, format: str = "text", path: str | None = None, **options: str) -> DataFrame:
    """The batch twin of ``read_edit_stream``."""
    reader = spark.read.format(format).options(**options)
    source = reader.load(path) if path else reader.load()
    return source.select(F.col("value").cast("string").alias("value"))


def messages(feed: DataFrame, kind: str = "kind") -> DataFrame:
    """Rows of a feed that has several kinds of event, named in ``kind``."""
    return feed.where(F.col(kind) == "message")


def parse_edits(feed: DataFrame, schema: str = schemas.EDIT_EVENT) -> DataFrame:
    """Event text to columns; the text stays in ``raw``.

    Text that cannot be read gives a row of nulls, a field of the wrong type a
    null in that field. Generating the columns keeps later filters from parsing
    the text a second time.
    """
    event = F.from_json("value", schema)
    return feed.select(F.inline(F.array(event)), F.col("value").alias("raw"))


def parse_raw_edits(feed: DataFrame) -> DataFrame:
    """Events as they come from the feed; text that is no JSON object is left out."""

    def readable(event: Column) -> Column:
        # Only an event without these fields is looked at again.
        known = event.getField("title").isNotNull() | event.getField("server_name").isNotNull()
        return known | F.json_object_keys("value").isNotNull()

    events = F.filter(F.array(F.from_json("value", schemas.RAW_EDIT)), readable)
    return feed.where(F.length("value") > 0).select(F.inline(events), F.col("value").alias("raw"))


def rejected_count(feed: DataFrame) -> DataFrame:
    """How many rows ``parse_raw_edits`` leaves out."""
    unreadable = F.coalesce(F.length("value"), F.lit(0)) == 0
    unreadable = unreadable | F.json_object_keys("value").isNull()
    return feed.agg(F.count(F.when(unreadable, 1)).alias("rejected"))
