"""Feed events to stored, tagged edits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.articles import edit_rows, mark_articles, with_country
from tidemark.operators.dedup import one_per_id, split_keyless
from tidemark.operators.geo import resolve_country
from tidemark.operators.topics import keyword_pairs, tag_topics
from tidemark.sources.edits import parse_edits, parse_raw_edits
from tidemark.sources.sinks import as_messages, write_batch, write_edits
from tidemark.streaming.batches import counted, for_each_batch, log_counts


Report = Callable[[str, dict[str, int]], None]


def tagged_edits(rows: DataFrame, topics: DataFrame, **options) -> DataFrame:
    """Flat rows to edits with a country and at least one topic, one per id.

    Repeated ids are reduced first, so that a row's topics are its own.
    """
    return tag_topics(one_per_id(with_country(rows)), keyword_pairs(topics), **options)


def enriched_events(feed: DataFrame, page_entity: DataFrame, sitelink: DataFrame) -> DataFrame:
    """Raw event text to events with a country or a drop reason.

    The two page tables come from ``place_pages``.
    """
    return resolve_country(mark_articles(parse_raw_edits(feed)), page_entity, sitelink, ["raw"])


def store_edits(
    feed: DataFrame,
    topics: Callable[[], DataFrame],
    path: str,
    checkpoint: str,
    same_date: bool = False,
    ingested_at: Column | None = None,
    quarantine: str | None = None,
    report: Report = log_counts,
    **options,
) -> StreamingQuery:
    """Store a stream of enriched events, each id once.

    ``topics`` is called for every micro-batch, so changes to the dictionary
    take effect without a restart. ``ingested_at`` stamps the rows, for example
    with ``current_timestamp()``. ``report`` gets the counts of each batch. Events
    without an id can't be stored once; ``quarantine`` names a folder that takes them.
    """

    def write(batch: DataFrame, name: str) -> None:
        rows, counts = counted(
            edit_rows(parse_edits(batch)),
            no_id=F.col("meta_id").isNull(),
            no_time=F.col("dt").isNull(),
            no_country=F.col("page_country_code").isNull(),
        )
        tagged = tagged_edits(rows, topics())
        if ingested_at is not None:
            tagged = tagged.withColumn("ingested_at", ingested_at)
        write_edits(tagged, path, name, same_date=same_date)
        if quarantine is not None:
            write_batch(split_keyless(edit_rows(parse_edits(batch)))[1], quarantine, name)
        report(name, counts.get)

    return for_each_batch(feed, write, checkpoint, **options)


def enrich_stream(
    feed: DataFrame,
    pages: Callable[[], tuple[DataFrame, DataFrame]],
    path: str,
    checkpoint: str,
    report: Report = log_counts,
    **options,
) -> StreamingQuery:
    """Enrich raw events and store the kept ones as message text.

    ``pages`` gives the placed page entities and site links, for every
    micro-batch anew. ``report`` gets events seen and kept of each batch.
    """

    def write(batch: DataFrame, name: str) -> None:
        kept = F.col("skip_reason").isNull()
        events, counts = counted(enriched_events(batch, *pages()), kept=kept)
        write_batch(as_messages(events.where(kept).drop("raw", "skip_reason", "ns")), path, name)
        report(name, counts.get)

    return for_each_batch(feed, write, checkpoint, **options)
