"""Topic tagging by exact keyword match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import seeds
from tidemark.functions import text as T
from tidemark.operators.skew import fact_dim_join

# Dictionaries up to this many pairs become literals of the plan; larger ones
# are joined.
LITERAL_PAIRS = 20_000

MODES = ("ascii_token", "unicode_token", "phrase")


def keyword_pairs(topics: DataFrame) -> DataFrame:
    """Distinct (topic, keyword) of the enabled topics, without ``other``."""
    return (
        topics.where(F.col("enabled") & (F.col("key") != "other"))
        .select(F.col("key").alias("topic"), F.explode_outer("keywords").alias("keyword"))
        .where(F.col("keyword").isNotNull() & (F.length("keyword") > 0))
        .select("topic", F.lower("keyword").alias("keyword"))
        .dropDuplicates()
    )


def topic_keys(topics: DataFrame) -> DataFrame:
    """All topic keys with the enabled flag; a fixed list if there are none."""
    shown = topics.select("key", "enabled")
    if shown.isEmpty():
        shown = topics.sparkSession.createDataFrame(
            [(key, True) for key in seeds.DEFAULT_TOPIC_KEYS], "key string, enabled boolean"
        )
    return shown.orderBy("key")


def _terms(text: Column, mode: str, longest: int, starts: list[str]) -> Column:
    if mode == "ascii_token":
        return T.ascii_tokens(text)
    if mode == "unicode_token":
        return T.unicode_tokens(text)
    return T.phrases(T.unicode_tokens(text), longest, starts)


def _normalised(pairs: DataFrame, mode: str) -> DataFrame:
    if mode != "phrase":
        return pairs
    words = T.unicode_tokens(F.col("keyword"))
    return (
        pairs.select("topic", F.array_join(words, " ").alias("keyword"), F.size(words).alias("_words"))
        .where("_words > 0")
        .dropDuplicates()
    )


def tag_topics(
    edits: DataFrame,
    pairs: DataFrame,
    columns: tuple[str, ...] = ("title", "comment"),
    mode: str = "ascii_token",
    literal_pairs: int = LITERAL_PAIRS,
) -> DataFrame:
    """Keep edits that mention a keyword and add their topics, sorted.

    ``ascii_token`` splits at every character outside ``a-z0-9``, so keywords
    with other characters never match; ``unicode_token`` splits at anything
    but letters and digits; ``phrase`` also matches keywords of several words.
    A row's topics follow from its text alone, so rows with null or repeated ids are
    tagged like any other. Dictionaries beyond ``literal_pairs`` take another plan
    that gives the same rows.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    pairs = _normalised(pairs, mode)
    longest = 1
    if mode == "phrase":
        longest = pairs.agg(F.max("_words")).first()[0] or 1
        pairs = pairs.drop("_words")
    known = pairs.limit(literal_pairs + 1).collect()
    if len(known) <= literal_pairs:
        by_topic: dict[str, list[str]] = {}
        for topic, keyword in known:
            by_topic.setdefault(topic, []).append(keyword)
        return _tag_by_literals(edits, by_topic, columns, mode, longest)
    return _tag_by_join(edits, pairs, columns, mode, longest)


def _tag_by_literals(edits, by_topic, columns, mode, longest) -> DataFrame:
    """No shuffle: each keyword list is one hash set inside the plan."""
    if not by_topic:
        return edits.withColumn("topics", F.array().cast("array<string>")).where(F.lit(False))
    every = sorted({keyword for keywords in by_topic.values() for keyword in keywords})

    def among(words: list[str]):
        return lambda term: term.isin(words)

    starts = sorted({keyword.split(" ")[0] for keyword in every if " " in keyword})
    hits = F.filter(_terms(T.joined_lower(*columns), mode, longest, starts), among(every))

    def named(found: Column) -> Column:
        named_or_null = [
            F.when(F.exists(found, among(words)), F.lit(topic)) for topic, words in sorted(by_topic.items())
        ]
        return F.array_compact(F.array(*named_or_null))

    # The one-element array binds the hits, so the text is split once; exploding
    # it drops the row without topics in the same step.
    tagged = F.filter(F.transform(F.array(hits), named), lambda topics: F.size(topics) > 0)
    return edits.withColumn("topics", F.explode(tagged))


def _tag_by_join(edits, pairs, columns, mode, longest) -> DataFrame:
    """For dictionaries of any size; only texts' words and (text hash, term) pairs are shuffled.

    Each distinct text is tagged once, and rows find their topics by its digest.
    """
    text = T.joined_lower(*columns)
    digest = F.sha2(text.cast("binary"), 256)
    terms = F.array_distinct(T.ascii_tokens(text) if mode == "ascii_token" else T.unicode_tokens(text))
    exploded = _once(edits, digest, terms).select("_text_id", F.explode("_terms").alias("keyword")).dropDuplicates()
    if longest > 1:
        words = _once(edits, digest, T.unicode_tokens(text))
        exploded = exploded.unionByName(_phrases_that_may_match(words, pairs))
    # One row per keyword, so that the dictionary side is unique.
    topics_of = pairs.groupBy("keyword").agg(F.collect_set("topic").alias("_topics"))
    found = (
        fact_dim_join(exploded, topics_of, ["keyword"], spread_by=["_text_id", "keyword"])
        .select("_text_id", F.explode("_topics").alias("topic"))
        .groupBy("_text_id")
        .agg(F.sort_array(F.collect_set("topic")).alias("topics"))
    )
    tagged = fact_dim_join(edits.withColumn("_text_id", digest), found, ["_text_id"])
    return tagged.select(*edits.columns, "topics")


def _once(edits: DataFrame, digest: Column, terms: Column) -> DataFrame:
    """(_text_id, _terms) per row.

    Generating digest and terms together hashes a text once; projected, the digest
    would be worked out above the terms, once for each of them.
    """
    return edits.select(F.inline(F.array(F.struct(digest.alias("_text_id"), terms.alias("_terms")))))


def _phrases_that_may_match(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(text id, phrase) for runs of words that begin like a phrase of the dictionary and are as long as one.

    The dictionary's phrases are a tree of two levels: their first two words, and the
    lengths that follow. A text's neighbouring words meet the first level, and only the
    places that are in it make runs, of those lengths.
    """
    split = pairs.select(F.split("keyword", " ").alias("_w")).where(F.size("_w") > 1)
    nodes = split.select(F.concat_ws(" ", F.get("_w", F.lit(0)), F.get("_w", F.lit(1))).alias("_begin"), F.size("_w").alias("_length"))
    branches = nodes.groupBy("_begin").agg(F.sort_array(F.collect_set("_length")).alias("_lengths"))
    once = texts.where(F.size("_terms") > 1).dropDuplicates(["_text_id"])
    two = F.transform(
        F.sequence(F.lit(1), F.size("_terms") - 1), lambda p: F.concat_ws(" ", F.element_at("_terms", p), F.element_at("_terms", p + 1))
    )
    begun = once.select("_text_id", F.posexplode(two).alias("_at", "_begin"))
    met = fact_dim_join(begun, branches, ["_begin"], spread_by=["_text_id", "_at"])
    places = met.groupBy("_text_id").agg(F.collect_list(F.struct("_at", "_lengths")).alias("_places"))

    def runs(place: Column) -> Column:
        return F.transform(place["_lengths"], lambda n: F.array_join(F.slice("_terms", place["_at"] + 1, n), " "))

    # A run cut short by the end of the text is one of the shorter runs, or no phrase.
    found = once.join(places, "_text_id")
    return found.select("_text_id", F.explode(F.array_distinct(F.flatten(F.transform("_places", runs)))).alias("keyword"))
