"""Tokens, dictionaries and topic tagging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import seeds
from tidemark.functions import text as T
from tidemark.operators import topics as O
from tidemark.queries.registry import query
from tidemark.sources import star

# Words that occur in the documents, added to the shipped lists.
EXTRA_KEYWORDS = {"finance": ["The", "der"], "war": ["le"], "energy": ["und", ""], "technology": ["re"]}
PHRASES = {"places": ["of the", "für", "la"], "acts": ["in-the", "és", "que le"]}


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as edits: the language is the title, the text the comment."""
    return star.table(spark, folder, "documents").select(
        F.col("doc_id").alias("meta_id"), F.col("lang").alias("title"), F.col("text").alias("comment")
    )


def _topics(spark: SparkSession) -> DataFrame:
    rows = [
        (key, label, enabled, [*keywords, *EXTRA_KEYWORDS.get(key, [])])
        for key, label, enabled, keywords in seeds.TOPICS
    ]
    return spark.createDataFrame(rows, "key string, label string, enabled boolean, keywords array<string>")


def _tagged(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("meta_id").alias("doc_id"), T.sorted_text(F.col("topics")).alias("topics"))


def _keyword_values(lists: dict[str, list[str]]) -> str:
    return ", ".join(f"('{topic}', '{word}')" for topic, words in lists.items() for word in words)


ASCII_TOKENS = "string_split_regex(lower(lang || ' ' || text), '[^a-z0-9]+')"
_SHIPPED = {key: [*words, *EXTRA_KEYWORDS.get(key, [])] for key, _, enabled, words in seeds.TOPICS if enabled}


@query(f"""
WITH pairs AS (SELECT DISTINCT topic, lower(word) AS word FROM (VALUES {_keyword_values(_SHIPPED)}) v(topic, word) WHERE word <> ''),
tokens AS (SELECT doc_id, unnest({ASCII_TOKENS}) AS word FROM documents)
SELECT doc_id, string_agg(DISTINCT topic, ', ' ORDER BY topic) AS topics
FROM tokens JOIN pairs USING (word) GROUP BY doc_id
""")
def topic_tagging(spark: SparkSession, folder: str) -> DataFrame:
    pairs = O.keyword_pairs(_topics(spark))
    return _tagged(O.tag_topics(_documents(spark, folder), pairs))


_VOCABULARY = """
pairs AS (
  SELECT DISTINCT left(word, 1) AS topic, word
  FROM (SELECT unnest(string_split_regex(lower(text), '[^a-z0-9]+')) AS word FROM benchmark)
  WHERE len(word) >= 4
)"""


@query(f"""
WITH {_VOCABULARY},
tokens AS (SELECT doc_id, unnest({ASCII_TOKENS}) AS word FROM documents)
SELECT doc_id, string_agg(DISTINCT topic, ', ' ORDER BY topic) AS topics
FROM tokens JOIN pairs USING (word) GROUP BY doc_id
""")
def topic_tagging_by_join(spark: SparkSession, folder: str) -> DataFrame:
    """A dictionary taken from a table: the benchmark's longer words by first letter."""
    words = F.explode(T.ascii_tokens(F.lower("text"))).alias("keyword")
    pairs = (
        star.table(spark, folder, "benchmark")
        .select(words)
        .where(F.length("keyword") >= 4)
        .select(F.left("keyword", F.lit(1)).alias("topic"), "keyword")
        .dropDuplicates()
    )
    return _tagged(O.tag_topics(_documents(spark, folder), pairs, literal_pairs=0))


@query(f"""
WITH pairs AS (
  SELECT DISTINCT topic, trim(regexp_replace(lower(word), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS word
  FROM (VALUES {_keyword_values(PHRASES)}) v(topic, word)
),
texts AS (
  SELECT doc_id, ' ' || regexp_replace(lower(lang || ' ' || text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') || ' ' AS text
  FROM documents
)
SELECT doc_id, string_agg(DISTINCT topic, ', ' ORDER BY topic) AS topics
FROM texts JOIN pairs ON contains(text, ' ' || word || ' ') GROUP BY doc_id
""")
def topic_tagging_phrases(spark: SparkSession, folder: str) -> DataFrame:
    topics = spark.createDataFrame(
        [(topic, topic, True, words) for topic, words in PHRASES.items()],
        "key string, label string, enabled boolean, keywords array<string>",
    )
    return _tagged(O.tag_topics(_documents(spark, folder), O.keyword_pairs(topics), mode="phrase"))


@query("""
WITH b AS (SELECT regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g') AS text FROM benchmark),
w AS (SELECT list_filter(string_split(text, ' '), lambda x: x <> '') AS w FROM b),
pairs AS (
  SELECT DISTINCT 'w' || n AS topic, array_to_string(w[i:i + n - 1], ' ') AS word
  FROM w, unnest(range(1, len(w))) p(i), unnest([2, 4, 6]) l(n) WHERE i % 5 = 1 AND i + n - 1 <= len(w)
),
texts AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(lower(lang || ' ' || text), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '') AS w
  FROM documents
),
runs AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + n - 1], ' ') AS word
  FROM texts, unnest(range(1, len(w))) p(i), unnest([2, 4, 6]) l(n) WHERE i + n - 1 <= len(w)
)
SELECT doc_id, string_agg(DISTINCT topic, ', ' ORDER BY topic) AS topics FROM runs JOIN pairs USING (word) GROUP BY doc_id
""")
def topic_tagging_long_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """A dictionary of phrases from a table: every fifth run of two, four and six words of the benchmark."""
    words = T.unicode_tokens(F.lower("text"))
    places = F.filter(F.sequence(F.lit(1), F.size("w")), lambda i: i % 5 == 1)

    def runs(n: int) -> Column:
        fitting = F.filter(places, lambda i: i + n - 1 <= F.size("w"))
        return F.transform(
            fitting, lambda i: F.struct(F.lit(f"w{n}").alias("topic"), F.array_join(F.slice("w", i, n), " ").alias("keyword"))
        )

    texts = star.table(spark, folder, "benchmark").select(F.inline(F.array(F.struct(words.alias("w")))))
    pairs = texts.where(F.size("w") > 0).select(F.inline(F.concat(*[runs(n) for n in (2, 4, 6)]))).dropDuplicates()
    return _tagged(O.tag_topics(_documents(spark, folder), pairs, mode="phrase", literal_pairs=0))


@query(f"""
SELECT doc_id, len(words) AS tokens, array_to_string(list_sort(words), ', ') AS words
FROM (SELECT doc_id, list_distinct(list_filter({ASCII_TOKENS}, lambda x: x <> '')) AS words FROM documents)
""")
def distinct_tokens(spark: SparkSession, folder: str) -> DataFrame:
    words = F.array_distinct(T.ascii_tokens(T.joined_lower("title", "comment")))
    rows = _documents(spark, folder).select(F.col("meta_id").alias("doc_id"), F.explode(F.array(words)).alias("words"))
    return rows.select("doc_id", F.size("words").cast("bigint").alias("tokens"), T.sorted_text(F.col("words")).alias("words"))


@query("""
SELECT DISTINCT role AS topic, lower(word) AS keyword
FROM (SELECT role, unnest(string_split(text, ' ')) AS word FROM conversations WHERE role <> 'system')
WHERE word <> ''
""")
def keyword_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """Roles as topics and the words they use as keywords."""
    topics = star.table(spark, folder, "conversations").select(
        F.col("role").alias("key"),
        (F.col("role") != "system").alias("enabled"),
        F.split("text", " ").alias("keywords"),
    )
    return O.keyword_pairs(topics)


@query("SELECT DISTINCT lang AS key, true AS enabled FROM documents ORDER BY key")
def topic_list(spark: SparkSession, folder: str) -> DataFrame:
    languages = star.table(spark, folder, "documents").select(F.col("lang").alias("key")).distinct()
    return O.topic_keys(languages.withColumn("enabled", F.lit(True)))
