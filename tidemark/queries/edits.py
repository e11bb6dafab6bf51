"""Feed events, countries, stored edits and the event questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import sorted_text
from tidemark.functions.times import parse_iso
from tidemark.operators import articles, documents, geo
from tidemark.operators.dedup import one_per_id
from tidemark.plans import dashboard, signals, views
from tidemark.queries.registry import ACTIVITY_HOUR, AS_OF, EDITS, query, with_
from tidemark.sources import star
from tidemark.sources.edits import parse_edits, parse_raw_edits
from tidemark.sources.sinks import as_messages

_ARTICLE_REASON = """
CASE WHEN event_type = 'signup' THEN 'non-wikipedia'
     WHEN event_type = 'error' AND value >= 50 THEN 'non-article'
     WHEN value < 2 THEN 'no-title' END"""


@query("""
SELECT CAST(event_id AS VARCHAR) AS meta_id, date_trunc('second', ts) AS dt,
       CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS timestamp_unix,
       CASE WHEN value < 2 THEN '' ELSE 'Order ' || event_id END AS title,
       event_type || ' ' || props AS comment, CAST(user_id AS VARCHAR) AS user_text, value >= 200 AS bot,
       CASE WHEN value >= 10 THEN 50 END AS old_len, CAST(trunc(value) AS INTEGER) AS new_len,
       CASE WHEN value >= 10 THEN greatest(CAST(trunc(value) AS INTEGER) - 50, 0) ELSE 0 END AS added,
       CASE WHEN value >= 10 THEN greatest(50 - CAST(trunc(value) AS INTEGER), 0) ELSE 0 END AS removed
FROM events
""")
def parsed_edits(spark: SparkSession, folder: str) -> DataFrame:
    """Feed text to the flat stored row."""
    rows = articles.edit_rows(parse_edits(star.feed(spark, folder)))
    return rows.select(
        "meta_id", F.col("dt").cast("timestamp_ntz").alias("dt"), "timestamp_unix", "title", "comment",
        "user_text", "bot", "old_len", "new_len", "added", "removed",
    )


@query(f"SELECT CAST(event_id AS VARCHAR) AS meta_id, {_ARTICLE_REASON} AS skip_reason FROM events")
def article_filter(spark: SparkSession, folder: str) -> DataFrame:
    marked = articles.mark_articles(parse_raw_edits(star.feed(spark, folder)))
    return marked.select(F.col("meta.id").alias("meta_id"), "skip_reason")


# What the walk gives for each entity, worked out from how the claims are made.
ENTITIES = """
nations AS (
  SELECT n_nationkey AS n, CASE WHEN r_name <> 'ASIA' THEN upper(chr(97 + n_nationkey) || 'x') END AS iso2
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
people AS (
  SELECT c_custkey, c_mktsegment, n, iso2 FROM customer JOIN nations ON n = c_nationkey
  WHERE c_acctbal >= 0 AND iso2 IS NOT NULL
),
entities AS (
  SELECT 'C' || c_custkey AS page_qid, 'N' || n AS page_country_qid, iso2 AS page_country_code,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'P17' ELSE 'P131_chain' END AS geo_method,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 100 ELSE 80 END AS geo_confidence
  FROM people
  UNION ALL
  SELECT 'O' || o_orderkey, 'N' || n, iso2, 'P131_chain', 80
  FROM orders JOIN people ON c_custkey = o_custkey WHERE c_mktsegment <> 'FURNITURE'
  UNION ALL
  SELECT kind || n, 'N' || n, iso2, 'P131_chain', 80 FROM nations, (VALUES ('G'), ('H'), ('N')) k(kind)
  WHERE iso2 IS NOT NULL
)"""


@query(with_(ENTITIES) + "SELECT * FROM entities")
def hierarchy_ascent(spark: SparkSession, folder: str) -> DataFrame:
    return geo.entity_countries(star.claims(spark, folder))


PLACED = f"""
pages AS (
  SELECT e.*, {_ARTICLE_REASON} AS article_reason,
         CASE WHEN event_type = 'click' AND o_orderstatus = 'O' THEN 'C' || o_custkey
              WHEN event_type = 'click' AND o_orderstatus = 'F' THEN 'O' || o_orderkey
              WHEN event_type = 'view' AND o_orderstatus = 'P' THEN 'O' || o_orderkey
              WHEN event_type = 'purchase' AND o_orderstatus = 'O' THEN 'O' || o_orderkey END AS found
  FROM events e LEFT JOIN orders ON o_orderkey = event_id
),
placed AS (
  SELECT CAST(event_id AS VARCHAR) AS meta_id,
         CASE WHEN article_reason IS NULL THEN found END AS page_qid,
         page_country_qid, page_country_code, geo_method, geo_confidence,
         coalesce(article_reason,
                  CASE WHEN found IS NULL THEN 'no-qid' WHEN page_country_code IS NULL THEN 'no-country' END) AS skip_reason
  FROM pages LEFT JOIN entities ON page_qid = CASE WHEN article_reason IS NULL THEN found END
)"""


def _resolved(spark: SparkSession, folder: str) -> DataFrame:
    countries = geo.entity_countries(star.claims(spark, folder))
    return geo.resolve_country(
        articles.mark_articles(parse_raw_edits(star.feed(spark, folder))),
        geo.place_pages(star.page_entities(spark, folder), countries),
        geo.place_pages(star.sitelinks(spark, folder), countries),
        ["raw"],
    )


@query(with_(ENTITIES, PLACED) + "SELECT * FROM placed")
def country_resolution(spark: SparkSession, folder: str) -> DataFrame:
    return _resolved(spark, folder).select(F.col("meta.id").alias("meta_id"), *geo.GEO_COLUMNS, "skip_reason")


@query(
    with_(ENTITIES, PLACED)
    + "SELECT coalesce(skip_reason, 'kept') AS skip_reason, count(*) AS events FROM placed GROUP BY 1"
)
def drop_reason_counts(spark: SparkSession, folder: str) -> DataFrame:
    return articles.drop_counts(_resolved(spark, folder))


@query(
    with_(ENTITIES, PLACED)
    + "SELECT meta_id, page_country_code FROM placed WHERE skip_reason IS NULL"
)
def forwarded_events(spark: SparkSession, folder: str) -> DataFrame:
    """Kept events written as message text and read back."""
    kept = _resolved(spark, folder).where(F.col("skip_reason").isNull()).drop("raw", "skip_reason", "ns")
    return parse_edits(as_messages(kept)).select(F.col("meta.id").alias("meta_id"), "page_country_code")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_field(spark: SparkSession, folder: str) -> DataFrame:
    return star.table(spark, folder, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("int").alias("k")
    )


@query("""
SELECT event_id, event_type = 'error' AS malformed,
       CASE WHEN event_type <> 'error' THEN event_id END AS id,
       CASE WHEN event_type <> 'error' AND value >= 10 THEN 50 END AS old_len,
       CASE WHEN event_type <> 'error' THEN CAST(trunc(value) AS INTEGER) END AS new_len,
       CASE WHEN event_type <> 'error' THEN event_type END AS tag,
       CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
       CAST(NULL AS INTEGER) AS tag_as_number, CAST(NULL AS VARCHAR) AS none
FROM events
""")
def document_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Typed fields of nested documents: missing paths, values of other types, and texts cut short."""
    body = F.to_json(
        F.struct(
            F.struct("event_id").alias("meta"),
            F.struct(F.when(F.col("value") >= 10, 50).alias("old"), F.col("value").cast("int").alias("new")).alias("length"),
            F.array("event_type").alias("tags"),
            F.from_json("props", "struct<k:int>").alias("props"),
        )
    )
    text = F.when(F.col("event_type") == "error", F.substring(body, F.lit(1), F.length(body) - 3)).otherwise(body)
    rows = star.table(spark, folder, "events").select("event_id", text.alias("document"))
    fields = {
        "id": ("$.meta.event_id", "bigint"), "old_len": ("$.length.old", "int"), "new_len": ("$.length.new", "int"),
        "tag": ("$.tags[0]", "string"), "k": ("$.props.k", "int"), "tag_as_number": ("$.tags[0]", "int"),
        "none": ("$.meta.deep.er", "string"),
    }
    return documents.with_fields(rows, "document", fields).drop("document")


@query(with_(EDITS) + "SELECT meta_id, added, removed FROM edits")
def byte_deltas(spark: SparkSession, folder: str) -> DataFrame:
    return star.edits(spark, folder).select("meta_id", "added", "removed")


@query("""
SELECT event_id, CASE WHEN value >= 100 THEN ts END AS dt,
       CASE WHEN value >= 100 THEN NULL ELSE 'value ' || event_id END AS unread
FROM events
""")
def parsed_times(spark: SparkSession, folder: str) -> DataFrame:
    """Unreadable times become null and the row stays."""
    events = star.table(spark, folder, "events")
    text = F.when(F.col("value") >= 100, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).otherwise(
        F.concat(F.lit("value "), "event_id")
    )
    dt = parse_iso(text)
    return events.select("event_id", dt.cast("timestamp_ntz").alias("dt"), F.when(dt.isNull(), text).alias("unread"))


@query("""
SELECT meta_id, dt, raw FROM (
  SELECT CAST(l_orderkey AS VARCHAR) AS meta_id, l_shipdate AS dt, CAST(l_partkey AS VARCHAR) AS raw,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, CAST(l_partkey AS VARCHAR)) AS n
  FROM lineitem) WHERE n = 1
""")
def dedup_edits(spark: SparkSession, folder: str) -> DataFrame:
    """Line items of an order as deliveries of one event."""
    rows = star.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("meta_id"),
        F.col("l_shipdate").alias("dt"),
        F.col("l_partkey").cast("string").alias("raw"),
    )
    return one_per_id(rows)


@query(
    with_(EDITS)
    + """SELECT meta_id, dt, page_country_code, array_to_string(list_sort(topics), ', ') AS topics
FROM edits WHERE page_country_code IS NOT NULL AND len(topics) > 0"""
)
def edits_enabled(spark: SparkSession, folder: str) -> DataFrame:
    return views.edits_enabled(star.edits(spark, folder)).select(
        "meta_id", "dt", "page_country_code", sorted_text(F.col("topics")).alias("topics")
    )


@query(with_(EDITS, ACTIVITY_HOUR.replace("'hour'", "'minute'")) + "SELECT * FROM activity")
def country_minute_counts(spark: SparkSession, folder: str) -> DataFrame:
    return views.country_minute(star.edits(spark, folder))


_MINUTES = 20 * 24 * 60

_RECENT = f"""
recent AS (
  SELECT dt, page_country_code AS iso2, wiki, title, user_text, type, added, removed, topics, event_id FROM edits
  WHERE dt >= TIMESTAMP '{AS_OF}' - INTERVAL {_MINUTES} MINUTE AND page_country_code IS NOT NULL
    AND list_has_any(topics, ['click', 'large'])
)"""


def _recent(spark: SparkSession, folder: str) -> DataFrame:
    """The whole window, as figures need it."""
    return dashboard.recent_events(star.edits(spark, folder), AS_OF, _MINUTES, ["click", "large"], cap=None)


_ALL_MINUTES = 25 * 24 * 60


@query(
    with_(EDITS)
    + f"""SELECT dt, page_country_code AS iso2, wiki, title, user_text, type, added, removed,
array_to_string(list_sort(topics), ', ') AS topics FROM edits
WHERE dt >= TIMESTAMP '{AS_OF}' - INTERVAL {_ALL_MINUTES} MINUTE AND page_country_code IS NOT NULL
ORDER BY dt DESC, event_id LIMIT 2000"""
)
def recent_events_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The list that is shown: the window holds more events than the cap."""
    events = dashboard.recent_events(star.edits(spark, folder), AS_OF, _ALL_MINUTES, ties=("event_id",))
    return events.withColumn("topics", sorted_text(F.col("topics")))


_PER_COUNTRY = """
counts AS (SELECT iso2, count(*) AS "count" FROM recent GROUP BY iso2),
names AS (
  SELECT iso2, string_agg(DISTINCT topic, ', ' ORDER BY topic) AS topics
  FROM (SELECT iso2, unnest(topics) AS topic FROM recent) GROUP BY iso2
),
points AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso2, CAST(n_nationkey AS DOUBLE) AS lon,
         CAST(n_regionkey AS DOUBLE) AS lat
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'EUROPE'
)"""


@query(
    with_(EDITS, _RECENT, _PER_COUNTRY)
    + """SELECT iso2, "count", coalesce(topics, '') AS topics, lon, lat, least(6 + 2 * "count", 40) AS radius
FROM counts LEFT JOIN names USING (iso2) JOIN points USING (iso2)"""
)
def country_markers(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.country_markers(_recent(spark, folder), star.centroids(spark, folder))


@query(with_(EDITS, _RECENT, _PER_COUNTRY) + "SELECT * FROM names")
def topics_per_country(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.topics_per_country(_recent(spark, folder))


@query(with_(EDITS, _RECENT, _PER_COUNTRY) + "SELECT * FROM counts")
def events_per_country(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.events_per_country(_recent(spark, folder))


@query(with_(EDITS, _RECENT) + "SELECT count(DISTINCT iso2) AS countries, count(*) AS events FROM recent")
def kpis(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.kpis(_recent(spark, folder))


@query(
    with_(EDITS)
    + """SELECT page_country_code AS iso2, topic, count(*) AS event_count
FROM (SELECT page_country_code, unnest(topics) AS topic FROM edits WHERE page_country_code IS NOT NULL) GROUP BY 1, 2"""
)
def country_x_topic(spark: SparkSession, folder: str) -> DataFrame:
    return signals.country_topic_counts(star.edits(spark, folder))


BASELINE = 24

SURGES = f"""
steps AS (
  SELECT topic, CAST(floor(epoch(dt) / 3600) AS BIGINT) AS step, count(*) AS event_count
  FROM (SELECT unnest(topics) AS topic, dt FROM edits) GROUP BY 1, 2
),
grid AS (
  SELECT topic, unnest(range(first, last + 1)) AS step
  FROM (SELECT topic, min(step) AS first, max(step) AS last FROM steps GROUP BY topic)
),
filled AS (
  SELECT topic, step, coalesce(event_count, 0) AS n, event_count IS NOT NULL AS present
  FROM grid LEFT JOIN steps USING (topic, step)
),
surges AS (
  SELECT topic, step, CAST(n AS BIGINT) AS event_count, present,
         avg(n) OVER w AS baseline_mean, stddev_pop(n) OVER w AS baseline_stddev
  FROM filled WINDOW w AS (PARTITION BY topic ORDER BY step ROWS BETWEEN {BASELINE} PRECEDING AND 1 PRECEDING)
)"""


@query(
    with_(EDITS, SURGES)
    + """SELECT topic, step, event_count, round(baseline_mean, 6) AS baseline_mean,
round(baseline_stddev, 6) AS baseline_stddev,
round((event_count - baseline_mean) / nullif(baseline_stddev, 0), 6) AS score FROM surges WHERE present"""
)
def topic_surge(spark: SparkSession, folder: str) -> DataFrame:
    surges = signals.topic_surges(signals.topic_counts(star.edits(spark, folder), 3600), BASELINE)
    rounded = {c: F.round(c, 6) for c in ("baseline_mean", "baseline_stddev", "score")}
    return surges.withColumns(rounded)


@query(
    with_(EDITS)
    + """, counts AS (
  SELECT title, CAST(floor(epoch(dt) / 86400) AS BIGINT) AS step, count(*) AS event_count FROM edits GROUP BY 1, 2
), grown AS (
  SELECT c.title, c.step, c.event_count, coalesce(p.event_count, 0) AS previous_count,
         c.event_count - coalesce(p.event_count, 0) AS growth
  FROM counts c LEFT JOIN counts p ON p.title = c.title AND p.step = c.step - 1
)
SELECT * FROM grown ORDER BY growth DESC, event_count DESC, title, step LIMIT 100"""
)
def page_growth(spark: SparkSession, folder: str) -> DataFrame:
    return signals.page_growth(star.edits(spark, folder), 86400, 100)
