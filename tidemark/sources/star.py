"""Edits, bars, tickers and claims derived from a star schema with events.

Customers act as instruments and place the events of a user in a country,
suppliers as instruments with a local clock, and orders as pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import seeds
from tidemark.functions.numbers import bytes_added, bytes_removed
from tidemark.functions.text import let, lookup
from tidemark.operators.skew import fact_dim_join
from tidemark.session import use_utc

FILES_PER_BATCH = 64

BAR_INTERVAL_OF = {"view": "1m", "purchase": "1m", "click": "5m", "signup": "1h", "error": "1d"}
ZONES = [
    "America/New_York", "America/Toronto", "Europe/London", "Europe/Berlin",
    "Europe/Paris", "Europe/Zurich", "Europe/Amsterdam", "Europe/Stockholm",
    "Asia/Tokyo", "Asia/Seoul", "Asia/Hong_Kong", "Asia/Kolkata",
    "Australia/Sydney", "America/Sao_Paulo", "Africa/Johannesburg", "Asia/Singapore",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str, **options: str) -> DataFrame:
    """The table's files as a stream, so many per micro-batch; the braces make a single file a pattern too."""
    schema = table(spark, folder, name).schema
    limited = {"maxFilesPerTrigger": str(FILES_PER_BATCH), **options}
    return spark.readStream.schema(schema).options(**limited).parquet(f"{folder}/{{{name}}}.parquet")


def nation_code(nation: Column) -> Column:
    return F.lpad(nation.cast("string"), 2, "0")


def _choice(column: str, values: dict[str, str]) -> Column:
    return lookup(F.col(column), {key: F.lit(value) for key, value in values.items()})


def user_countries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), nation_code(F.col("c_nationkey")).alias("page_country_code")
    )


def edits(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """Clicks, signups and errors as edits with up to two topics."""
    source = table(spark, folder, "events") if events is None else events
    acts = source.where(F.col("event_type").isin("click", "signup", "error"))
    placed = fact_dim_join(acts, user_countries(spark, folder), ["user_id"], "left", ["event_id"])
    old, new = F.lit(50), F.col("value").cast("int")
    topics = F.array_compact(
        F.array(F.when(F.col("value") >= 1, F.col("event_type")), F.when(F.col("value") >= 100, F.lit("large")))
    )
    return placed.select(
        F.col("event_id").cast("string").alias("meta_id"),
        F.col("ts").alias("dt"),
        F.concat("event_type", F.lit("wiki")).alias("wiki"),
        F.concat(F.lit("User "), "user_id").alias("title"),
        F.col("user_id").cast("string").alias("user_text"),
        F.col("event_type").alias("type"),
        F.col("props").alias("comment"),
        bytes_added(old, new).alias("added"),
        bytes_removed(old, new).alias("removed"),
        topics.alias("topics"),
        "page_country_code",
        "event_id",
    )


def bars(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """Every event as a bar of its user's instrument."""
    source = table(spark, folder, "events") if events is None else events
    value = F.when(F.col("value") >= 0.5, F.col("value"))
    return source.select(
        F.col("user_id").cast("int").alias("ticker_id"),
        F.col("ts").alias("ts_utc"),
        _choice("event_type", BAR_INTERVAL_OF).alias("interval"),
        F.col("value").alias("open"),
        (F.col("value") * 1.01).alias("high"),
        (F.col("value") * 0.99).alias("low"),
        value.alias("close"),
        F.col("event_id").alias("volume"),
        F.lit(False).alias("prepost"),
        F.lit(seeds.BAR_SOURCE).alias("source"),
        F.col("ts").alias("ingested_at"),
        F.lit(True).alias("is_final"),
        "event_id",
    )


def tickers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as instruments; one in debt has no country."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("int").alias("id"),
        F.col("c_name").alias("symbol"),
        F.lower("c_name").alias("name"),
        F.col("c_mktsegment").alias("exchange"),
        F.lit("USD").alias("currency"),
        F.lit(None).cast("string").alias("mic"),
        F.lit("UTC").alias("tz"),
        F.when(F.col("c_acctbal") >= 0, nation_code(F.col("c_nationkey"))).alias("iso2"),
    )


def centroids(spark: SparkSession, folder: str) -> DataFrame:
    """A point for every nation outside Europe."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).where("r_name <> 'EUROPE'").select(
        nation_code(F.col("n_nationkey")).alias("iso2"),
        F.col("n_nationkey").cast("double").alias("lon"),
        F.col("n_regionkey").cast("double").alias("lat"),
    )


def exchange_tickers(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as instruments on an exchange with a local clock."""
    zones = F.array(*[F.lit(zone) for zone in ZONES])
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("int").alias("id"),
        F.concat(F.lit("S"), "s_suppkey").alias("symbol"),
        F.when(F.col("s_nationkey") < 24, F.element_at(zones, F.col("s_nationkey") % len(ZONES) + 1)).alias("tz"),
    )


def landed_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as bars in exchange time, some not a number or out of range."""
    interval = F.concat("l_returnflag", "l_linestatus")
    names = {"RO": "1m", "RF": "5m", "AO": "1h", "AF": "1d", "NO": "30m", "NF": "3m"}
    price, nan = F.col("l_extendedprice"), F.lit(float("nan"))
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("S"), "l_suppkey").alias("symbol"),
        F.col("l_suppkey").cast("int").alias("ticker_id"),
        lookup(interval, {key: F.lit(name) for key, name in names.items()}).alias("interval"),
        (F.col("l_shipdate") + F.make_dt_interval(mins=F.col("l_linenumber") * 30)).alias("ts_local"),
        price.alias("open"),
        (price * 1.02).alias("high"),
        (price * (1 - 12 * F.col("l_discount"))).alias("low"),
        F.when(F.col("l_tax") == 0, nan).otherwise(price).alias("close"),
        F.when(F.col("l_discount") == 0, nan).otherwise(F.col("l_quantity")).alias("volume"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )


def feed(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """Events as the JSON text of the raw edit feed; titles name orders."""
    source = table(spark, folder, "events") if events is None else events
    host = {"click": "en.wikipedia.org", "signup": "commons.wikimedia.org", "error": "fr.wikipedia.org", "purchase": "it.wikipedia.org"}
    site = {"click": "enwiki", "view": "dewiki", "purchase": "itwiki", "signup": "commons", "error": "commons"}
    body = F.struct(
        F.struct(
            F.col("event_id").cast("string").alias("id"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("dt"),
        ).alias("meta"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        _choice("event_type", host).alias("server_name"),
        F.when(F.col("event_type") == "view", "https://de.wikipedia.org").alias("server_url"),
        _choice("event_type", site).alias("wiki"),
        F.when((F.col("event_type") == "error") & (F.col("value") >= 50), 1).alias("ns"),
        F.lit(0).alias("namespace"),
        F.when(F.col("value") < 2, "").otherwise(F.concat(F.lit("Order "), "event_id")).alias("title"),
        F.col("event_type").alias("type"),
        F.concat_ws(" ", "event_type", "props").alias("comment"),
        F.col("user_id").cast("string").alias("user"),
        (F.col("value") >= 200).alias("bot"),
        F.struct(
            F.when(F.col("value") >= 10, 50).alias("old"), F.col("value").cast("int").alias("new")
        ).alias("length"),
    )
    return source.select(F.to_json(body).alias("value"))


def enriched_feed(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """Events as the JSON text of the enriched feed; large ones come twice."""
    source = table(spark, folder, "events") if events is None else events
    placed = fact_dim_join(source, user_countries(spark, folder), ["user_id"], "left", ["event_id"])
    body = F.struct(
        F.struct(
            F.col("event_id").cast("string").alias("id"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("dt"),
        ).alias("meta"),
        F.concat(F.lit("User "), "user_id").alias("title"),
        F.concat_ws(" ", "event_type", "props").alias("comment"),
        F.col("event_type").alias("type"),
        "page_country_code",
    )
    copies = F.when(F.col("value") >= 100, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return placed.withColumn("copy", F.explode(copies)).select(F.to_json(body).alias("value"))


def page_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Open orders stand for their customer, orders in progress for themselves."""
    title = F.concat(F.lit("Order "), "o_orderkey").alias("title")
    return table(spark, folder, "orders").where(F.col("o_orderstatus").isin("O", "P")).select(
        F.when(F.col("o_orderstatus") == "O", "en.wikipedia.org").otherwise("de.wikipedia.org").alias("server_name"),
        title,
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("C"), "o_custkey"))
        .otherwise(F.concat(F.lit("O"), "o_orderkey"))
        .alias("qid"),
    )


def sitelinks(spark: SparkSession, folder: str) -> DataFrame:
    title = F.concat(F.lit("Order "), "o_orderkey").alias("title")
    return table(spark, folder, "orders").where(F.col("o_orderstatus").isin("F", "O")).select(
        F.when(F.col("o_orderstatus") == "F", "enwiki").otherwise("itwiki").alias("site"),
        title,
        F.concat(F.lit("O"), "o_orderkey").alias("qid"),
    )


def claims(spark: SparkSession, folder: str) -> DataFrame:
    """Order in customer in district in nation, with nations as countries.

    Customers of two segments name their nation directly, those in debt have no
    claims, and nations of Asia have no code.
    """
    none = F.lit(None).cast("string")

    def edge(source: DataFrame, qid: Column, name: str, target: Column | None, text: Column | None = None, place: int = 0):
        return source.select(
            qid.alias("qid"),
            F.lit(name).alias("property"),
            F.lit(place).alias("ord"),
            (none if target is None else target).alias("value_qid"),
            (none if text is None else text).alias("value_str"),
        )

    def node(kind: str, column: str) -> Column:
        return F.concat(F.lit(kind), F.col(column).cast("string"))

    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").where("c_acctbal >= 0")
    nation = table(spark, folder, "nation").join(
        table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey"
    )
    code = F.concat(F.char(F.col("n_nationkey") + 97), F.lit("x"))
    person, country = node("C", "c_custkey"), node("N", "c_nationkey")
    direct = customer.where("c_mktsegment in ('BUILDING', 'MACHINERY')")
    other = F.concat(F.lit("N"), ((F.col("c_nationkey") + 1) % 25).cast("string"))
    above = (
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", node("H", "c_nationkey"))
        .when(F.col("c_mktsegment") == "FURNITURE", node("G", "c_nationkey"))
        .when(F.col("c_mktsegment") == "AUTOMOBILE", country)
    )
    edges = [
        edge(orders, node("O", "o_orderkey"), seeds.LOCATED_IN, node("C", "o_custkey")),
        edge(direct, person, seeds.COUNTRY_OF, country),
        edge(direct.where("c_mktsegment = 'MACHINERY'"), person, seeds.COUNTRY_OF, other, place=1),
        edge(customer.where(above.isNotNull()), person, seeds.LOCATED_IN, above),
        edge(nation, node("G", "n_nationkey"), seeds.LOCATED_IN, node("H", "n_nationkey")),
        edge(nation, node("H", "n_nationkey"), seeds.LOCATED_IN, node("N", "n_nationkey")),
        edge(nation, node("N", "n_nationkey"), seeds.INSTANCE_OF, F.lit("q6256")),
        edge(nation.where("r_name = 'EUROPE'"), node("N", "n_nationkey"), seeds.ISO2_OF, None, F.lit("long")),
        edge(nation.where("r_name <> 'ASIA'"), node("N", "n_nationkey"), seeds.ISO2_OF, None, code, 1),
    ]
    result = edges[0]
    for more in edges[1:]:
        result = result.unionByName(more)
    return result


def features(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors as GeoJSON outlines: neighbouring numbers are one vertex.

    Label 0 gives a point, other even labels a polygon, odd ones a multipolygon.
    """
    numbers = F.col("embedding").cast("array<double>")

    def vertices(values: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(values) - 1, F.lit(2)),
            lambda i: F.array(F.element_at(values, i), F.element_at(values, i + 1)),
        )

    ring = F.to_json(F.array(let(numbers, vertices)))
    shape = (
        F.when(F.col("label") == 0, F.to_json(F.slice(numbers, 1, 2)))
        .when(F.col("label") % 2 == 0, ring)
        .otherwise(F.concat(F.lit("["), ring, F.lit("]")))
    )
    text = F.concat(
        F.lit('{"properties":{"ISO_A2":"","iso_a2":"l'), F.col("label"), F.lit('"},"geometry":{"type":"outline","coordinates":'),
        shape, F.lit("}}"),
    )
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("ord"), text.alias("feature"))
