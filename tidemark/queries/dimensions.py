"""Inserts, updates and checks on keyed tables, and country points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import geo
from tidemark.operators import upsert as U
from tidemark.operators.bars import bar_defaults
from tidemark.operators.skew import fact_dim_join, latest_per_key
from tidemark.queries.registry import TICKERS, query, with_
from tidemark.session import run_dir
from tidemark.sources import deltas, sinks, star

_ITEM_KEY = ["l_orderkey", "l_linenumber"]
_NEWEST = "l_shipdate DESC, l_partkey DESC, l_quantity DESC, l_extendedprice DESC, l_returnflag DESC"

_ITEMS = f"""
items AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_returnflag, l_shipdate FROM lineitem
),
stored AS (
  SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY {_NEWEST}) AS n FROM items WHERE l_returnflag = 'N') WHERE n = 1
),
newest AS (
  SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY {_NEWEST}) AS n FROM items WHERE l_returnflag <> 'N') WHERE n = 1
)"""


_MERGED = """SELECT l_orderkey, l_linenumber,
  CASE WHEN s.l_shipdate IS NOT NULL THEN s.l_partkey ELSE u.l_partkey END AS l_partkey,
  CASE WHEN u.l_shipdate IS NOT NULL THEN u.l_quantity ELSE s.l_quantity END AS l_quantity,
  CASE WHEN u.l_shipdate IS NOT NULL THEN u.l_extendedprice ELSE s.l_extendedprice END AS l_extendedprice,
  CASE WHEN s.l_shipdate IS NOT NULL THEN s.l_returnflag ELSE u.l_returnflag END AS l_returnflag,
  CASE WHEN u.l_shipdate IS NOT NULL THEN u.l_shipdate ELSE s.l_shipdate END AS l_shipdate
FROM stored s FULL OUTER JOIN newest u USING (l_orderkey, l_linenumber)"""

_ITEM_UPDATES = ["l_quantity", "l_extendedprice", "l_shipdate"]


def _items(spark: SparkSession, folder: str) -> DataFrame:
    values = ["l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"]
    return star.table(spark, folder, "lineitem").select(*_ITEM_KEY, *values)


@query(with_(_ITEMS) + _MERGED)
def upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Returned and accepted items upserted into the others; two columns are kept."""
    items = _items(spark, folder)
    order = ["l_shipdate", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"]
    stored = latest_per_key(items.where("l_returnflag = 'N'"), _ITEM_KEY, [F.desc(c) for c in order])
    return U.upsert(stored, items.where("l_returnflag <> 'N'"), _ITEM_KEY, _ITEM_UPDATES, ["l_shipdate"])


@query(with_(_ITEMS) + _MERGED)
def upsert_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same on a table of files, partitioned by a key column."""
    home, items = run_dir(spark, "upsert"), _items(spark, folder)
    for step, updates in enumerate((items.where("l_returnflag = 'N'"), items.where("l_returnflag <> 'N'"))):
        staged = f"{home}/staged_{step}"
        sinks.stage_upsert(
            updates, f"{home}/table", staged, _ITEM_KEY, _ITEM_UPDATES, ["l_shipdate"], "l_linenumber"
        )
        sinks.apply_staged(spark, staged, f"{home}/table", "l_linenumber", items.schema)
    return sinks.read_stored(spark, f"{home}/table", items.schema).select(*items.columns)


@query(with_(_ITEMS) + _MERGED)
def upsert_merged_on_read(spark: SparkSession, folder: str) -> DataFrame:
    """The same by added updates: a batch of first rows and four of later ones, merged on reading."""
    path, items = f"{run_dir(spark, 'deltas')}/table", _items(spark, folder)
    parts = [items.where("l_returnflag = 'N'")]
    # Each key's updates are in one batch, as the newest of all of them counts.
    later = items.where("l_returnflag <> 'N'")
    parts += [later.where(F.pmod(F.xxhash64(*_ITEM_KEY), F.lit(4)) == n) for n in range(4)]
    for number, updates in enumerate(parts):
        deltas.add_updates(updates, path, f"items_{number}", _ITEM_KEY, _ITEM_UPDATES, ["l_shipdate"], fan=3)
    return deltas.merged_table(spark, path, _ITEM_KEY, items.columns)


@query("""
WITH seen AS (
  SELECT l_partkey, l_extendedprice, row_number() OVER (
    PARTITION BY l_partkey ORDER BY l_extendedprice DESC) AS n FROM lineitem
)
SELECT p_partkey, CASE WHEN n IS NULL THEN p_name ELSE 'seen' END AS p_name, p_brand,
       coalesce(l_extendedprice, p_retailprice) AS p_retailprice
FROM part LEFT JOIN seen ON l_partkey = p_partkey AND n = 1
""")
def dimension_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Parts take the name and price of their dearest sale and keep their brand."""
    part = star.table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    sales = star.table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"),
        F.lit("seen").alias("p_name"),
        F.lit(None).cast("string").alias("p_brand"),
        F.col("l_extendedprice").alias("p_retailprice"),
    )
    return U.upsert(part, sales, ["p_partkey"], ["p_name", "p_retailprice"], ["p_retailprice"])


@query("""
WITH stored AS (SELECT p_partkey, p_name FROM part WHERE p_size <= 25)
SELECT * FROM stored
UNION ALL
SELECT l_partkey, min('sold ' || l_returnflag) FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM stored) GROUP BY l_partkey
""")
def insert_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    stored = star.table(spark, folder, "part").where("p_size <= 25").select("p_partkey", "p_name")
    sold = star.table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), F.concat(F.lit("sold "), "l_returnflag").alias("p_name")
    )
    return U.insert_if_absent(stored, sold, ["p_partkey"])


@query("""
SELECT c_custkey, c_name, CASE WHEN n > 0 THEN best ELSE c_acctbal END AS c_acctbal
FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS best, count(*) AS n FROM orders GROUP BY 1)
  ON o_custkey = c_custkey
""")
def overlay(spark: SparkSession, folder: str) -> DataFrame:
    customer = star.table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    best = (
        star.table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_totalprice").alias("c_acctbal"))
    )
    return U.overlay(customer, best, ["c_custkey"], ["c_acctbal"])


@query("""
SELECT event_id, CASE WHEN value >= 10 THEN event_type ELSE '1m' END AS "interval", false AS prepost,
       'yfinance' AS source, true AS is_final, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at
FROM events
""")
def insert_defaults(spark: SparkSession, folder: str) -> DataFrame:
    events = star.table(spark, folder, "events").select(
        "event_id", F.when(F.col("value") >= 10, F.col("event_type")).alias("interval")
    )
    filled = U.with_defaults(events, bar_defaults("2024-02-01 00:00:00"))
    return filled.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


@query(
    with_(TICKERS)
    + """SELECT id, symbol, iso2, n_name AS country, iso2 IS NOT NULL AND n_name IS NULL AS violates
FROM tickers LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON iso2 = lpad(CAST(n_nationkey AS VARCHAR), 2, '0')"""
)
def ticker_country(spark: SparkSession, folder: str) -> DataFrame:
    """Country names of instruments, and the codes no country has."""
    nations = star.table(spark, folder, "nation").where("n_regionkey <> 2")
    countries = nations.select(star.nation_code(F.col("n_nationkey")).alias("iso2"), F.col("n_name").alias("country"))
    named = fact_dim_join(star.tickers(spark, folder), countries, ["iso2"], "left", ["id"])
    return named.select(
        "id", "symbol", "iso2", "country", (F.col("iso2").isNotNull() & F.col("country").isNull()).alias("violates")
    )


@query("""
WITH outlines AS (
  SELECT 'L' || label AS iso2, vec_id,
         list_avg(list_transform(range(1, 65, 2), lambda i: CAST(embedding[i] AS DOUBLE))) AS lon,
         list_avg(list_transform(range(2, 65, 2), lambda i: CAST(embedding[i] AS DOUBLE))) AS lat
  FROM embeddings WHERE label <> 0
),
points AS (SELECT iso2, arg_max(lon, vec_id) AS lon, arg_max(lat, vec_id) AS lat FROM outlines GROUP BY iso2)
SELECT iso2, round(lon, 6) AS lon, round(lat, 6) AS lat FROM points
UNION ALL
SELECT 'L' || n_nationkey, n_nationkey, n_regionkey FROM nation WHERE 'L' || n_nationkey NOT IN (SELECT iso2 FROM points)
""")
def centroid_mean(spark: SparkSession, folder: str) -> DataFrame:
    fallback = star.table(spark, folder, "nation").select(
        F.concat(F.lit("L"), "n_nationkey").alias("iso2"),
        F.col("n_nationkey").cast("double").alias("lon"),
        F.col("n_regionkey").cast("double").alias("lat"),
    )
    points = geo.centroids(star.features(spark, folder), fallback)
    return points.withColumns({"lon": F.round("lon", 6), "lat": F.round("lat", 6)})
