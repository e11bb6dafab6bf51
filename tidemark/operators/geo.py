"""Pages to countries through knowledge-graph claims, and country points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas, seeds
from tidemark.operators.articles import server
from tidemark.operators.skew import LIMITS, at_most, fact_dim_join
from tidemark.session import written


def _first(value: Column, valid: Column) -> Column:
    """The valid value with the lowest ``ord``."""
    return F.min_by(F.when(valid, value), F.when(valid, F.col("ord")))


def entity_codes(claims: DataFrame) -> DataFrame:
    """The ISO code of every entity that has one: its first of two characters."""
    codes = claims.where((F.col("property") == seeds.ISO2_OF) & (F.length("value_str") == 2))
    return codes.groupBy("qid").agg(F.upper(F.min_by("value_str", "ord")).alias("iso2"))


def entity_nodes(claims: DataFrame) -> DataFrame:
    """One row per entity with the first claim of each kind."""

    def first_id(name: str) -> Column:
        return _first(F.col("value_qid"), (F.col("property") == name) & (F.length("value_qid") > 0))

    is_country = (F.col("property") == seeds.INSTANCE_OF) & (F.upper("value_qid") == seeds.COUNTRY_CLASS)
    return claims.groupBy("qid").agg(
        F.coalesce(F.max(is_country), F.lit(False)).alias("is_country"),
        first_id(seeds.COUNTRY_OF).alias("p17"),
        first_id(seeds.LOCATED_IN).alias("p131"),
    )


def entity_countries(claims: DataFrame) -> DataFrame:
    """Country of every entity that resolves.

    The direct country counts if it has an ISO code. Otherwise the walk starts
    at the entity and climbs by its location, at most four entities in all. It
    ends at the first that is a country or names one, with or without a code.
    Only entities that have not ended are joined again. What later steps read
    is written, so that they see its true size; steps of a small table are not.
    """
    codes = written(entity_codes(claims), "codes")
    own = codes.withColumnRenamed("iso2", "own_iso2")
    named = codes.select(F.col("qid").alias("p17"), F.col("iso2").alias("p17_iso2"))
    nodes = fact_dim_join(entity_nodes(claims), own, ["qid"], "left", ["qid"])
    nodes = fact_dim_join(nodes, named, ["p17"], "left", ["qid"])
    is_country, direct = F.col("is_country"), F.col("p17").isNotNull()
    steps = written(
        nodes.select(
            "qid",
            "p17",
            "p17_iso2",
            F.when(is_country, F.col("qid")).otherwise(F.col("p17")).alias("stop"),
            F.when(is_country, F.col("own_iso2")).otherwise(F.col("p17_iso2")).alias("stop_iso2"),
            F.when(~is_country & ~direct, F.col("p131")).alias("above"),
        ),
        "steps",
    )
    ended = [
        steps.select(
            "qid",
            F.coalesce("p17", "stop").alias("country"),
            F.coalesce("p17_iso2", "stop_iso2").alias("iso2"),
            direct.alias("direct"),
        )
    ]
    small = at_most(steps, LIMITS.plain_bytes)
    parents = steps.select(F.col("qid").alias("above"), "stop", "stop_iso2", F.col("above").alias("next"))
    climbing = steps.select("qid", "above")
    for node in range(2, seeds.ASCENT_NODES + 1):
        reached = fact_dim_join(climbing.where("above is not null"), parents, ["above"], "inner", ["qid"])
        reached = reached.select("qid", "stop", "stop_iso2", F.col("next").alias("above"))
        reached = reached if small else written(reached, f"node{node}")
        ended.append(
            reached.select("qid", F.col("stop").alias("country"), F.col("stop_iso2").alias("iso2"), F.lit(False).alias("direct"))
        )
        climbing = reached.select("qid", "above")
    found = ended[0]
    for more in ended[1:]:
        found = found.unionByName(more)
    by_direct = F.col("direct")
    return found.where("country is not null and iso2 is not null").select(
        F.col("qid").alias("page_qid"),
        F.col("country").alias("page_country_qid"),
        F.col("iso2").alias("page_country_code"),
        F.when(by_direct, seeds.METHOD_DIRECT).otherwise(seeds.METHOD_ASCENT).alias("geo_method"),
        F.when(by_direct, seeds.CONFIDENCE_DIRECT).otherwise(seeds.CONFIDENCE_ASCENT).alias("geo_confidence"),
    )


GEO_COLUMNS = ["page_qid", "page_country_qid", "page_country_code", "geo_method", "geo_confidence"]


def place_pages(pages: DataFrame, countries: DataFrame) -> DataFrame:
    """Add the country columns to a page table with a ``qid``; written once, read by every batch."""
    return written(fact_dim_join(pages.withColumnRenamed("qid", "page_qid"), countries, ["page_qid"], "left"), "pages")


def resolve_country(
    marked: DataFrame,
    page_entity: DataFrame,
    sitelink: DataFrame,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Fill page and country columns and the later drop reasons.

    ``marked`` comes from ``mark_articles``, the other two from ``place_pages``
    over pages by (server_name, title) and by (site, title), unique per page.
    The second is asked only by sites with the usual suffix. Events that are
    already dropped match nothing, as their join keys are null.
    """
    keep = F.col("skip_reason").isNull()
    events = marked.drop(*GEO_COLUMNS).withColumns(
        {
            "_server": F.when(keep, server()),
            "_site": F.when(keep & F.endswith("wiki", F.lit(seeds.SITE_SUFFIX)), F.col("wiki")),
        }
    )
    place = F.struct(*GEO_COLUMNS)
    primary = page_entity.select(F.col("server_name").alias("_server"), "title", place.alias("_primary"))
    second = sitelink.select(F.col("site").alias("_site"), "title", place.alias("_second"))
    found = fact_dim_join(events, primary, ["_server", "title"], "left", spread_by)
    found = fact_dim_join(found, second, ["_site", "title"], "left", spread_by)
    found = found.withColumn("_place", F.coalesce("_primary", "_second"))
    reason = (
        F.when(~keep, F.col("skip_reason"))
        .when(F.col("_place").isNull(), "no-qid")
        .when(F.col("_place.page_country_code").isNull(), "no-country")
    )
    rest = [c for c in marked.columns if c not in GEO_COLUMNS and c != "skip_reason"]
    return found.select(*rest, "_place.*", reason.alias("skip_reason"))


def centroids(features: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """One point per country: the mean of its polygon vertices, else the fallback.

    ``features`` has the GeoJSON feature as text in ``feature`` and its position
    in ``ord``; of several features of a country the last one with vertices
    counts. Only coordinates nested as polygons or multipolygons are used.
    """
    parsed = features.select("ord", F.from_json("feature", schemas.GEO_FEATURE).alias("f")).select(
        "ord",
        F.upper(
            F.coalesce(
                *[
                    F.when(F.length(F.col("f.properties")[name]) > 0, F.col("f.properties")[name])
                    for name in ("ISO_A2", "ISO2", "iso_a2")
                ]
            )
        ).alias("iso2"),
        F.col("f.geometry.coordinates").alias("xy"),
    )
    ring = "array<array<array<double>>>"
    rings = (
        F.when(F.col("xy").rlike(r"^\s*(\[\s*){4}"), F.flatten(F.from_json("xy", f"array<{ring}>")))
        .when(F.col("xy").rlike(r"^\s*(\[\s*){3}"), F.from_json("xy", ring))
    )

    def mean(vertices: Column, place: int) -> Column:
        return F.aggregate(vertices, F.lit(0.0), lambda total, point: total + point[place]) / F.size(vertices)

    # Generating the point keeps the text from being parsed for each use of it.
    outlines = F.filter(F.array(F.flatten(rings)), lambda vertices: F.size(vertices) > 0)
    means = F.transform(outlines, lambda v: F.struct(mean(v, 0).alias("lon"), mean(v, 1).alias("lat")))
    points = (
        parsed.where("iso2 is not null")
        .select("iso2", "ord", F.explode(means).alias("point"))
        .groupBy("iso2")
        .agg(F.max_by("point", "ord").alias("point"))
        .select("iso2", "point.lon", "point.lat")
    )
    if fallback is None:
        return points
    return points.unionByName(fallback.join(points, "iso2", "left_anti"))
