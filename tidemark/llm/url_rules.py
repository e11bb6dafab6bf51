"""URL rules, with block decisions carried over to equivalent addresses.

Pages that redirect to each other or name each other canonical are one group, a
connected component of those links. A rule that fits a page decides it. A page
without one is blocked if a page of its group is blocked by a rule and none is
allowed by one: an explicit allow takes precedence over a carried block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, spare
from tidemark.session import written

#: Query parameters that say where a visit came from, not what is shown.
TRACKING = r"(?:utm_[a-z]+|gclid|fbclid|ref)"


def _lower(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """Up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return _lower(F.coalesce(F.regexp_extract(_after_scheme(url), r"^(?s:[^/?#]*)", 0), F.lit("")))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*((?s:[^?#]*))", 1), F.lit(""))


def normal_form(url: Column) -> Column:
    """Host, path and query without scheme, fragment, tracking parameters and a last slash; null without a host."""
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(query, rf"(?:^|&){TRACKING}=[^&]*", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_replace(query, "^&", "")
    form = F.concat(host_of(url), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host_of(url) != "", form)


def named_targets(html: Column) -> Column:
    """All addresses that a page's links name canonical or its refreshes lead to, with ``&amp;`` read as ``&``."""

    def found(tag: str, value: str) -> Column:
        tags = F.regexp_extract_all(html, F.lit(tag), F.lit(0))
        return F.transform(tags, lambda t: F.replace(F.regexp_extract(t, value, 1), F.lit("&amp;"), F.lit("&")))

    hrefs = found(r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)")
    targets = found(r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", r"(?is)\burl\s*=\s*[\"']?([^\"'\s>;]+)")
    return F.filter(F.concat(hrefs, targets), lambda t: t != "")


def _without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments resolved; the root has no parent."""
    return F.array_join(
        F.reduce(
            F.split(path, "/"),
            F.array().cast("array<string>"),
            lambda kept, part: F.when(part == ".", kept)
            .when(part == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1))))
            .otherwise(F.concat(kept, F.array(part))),
        ),
        "/",
    )


def absolute(target: Column, url: Column) -> Column:
    """A target seen from the page's address; null if it can't be told.

    Relative ones replace what follows the last slash of the page's path, a bare
    query the page's query; a bare fragment is the page itself. Targets with another
    scheme than ``x://`` (``mailto:`` and the like) can't be told.
    """
    host, path = F.concat(F.lit("http://"), host_of(url)), path_of(url)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, r"[^/]*$", ""))
    cut = F.regexp_extract(target, r"^(?s:[^?#]*)", 0)
    rest = F.substring(target, F.length(cut) + 1, F.length(target))
    whole = F.when(F.startswith(target, F.lit("/")), cut).otherwise(F.concat(folder, cut))
    return (
        F.when(F.instr(target, "://") > 0, target)
        .when(F.startswith(target, F.lit("//")), F.concat(F.lit("http:"), target))
        .when(F.regexp_like(target, F.lit(r"^[A-Za-z][A-Za-z0-9+.\-]*:")), F.lit(None).cast("string"))
        .when(F.startswith(target, F.lit("?")), F.concat(host, path, target))
        .when(F.startswith(target, F.lit("#")), url)
        .otherwise(F.concat(host, _without_dots(whole), rest))
    )


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null.

    ``rules`` are (verdict, host/path): configuration, tried longest first.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def judged(
    pages: DataFrame, rules: list[tuple[str, str]], redirects: DataFrame | None = None, default: str = "allow"
) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, host, path, rule, verdict.

    Links are those that the pages' html names and ``redirects`` (source, target),
    between normal forms of addresses; pages of one normal form are one. Forms are
    compared by a 64-bit hash. Decisions are gathered per group with partial
    aggregates and only the groups that are blocked are joined back.

    A null url, or one without ``://``, has an empty host and path, fits no rule
    and stands alone. Null html names nothing. Rows are judged one by one.
    """
    html = F.col("html").cast("string") if "html" in pages.columns else F.lit(None).cast("string")
    url = F.col("url").cast("string")
    form = F.xxhash64(normal_form(url))
    seen = pages.select("page_id", url.alias("url"), F.when(normal_form(url).isNotNull(), form).alias("node"))
    seen = seen.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "node")
    ruled = rule_of(F.col("host"), F.col("path"), rules)
    flat = written(
        seen.withColumn("_r", ruled).select("page_id", "host", "path", "node", "_r.rule", F.col("_r.verdict").alias("own")),
        "judged-pages",
    )

    def edges(rows: DataFrame, source: Column, target: Column) -> DataFrame:
        made = rows.select(source.alias("s"), target.alias("t")).select(normal_form(F.col("s")).alias("s"), normal_form(F.col("t")).alias("t"))
        return made.where("s is not null and t is not null").select(F.xxhash64("s").alias("a"), F.xxhash64("t").alias("b"))

    named = pages.select(url.alias("u"), F.explode(named_targets(html)).alias("x")).where("x is not null")
    links = edges(named, F.col("u"), absolute(F.col("x"), F.col("u")))
    if redirects is not None:
        links = links.union(edges(redirects, F.col("source").cast("string"), F.col("target").cast("string")))
    roots = components(links)
    placed = flat.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = (
        placed.where("own is not null and root is not null")
        .groupBy("root")
        .agg(F.max((F.col("own") == "block").cast("int")).alias("b"), F.max((F.col("own") == "allow").cast("int")).alias("a"))
        .where("b = 1 and a = 0")
        .select("root", F.lit(True).alias("carried"))
    )
    verdict = F.coalesce("own", F.when(F.col("carried"), F.lit("block")), F.lit(default))
    return placed.join(groups, "root", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def allowed_pages(pages: DataFrame, rules: list[tuple[str, str]], **options) -> DataFrame:
    """The rows of ``pages`` whose verdict is allow; rows without an id are judged by their own rule alone."""
    verdicts = judged(pages, rules, **options).where("verdict = 'block' and page_id is not null").select("page_id").distinct()
    mark = spare("own", pages.columns)
    kept = pages.join(verdicts, "page_id", "left_anti")
    url = F.col("url").cast("string")
    own = rule_of(host_of(url), path_of(url), rules)["verdict"]
    return kept.withColumn(mark, own).where(F.col("page_id").isNotNull() | F.col(mark).isNull() | (F.col(mark) == "allow")).drop(mark)
