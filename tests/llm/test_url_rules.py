import re
from urllib.parse import urljoin

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import sql
from tidemark.llm import url_rules as ur
from tidemark.llm.queries import URL_RULES

RULES = [*URL_RULES, ("block", "bad.org/")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fitting = []
    for verdict, r in RULES:
        name, _, rest = r.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fitting.append((len(r), r, verdict))
    return max(fitting)[1:] if fitting else (None, None)


def test_table(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    wanted = []
    for r in pages.collect():
        host, path = split(r.url)
        found, verdict = rule(host, path)
        wanted.append((r.page_id, host, path, found, verdict or "allow"))
    got = [tuple(r) for r in ur.judged(pages, RULES).collect()]
    assert sorted(got) == sorted(wanted)


def page(canonical=None, refresh=None):
    head = f"<LINK rel='canonical' href='{canonical}'>" if canonical else ""
    head += f'<meta http-equiv="refresh" content="0; url={refresh}">' if refresh else ""
    return f"<html><head>{head}</head></html>"


@pytest.fixture
def linked(spark):
    rows = [
        (1, "http://bad.org/x", None),
        (2, "https://alias.org/a?utm_source=q", page("http://bad.org/x/")),  # blocked through 1
        (3, "http://far.org/1#top", page(refresh="https://alias.org/a")),  # through 2
        (4, "http://far.org/1/", ""),  # the same address as 3
        (5, "http://own.com/q", page("http://bad.org/x")),  # allowed by its rule
        (6, "http://left.org/", None),
        (7, "HTTP no scheme", page("/x")), (8, None, page("http://far.org/1")), (9, "", None),
        (None, "http://bad.org/y?z://w", None), (None, "http://bad.org/y?z://w", None),
        (10, "http://BAD.org:80/", None), (11, "http://notbad.org/", None), (12, "http://bad.org", None),
        (13, "http://moved.org/", None),
    ]
    return spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, node string")


def test_blocks_are_carried(spark, linked):
    verdicts = sorted((tuple(r) for r in ur.judged(linked, RULES).select("page_id", "rule", "verdict").collect()), key=repr)
    blocked = {v[0] for v in verdicts if v[2] == "block"}
    # 5 is in the group and allowed by a rule, so the group's block isn't carried.
    assert blocked == {1, None} and len(verdicts) == 15
    without = linked.where("page_id is null or page_id <> 5")
    found = {r.page_id: r.verdict for r in ur.judged(without, RULES).collect()}
    assert {k for k, v in found.items() if v == "block"} == {1, 2, 3, 4, None}
    moves = spark.createDataFrame([("http://moved.org", "http://far.org/1"), (None, "x"), ("http://a.org", None)], "source string, target string")
    found = {r.page_id: r.verdict for r in ur.judged(without, RULES, moves).collect()}
    assert found[13] == "block" and found[6] == "allow"
    kept = ur.allowed_pages(without, RULES, redirects=moves)
    assert kept.columns == linked.columns
    assert sorted(r.page_id for r in kept.collect()) == [6, 7, 8, 9, 10, 11, 12]


def test_hosts_and_paths(linked):
    got = {(r.host, r.path) for r in ur.judged(linked, RULES).collect()}
    assert got == {split(r.url) for r in linked.collect()}
    assert ur.judged(linked.limit(0), RULES).count() == 0


TARGETS = [
    "next.html", "./next.html", "../up", "../../top/x", "../../../../over", "dir/", "dir/../x?y=1", "?x=1&amp;y=2", "#part", ".", "..",
    "/root/../a", "//other.org/z", "https://full.org/p", "mailto:a@b.org", "javascript:void(0)", "a?b=../c", "x#y", "/", "a:b", "a/./b",
]


def resolved(target, base):
    """By the standard library, whose rules are those of the web."""
    target = target.replace("&amp;", "&")
    if re.match(r"[A-Za-z][A-Za-z0-9+.\-]*:(?!//)", target):
        return None
    return urljoin(base, target)


def test_relative_targets(spark):
    bases = ["http://h.org/a/b/c.html?q=1#f", "http://h.org", "http://h.org/", "https://h.org/a/b/", "http://h.org/x"]
    rows = [(b, t) for b in bases for t in TARGETS]
    html = F.concat(F.lit('<link rel="canonical" href="'), F.col("t"), F.lit('">'))
    df = spark.createDataFrame(rows, "b string, t string").withColumn("x", F.explode(ur.named_targets(html)))
    forms = df.select("b", "t", ur.normal_form(ur.absolute(F.col("x"), F.col("b"))).alias("got")).collect()
    wanted = {(b, t): resolved(t, b) for b, t in rows}
    given = spark.createDataFrame([(*k, v) for k, v in wanted.items()], "b string, t string, v string")
    expected = {(r.b, r.t): r.v for r in given.select("b", "t", ur.normal_form(F.col("v")).alias("v")).collect()}
    assert len(forms) == len(rows) and {(r.b, r.t): r.got for r in forms} == expected


def test_all_links_are_edges_as_in_sql(spark, linked):
    """Several canonical links and refreshes on a page, relative and escaped ones; the SQL gives the same verdicts."""
    two = page("http://left.org/") + page("../y?z=1&amp;k=2") + page(refresh="other/../x")
    rows = [
        (20, "http://bad.org/s/t", two), (21, "http://bad.org/y?z=1&k=2", None), (22, "http://bad.org/s/x", None),
        (23, "http://free.org/d/e", page("f") + page("//bad.org/s/t")), (24, "http://free.org/d/f", None),
    ]
    pages = linked.select("page_id", "url", "html").unionByName(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = sorted((tuple(r) for r in ur.judged(pages, RULES).collect()), key=repr)
    verdicts = {r[0]: r[4] for r in got}
    assert verdicts[6] == verdicts[23] == verdicts[24] == "block"
    connection = duckdb.connect()
    connection.register("pages", pages.toArrow())
    assert sorted(connection.sql(sql.url_verdicts(RULES)).fetchall(), key=repr) == got
