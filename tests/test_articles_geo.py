import json


from tidemark import schemas
from tidemark.operators import geo
from tidemark.operators.articles import edit_rows, mark_articles
from tidemark.sources.edits import messages, parse_edits, parse_raw_edits, rejected_count

WIKI = "wikipedia.org"


def _feed(rows, events):
    return rows([(e if isinstance(e, str) else json.dumps(e),) for e in events], "value string")


def test_article_reasons(rows):
    cases = [
        ({"server_name": f"en.{WIKI}", "namespace": 0, "title": "A"}, None),
        ({"server_url": f"https://de.{WIKI}", "title": "B"}, None),
        ({"server_name": "", "server_url": f"http://fr.{WIKI}", "title": "C"}, None),
        ({"server_name": f"en.{WIKI}", "title": "D"}, None),
        ({"server_name": "commons.wikimedia.org", "title": "E"}, "non-wikipedia"),
        ({"title": "F"}, "non-wikipedia"),
        ({"server_name": f"en.{WIKI}", "namespace": 1, "title": "G"}, "non-article"),
        ({"server_name": f"en.{WIKI}", "ns": 1, "namespace": 0, "title": "H"}, "non-article"),
        ({"server_name": f"en.{WIKI}", "ns": 0, "namespace": 1, "title": "I"}, None),
        ({"server_name": f"en.{WIKI}", "title": ""}, "no-title"),
        ({"server_name": f"en.{WIKI}"}, "no-title"),
        ({"server_name": "x.org", "namespace": 1, "title": ""}, "non-wikipedia"),
    ]
    marked = mark_articles(parse_raw_edits(_feed(rows, [event for event, _ in cases])))
    got = {json.dumps(json.loads(r.raw)): r.skip_reason for r in marked.select("raw", "skip_reason").collect()}
    assert got == {json.dumps(event): reason for event, reason in cases}


def test_unreadable_text_is_counted(rows):
    feed = _feed(rows, ['{"title": ', "", "[1]", "nonsense", '{"title": "ok"}', "{}", {"other": 1}])
    assert parse_raw_edits(feed).count() == 3
    assert rejected_count(feed).first().rejected == 4


def test_only_messages(rows):
    feed = rows([("message", "{}"), ("ping", "{}"), (None, "{}")], "kind string, value string")
    assert messages(feed).count() == 1


def test_edit_row(rows):
    events = [
        {"meta": {"id": "grow", "dt": "2024-01-01T10:00:30Z"}, "length": {"old": 4, "new": 10}, "user": "u"},
        {"meta": {"id": "shrink", "dt": "2024-01-01T12:00:00+02:00"}, "length": {"old": 10, "new": 4}},
        {"meta": {"id": "none", "dt": "not a date"}, "namespace": "0"},
    ]
    got = {
        r.meta_id: (r.added, r.removed, str(r.dt), r.namespace, r.page_id)
        for r in edit_rows(parse_edits(_feed(rows, events))).collect()
    }
    assert got == {
        "grow": (6, 0, "2024-01-01 10:00:30", None, None),
        "shrink": (0, 6, "2024-01-01 10:00:00", None, None),
        "none": (0, 0, "None", None, None),
    }
    assert set(edit_rows(parse_edits(_feed(rows, events))).columns) == {
        line.split()[0] for line in schemas.EDIT.replace("\n", " ").split(",") if line.strip()
    } - {"topics"}


CLAIMS = [
    # qid, property, ord, value_qid, value_str
    ("Q30", "P297", 0, None, "us"), ("Q30", "P31", 0, "Q6256", None),
    ("Q183", "P297", 0, None, "DE"), ("Q142", "P297", 0, None, "FR"),
    ("direct", "P17", 0, "Q30", None),
    ("two", "P17", 1, "Q30", None), ("two", "P17", 0, "Q142", None),
    ("no_id", "P17", 0, None, None), ("no_id", "P17", 1, "Q30", None),
    ("B", "P17", 0, "Q183", None), ("A", "P131", 0, "B", None), ("chain", "P131", 0, "A", None),
    ("c3", "P17", 0, "Q183", None), ("c2", "P131", 0, "c3", None), ("c1", "P131", 0, "c2", None),
    ("fourth", "P131", 0, "c1", None), ("fifth", "P131", 0, "fourth", None),
    ("own", "P31", 0, "q6256", None), ("own", "P297", 0, None, "FR"),
    ("codeless", "P17", 0, "X", None), ("X", "P31", 0, "Q1", None),
    ("both", "P17", 0, "X", None), ("both", "P31", 0, "Q6256", None), ("both", "P297", 0, None, "XX"),
    ("ring", "P131", 0, "ring2", None), ("ring2", "P131", 0, "ring", None),
    ("long", "P17", 0, "L", None), ("L", "P297", 0, None, "USA"), ("L", "P297", 1, None, "US"),
    ("under", "P131", 0, "codeless", None),
    ("gone", "P131", 0, "missing", None),
]

EXPECTED = {
    "Q30": ("Q30", "US", "P131_chain", 80),
    "direct": ("Q30", "US", "P17", 100),
    "two": ("Q142", "FR", "P17", 100),
    "no_id": ("Q30", "US", "P17", 100),
    "A": ("Q183", "DE", "P131_chain", 80),
    "B": ("Q183", "DE", "P17", 100),
    "chain": ("Q183", "DE", "P131_chain", 80),
    "c1": ("Q183", "DE", "P131_chain", 80),
    "c2": ("Q183", "DE", "P131_chain", 80),
    "c3": ("Q183", "DE", "P17", 100),
    "fourth": ("Q183", "DE", "P131_chain", 80),
    "own": ("own", "FR", "P131_chain", 80),
    "both": ("X", "XX", "P17", 100),
    "long": ("L", "US", "P17", 100),
}


def test_entity_countries(rows):
    claims = rows(CLAIMS, schemas.CLAIM)
    got = {r[0]: tuple(r[1:]) for r in geo.entity_countries(claims).collect()}
    assert got == EXPECTED


def test_resolution_reasons(rows):
    countries = geo.entity_countries(rows(CLAIMS, schemas.CLAIM))
    pages = rows([(f"en.{WIKI}", "T1", "direct"), (f"en.{WIKI}", "T2", "fifth")], "server_name string, title string, qid string")
    links = rows([("enwiki", "T3", "chain"), ("commons", "T3", "direct"), ("enwiki", "T1", "own")], "site string, title string, qid string")
    events = [
        ("T1", "enwiki", None, "US"), ("T2", "enwiki", "no-country", None), ("T3", "enwiki", None, "DE"),
        ("T3", "commons", "no-qid", None), ("T4", "enwiki", "no-qid", None), ("", "enwiki", "no-title", None),
    ]
    feed = _feed(rows, [{"server_name": f"en.{WIKI}", "title": t, "wiki": w} for t, w, _, _ in events])
    marked = mark_articles(parse_raw_edits(feed))
    resolved = geo.resolve_country(marked, geo.place_pages(pages, countries), geo.place_pages(links, countries))
    got = {(r.title, r.wiki, r.skip_reason, r.page_country_code) for r in resolved.collect()}
    assert got == set(events)


def test_centroids(rows):
    def feature(iso, coordinates, kind="Polygon", key="ISO_A2"):
        return json.dumps({"properties": {key: iso, "ADMIN": 1}, "geometry": {"type": kind, "coordinates": coordinates}})

    ring = [[0, 0], [4, 0], [4, 4], [0, 0]]
    features = [
        feature("aa", [ring]),
        feature("BB", [[ring], [[[10, 10], [20, 20]]]], "MultiPolygon", "ISO2"),
        feature("CC", [1, 2], "Point"),
        feature("DD", [[1, 2], [3, 4]], "LineString"),
        feature("", [ring]),
        feature("EE", [ring], key="iso_a2"),
        feature("EE", [[[6, 6], [8, 8]]]),
        json.dumps({"properties": {"ISO_A2": "FF"}, "geometry": None}),
    ]
    table = rows(list(enumerate(features)), "ord int, feature string")
    fallback = rows([("AA", 9.0, 9.0), ("XK", 20.0, 42.0)], schemas.CENTROID)
    got = {r.iso2: (r.lon, r.lat) for r in geo.centroids(table, fallback).collect()}
    assert got == {
        "AA": (2.0, 1.0), "BB": (38 / 6, 34 / 6), "EE": (7.0, 7.0), "XK": (20.0, 42.0),
    }
