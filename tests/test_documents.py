"""Typed fields of JSON documents."""

from tidemark.operators import documents


def test_fields(rows, capsys):
    texts = ['{"a": {"b": [1, "2"]}, "c": "x"}', '{"a": 5}', "[1, 2]", '{"a": ', "", None, "null", '{"c": 3.0}']
    df = rows([(n, t) for n, t in enumerate(texts)], "n int, text string")
    fields = {"first": ("$.a.b[0]", "int"), "second": ("$.a.b[1]", "int"), "c": ("$.c", "string"), "c_number": ("$.c", "int")}
    found = documents.with_fields(df, "text", fields)
    got = {r.n: (r.first, r.second, r.c, r.c_number, r.malformed) for r in found.collect()}
    none = (None,) * 4
    assert got[0] == (1, 2, "x", None, False) and got[7] == (None, None, "3", 3, False)
    assert got[1] == got[2] == got[5] == got[6] == (*none, False) and got[3] == got[4] == (*none, True)
    assert documents.malformed_count(df, "text").first() == (7, 2)
    found.explain("extended")
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert plan.count("parse_json") + plan.count("parseJson") == 1
