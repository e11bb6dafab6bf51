import random

import pytest
from pyspark.sql import functions as F

from tidemark import schemas, seeds
from tidemark.operators import topics as T


def _tag(rows, texts, pairs, **options):
    edits = rows([(str(n), title, comment) for n, (title, comment) in enumerate(texts)], "meta_id string, title string, comment string")
    return {r.title: r.topics for r in T.tag_topics(edits, pairs, **options).collect()}


@pytest.fixture
def pairs(rows):
    return rows(
        [
            ("war", "war"), ("finance", "bank"), ("finance", "inflation"), ("economics", "inflation"),
            ("finance", "rate"), ("finance", "interest rate"), ("technology", "re"),
            ("politics", "élection"), ("consumer", "e-commerce"),
        ],
        "topic string, keyword string",
    )


TEXTS = [
    ("The Award", None), ("WAR, and bank", None), ("x1", "Inflation!"), ("Élection", None),
    ("x2", "interest rate"), ("re", ""), ("E-Commerce", None), (None, None),
]


@pytest.mark.parametrize("literal_pairs", [100, 0])
def test_ascii_tokens(rows, pairs, literal_pairs):
    assert _tag(rows, TEXTS, pairs, literal_pairs=literal_pairs) == {
        "WAR, and bank": ["finance", "war"],
        "x1": ["economics", "finance"],
        "x2": ["finance"],
        "re": ["technology"],
    }


@pytest.mark.parametrize("literal_pairs", [100, 0])
def test_unicode_tokens_and_phrases(rows, pairs, literal_pairs):
    single = _tag(rows, TEXTS, pairs, mode="unicode_token", literal_pairs=literal_pairs)
    assert single["Élection"] == ["politics"]
    assert "E-Commerce" not in single
    several = _tag(rows, TEXTS, pairs.where(F.col("keyword") != "rate"), mode="phrase", literal_pairs=literal_pairs)
    assert several["E-Commerce"] == ["consumer"]
    assert several["x2"] == ["finance"]
    assert "The Award" not in several


def test_token_order_does_not_matter(rows, pairs):
    one = _tag(rows, [("war bank re", None)], pairs)
    other = _tag(rows, [("re bank war", None)], pairs)
    assert list(one.values()) == list(other.values())


def test_empty_dictionary_keeps_nothing(rows, pairs):
    assert _tag(rows, TEXTS, pairs.limit(0)) == {}


def test_keyword_pairs(rows):
    topics = rows(
        [
            ("a", "A", True, ["dCF", "dcf", "", None, "x"]), ("b", "B", False, ["y"]),
            ("other", "Other", True, ["z"]), ("c", "C", True, []),
        ],
        schemas.TOPIC,
    )
    assert sorted(map(tuple, T.keyword_pairs(topics).collect())) == [("a", "dcf"), ("a", "x")]


def test_topic_keys_fall_back(spark, rows):
    assert [r.key for r in T.topic_keys(seeds.topics(spark)).collect()] == sorted(key for key, *_ in seeds.TOPICS)
    empty = rows([], schemas.TOPIC)
    assert [r.key for r in T.topic_keys(empty).collect()] == sorted(seeds.DEFAULT_TOPIC_KEYS)


def test_seed_tables(spark):
    assert (seeds.topics(spark).count(), seeds.tickers(spark).count()) == (10, 30)
    assert (seeds.countries(spark).count(), seeds.fallback_centroids(spark).count()) == (34, 35)
    unknown = seeds.tickers(spark).join(seeds.countries(spark), "iso2", "left_anti")
    assert unknown.count() == 0


def test_both_plans_tag_the_same_rows(rows, pairs):
    """Rows with null and repeated ids, and repeated rows, are tagged by their own text."""
    data = [(None, "war", None), (None, "bank", None), ("1", "war", "bank"), ("1", "re", None), ("1", "re", None), ("2", None, None)]
    edits = rows(data, "meta_id string, title string, comment string")
    for mode in T.MODES:
        found = [sorted(map(repr, T.tag_topics(edits, pairs, mode=mode, literal_pairs=n).collect())) for n in (100, 0)]
        assert found[0] == found[1] and len(found[0]) == 5


def test_texts_are_hashed_once(rows, capsys):
    """Digest and terms come from one generator; above the terms' own no digest is worked out."""
    edits = rows([("a", "one two")], "title string, comment string")
    T.tag_topics(edits, rows([("t", "two")], "topic string, keyword string"), literal_pairs=0).explain("extended")
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    lines = [line.strip(" :+-") for line in plan.splitlines()]
    at = next(i for i, line in enumerate(lines) if "Generate explode(_terms" in line)
    assert "sha2" not in lines[at - 1] and any(line.startswith("Generate inline") and "sha2" in line for line in lines[at:])


def test_phrase_tree_gives_the_rows_of_the_literal_plan(rows):
    rnd = random.Random(4)
    words = ["a", "b", "c", "dd", "é"]
    phrases = sorted({" ".join(rnd.choices(words, k=rnd.randint(1, 6))) for _ in range(300)})
    pairs = rows([(f"t{n % 7}", p) for n, p in enumerate(phrases)], "topic string, keyword string")
    texts = [(str(n), " ".join(rnd.choices([*words, "x", "y", "z"], k=rnd.randint(0, 12)))) for n in range(150)]
    texts += [("0", None), (None, None), (None, "a b"), ("7", texts[7][1])]
    literal = {k: v for k, v in _tag(rows, texts, pairs, mode="phrase").items()}
    assert len(literal) > 50 and _tag(rows, texts, pairs, mode="phrase", literal_pairs=0) == literal


def test_phrase_tree_makes_no_other_runs(rows):
    """Runs are made only at places whose two words begin a phrase, of the lengths that follow them."""
    edits = rows([("a", "one two three"), ("b", "two one")], "title string, comment string")
    pairs = rows([("t", "one two three four five six"), ("u", "two")], "topic string, keyword string")
    found = T._phrases_that_may_match(
        T._once(edits, F.col("title"), F.split("comment", " ")),
        pairs,
    )
    assert [tuple(r) for r in found.collect()] == [("a", "one two three")]


def test_a_hundred_thousand_phrases(rows, spark):
    """Phrases of two to six words; every text holds two of them, and nothing else is found."""
    def phrase(n):
        return F.concat_ws(" ", *[F.when(F.lit(k) < 2 + n % 5, F.concat(F.lit("w"), (n * 7 + k * (n % 11)) % 900)) for k in range(6)])

    numbers = spark.range(100_000).select(F.col("id").alias("n"), phrase(F.col("id")).alias("keyword"))
    pairs = numbers.select(F.concat(F.lit("t"), F.col("n") % 50).alias("topic"), "keyword")
    texts = numbers.where(F.col("n") % 5000 == 3).select(
        F.concat(F.lit("zz "), "keyword", F.lit(" yy")).alias("title"), F.lit(None).cast("string").alias("comment")
    )
    got = {r.title: r.topics for r in T.tag_topics(texts, pairs, mode="phrase").collect()}
    known = {}
    for r in pairs.collect():
        known.setdefault(r.keyword, set()).add(r.topic)
    assert len(got) == 20
    for title, topics in got.items():
        w = title.split(" ")
        held = {" ".join(w[i:j]) for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        assert topics == sorted(set().union(*(known[p] for p in held & known.keys())))
