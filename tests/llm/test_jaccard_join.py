import random
import re
from itertools import combinations

import pytest

from tidemark.llm import jaccard_join as jj
from tidemark.llm.common import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text, width):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def brute(docs, width=3, threshold=90):
    sets = [(d, grams(t, width)) for d, t in docs]
    root = {d: d for d, _ in docs if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in combinations(sets, 2):
        if a is None or b is None:
            continue
        if a == b or x and y and 100 * len(x & y) >= threshold * len(x | y):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return sorted(((d, len(s), None if d is None else find(d)) for d, s in sets), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def near_copies(seed=4):
    """Groups of near copies around several templates, some just beside the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = [rng.choice(vocabulary) for _ in range(60)]
    docs = []
    for group in range(6):
        template = [rng.choice(vocabulary) for _ in range(rng.choice([4, 30, 90, 200]))] + (shared if group % 2 else [])
        for _ in range(rng.choice([2, 12, 25])):
            words = list(template)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(words))
                words[at : at + rng.choice([0, 1])] = [rng.choice(["NEW", rng.choice(vocabulary), f"u{rng.random()}"])]
            docs.append(" ".join(words).upper() if rng.random() < 0.3 else "  ".join(words))
    rng.shuffle(docs)
    return [(i + 1, d) for i, d in enumerate(docs)]


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_near_copies(spark, seed):
    docs = near_copies(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    wanted = brute(docs)
    assert len({w[2] for w in wanted}) < len(wanted)
    assert got(jj.near_groups(df, local_count=2)) == wanted
    if seed == 4:
        assert got(jj.near_groups(df, common_limit=1, most_sent=0)) == wanted
        assert got(jj.near_groups(df, width=5, threshold=80)) == brute(docs, 5, 80)


def test_table(documents):
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    wanted = brute(docs)
    assert got(jj.near_groups(documents)) == wanted
    kept = jj.one_of_each(documents)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({w[2] for w in wanted})


def test_awkward(spark, awkward):
    more = spark.createDataFrame(
        [(9, "ONE  two", "x", "y", 1, "z"), (9, "quite another text", "x", "y", 1, "z"), (0, "quite another TEXT", None, "y", 1, "z")],
        awkward.schema,
    )
    docs = awkward.union(more)
    pairs = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(jj.near_groups(docs)) == brute(pairs)
    kept = jj.one_of_each(docs.withColumnRenamed("sequence_id", "rank"), most_sent=0)
    assert kept.columns[-1] == "rank"
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [0, 1, 2, 3, 4, 7, None]
    assert jj.near_groups(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    assert found == {n: find(n) for a, b in edges if a != b for n in (a, b)}
