import re

import numpy as np
import pytest

from tidemark.llm import decontaminate as dec

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, width=13):
    windows = {}
    for item, text in items:
        w = split(text)
        if item is None:
            continue
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + width]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = split(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (owners := windows.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= owners
        out.append((doc, len(w), len(hit), len(found), dec.items_digest(list(found)), 0 < len(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.drop("spans").collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"shard_words": 300, "block_bytes": 500}])
def test_tables(spark, folder, documents, options):
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    wanted = brute(documents.select("doc_id", "text").collect(), benchmark.select("item_id", "text").collect())
    assert got(dec.contamination(documents, benchmark, **options)) == wanted
    kept = dec.without_contaminated(documents, benchmark, **options)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(w[0] for w in wanted if not w[-1])


def test_awkward(spark, awkward):
    items = [(1, "word1 the"), (2, None), (3, "?!"), (None, "one two"), (4, "ONE two"), (4, "naïve 12"), (5, "word2 the word3 the " * 9)]
    benchmark = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, n_words int")
    docs = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    for size in (3, 1_000_000):
        assert got(dec.contamination(awkward, benchmark, shard_words=size)) == brute(docs, items)
    clash = awkward.withColumnRenamed("sequence_id", "spans").withColumnRenamed("source", "n_words")
    assert dec.without_contaminated(clash, benchmark).columns == clash.columns
    assert dec.contamination(awkward, benchmark.limit(0)).where("n_hit > 0").count() == 0
    assert dec.contamination(awkward.limit(0), benchmark).count() == 0


def test_index_counts_and_locates():
    rng = np.random.default_rng(5)
    for size, n in ((3, 50), (9, 4000)):
        text = np.append(rng.integers(1, size, n), 0)
        text[20:30] = text[5:15]
        index = dec.FMIndex(text, size, sample=4)
        phrases = np.array([text[i : i + 4] for i in range(0, n - 4, 3)])
        low, high = index.search(phrases, np.full(len(phrases), 4))
        for p, a, b in zip(phrases, low, high, strict=True):
            wanted = [i for i in range(n - 3) if (text[i : i + 4] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == wanted
