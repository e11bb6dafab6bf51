"""Runs of repeated words against brute force over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import periodic_runs
from tidemark.llm.queries import QUERIES


def brute(words, least=6, times=4):
    s, out = np.array(words, object), []
    for p in range(1, len(s) // times + 1):
        same = np.concatenate(([False], s[:-p] == s[p:], [False])).astype(bool)
        edges = np.flatnonzero(np.diff(same.view(np.int8)))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            x = s[a : b + p]
            if len(x) >= max(least, times * p) and not any((x[q:] == x[:-q]).all() for q in range(1, p)):
                out.append((a, len(x), p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive(rnd):
    out = []
    while len(out) < rnd.randint(0, 70):
        out += [rnd.randint(1, rnd.choice([1, 2, 3, 5])) for _ in range(rnd.randint(1, 6))] * rnd.randint(1, 6)
        if out and rnd.random() < 0.3:
            out.pop()
    return out


def test_runs_of_numbers():
    rnd = random.Random(1)
    for _ in range(800):
        s = repetitive(rnd)
        assert [tuple(r) for r in periodic_runs.runs_of(s).tolist()] == brute(s)
        # All runs of two periods and more: the trees, not the lengths, decide.
        assert [tuple(r) for r in periodic_runs.runs_of(s, 2, 2).tolist()] == brute(s, 2, 2)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=40), min_size=1, max_size=4), st.integers(2, 5), st.integers(1, 9))
def test_runs_of_texts(texts, times, least):
    found = periodic_runs.text_runs([" ".join(map(str, t)).encode() for t in texts], least, times)
    for t, (words, runs) in zip(texts, found, strict=True):
        assert words == [str(x).encode() for x in t]
        assert [tuple(r) for r in runs.tolist()] == brute(t, least, times)


def test_suffix_tree_agreement():
    rnd = random.Random(2)
    for _ in range(100):
        s = [*repetitive(rnd), 9, 0]
        tree = periodic_runs.SuffixTree(s)
        assert [i for _, i in sorted(zip(tree.rank.tolist(), range(len(s)), strict=True))] == sorted(range(len(s)), key=lambda i: s[i:])
        pairs = [(a, b) for a in range(len(s)) for b in range(len(s)) if a != b]
        got = tree.agree(*map(np.array, zip(*pairs, strict=True)))
        for (a, b), n in zip(pairs, got.tolist(), strict=True):
            assert s[a : a + n] == s[b : b + n] and s[a + n : a + n + 1] != s[b + n : b + n + 1]


def test_long_texts():
    words = [f"w{i}" for i in range(3000)]
    text = " ".join([*words, *["x"] * 1000, *words * 4, *["a", "b"] * 20_000]).encode()
    runs = periodic_runs.text_runs([text])[0][1].tolist()
    assert runs == [[3000, 1000, 1], [4000, 12_000, 3000], [16_000, 40_000, 2]]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    texts = "".join("{},{},{}\n".format(*r) for r in runs), " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (len(runs), *top, *(hashlib.sha256(t.encode()).hexdigest() for t in texts))


def test_query(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op13_periodic_runs"](spark, folder).collect()
    assert len(rows) == len(texts) and any(r.n_runs for r in rows)
    for r in rows:
        assert tuple(r)[1:] == expected(r.doc_id, texts[r.doc_id])


def test_planting(spark):
    """Every tenth id, long and short texts, null and empty ones, ids that are no numbers."""
    texts = ["", None, " \t", "one", "a b", *(" ".join(f"w{i}" for i in range(n)) for n in (3, 7, 40, 200))]
    data = [(f"{i}", texts[i % len(texts)]) for i in range(1500)] + [(None, texts[-1])]
    docs = spark.createDataFrame(data, "doc_id string, text string")
    planted = docs.withColumn("text", periodic_runs.planted(F.col("doc_id"), F.col("text")))
    rows = periodic_runs.find_runs(planted).select("doc_id", *periodic_runs.digest()).collect()
    by_id = dict(data)
    assert sum(r.n_runs > 0 for r in rows) > 5
    for r in rows:
        assert tuple(r)[1:] == expected(r.doc_id, by_id[r.doc_id])


def test_awkward_rows(awkward):
    docs = awkward.withColumnRenamed("source", "runs")  # a name that clashes is replaced
    rows = periodic_runs.find_runs(docs).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        # The long text repeats 1,400 words.
        runs, kept = ([(0, 40_000, 1400)], words[:1400]) if r.doc_id == 4 else ([], words)
        assert r.n_words == len(words) and [tuple(x) for x in r.runs] == runs and r.collapsed == " ".join(kept)
    assert periodic_runs.find_runs(awkward.limit(0)).count() == 0


def test_ties_of_exponents(spark):
    text = "a a a a a a x b b b b b b y c d c d c d c d c d c d"
    row = periodic_runs.find_runs(spark.createDataFrame([(1, text)], "doc_id int, text string")).select(*periodic_runs.digest()).first()
    assert tuple(row)[:5] == (3, 0, 6, 1, 6000)
