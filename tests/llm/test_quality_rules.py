import random
import re
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), sum(c in qr.SYMBOLS for c in text), lines, len(covered)


def test_statistics(documents, awkward, spark):
    rng = random.Random(1)
    odd = [(i, "".join(rng.choice("ab \n\t#é\x0b\r") for _ in range(rng.randrange(300))), "x", "y", 1, "z") for i in range(200)]
    odd += [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(12))), "x", "y", 1, "z") for i in range(200)]
    for docs in (documents, awkward.withColumnRenamed("sequence_id", "_w"), spark.createDataFrame(odd, awkward.schema)):
        rows = qr.text_statistics(docs).select("text", *qr.BASE).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert tuple(r)[1:] == brute(r.text), r.text


def test_binomial_tail(spark):
    data = [(k, n) for n in (1, 20, 700) for k in (0, 1, 2, 5, 6) if k <= n] + [(900, 100_000), (0, 50_000_000), (49_000, 5_000_000)]
    df = spark.createDataFrame(data, "k long, n long").withColumn("p", qr.binomial_tail(F.col("k"), F.col("n"), 0.01))
    for k, n, p in df.collect():
        if n <= 700:
            wanted = 1.0 if k >= n * 0.01 else sum(comb(n, i) * 0.01**i * 0.99 ** (n - i) for i in range(k + 1))
            assert p == pytest.approx(wanted, rel=1e-9)
        else:
            assert 0 <= p < 1e-2


def test_cutoffs_bound_false_rejections(spark):
    """In "a" symbols tell bad from good; in "b" good documents have them as well; "c" has few labels."""
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(9000):
        stratum = "a" if i < 4000 else "b" if i < 8000 else None if i < 8950 else "c"
        bad = rng.random() < 0.2
        noisy = bad if stratum != "b" else rng.random() < 0.5
        rows.append((i, stratum, 100, 500, 100 if noisy else 0, 0, 0, 10, 90))
        labels.append((i, 0 if bad else 1, 1))
    stats = spark.createDataFrame(
        rows, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, n_lines long, n_distinct long"
    )
    known = spark.createDataFrame([*labels, (None, 1, 1), (3, None, 1)], "doc_id long, quality int, toxic int")
    chosen = {r.stratum: r.cutoff for r in qr.cutoffs(stats, known, risk=0.05).collect()}
    assert chosen == {"a": {"symbols": 0.12}, None: {"symbols": 0.12}}
    kept = qr.judge(stats, qr.cutoffs(stats, known, risk=0.05))
    assert kept.where("not kept and (lang in ('b', 'c') or n_symbols = 0)").count() == 0
    assert kept.where("kept and n_symbols > 0 and (lang = 'a' or lang is null)").count() == 0
    assert qr.cutoffs(stats, known.limit(0)).count() == 0
    assert qr.judge(stats, qr.cutoffs(stats, known.limit(0))).where("not kept").count() == 0


def test_few_labels_are_enough_and_small_strata_are_pooled(spark):
    """450 good labels certify a clean rule in "a"; "b" and "c" have too few alone, not together; "d" has a bad rule."""
    sizes = {"a": 450, "b": 250, "c": 250, "d": 450}
    assert sizes["b"] < qr.labels_needed(4) <= 450
    rows, labels = [], []
    for lang, n in sizes.items():
        for k in range(n + 60):
            noisy = k >= n or (lang == "d" and k % 10 == 0)
            rows.append((len(rows), lang, 100, 500, 100 if noisy else 0, 0, 0, 10, 90))
            labels.append((len(labels), int(k < n)))
    stats = spark.createDataFrame(
        rows, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, n_lines long, n_distinct long"
    )
    chosen = qr.cutoffs(stats, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert {r.stratum: r.cutoff for r in chosen.collect()} == {x: {"symbols": 0.12} for x in "abc"}


def test_report_and_filter_agree(spark, folder, documents, awkward):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    for docs in (documents, awkward, awkward.limit(0)):
        report = qr.quality_report(docs, labels)
        assert report.count() == docs.count()
        kept = qr.good_documents(docs, labels)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in report.where("kept").collect())


def test_main_path_has_no_python(spark, documents, folder, capsys):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    qr.quality_report(documents, labels).explain("formatted")
    qr.text_statistics(documents).explain("formatted")
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow|BroadcastNestedLoop|Cartesian", plan)
