import math
import re
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import common
from tidemark.llm import gru_lm as lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), None]


def held(doc):
    return zlib.crc32(b"" if doc is None else str(doc).encode()) % 7 == 2


def check(rows, docs):
    counts = Counter(t for d, text in docs if not held(d) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    wanted = []
    for d, text in docs:
        t = tokens(text)
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in t)
        wanted.append((d, held(d), len(t), sum(counts[x] > 0 for x in t), n, round(base, 4)))
    got = [(*tuple(r)[:5], round(r.base_score, 4)) for r in rows]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert all(math.isfinite(r.score) and r.score <= 1e-6 for r in rows)


def test_counts_and_base_scores(documents):
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    for options in ({}, {"vocabulary": 70, "common": 300, "hidden": 4, "one_in": 2}):
        check(lm.language_scores(documents, **options).collect(), docs)


def test_awkward(awkward):
    docs = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    renamed = awkward.withColumnRenamed("sequence_id", "row").withColumnRenamed("source", "token")
    check(lm.language_scores(renamed, common=20, vocabulary=8, hidden=3).collect(), docs)
    assert lm.language_scores(awkward.limit(0)).count() == 0
    only_held = awkward.where("doc_id is not null and crc32(cast(cast(doc_id as string) as binary)) % 7 = 2")
    check(lm.language_scores(only_held).collect(), [tuple(r) for r in only_held.select("doc_id", "text").collect()])


def small_net():
    net = lm.new_net(np.array([5.0, 9, 8, 7, 3] * 30), 6, seed=3)
    rng = np.random.default_rng(4)
    return {k: (v + rng.normal(0, 0.3, v.shape)).astype(np.float64) if k != "ob" else v.astype(np.float64) for k, v in net.items()}


def test_gradients():
    rng = np.random.default_rng(1)
    net = small_net()
    x, y = rng.integers(0, 150, (3, 5)), rng.integers(0, 150, (3, 5))
    h = rng.normal(0, 0.5, (3, 6))
    grads, _, _ = lm.train_window(net, x, y, h, end=7)
    for name in net:
        flat = net[name].reshape(-1)
        for i in rng.integers(0, flat.size, 6):
            old = flat[i]
            flat[i] = old + 1e-5
            up = lm.train_window(net, x, y, h, 7)[2]
            flat[i] = old - 1e-5
            down = lm.train_window(net, x, y, h, 7)[2]
            flat[i] = old
            assert grads[name].reshape(-1)[i] == pytest.approx(-(up - down) / 2e-5, abs=1e-4)


def test_probabilities_sum_to_one():
    net = small_net()
    h = np.random.default_rng(2).normal(0, 1, (1, 6))
    every = lm.output(net, np.repeat(h, 150, 0), np.arange(150))
    assert np.exp(every).sum() == pytest.approx(1, abs=1e-6)


def test_score_follows_the_whole_text():
    """The windowed scores equal a plain loop over one text at a time."""
    net = lm.new_net(np.array([5.0, 9, 8, 7, 3] * 4), 5, seed=3)
    words = lm.Words(np.array([lm.END]), np.array([9]), np.array([1]), np.ones(20), 9, 1, 0.5, None)
    rng = np.random.default_rng(5)
    lengths = [0, 3, 70, 1, 33, 0]
    ids = rng.integers(0, 20, sum(lengths))
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    got = lm.score_texts(net, words, ids, bounds)
    table = net["embed"] @ net["wx"] + net["b"]
    for k in range(len(lengths)):
        h, last, total = np.zeros((1, 5), np.float32), 1, 0.0
        for target in [*ids[bounds[k] : bounds[k + 1]], 1]:
            h, _ = lm.cell(table[[last]], h, net["wh"])
            total += lm.output(net, h, np.array([target]))[0]
            last = target
        assert got[k] == pytest.approx(total / math.log(10), rel=1e-4)


def test_training_learns_order():
    rng = np.random.default_rng(6)
    ids = np.concatenate([[*(np.arange(8) + rng.integers(1, 4)), 1] for _ in range(900)])
    net = lm.new_net(np.bincount(ids, minlength=12), 12)
    words = lm.Words(np.array([lm.END]), np.array([9]), np.array([1]), np.ones(12), 9, 1, 0.5, None)
    bounds = np.arange(0, 9 * 40, 9)
    before = lm.score_texts(net, words, ids, bounds).sum()
    after = lm.score_texts(lm.train(net, ids, 1, streams=8, rate=0.05), words, ids, bounds).sum()
    assert after > before * 0.75


def test_rounds_train_on_every_training_document_once(documents, monkeypatch):
    seen = []
    monkeypatch.setattr(lm, "train_round", lambda rows, net, words: seen.extend(r.doc_id for r in rows.collect()) or net)
    lm.language_scores(documents)
    assert sorted(seen) == sorted(r.doc_id for r in documents.collect() if not held(r.doc_id))


@pytest.mark.parametrize("n", [1, 31, 97, 1000])
def test_every_id_is_trained_on(monkeypatch, n):
    seen, window = [], lm.train_window
    monkeypatch.setattr(lm, "train_window", lambda net, x, y, h, end: seen.extend(y.ravel()) or window(net, x, y, h, end))
    ids = np.arange(n) % 150
    lm.train(lm.new_net(np.ones(150), 4), ids, 7, streams=9, steps=5)
    assert sorted(seen) == sorted(ids)


def test_spelling_sums_to_one():
    """Over words of two bytes at most, with what longer words have taken off."""
    words = [b"ab", b"ba", b"a", b"abc", b"b", b"aab"]
    buffer = b" ".join(words)
    starts = np.cumsum([0, *[len(w) + 1 for w in words]])[:-1]
    codes, _ = lm.spelled_codes(buffer, starts, starts + [len(w) for w in words])
    triples, counts = np.unique(codes[:, 0] * 66_049 + codes[:, 1] * 257 + codes[:, 2], return_counts=True)
    chain = lm.Chain(triples, counts)
    k = chain.code[:256]
    for before in ((256, 256), (256, 97), (97, 98), (200, 201)):
        a, b = chain.code[list(before)]
        each = 10.0 ** (chain.log[a, b, k] - np.where(k == 95, chain.other, 0))
        assert each.sum() + 10.0 ** chain.log[a, b, 0] == pytest.approx(1, abs=0.02)


def test_edges_of_words_are_no_bytes():
    """The edge has a code of its own, and spelling by tables equals a plain walk over a word's bytes."""
    words = [b"ab", b"\x00a", b"a", "né".encode(), b"\x00"]
    buffer = b" ".join(words)
    starts = np.cumsum([0, *[len(w) + 1 for w in words]])[:-1]
    ends = starts + [len(w) for w in words]
    codes, rows = lm.spelled_codes(buffer, starts, ends)
    assert codes.tolist()[:3] == [[256, 256, 97], [256, 97, 98], [97, 98, 256]] and rows[-1] == sum(len(w) + 1 for w in words)
    chain = lm.Chain(codes[:, 0].astype(int) * 66_049 + codes[:, 1] * 257 + codes[:, 2], np.ones(len(codes)))
    for word, got in zip(words, chain.spell(buffer, starts, ends), strict=True):
        k = chain.code[[256, 256, *word, 256]]
        wanted = sum(chain.log[a, b, c] - (chain.other if c == 95 else 0) for a, b, c in zip(k, k[1:], k[2:], strict=False))
        assert got == pytest.approx(wanted, rel=1e-5)


def test_common_tokens_are_found_by_their_leading_bits():
    """Also where many share them, and where a hash lies beside those of a common token."""
    rng = np.random.default_rng(7)
    common = np.unique(np.concatenate((rng.integers(0, 2**63, 300, np.uint64) * 2, np.arange(50, dtype=np.uint64), 2**64 - 1 - np.arange(9, dtype=np.uint64))))
    words = lm.Words(common, np.arange(1, len(common) + 1), np.arange(len(common)) % 7, np.ones(7), 9, 1, 0.5, None)
    asked = np.concatenate((common, common + np.uint64(1), common - np.uint64(1), rng.integers(0, 2**63, 500, np.uint64)))
    ids, counts = lm.look_up(words, asked)
    wanted = {h: (k % 7, k + 1) for k, h in enumerate(common.tolist())}
    assert [*zip(ids.tolist(), counts.tolist(), strict=True)] == [wanted.get(h, (0, 0)) for h in asked.tolist()]


def test_scoring_keeps_the_ids_of_a_group_and_a_slice_of_the_rest(documents, monkeypatch):
    """A task that keeps all words' arrays and bytes until they are scored takes several times as much."""
    runs, in_arrow = [], lm.in_arrow
    monkeypatch.setattr(lm, "in_arrow", lambda rows, run, ddl: runs.append(run) or in_arrow(rows, run, ddl))
    lm.language_scores(documents)
    monkeypatch.setattr(lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    text = [" ".join(f"w{(k * 31 + i * i) % 5000}" for i in range(700)) for k in range(5000)]
    rows = {"doc_id": range(5000), "held_out": [k % 7 == 2 for k in range(5000)], "text": text}
    batch = pa.RecordBatch.from_pydict(rows)
    del text, rows
    tracemalloc.start()
    try:
        got = [r for b in runs[-1](iter([batch])) for r in zip(*(b.column(n).to_pylist() for n in ("row", "doc_id", "n_tokens")), strict=True)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got == [(3 << 40 | k, k, 701) for k in range(5000)]
    assert peak < 220e6


def test_word_hashes_are_the_polynomial_of_the_bytes():
    """Whatever piece a word falls in, and however long it is."""
    rng = np.random.default_rng(8)
    for buffer in (b"", b" ", b"a", b" \nab  c ", bytes(200_000), b"x" * 70_000 + b" y " + b"z" * 140_000, rng.choice(list(b"abc \x00\xff"), 300_000).astype(np.uint8).tobytes()):
        hashes, starts, ends = common.word_hashes(buffer, common.SPACED)
        spans = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", buffer)]
        assert [*zip(starts.tolist(), ends.tolist(), strict=True)] == spans
        for (a, b), got in [*zip(spans, hashes.tolist(), strict=True)][:: max(1, len(spans) // 50)]:
            total = sum((c + 1) * pow(common._BASE, i, 1 << 64) for i, c in enumerate(buffer[a:b])) + b - a
            assert got == int(common.mix(np.array([total % (1 << 64)], np.uint64))[0])


def test_weights_of_tasks_are_averaged_by_their_tokens(spark, monkeypatch):
    monkeypatch.setattr(lm, "in_arrow", lambda rows, run, ddl: run_here(rows, run, ddl))

    def run_here(rows, run, ddl):
        """Each row a task of its own."""
        found = [b.to_pylist() for r in rows.collect() for b in run(iter([pa.RecordBatch.from_pylist([r.asDict()])]))]
        return spark.createDataFrame([tuple(x.values()) for some in found for x in some], ddl)

    net = lm.new_net(np.array([5.0, 9, 8, 7, 3] * 4), 5, seed=3)
    words = lm.Words(np.array([lm.END]), np.array([9]), np.array([1]), np.ones(20), 9, 1, 0.5, None)
    monkeypatch.setattr(lm, "train", lambda net, ids, end, squares: {k: v + len(ids) for k, v in net.items()})
    rows = spark.createDataFrame([(1, False, "a b c"), (2, False, "a")], "doc_id long, held_out boolean, text string")
    got = lm.train_round(rows, net, words)
    for k, v in net.items():
        assert got[k] == pytest.approx(v + (4 * 4 + 2 * 2) / 6, rel=1e-5)
