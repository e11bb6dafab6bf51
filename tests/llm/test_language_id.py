import math
import zlib

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import language_id as li

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def by_hand(word, table):
    """Sum over all segmentations, written out as a recursion."""
    if not word:
        return 1.0
    return sum(table[word[:n]] * by_hand(word[n:], table) for n in range(1, len(word) + 1) if word[:n] in table)


@pytest.fixture(scope="module")
def toy():
    strings = [bytes([b]) for b in range(256)] + [b" a", b"ab", b"bc", b" abc", b"cab", "é".encode(), b"caba"]
    p = np.random.default_rng(1).dirichlet(np.ones(len(strings)), 2).T
    return strings, li.Pieces(strings), p


def test_sum_over_segmentations(toy):
    strings, pieces, p = toy
    words = [b"abc", b"a", b"cabab", "éa\u3000b".encode(), b"bcabcabc", b"caba"]
    buffer = li.joined(words)
    starts = np.cumsum([1, *[len(w) + 1 for w in words[:-1]]])
    logs = li.word_logs(pieces, p, buffer, starts, starts + [len(w) for w in words])
    for k in range(2):
        table = dict(zip(strings, p[:, k], strict=True))
        for w, got in zip(words, logs[:, k], strict=True):
            assert got == pytest.approx(math.log(by_hand(b" " + w, table)), rel=1e-9)


def test_long_words_are_summed_over_the_parts_borders(toy):
    """Words around and beyond the length worked on at once, against one pass over the whole word."""
    strings, pieces, p = toy
    rng = np.random.default_rng(3)
    words = [bytes(rng.choice(list(b"abc"), n)) for n in (254, 255, 256, 257, 300, 511, 512, 513, 2000, 7)]
    buffer = li.joined(words)
    starts = np.cumsum([1, *[len(w) + 1 for w in words[:-1]]])
    logs = li.word_logs(pieces, p, buffer, starts, starts + [len(w) for w in words])
    for k in range(2):
        table = dict(zip(strings, p[:, k], strict=True))
        for word, got in zip(words, logs[:, k], strict=True):
            w, sums, scale = b" " + word, [1.0], 0.0
            for i in range(1, len(w) + 1):
                # Sums over the last places, with what was taken out of them in ``scale``.
                sums.append(sum(sums[-n] * table.get(w[i - n : i], 0.0) for n in range(1, min(i, 8) + 1)))
                if sums[-1] < 1e-200:
                    sums = [x * 1e200 for x in sums[-10:]]
                    scale -= math.log(1e200)
            assert got == pytest.approx(math.log(sums[-1]) + scale, rel=1e-9)


def test_no_piece_is_left_out():
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PIECES)
    longest = max(len(model.id_to_piece(i).replace("▁", " ").encode()) for i in range(259, model.get_piece_size()))
    assert longest > 16 and max(map(len, li.piece_strings(PIECES))) == longest


def test_expected_counts(toy):
    """The expected counts are p times the slope of the log probability."""
    strings, pieces, p = toy
    words = [b"abcab", b"caba", b"b"]
    buffer = li.joined(words)
    starts = np.cumsum([1, *[len(w) + 1 for w in words[:-1]]])
    ends = starts + [len(w) for w in words]
    weight = np.array([[2.0, 1], [1, 0], [3, 3]])
    counts = np.zeros_like(p)
    for rows, edges, lengths, width in li._groups(pieces, np.frombuffer(buffer, np.uint8), starts, ends, 2):
        counts += li.expected(edges, p, lengths, width, weight[rows])
    for piece in (strings.index(x) for x in (b" a", b"ab", b"caba", b"b", b" ")):
        more = p.copy()
        more[piece] *= 1 + 1e-6
        slope = (li.word_logs(pieces, more, buffer, starts, ends) - li.word_logs(pieces, p, buffer, starts, ends)) * weight
        assert counts[piece] == pytest.approx(slope.sum(0) / 1e-6, rel=1e-3, abs=1e-6)


def test_long_words_are_cut_not_dropped(toy):
    _, pieces, p = toy
    names, share = li.judge(pieces, li.Model(["x", "y"], np.zeros(2), p), [b"ab" * 5000, b"", b"abc"])
    assert len(names) == 3 and np.isfinite(share).all() and share[1] == pytest.approx(0.5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = li.identify(docs, PIECES, per_language=60, rounds=1).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    held = [r.lang == r.lang_pred for r in found if r.held_out]
    assert np.mean(held) > 0.9


def test_awkward(spark, awkward):
    extra = spark.createDataFrame([(8, "123 ... !", "en", "a", 9, "x")], awkward.schema)
    docs = awkward.union(extra).withColumnRenamed("sequence_id", "letters")
    rows = {r.doc_id: r for r in li.identify(docs, PIECES).collect()}
    assert [rows[k].lang_pred for k in (1, 2, 3, 8)] == ["und"] * 4 and rows[1].score == 0
    assert rows[4].lang_pred in ("en", "de", "fr")
    assert li.identify(docs.limit(0), PIECES).count() == 0
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in li.identify(unlabelled, PIECES).collect()} == {"und"}
