"""Encoder, packing and token files against whole-text encoding."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import packing, token_files
from tidemark.llm.bpe import Encoder
from tidemark.llm.common import new_folder


@pytest.fixture(scope="module")
def plain(vocabulary):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)

    def ids(text):
        return tokenizer.encode(text or "", add_special_tokens=False).ids

    return ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_encoded_apart_give_the_whole_texts_ids(vocabulary, plain):
    rng = random.Random(3)
    odd = ["a  b", " a b ", "x\n b  c", "　x y", "", None, "don't 's 12 34!!  \t x\r\n\r\n y", "a\xa0 b", "Ġ Ġx b", "  "]
    odd += ["".join(rng.choice(" \n\ta1.é'　 \x1c\x85Ġs") for _ in range(rng.randrange(30))) for _ in range(3000)]
    small = Encoder(vocabulary, limit=50)
    for some in (odd, odd):
        assert [list(np.frombuffer(b, "<u4")) for b in small.encode(some)] == [plain(t) for t in some]


def test_added_tokens_are_those_of_the_plain_call(vocabulary, plain):
    texts = ["one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|>b  c\n", "one two", None, "<|endoftext|> <|endoftext|>", "<|endoftext |>"]
    got = [list(np.frombuffer(b, "<u4")) for b in Encoder(vocabulary).encode(texts)]
    assert got == [plain(t) for t in texts] and got[0] == [505, 220, 50256, 734]


def test_best_fill_is_the_best():
    rng = random.Random(1)
    for _ in range(200):
        counts = {}
        for _ in range(rng.randrange(1, 7)):
            n = rng.randrange(1, 30)
            counts[n] = counts.get(n, 0) + 1
        sums = {0}
        for n, k in counts.items():
            sums = {s + i * n for s in sums for i in range(k + 1)}
        chosen = packing.best_fill(sorted(counts, reverse=True), counts, 40)
        assert sum(n * k for n, k in chosen.items()) == max(s for s in sums if s <= 40)
        assert all(k <= counts[n] for n, k in chosen.items())


@pytest.mark.parametrize("capacity", [64, 2048])
def test_pieces_cover_each_document_and_fill_sequences(documents, awkward, vocabulary, plain, capacity):
    for docs in (documents, awkward):
        texts = docs.select("doc_id", "text").toPandas().astype(object)
        rows = packing.pack(docs, vocabulary, capacity, 1, with_ids=True).toPandas()
        for row in rows.itertuples():
            assert crc(np.frombuffer(row.ids, "<u4")) == row.ids_crc32 and len(row.ids) == 4 * row.length
        wanted = {}
        for key, text in texts.itertuples(index=False):
            wanted.setdefault(None if key != key or key is None else int(key), []).append([*plain(text), 1])
        for key, lists in wanted.items():
            mine = rows[rows.doc_id.isna()] if key is None else rows[rows.doc_id == key]
            got = {}
            for r in mine.sort_values("start").itertuples():
                assert r.doc_tokens == len(lists[0])
                got.setdefault(r.start, []).append(list(np.frombuffer(r.ids, "<u4")))
            joined = sorted(sum((x[0] for _, x in sorted(got.items())), [])) if len(lists) == 1 else None
            assert joined is None or joined == sorted(lists[0])
            assert sum(len(x) for v in got.values() for x in v) == sum(map(len, lists))
        padding = 0
        for _, s in rows.groupby("sequence_id"):
            s = s.sort_values("offset")
            assert list(s.offset) == [0, *np.cumsum(s.length)[:-1]]
            total = int(s.length.sum())
            assert total <= capacity
            padding += 0 if total & (total - 1) == 0 else capacity - total
        assert padding <= 0.01 * rows.length.sum()


def test_no_documents(spark, awkward, vocabulary):
    none = awkward.limit(0)
    assert packing.pack(none, vocabulary).count() == 0
    assert token_files.token_files(none, vocabulary).count() == 0


def test_ranks_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 1000, token_files.SLICE + 3):
        ranks = (rng.random(n) ** 8 * 2**32).astype(np.uint32)
        control, data = token_files.encode_ranks(ranks)
        back = token_files.decode_ranks(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n)
        assert (back == ranks).all() and len(control) == -(-n // 4)


@pytest.mark.parametrize("file_ids", [300, 8_000_000])
def test_files_read_back(documents, vocabulary, plain, file_ids):
    rows = token_files.token_files(documents, vocabulary, 0, file_ids).toPandas().sort_values("doc_id")
    start = 0
    texts = dict(documents.select("doc_id", "text").collect())
    assert sorted(texts) == list(rows.doc_id)
    for row in rows.itertuples():
        ids = [*plain(texts[row.doc_id]), 0]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def test_awkward_files(awkward, vocabulary, plain):
    rows = token_files.token_files(awkward, vocabulary, 0).toPandas().sort_values("start")
    assert rows.doc_id.isna().tolist() == [True] + [False] * 7
    assert rows.doc_id.tolist()[1:] == [1, 2, 3, 4, 5, 5, 7]
    assert rows.n_tokens.tolist()[1:3] == [1, 1]
    assert rows.start.tolist() == [0, *np.cumsum(rows.n_tokens)[:-1]]


def test_every_token_file_is_read_by_a_task_of_its_own(documents, vocabulary):
    home = new_folder(documents, "tokens")
    files = token_files.write_files(documents, vocabulary, home, 0, 2_000)
    tasks = token_files.read_files(files, home).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == files.count() > 10
