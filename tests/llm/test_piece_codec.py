"""Piece ids and texts against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tidemark.llm import piece_codec
from tidemark.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [
    "a", "b", "e", "t", "h", " ", "  ", "▁", "\n", "é", "日", "本", "0", "12", "<s>", "<0x41>", "\x00", "\U0001f600", "the",
    "ing", "     ", "\t", "ß", "и", "н", "\xa0", "　",
]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def pieces():
    return piece_codec.Pieces(PATH)


def split(raw, bounds):
    ids = np.frombuffer(raw, "<i4")
    return [ids[b:e].tolist() for b, e in zip(bounds[:-1], bounds[1:], strict=True)]


def test_encode_as_the_library(library, pieces):
    rnd = random.Random(3)
    vocabulary = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    texts = ["", " ", "  ", " a", "a ", "▁", "a" * 3000, " " * 2001, "ab" * 999, "aab" * 500]
    texts += ["".join(rnd.choices(PARTS, k=rnd.randint(1, 60))) for _ in range(3000)]
    texts += ["".join(rnd.choices(vocabulary, k=rnd.randint(1, 12))) for _ in range(3000)]
    texts.append("".join(rnd.choices("abcdefghijklmnopqrstuvwxyzABCDEFGH0123456789+/", k=20_000)))
    found = split(*piece_codec.Encoder(pieces).encode(texts))
    assert found == library.encode(texts)
    flat, bounds = np.array(sum(found, []), np.int32), np.cumsum([0, *map(len, found)])
    assert pieces.texts(flat, bounds) == library.decode(found)


def test_one_piece_texts_in_small_pieces(library, pieces):
    """Without the cut at marks, and with a memory of few words, the ids are the same."""
    encoder = piece_codec.Encoder(pieces, limit=3)
    texts = ["the thing  in the   thing ", "one two", " the"]
    assert [split(*encoder.encode([t]))[0] for t in texts * 2] == library.encode(texts * 2)
    ids, bounds = pieces.merge(["▁" + t.replace(" ", "▁") for t in texts])
    assert split(ids.astype("<i4").tobytes(), bounds) == library.encode(texts)


def test_decode_any_ids(library, pieces):
    """Broken bytes, control ids between them, the unknown id."""
    rnd = random.Random(5)
    lists = [
        [rnd.randint(0, 300) if rnd.random() < 0.7 else rnd.randint(0, 31999) for _ in range(rnd.randint(0, 12))]
        for _ in range(5000)
    ]
    lists += [[0], [1, 28705, 264], [28705, 28705], [2, 1], [198, 1, 172]]
    bounds = np.cumsum([0, *map(len, lists)])
    assert pieces.texts(np.array(sum(lists, []), np.int32), bounds) == library.decode(lists)


def test_awkward_rows(spark, awkward, library):
    docs = awkward.withColumnRenamed("sequence_id", "ids")  # a name that clashes is replaced
    rows = piece_codec.decode(piece_codec.encode(docs, PATH), PATH).collect()
    assert len(rows) == awkward.count() and {"lang", "source", "ids", "decoded", "text"} <= set(rows[0].asDict())
    for r in rows:
        assert r.ids == library.encode(r.text or "") and r.decoded == library.decode(r.ids)
    empty = piece_codec.decode(piece_codec.encode(awkward.limit(0), PATH), PATH)
    assert empty.count() == 0 and dict(empty.dtypes)["ids"] == "array<int>"
    nulls = piece_codec.decode(spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>"), PATH)
    assert [r.decoded for r in nulls.orderBy("k").collect()] == ["", ""]


def test_query(spark, folder, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op12_sentencepiece"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id])
        wanted = (len(ids), ",".join(map(str, ids)), library.decode(ids))
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in wanted[1:]]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (wanted[0], *digests)


def test_other_columns_pass_through(spark):
    docs = spark.createDataFrame([(1, "a b", "x")], "`a.b` int, text string, given string")
    row = piece_codec.encode(docs.withColumn("day", F.lit("2024-01-02").cast("date")), PATH).first()
    assert row["a.b"] == 1 and row["given"] == "x" and str(row["day"]) == "2024-01-02" and row["text"] == "a b"
