"""Language of texts by unigrams over pieces, summed over all segmentations.

A language is a distribution over the pieces of a fixed public vocabulary. A
word's probability is the sum over all ways to cut it into pieces, had by a
forward pass over its bytes; a text's is the product over its words. The
distributions are fitted by expectation and maximisation: a backward pass gives
how often each piece is expected in the words of labelled texts.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACED, Batches, in_arrow, texts, word_hashes
from tidemark.session import written

RUN = 256  # bytes of a word that are worked on at once
MULTIPLIER = np.uint64(0x100000001B3)
SCALE = 24.0  # keeps products of byte-wise probabilities near one


def piece_strings(path: str) -> list[bytes]:
    """The vocabulary's distinct pieces as bytes; a blank marks a word's start."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    found = {bytes([b]): None for b in range(256)}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            piece = model.id_to_piece(i).replace("▁", " ").encode()
            if piece:
                found[piece] = None
    return list(found)


class Pieces:
    """Finds every piece in many words at once, by a table of all pieces' beginnings."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.longest = max(map(len, strings))
        ids: dict[bytes, int] = {}
        for i, s in enumerate(strings):
            for n in range(1, len(s)):
                ids.setdefault(s[:n], -1)
            ids[s] = i
        self.bits = max(8, (len(ids) * 8).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        for s, i in ids.items():
            h = np.uint64(0)
            for c in s:
                h = self.extend(h, np.uint64(c))
            at = int(self.slot(h))
            while self.keys[at]:
                at = (at + 1) % len(self.keys)
            self.keys[at], self.values[at] = h, i

    @staticmethod
    def extend(h, byte):
        with np.errstate(over="ignore"):
            h = (h ^ (byte + np.uint64(1))) * MULTIPLIER
            return h ^ (h >> np.uint64(32))

    def slot(self, h):
        with np.errstate(over="ignore"):
            return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash begins a piece, and the piece that it is, or -1."""
        at = self.slot(h)
        begins, value = np.zeros(len(h), bool), np.full(len(h), -1, np.int32)
        left = np.arange(len(h))
        while len(left):
            key = self.keys[at[left]]
            hit = key == h[left]
            begins[left[hit]] = True
            value[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (key != 0)]
            at[left] = (at[left] + 1) % len(self.keys)
        return begins, value

    def edges(self, words: np.ndarray, lengths: np.ndarray, places: int | None = None) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """For each place, or the first ``places``, the pieces that start there: (bytes, words, piece ids)."""
        out = []
        for i in range(min(words.shape[1], places or words.shape[1])):
            live = np.flatnonzero(lengths > i)
            h, here = np.zeros(len(live), np.uint64), []
            for n in range(1, min(self.longest, words.shape[1] - i) + 1):
                ok = lengths[live] >= i + n
                live, h = live[ok], h[ok]
                if not len(live):
                    break
                h = self.extend(h, words[live, i + n - 1].astype(np.uint64))
                begins, value = self.find(h)
                is_piece = value >= 0
                if is_piece.any():
                    here.append((n, live[is_piece], value[is_piece]))
                live, h = live[begins], h[begins]
            out.append(here)
        return out


def forward(edges, p: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """Scaled probabilities of each word's beginnings; (words, places, languages)."""
    alpha = np.zeros((len(lengths), width + 1, p.shape[1]))
    alpha[:, 0] = 1
    for i, here in enumerate(edges):
        for n, w, piece in here:
            alpha[w, i + n] += alpha[w, i] * p[piece] * SCALE**n
    return alpha


def expected(edges, p: np.ndarray, lengths: np.ndarray, width: int, weight: np.ndarray) -> np.ndarray:
    """Expected count of each piece in the words, weighted; (pieces, languages)."""
    alpha = forward(edges, p, lengths, width)
    beta = np.zeros_like(alpha)
    rows = np.arange(len(lengths))
    beta[rows, lengths] = 1
    total = alpha[rows, lengths]
    counts = np.zeros_like(p)
    per = weight / np.maximum(total, 1e-300)
    for i in reversed(range(len(edges))):
        for n, w, piece in edges[i]:
            through = p[piece] * SCALE**n * beta[w, i + n]
            beta[w, i] += through
            np.add.at(counts, piece, alpha[w, i] * through * per[w])
    return counts


def matrix(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Words as rows of bytes, each behind a blank where it starts a word."""
    width = int(lengths.max())
    at = np.minimum(starts[:, None] + np.arange(width), len(data) - 1)
    return data[at]


def word_logs(pieces: Pieces, p: np.ndarray, buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """ln probability of each word under each language; ``buffer`` has a blank before each word."""
    data = np.frombuffer(buffer, np.uint8)
    out = np.zeros((len(starts), p.shape[1]))
    long = ends - starts + 1 > RUN
    short = np.flatnonzero(~long)
    for rows, edges, lengths, width in _groups(pieces, data, starts[short], ends[short], p.shape[1]):
        alpha = forward(edges, p, lengths, width)
        out[short[rows]] = np.log(np.maximum(alpha[np.arange(len(rows)), lengths], 1e-300)) - (lengths * np.log(SCALE))[:, None]
    rows = np.flatnonzero(long)
    for i in range(0, len(rows), 1024):
        some = rows[i : i + 1024]
        out[some] = _long_logs(pieces, p, data, starts[some] - 1, ends[some])
    return out


def _long_logs(pieces: Pieces, p: np.ndarray, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The same for long words, ``RUN`` bytes at a time.

    Pieces may reach over a part's end: the forward values there are carried into the
    next part, with the logarithm of the greatest taken out, so all segmentations count.
    """
    reach = pieces.longest
    logs, out = np.zeros((len(begins), p.shape[1])), np.zeros((len(begins), p.shape[1]))
    carried = np.zeros((len(begins), reach + 1, p.shape[1]))
    carried[:, 0] = 1
    live = np.arange(len(begins))
    while len(live):
        left = ends[live] - begins[live]
        lengths = np.minimum(left, RUN + reach)
        words = matrix(data, begins[live], lengths)
        alpha = np.zeros((len(live), RUN + reach + 1, p.shape[1]))
        alpha[:, : reach + 1] = carried
        for i, here in enumerate(pieces.edges(words, lengths, RUN)):
            for n, w, piece in here:
                alpha[w, i + n] += alpha[w, i] * p[piece] * SCALE**n
        done = left <= RUN
        at = np.flatnonzero(done)
        out[live[at]] = logs[live[at]] + np.log(np.maximum(alpha[at, left[at]], 1e-300)) - np.log(SCALE) * left[at][:, None]
        live, alpha = live[~done], alpha[~done]
        carried = alpha[:, RUN:]
        greatest = np.maximum(carried.max(1), 1e-300)
        carried = carried / greatest[:, None]
        logs[live] += np.log(greatest) - RUN * np.log(SCALE)
        begins = begins.copy()
        begins[live] += RUN
    return out


def _groups(pieces: Pieces, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, languages: int):
    """Words of like length together: rows, edges, lengths, width.

    For fitting, words beyond ``RUN`` bytes are cut into runs; scores never are.
    """
    begins, rows = starts - 1, np.arange(len(starts))
    lengths = ends - begins
    if len(lengths) and lengths.max() > RUN:
        times = -(-lengths // RUN)
        rows = np.repeat(rows, times)
        inside = np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times)
        begins = begins[rows] + inside * RUN
        lengths = np.minimum(lengths[rows] - inside * RUN, RUN)
    order = np.argsort(lengths, kind="stable")
    i = 0
    while i < len(order):
        size = max(256, 2_000_000 // (int(lengths[order[min(len(order) - 1, i + 4096)]]) * languages + 1))
        some = order[i : i + size]
        words = matrix(data, begins[some], lengths[some])
        yield rows[some], pieces.edges(words, lengths[some]), lengths[some], words.shape[1]
        i += size


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray  # ln share of each language's texts
    p: np.ndarray  # (pieces, languages)


def joined(some: list[bytes]) -> bytes:
    """All texts, with a blank before each and every white space turned into a blank."""
    return (b" " + b" ".join(some)).translate(bytes(c if s else 32 for c, s in enumerate(SPACED)))


def slices(batches: Batches, columns: list[int], size: int = 16 << 20):
    """(column lists, texts) with about so many bytes of text; the text is the last column."""
    held: list[list] = [[] for _ in columns]
    found, total = [], 0
    for b in batches:
        for *values, t in zip(*(b.column(c).to_pylist() for c in columns), texts(b), strict=True):
            for h, v in zip(held, values, strict=True):
                h.append(v)
            found.append(t)
            total += len(t)
            if total >= size:
                yield held, found
                held, found, total = [[] for _ in columns], [], 0
    if found:
        yield held, found


def fit(
    labelled: DataFrame, strings: list[bytes], per_language: int = 2000, rounds: int = 2, smoothing: float = 0.05
) -> Model:
    """The model of ``labelled`` (doc_id, lang, text).

    The prior is from all of its rows. The pieces' probabilities are from about
    ``per_language`` texts of each language (all, if there are fewer), chosen by
    their id's hash, in ``rounds`` rounds of expectation and maximisation.
    """
    spark = labelled.sparkSession
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    p = np.full((len(strings), len(languages)), 1.0 / len(strings))
    prior = np.log(np.array([sizes[k] for k in languages], float) / max(1, sum(sizes.values())))
    if not languages:
        return Model([], prior, p)
    shares = F.create_map(*[F.lit(x) for k in languages for x in (k, int(1e9 * min(1.0, per_language / sizes[k])))])
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000_000))
    sample = labelled.where(place < shares[F.col("lang")]).select("lang", "text")

    def count(batches: Batches) -> Batches:
        counts: Counter[tuple[str, str]] = Counter()
        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), texts(b), strict=True):
                counts.update((lang, w) for w in t.split())
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([k[0] for k in counts], pa.string()),
                "word": pa.array([k[1] for k in counts], pa.binary()),
                "n": pa.array(list(counts.values()), pa.int64()),
            }
        )

    words = in_arrow(sample, count, "lang string, word binary, n long").groupBy("word", "lang").agg(F.sum("n").alias("n"))
    words = written(words, "language-words")
    pieces = Pieces(strings)
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast((pieces, p, languages))

        def expect(batches: Batches, sent=sent) -> Batches:
            known, now, names = sent.value
            counts, column = np.zeros_like(now), {k: i for i, k in enumerate(names)}
            for b in batches:
                some = b.column(0).to_pylist()
                buffer = b"".join(b" " + w for w in some)
                ends = np.cumsum([len(w) + 1 for w in some])
                starts = ends - [len(w) for w in some]
                weight = np.zeros((len(some), len(names)))
                weight[np.arange(len(some)), [column[k] for k in b.column(1).to_pylist()]] = b.column(2).to_pylist()
                for rows, edges, lengths, width in _groups(known, np.frombuffer(buffer, np.uint8), starts, ends, 2 * len(names)):
                    counts += expected(edges, now, lengths, width, weight[rows])
            piece, lang = np.nonzero(counts)
            yield pa.RecordBatch.from_pydict(
                {"piece": pa.array(piece.astype(np.int32)), "lang": pa.array(lang.astype(np.int32)), "n": pa.array(counts[piece, lang])}
            )

        sums = in_arrow(words, expect, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        counts = np.full_like(p, smoothing)
        for r in sums.collect():
            counts[r.piece, r.lang] += r.n
        p = counts / counts.sum(0)
    return Model(languages, prior, p)


def predict(docs: DataFrame, model: Model, strings: list[bytes]) -> DataFrame:
    """doc_id, held_out, lang_pred and score (the language's posterior) of (doc_id, held_out, letters, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast((Pieces(strings), model))

    def run(batches: Batches) -> Batches:
        pieces, known = sent.value
        kinds = []

        def first(some: Batches) -> Batches:
            for b in some:
                kinds.append(b.schema.field(0).type)
                yield b

        for (ids, held, letters), some in slices(first(batches), [0, 1, 2]):
            names, scores = judge(pieces, known, some)
            able = [bool(x) and bool(known.languages) for x in letters]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, kinds[0]),
                    pa.array(held, pa.bool_()),
                    pa.array([n if ok else "und" for n, ok in zip(names, able, strict=True)]),
                    pa.array([float(s) if ok else 0.0 for s, ok in zip(scores, able, strict=True)]),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return in_arrow(docs, run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def judge(pieces: Pieces, model: Model, some: list[bytes]) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its posterior; each distinct word is summed once."""
    if not model.languages:
        return ["und"] * len(some), np.zeros(len(some))
    buffer = joined(some)
    hashes, starts, ends = word_hashes(buffer, SPACED)
    bounds = np.concatenate(([0], np.searchsorted(starts, np.cumsum([len(t) + 1 for t in some]))))
    _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    logs = word_logs(pieces, model.p, buffer, starts[first], ends[first])
    owner = np.repeat(np.arange(len(some)), np.diff(bounds))
    total = np.column_stack(
        [np.bincount(owner, logs[inverse, k], minlength=len(some)) + model.prior[k] for k in range(len(model.languages))]
    )
    best = total.argmax(1)
    share = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
    return [model.languages[b] for b in best], share


def identify(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred and score.

    Rows whose crc32(doc_id as text) mod 4 is 2 are held out (a null id counts as
    the text ""); the others with a lang and a text teach. A null text, or one
    without a letter, is ``und`` with score 0, and so is everything if nothing
    teaches. Rows are judged one by one. No text is shuffled.
    """
    strings = piece_strings(vocabulary)
    crc = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0))
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", (crc % 4 == 2).alias("held_out"), F.col("lang").cast("string").alias("lang"), text.alias("text"))
    teaching = rows.where("not held_out and lang is not null and text is not null").select("doc_id", "lang", "text")
    model = fit(teaching, strings, **options)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return predict(rows.select("doc_id", "held_out", letters.alias("letters"), "text"), model, strings)
