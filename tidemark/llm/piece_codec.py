"""SentencePiece encoding and decoding of whole texts by vectorised merge rounds.

A text is the symbols of its characters behind one space mark. The pair of
neighbours that makes the best-scored piece is merged, the leftmost of equals
first, until no pair makes a piece; a character that is no piece becomes the ids of
its UTF-8 bytes. The rounds do this for many words at once over flat arrays.
"""

from __future__ import annotations

import codecs
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep, with_columns

MARK = "▁"  # stands for a space
#: A word and the blanks before it: no piece of the vocabulary holds a mark behind another character.
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
NONE = np.int32(np.iinfo(np.int32).max)  # the rank of a pair that makes no piece

codecs.register_error("tidemark-each", lambda e: ("�" * (e.end - e.start), e.end))


class Pieces:
    """A vocabulary's tables: characters to symbols, pairs to merges, ids to bytes.

    Symbols are piece ids; characters that occur only inside pieces have numbers
    past them, and all other characters are -1 and never merge.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules, trained = model.normalizer_spec, model.trainer_spec
        if trained.model_type != trained.BPE or not trained.byte_fallback or rules.precompiled_charsmap:
            raise ValueError("a BPE vocabulary with byte fallback and no character map is needed")
        if rules.remove_extra_whitespaces or not rules.add_dummy_prefix or trained.treat_whitespace_as_suffix:
            raise ValueError("a vocabulary that keeps white space and puts a space in front is needed")
        library = SentencePieceProcessor(model_file=path)
        self.size = len(model.pieces)
        names = {p.piece: i for i, p in enumerate(model.pieces) if p.type == p.NORMAL}
        if len(names) + sum(p.type in (p.CONTROL, p.UNKNOWN, p.BYTE) for p in model.pieces) != self.size:
            raise ValueError("user-defined and unused pieces are not handled")
        self.cuts_at_marks = not any(re.search(f"[^{MARK}]{MARK}", name) for name in names)
        self.bytes = np.array([library.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)

        symbols = dict(names)
        for c in sorted({c for name in names for c in name}):
            symbols.setdefault(c, self.size + len(symbols))
        self.symbol = np.full(0x110000, -1, np.int32)
        for name, i in symbols.items():
            if len(name) == 1:
                self.symbol[ord(name)] = i
        ranks = {score: r for r, score in enumerate(sorted({model.pieces[i].score for i in names.values()}, reverse=True))}
        self.width = max(symbols.values()) + 2
        found = sorted(
            (symbols[name[:k]] * self.width + symbols[name[k:]], i, ranks[model.pieces[i].score])
            for name, i in names.items()
            for k in range(1, len(name))
            if name[:k] in symbols and name[k:] in symbols
        )
        self.keys = np.array([f[0] for f in found], np.int64)
        self.made = np.array([f[1] for f in found], np.int32)
        self.ranks = np.array([*(f[2] for f in found), NONE], np.int32)  # the last for pairs that make none

        plain = [
            bytes([int(p.piece[1:-1], 16)]) if p.type == p.BYTE
            else b"" if p.type == p.CONTROL
            else trained.unk_surface.encode() if p.type == p.UNKNOWN
            else p.piece.replace(MARK, " ").encode()
            for p in model.pieces
        ]
        self.blob = np.frombuffer(b"".join(plain), np.uint8)
        self.lengths = np.array([len(p) for p in plain], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.silent = np.array([p.type == p.CONTROL for p in model.pieces])
        self.opens = np.array([p.type == p.NORMAL and p.piece[:1] == MARK for p in model.pieces])

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place in the merge table of each pair of symbols, or -1."""
        if not len(self.keys):
            return np.full(len(left), -1, np.int32)
        # Unknown characters have no key: a negative number meets none.
        key = np.where((left < 0) | (right < 0), -1, left.astype(np.int64) * self.width + right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at, -1).astype(np.int32)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the ids of each word, given with its marks.

        Every round takes each word's pairs of least rank and merges them from left
        to right at once, up to the first one whose new neighbours would have come
        before the next. Words without a pair leave, the others close their gaps.
        """
        data = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        lengths = np.array([len(w) for w in words], np.int64)
        sym, word = self.symbol[data], np.repeat(np.arange(len(words)), lengths)
        # A character that never merges is known by its code point, below all symbols.
        sym = np.where(sym < 0, -1 - data.astype(np.int64), sym).astype(np.int32)
        pair = np.full(len(sym), -1, np.int32)
        inner = np.flatnonzero(word[:-1] == word[1:])
        pair[inner] = self.pair(sym[inner], sym[inner + 1])
        done = []
        while len(sym):
            rank = self.ranks[pair]
            firsts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            sizes = np.diff(np.concatenate((firsts, [len(sym)])))
            least = np.repeat(np.minimum.reduceat(rank, firsts), sizes)
            ended = least == NONE
            if ended.any():
                done.append((word[ended], sym[ended]))
                rest = ~ended
                sym, word, pair, rank, least = sym[rest], word[rest], pair[rest], rank[rest], least[rest]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == least)
            # Of pairs that overlap, every second one from the left.
            run = np.concatenate(([True], np.diff(at) != 1))
            begin = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begin) % 2 == 0]
            at = self._safe(at, sym, word, rank, pair)
            sym[at] = self.made[pair[at]]
            stays = np.ones(len(sym), bool)
            stays[at + 1] = False
            place = np.cumsum(stays) - 1
            sym, word, pair, at = sym[stays], word[stays], pair[stays], place[at]
            # Only pairs with a new symbol change.
            for i in (at[at > 0] - 1, at):
                last = i == len(sym) - 1
                j = np.where(last, i, i + 1)
                found = self.pair(sym[i], sym[j])
                pair[i] = np.where(last | (word[i] != word[j]), -1, found)
        if not done:
            return np.zeros(0, np.int32), np.zeros(len(words) + 1, np.int64)
        word, sym = (np.concatenate([d[k] for d in done]) for k in (0, 1))
        order = np.argsort(word, kind="stable")
        return self._spell(sym[order], word[order], len(words))

    def _safe(self, at: np.ndarray, sym: np.ndarray, word: np.ndarray, rank: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """The merges ``at`` up to each word's first that makes a pair due before the next one."""
        new = self.made[pair[at]]
        n = len(sym)
        before = np.maximum(at - 1, 0)
        left = sym[before]
        joined = np.concatenate(([False], at[1:] - at[:-1] == 2))  # its left neighbour was merged just before
        left = np.where(joined, np.concatenate((new[:1], new[:-1])), left)
        left_word = np.where(at > 0, word[before], -1)
        after = np.minimum(at + 2, n - 1)
        right_word = np.where(at + 2 < n, word[after], -1)
        mine = word[at]
        near = np.minimum(
            np.where(left_word == mine, self.ranks[self.pair(left, new)], NONE),
            np.where(right_word == mine, self.ranks[self.pair(new, sym[after])], NONE),
        )
        early = np.flatnonzero(near <= rank[at])
        if not len(early):
            return at
        stop = np.full(int(mine.max()) + 1, n, np.int64)
        whose, first = np.unique(mine[early], return_index=True)
        stop[whose] = at[early[first]]
        return at[at <= stop[mine]]

    def _spell(self, sym: np.ndarray, word: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and bounds, characters that are no piece as the ids of their bytes."""
        odd = np.flatnonzero((sym < 0) | (sym >= self.size))
        counts = np.ones(len(sym), np.int64)
        if len(odd):
            inverse = {int(self.symbol[c]): c for c in np.flatnonzero(self.symbol >= self.size)}
            raw = [chr(-1 - s if s < 0 else inverse[s]).encode() for s in sym[odd].tolist()]
            counts[odd] = [len(r) for r in raw]
            ids = np.repeat(sym, counts)
            spelled = np.zeros(len(sym), bool)
            spelled[odd] = True
            ids[np.repeat(spelled, counts)] = self.bytes[np.frombuffer(b"".join(raw), np.uint8)]
        else:
            ids = sym
        sizes = np.bincount(word, counts, minlength=words).astype(np.int64)
        return ids, np.concatenate(([0], np.cumsum(sizes)))

    def texts(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """What each run of ids stands for, without the space put in front."""
        lengths = self.lengths[ids]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        at = np.arange(int(ends[-1])) + np.repeat(self.begins[ids] - ends[:-1], lengths)
        data = self.blob[at].tobytes()
        silent = np.flatnonzero(self.silent[ids])
        spoken = np.flatnonzero(~self.silent[ids])
        first = np.searchsorted(spoken, bounds[:-1])
        cuts = np.searchsorted(silent, bounds).tolist()
        out = []
        for k, (b, e) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            i = int(spoken[first[k]]) if first[k] < len(spoken) else e
            begin = int(ends[b]) + (1 if i < e and self.opens[ids[i]] else 0)
            # Bytes on both sides of a control id make no character together.
            stops = [*(max(begin, int(ends[s])) for s in silent[cuts[k] : cuts[k + 1]]), int(ends[e])]
            out.append("".join(data[x:y].decode("utf-8", "tidemark-each") for x, y in zip([begin, *stops], stops, strict=False)))
        return out


class Encoder:
    """Encodes with one vocabulary; remembers at most about ``limit`` words."""

    def __init__(self, pieces: Pieces, limit: int = 250_000):
        self.pieces, self.limit = pieces, limit
        self.known: dict[str, bytes] = {}

    def _words(self, text: str) -> list[str]:
        marked = MARK + text.replace(" ", MARK)
        if not self.pieces.cuts_at_marks:
            return [marked]
        if MARK + MARK in marked or marked[-1] == MARK:
            return WORD.findall(marked)
        return [MARK + w for w in marked[1:].split(MARK)]

    def encode(self, texts: list[str | None]) -> tuple[bytes, np.ndarray]:
        """(little-endian 32-bit ids, bounds) of the texts; null is empty."""
        parts = [self._words(t) if t else [] for t in texts]
        new = list(set().union(*parts).difference(self.known))
        ids, bounds = self.pieces.merge(new)
        raw, ends = ids.astype("<i4").tobytes(), (bounds * 4).tolist()
        self.known.update((w, raw[b:e]) for w, b, e in zip(new, ends[:-1], ends[1:], strict=True))
        get = self.known.__getitem__
        out = [b"".join(map(get, p)) for p in parts]
        if len(self.known) > self.limit:
            self.known = {}
        return b"".join(out), np.concatenate(([0], np.cumsum([len(o) // 4 for o in out]))).astype(np.int64)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Every row of ``docs`` with ``ids``, the whole text's piece ids (array of int).

    No marks of begin or end, no sampling. A null or empty text has no ids; a text of
    blanks has the ids of its marks. Rows stand one by one, repeated ones too; other
    columns pass through unchanged, but for one named like ``ids``, which is replaced.
    Long texts are sent to the merge rounds alone, so memory follows the longest text.
    """
    return with_columns(docs, F.col(f"`{text}`").cast("string"), {ids: "array<int>"}, lambda c: [_encoded(c, path)], keeps=True, most=1 << 20)


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Every row with ``text``, what its ids stand for.

    The space put in front by encoding is taken away; bytes that make no character
    become U+FFFD one by one. Null ids give an empty text. A null id in the array, or
    one outside the vocabulary, raises. Other columns pass through as in ``encode``.
    """
    return with_columns(rows, F.col(f"`{ids}`"), {text: "string"}, lambda c: [_decoded(c, path)], keeps=True, most=1 << 18)


def _encoder(path: str) -> Encoder:
    return keep(f"pieces {path}", lambda: Encoder(Pieces(path)))


def _encoded(column: pa.Array, path: str) -> pa.Array:
    raw, bounds = _encoder(path).encode(column.to_pylist())
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.frombuffer(raw, "<i4")))


def _decoded(column: pa.Array, path: str) -> pa.Array:
    sizes = np.asarray(pc.list_value_length(column).fill_null(0))
    bounds = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return pa.array(_encoder(path).pieces.texts(np.asarray(column.flatten()), bounds), pa.string())
