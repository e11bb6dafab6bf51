"""Token ids of whole texts by the tokenizers library, with repeated words encoded once.

A byte-level BPE first cuts a text with a pattern in which a blank can only
start a piece or belong to a run of white space. So a single blank between two
characters that aren't white space always starts a new piece, and what follows
is encoded independently of what went before. Words between such blanks are
encoded once and remembered; texts with other runs of blanks are cut by the
slower pattern ``CUT``. Texts that hold an added token, such as <|endoftext|>, are
encoded whole. The ids equal those of the plain call on the whole text.
"""

from __future__ import annotations

import os
import re

import numpy as np

from tidemark.llm.common import keep

CUT = re.compile(r"(?<=\S) (?=\S)")
#: White space other than a blank or a line feed.
RARE = re.compile(r"[^\S \n]")


def uneven(text: str) -> bool:
    """Whether a blank may stand next to white space or at an end of the text."""
    return "  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1].isspace() or bool(RARE.search(text))


class Encoder:
    """Encodes with one vocabulary; remembers at most ``limit`` words per process."""

    def __init__(self, path: str, limit: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.limit = limit
        self.known: dict[str, bytes] = {}
        size = self.tokenizer.get_vocab_size()
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])

    def _holds_added(self, text: str) -> bool:
        return any(a in text for a in self.added)

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word with a blank before it, all encoded as texts of many words."""
        out: dict[str, bytes] = {}
        for i in range(0, len(words), 2000):
            some = words[i : i + 2000]
            joined = " " + " ".join(some)
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.opens[ids])
            if len(cuts) == len(some) and not self._holds_added(joined):
                raw, ends = ids.tobytes(), [*(cuts[1:] * 4).tolist(), len(ids) * 4]
                begin = 0
                for word, end in zip(some, ends, strict=True):
                    out[word] = raw[begin:end]
                    begin = end
            else:  # a word itself holds a piece that opens like a blank
                out.update((w, self._plain(" " + w)) for w in some)
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null is empty."""
        whole = {k: self._plain(t) for k, t in enumerate(texts) if t and self._holds_added(t)}
        parts = [
            (CUT.split(t) if uneven(t) else t.split(" ")) if t and k not in whole else [] for k, t in enumerate(texts)
        ]
        known = self.known
        more = self._words(list(set().union(*parts).difference(known)))
        known.update(more)
        firsts = self.tokenizer.encode_batch_fast([p[0] if p else "" for p in parts], add_special_tokens=False)
        get = known.__getitem__
        out = [
            whole[k] if k in whole else np.array(first.ids, "<u4").tobytes() + b"".join(map(get, part[1:]))
            for k, (first, part) in enumerate(zip(firsts, parts, strict=True))
        ]
        if len(known) > self.limit:
            for word in more:
                del known[word]
        return out


def encoder(path: str, limit: int = 1_000_000) -> Encoder:
    """The encoder of this process for a vocabulary file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return keep(f"encoder {limit} {path}", lambda: Encoder(path, limit))


def in_slices(texts: list[str | None], characters: int = 4_000_000):
    """Runs of texts of about so many characters, to bound what is held at once."""
    some, size = [], 0
    for t in texts:
        some.append(t)
        size += len(t or "")
        if size >= characters:
            yield some
            some, size = [], 0
    if some:
        yield some
