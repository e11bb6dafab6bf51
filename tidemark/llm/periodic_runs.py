"""Runs of words that repeat with a period, found by suffix trees.

A run is a stretch of consecutive words with smallest period q that no neighbouring
word extends. Ukkonen's trees of the words and of their reversal, with the Euler
tour's minima in a sparse table, tell in constant time how far two places agree
forward and backward. The longest Lyndon word that starts at a place, under an
order of the words or its inverse, ends at the next smaller or next greater suffix;
every run has such a word of its period's length as a root, so extending these
roots in both directions finds all runs.

Trees are grown for the stretches of a text that can lie in a run of the wanted
length: all but the last period of a run are words whose next occurrence is at most
a period away. Other stretches are each replaced by one mark that occurs once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import with_columns


class SuffixTree:
    """Ukkonen's suffix tree of numbers, whose last one occurs once and is the smallest.

    ``rank`` is each suffix's place among all sorted suffixes. Of the Euler tour only
    the lowest depth between neighbouring leaves is kept, as leaves alone are asked
    for. About 500 bytes a number while the tree is grown, 4 log2(n) afterwards.
    """

    def __init__(self, symbols: list[int]):
        edges, begin, end, width = _grow(symbols)
        self.rank, lows = _tour(len(symbols), edges, begin, end, width)
        self.table = [lows]
        while 2 * (step := 1 << (len(self.table) - 1)) <= len(lows):
            self.table.append(np.minimum(self.table[-1][:-step], self.table[-1][step:]))

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers from places ``a`` and ``b`` on are equal; the places differ."""
        a, b = self.rank[a], self.rank[b]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp(high - low)[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at, row = np.flatnonzero(level == k), self.table[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k))])
        return out


def _grow(s: list[int]) -> tuple[dict[int, int], list[int], list[int], int]:
    """Edges by node and first number, and each node's edge label as bounds in ``s``.

    Node 0 is the root. The k-th leaf that is made stands for the suffix from k on;
    its label's end is len(s), that of inner nodes where they were split.
    """
    n, width = len(s), max(s) + 1
    edges: dict[int, int] = {}
    begin, end, link = [0], [0], [0]
    node, edge, length, waiting = 0, 0, 0, 0  # the active point, and the suffixes still implicit
    for i, c in enumerate(s):
        last = 0
        waiting += 1
        while waiting:
            if not length:
                edge = i
            key = node * width + s[edge]
            child = edges.get(key)
            if child is None:
                edges[key] = len(begin)
                begin.append(i)
                end.append(n)
                link.append(0)
                if last:
                    link[last] = node
                    last = 0
            else:
                b = begin[child]
                span = (end[child] if end[child] < i else i) - b
                if length >= span:
                    edge += span
                    length -= span
                    node = child
                    continue
                if s[b + length] == c:
                    if last:
                        link[last] = node
                    length += 1
                    break
                inner = len(begin)
                begin += (b, i)
                end += (b + length, n)
                link += (0, 0)
                begin[child] = b + length
                edges[key] = inner
                edges[inner * width + c] = inner + 1
                edges[inner * width + s[b + length]] = child
                if last:
                    link[last] = inner
                last = inner
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return edges, begin, end, width


def _tour(n: int, edges: dict[int, int], begin: list[int], end: list[int], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each suffix's rank, and the lowest depth on the tour between the leaves of ranks r and r + 1."""
    keys = np.fromiter(edges.keys(), np.int64, len(edges))
    children = np.fromiter(edges.values(), np.int64, len(edges))
    order = np.argsort(-keys)  # by node, the greatest number first, so the smallest is popped first
    parent, children = keys[order] // width, children[order].tolist()
    nodes = np.arange(len(begin))
    first = np.searchsorted(-parent, -nodes, "left").tolist()
    past = np.searchsorted(-parent, -nodes, "right").tolist()
    depth = [0] * len(begin)
    lows, suffixes = [], []
    low, stack = 0, [0]
    above = [0] * len(begin)
    while stack:
        v = stack.pop()
        d = depth[above[v]]
        if d < low:
            low = d
        if end[v] == n and v:
            if suffixes:
                lows.append(low)
            low = n
            suffixes.append(begin[v] - d)
            continue
        d += end[v] - begin[v]
        depth[v] = d
        some = children[first[v] : past[v]]
        for w in some:
            above[w] = v
        stack += some
    rank = np.empty(n, np.int64)
    rank[suffixes] = np.arange(n)
    return rank, np.array(lows, np.int32)


def _next_beyond(rank: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For every place the next one of smaller and of greater rank, or the length."""
    n = len(rank)
    smaller, greater = [n] * n, [n] * n
    down, up = [], []
    for i, r in enumerate(rank):
        while down and rank[down[-1]] > r:
            smaller[down.pop()] = i
        while up and rank[up[-1]] < r:
            greater[up.pop()] = i
        down.append(i)
        up.append(i)
    return np.array(smaller), np.array(greater)


def runs_of(symbols: list[int], least: int = 6, times: int = 4) -> np.ndarray:
    """(start, length, period) of all runs of at least max(least, times * period) numbers, times >= 2.

    The numbers are 1 or more. Sorted by start, then period.
    """
    n = len(symbols)
    if n < max(least, times):
        return np.zeros((0, 3), np.int64)
    forward = SuffixTree([*symbols, 0])
    smaller, greater = _next_beyond(forward.rank.tolist())
    at = np.concatenate((np.arange(n), np.arange(n)))
    period = np.concatenate((smaller[:n], greater[:n])) - at
    root = (period * times <= n) & (at + period < n)
    at, period = at[root], period[root]
    if not len(at):
        return np.zeros((0, 3), np.int64)
    right = forward.agree(at, at + period)
    backward = SuffixTree([*symbols[::-1], 0])
    left = np.zeros(len(at), np.int64)
    inner = np.flatnonzero(at > 0)
    left[inner] = backward.agree(n - at[inner], n - at[inner] - period[inner])
    length = left + period + right
    wanted = length >= np.maximum(least, times * period)
    found = np.stack((at - left, length, period), 1)[wanted]
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _possible(ids: np.ndarray, owner: np.ndarray, ends: np.ndarray, least: int, times: int) -> np.ndarray:
    """Marks the places that can be in a run of their text.

    In a run of period q and length m the first m - q words recur within q places.
    For q up to each power of two, stretches of words that recur so near and that are
    long enough for the smallest such q are taken, with q more words behind them.
    """
    key = owner * (int(ids.max()) + 1) + ids
    order = np.argsort(key, kind="stable")
    gap = np.full(len(ids), len(ids) + 1, np.int64)
    same = key[order[1:]] == key[order[:-1]]
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    cover = np.zeros(len(ids) + 1, np.int64)
    longest = int(np.diff(ends, prepend=0).max())
    low, high = 1, 1
    while low * times <= longest:
        edges = np.flatnonzero(np.diff(np.concatenate(([False], gap <= high, [False])).view(np.int8)))
        a, b = edges[::2], edges[1::2]
        held = b - a >= min(max(least, times * q) - q for q in range(low, min(high, low + least) + 1))
        a, b = a[held], b[held]
        np.add.at(cover, a, 1)
        np.add.at(cover, np.minimum(b + high, ends[owner[a]]), -1)
        low, high = high + 1, 2 * high
    return np.cumsum(cover[:-1]) > 0


def text_runs(texts: list[bytes], least: int = 6, times: int = 4) -> list[tuple[list[bytes], np.ndarray]]:
    """Each text's words (cut at space and 0x09-0x0D) and its runs by place in them."""
    words = [t.split() for t in texts]
    none = np.zeros((0, 3), np.int64)
    out = [(w, none) for w in words]
    sizes = np.array([len(w) for w in words], np.int64)
    if not sizes.sum():
        return out
    numbers = {w: i for i, w in enumerate(set().union(*words), 1)}
    ids = np.fromiter((numbers[w] for some in words for w in some), np.int64, int(sizes.sum()))
    owner, ends = np.repeat(np.arange(len(words)), sizes), np.cumsum(sizes)
    possible = np.flatnonzero(_possible(ids, owner, ends, least, times))
    cuts = np.searchsorted(possible, np.concatenate(([0], ends)))
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        at = possible[cuts[k] : cuts[k + 1]]
        # One mark of its own between stretches that aren't neighbours.
        breaks = np.flatnonzero(np.diff(at) > 1) + 1
        _, small = np.unique(ids[at], return_inverse=True)
        symbols = np.insert(small + 1, breaks, small.max() + 2 + np.arange(len(breaks)))
        place = np.insert(at, breaks, -1) - int(ends[k] - sizes[k])
        found = runs_of(symbols.tolist(), least, times)
        found[:, 0] = place[found[:, 0]]
        out[k] = (words[k], found)
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by blanks, without those that a run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    dropped = np.zeros(len(words) + 1, np.int64)
    np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
    np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(dropped[:-1]) == 0
    return b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def find_runs(docs: DataFrame, text: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """Every row of ``docs`` with n_words, runs (start, length, period) and the collapsed text.

    Words are cut at space and 0x09-0x0D. Runs have at least max(least, times * period)
    words and are sorted by start, then period; the collapsed text leaves out what a
    run repeats. A null or empty text has no words, no runs and an empty collapsed
    text. Rows stand one by one, repeated ones too; other columns pass through, but
    for those with one of the three new names, which are replaced. One task holds one
    text, whatever its length.
    """

    def found(column: pa.Array) -> list[pa.Array]:
        some = [x or b"" for x in column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()]
        each = text_runs(some, least, times)
        runs = np.concatenate([r for _, r in each]) if each else np.zeros((0, 3), np.int64)
        bounds = np.concatenate(([0], np.cumsum([len(r) for _, r in each])))
        rows = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in range(3)], names=["start", "length", "period"])
        return [
            pa.array([len(w) for w, _ in each], pa.int64()),
            pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), rows),
            pa.array([collapsed(*e).decode() for e in each], pa.string()),
        ]

    new = {"n_words": "bigint", "runs": RUNS, "collapsed": "string"}
    return with_columns(docs, F.col(f"`{text}`").cast("string"), new, found)


def planted(doc_id: Column, text: Column) -> Column:
    """The text, in every tenth document by crc32 of its id with its words periodic from some word on.

    With h = crc32(doc_id as text) and g = h div 10, a text of n > 0 words has the words
    from a = g mod n on replaced by repetitions of its p = 1 + (n - a) div (3 + g mod 8)
    words from a on, if h mod 10 is 0. Other texts, and those of null ids, stay as they are.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    periodic = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")
    return F.when((h % 10 == 0) & (n > 0), periodic).otherwise(text)


def digest(runs: str = "runs", text: str = "collapsed") -> list[Column]:
    """n_runs, the run of greatest exponent (ties: smallest start, then period) and digests of both columns."""
    best = F.reduce(
        runs, F.get(F.col(runs), F.lit(0)),
        lambda kept, r: F.when(r.length * kept.period > kept.length * r.period, r).otherwise(kept),
    )
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return [
        F.size(runs).cast("long").alias("n_runs"),
        *(best[name].alias(name) for name in ("start", "length", "period")),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col(text), 256).alias("collapsed_sha256"),
    ]
