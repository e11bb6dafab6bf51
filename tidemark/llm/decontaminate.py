"""Benchmark passages in training texts, by an FM-index per shard.

A shard is a run of whole documents. Its words become numbers, each document
closed by a number of its own, and the shard is indexed: a suffix array by
prefix doubling, the Burrows-Wheeler transform in a wavelet matrix, and sampled
suffix positions. All windows of the benchmark are searched backwards at once,
and what they match is located by walking to the next sampled position.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, Batches, in_arrow, spare

#: Lower-cases A-Z and turns every byte outside digits, letters and non-ASCII into a blank.
WORD_TABLE = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in LOWER)


def words(text: bytes) -> list[bytes]:
    return text.translate(WORD_TABLE).split()


def suffix_array(symbols: np.ndarray, bits: int) -> np.ndarray:
    """Sorted suffixes, by prefix doubling that goes on only where there are ties."""
    n, first = len(symbols), min(62 // bits, len(symbols))
    key = np.zeros(n, np.int64)
    for i in range(first):
        key <<= bits
        key[: n - i] |= symbols[i:] + 1
    order = np.argsort(key)
    new = np.concatenate(([True], np.diff(key[order]) != 0))
    heads = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    depth = first
    tied = _tied(new)
    while len(tied):
        suffixes = order[tied]
        after = suffixes + depth
        next_rank = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        group = rank[suffixes]
        by = np.lexsort((next_rank, group))
        suffixes, group, next_rank = suffixes[by], group[by], next_rank[by]
        order[tied] = suffixes
        start = np.concatenate(([True], (np.diff(group) != 0) | (np.diff(next_rank) != 0)))
        heads = np.flatnonzero(start)
        rank[suffixes] = tied[np.repeat(heads, np.diff(np.append(heads, len(start))))]
        tied = tied[_tied(start)]
        depth *= 2
    return order


def _tied(new: np.ndarray) -> np.ndarray:
    """Places whose group has more than one member."""
    return np.flatnonzero(~(new & np.append(new[1:], True)))


class FMIndex:
    """Counts and positions of phrases in a sequence of numbers below ``size``.

    The sequence must end with a number that occurs nowhere else.
    """

    def __init__(self, symbols: np.ndarray, size: int, sample: int = 32):
        self.n, self.sample = len(symbols), sample
        # Suffixes past the end add one more value to a key's digit.
        order = suffix_array(symbols, max(1, int(size + 1).bit_length()))
        self.first = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=size))))
        bwt = symbols[order - 1]
        sampled = order % sample == 0
        self.marks = np.concatenate(([0], np.cumsum(sampled, dtype=np.int32)))
        self.samples = order[sampled]
        self.levels: list[tuple[np.ndarray, int]] = []
        for level in reversed(range(max(1, int(size - 1).bit_length()))):
            bit = (bwt >> level & 1).astype(bool)
            ones = np.zeros(self.n + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((ones, self.n - int(ones[-1])))
            bwt = np.concatenate((bwt[~bit], bwt[bit]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before the row ``at`` of the transform."""
        low, at = np.zeros_like(at), at.copy()
        for i, (ones, zeros) in enumerate(self.levels):
            bit = symbol >> (len(self.levels) - 1 - i) & 1
            low = np.where(bit, zeros + ones[low], low - ones[low])
            at = np.where(bit, zeros + ones[at], at - ones[at])
        return at - low

    def step(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix one position earlier."""
        low, at, symbol = np.zeros_like(row), row.copy(), np.zeros_like(row)
        for ones, zeros in self.levels:
            bit = ones[at + 1] > ones[at]
            symbol = symbol << 1 | bit
            low = np.where(bit, zeros + ones[low], low - ones[low])
            at = np.where(bit, zeros + ones[at], at - ones[at])
        return self.first[symbol] + at - low

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [start, end) of each phrase; a number below 0 in a phrase matches nothing.

        ``phrases`` has a row per phrase, ended at its length.
        """
        start, end = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for i in reversed(range(phrases.shape[1])):
            live = np.flatnonzero((i < lengths) & (start < end))
            symbol = phrases[live, i]
            known = symbol >= 0
            end[live[~known]] = start[live[~known]]
            live, symbol = live[known], symbol[known]
            base = self.first[symbol]
            start[live], end[live] = base + self.rank(symbol, start[live]), base + self.rank(symbol, end[live])
        return start, end

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes in the given rows."""
        found, row, steps, left = np.empty(len(rows), np.int64), rows.copy(), 0, np.arange(len(rows))
        while len(left):
            hit = self.marks[row + 1] > self.marks[row]
            found[left[hit]] = self.samples[self.marks[row[hit]]] + steps
            left, row, steps = left[~hit], self.step(row[~hit]), steps + 1
        return found


def block_windows(items: list[tuple[str, bytes]], width: int) -> tuple[list[list[bytes]], list[list[str]]]:
    """Distinct windows of some items, and the items that have each."""
    owners: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            owners.setdefault(tuple(w[i : i + width]), set()).add(item)
    return [list(k) for k in owners], [sorted(v) for v in owners.values()]


def blocks_of(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark's items in blocks of at most about so many bytes, one held at a time."""
    some, size = [], 0
    rows = benchmark.where("item_id is not null and text is not null")
    for r in rows.select(F.col("item_id").cast("string"), F.col("text").cast("string")).toLocalIterator():
        some.append((r[0], r[1].encode()))
        size += len(some[-1][1])
        if size >= block_bytes:
            yield some
            some, size = [], 0
    if some:
        yield some


def merged(starts: np.ndarray, ends: np.ndarray) -> list[int]:
    """Disjoint spans that cover the given ones, flat: start, end, start, end, ..."""
    if not len(starts):
        return []
    by = np.argsort(starts, kind="stable")
    s, e = starts[by], np.maximum.accumulate(ends[by])
    new = np.concatenate(([True], s[1:] > e[:-1]))
    last = np.append(np.flatnonzero(new)[1:] - 1, len(s) - 1)
    return np.column_stack((s[new], e[last])).ravel().tolist()


def _shard(docs: list[list[bytes]], windows: list[list[bytes]], owners: list[list[str]], width: int):
    """Spans and item ids of each document of a shard."""
    ids: dict[bytes, int] = {}
    closing, fresh = len(docs), count()
    parts = []
    for k, w in enumerate(docs):
        for x in set(w).difference(ids):
            ids[x] = closing + next(fresh)
        part = np.empty(len(w) + 1, np.int64)
        part[:-1] = np.fromiter(map(ids.__getitem__, w), np.int64, len(w))
        part[-1] = k
        parts.append(part)
    starts = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    phrases = np.full((len(windows), width), -1, np.int64)
    lengths = np.array([len(w) for w in windows], np.int64)
    for i, w in enumerate(windows):
        phrases[i, : len(w)] = [ids.get(x, -1) for x in w]
    # A phrase with a word that the shard lacks can't occur in it.
    able = np.flatnonzero((phrases >= 0).sum(1) == lengths)
    out: list[tuple[list[int], set[str]]] = [([], set()) for _ in docs]
    if not len(able):
        return out
    index = FMIndex(np.concatenate(parts), closing + len(ids))
    low, high = index.search(phrases[able], lengths[able])
    which = np.repeat(able, high - low)
    rows = np.repeat(low, high - low) + np.arange(len(which)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
    at = index.locate(rows)
    doc = np.searchsorted(starts, at, "right") - 1
    begin = at - starts[doc]
    end = begin + lengths[which]
    by = np.argsort(doc, kind="stable")
    edges = np.flatnonzero(np.diff(doc[by])) + 1
    for some in np.split(by, edges) if len(by) else []:
        k = int(doc[some[0]])
        out[k] = (merged(begin[some], end[some]), {o for w in set(which[some].tolist()) for o in owners[w]})
    return out


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 13,
    shard_words: int = 1_000_000,
    block_bytes: int = 16 << 20,
    names: tuple[str, str, str] = ("n_words", "spans", "items"),
) -> DataFrame:
    """``docs`` with three columns: its words' count, spans hit and ids of items found.

    Words are runs of ASCII digits, letters (A-Z lower-cased) and non-ASCII
    characters. A window is ``width`` consecutive words of an item, or the whole
    of a shorter item that has words. ``spans`` has word positions (start, end)
    of the union of all occurrences, flat and ascending; ``items`` the sorted ids
    of the items with a window in the text.

    A row stays in its task and nothing is shuffled; a task indexes about
    ``shard_words`` words at a time (at least one document). The benchmark goes
    through in blocks of ``block_bytes`` bytes, one held by the driver at a time;
    every block's windows meet every shard, in one pass each.

    Null texts have no words. Items whose id or text is null, or that have no
    words, are never found; items that share an id count as one. An empty
    benchmark or table is fine. Other columns pass through untouched.
    """
    blocks = [block_windows(b, width) for b in blocks_of(benchmark, block_bytes)] or [([], [])]
    return _with_blocks(docs, blocks, width, shard_words, names)


def _with_blocks(docs: DataFrame, blocks, width: int, shard_words: int, names: tuple[str, str, str]) -> DataFrame:
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    schema += f", `{names[0]}` long, `{names[1]}` array<int>, `{names[2]}` array<string>"
    place = docs.columns.index("text")
    spark = docs.sparkSession
    sent = [spark.sparkContext.broadcast(b) for b in blocks]

    def run(batches: Batches) -> Batches:
        for batch, texts in slices(batches):
            found = [([], set()) for _ in texts]
            for b in sent:
                windows, owners = b.value
                for k, (spans, items) in enumerate(_shard(texts, windows, owners, width) if windows else ()):
                    if spans:
                        flat = np.array(found[k][0] + spans, np.int64).reshape(-1, 2)
                        found[k] = (merged(flat[:, 0], flat[:, 1]), found[k][1] | items)
            columns = [
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([f[0] for f in found], pa.list_(pa.int32())),
                pa.array([sorted(f[1]) for f in found], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])

    def slices(batches: Batches):
        """Rows of about ``shard_words`` words, with their words."""
        held, texts, size = [], [], 0
        for batch in batches:
            start, column = 0, batch.column(place)
            for i in range(batch.num_rows):
                w = words((column[i].as_py() or "").encode())
                texts.append(w)
                size += len(w) + 1
                if size >= shard_words:
                    yield joined([*held, batch.slice(start, i + 1 - start)]), texts
                    held, texts, size, start = [], [], 0, i + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield joined(held), texts

    def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return parts[0] if len(parts) == 1 else pa.concat_batches(parts)

    return in_arrow(docs, run, schema)


def hit_words(spans: str | Column) -> Column:
    """Words covered by flat spans."""
    spans = F.col(spans) if isinstance(spans, str) else spans
    signed = F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x).cast("long"))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x)


def is_contaminated(spans: str, n_words: str, share: int = 20) -> Column:
    """Some word is hit, and at least one in ``share`` is."""
    hits = hit_words(spans)
    return (hits > 0) & (share * hits >= F.col(n_words))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans."""
    found = find_passages(docs.select("doc_id", F.col("text").cast("string").alias("text")), benchmark, **options)
    return found.select(
        "doc_id",
        "n_words",
        hit_words("spans").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated("spans", "n_words").alias("contaminated"),
        "spans",
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged.

    Null and empty texts have no words and stay; repeated rows are judged one by one.
    An empty benchmark takes nothing away.
    """
    names = tuple(spare(n, docs.columns) for n in ("n_words", "spans", "items"))
    found = find_passages(docs, benchmark, names=names, **options)
    return found.where(~is_contaminated(names[1], names[0])).select(*[f"`{c}`" for c in docs.columns])


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
