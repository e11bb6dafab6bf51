"""Packing by minimum bin slack: a bitset subset-sum fills each window.

Documents longer than a window give full windows; what is left of each is a
*remainder*. A subset-sum over the multiset of remaining lengths, held as the
bits of one integer, finds the multiset that fills the next window closest to
its capacity; going back through the steps gives how many of each length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import encoder, in_slices
from tidemark.llm.common import Batches, in_arrow

PIECE = (
    "doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def best_fill(lengths: list[int], counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Counts per length whose sum is the largest up to ``capacity``.

    ``lengths`` are tried in the order given; the search ends early when the
    capacity is met exactly. Copies of a length go in by powers of two.
    """
    reach, mask, steps = 1, (1 << (capacity + 1)) - 1, []
    for length in lengths:
        left, take = counts[length], 1
        while left > 0 and length * take <= capacity:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            take *= 2
        if reach >> capacity:
            break
    at, chosen = reach.bit_length() - 1, defaultdict(int)
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            chosen[length] += take
    return dict(chosen)


Piece = tuple  # (doc, start, ids, doc_tokens); ids are bytes, four a token


def _cut(piece: Piece, tokens: int) -> tuple[Piece, Piece]:
    doc, start, ids, total = piece
    return (doc, start, ids[: 4 * tokens], total), (doc, start + tokens, ids[4 * tokens :], total)


def windows(pieces: list[Piece], capacity: int, slack: int):
    """Lists of pieces, each a sequence: full to ``slack`` tokens, or of a power of two."""
    held: dict[int, list[Piece]] = defaultdict(list)
    for p in reversed(pieces):
        held[len(p[2]) // 4].append(p)
    counts = {n: len(v) for n, v in held.items()}
    lengths = sorted(counts, reverse=True)
    while lengths:
        chosen = best_fill(lengths, counts, capacity)
        free = capacity - sum(n * k for n, k in chosen.items())
        # The same multiset fills as many windows as the counts allow, if it is tight.
        times = min(counts[n] // k for n, k in chosen.items()) if free <= slack else 1
        for _ in range(times):
            some = [held[n].pop() for n, k in chosen.items() for _ in range(k)]
            for n, k in chosen.items():
                counts[n] -= k
            if free > slack:
                rest = next((n for n in reversed(lengths) if counts[n]), 0)
                if rest:  # every remainder left is longer than the gap: one is cut to close it
                    head, tail = _cut(held[rest].pop(), free)
                    counts[rest] -= 1
                    some.append(head)
                    n = rest - free
                    held[n].append(tail)
                    counts[n] = counts.get(n, 0) + 1
                    lengths = sorted({*lengths, n}, reverse=True)
                else:
                    yield from _by_powers(some)
                    some = []
            if some:
                yield some
        lengths = [n for n in lengths if counts[n]]


def _by_powers(pieces: list[Piece]):
    """The last pieces in sequences whose lengths are powers of two: nothing is padded."""
    left = sum(len(p[2]) // 4 for p in pieces)
    queue = list(pieces)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        some = []
        while room:
            p = queue.pop(0)
            n = len(p[2]) // 4
            if n > room:
                p, tail = _cut(p, room)
                queue.insert(0, tail)
                n = room
            some.append(p)
            room -= n
        yield some


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 2048,
    end_id: int = 1,
    slack: int = 8,
    held_tokens: int = 16_000_000,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of each row of ``docs`` (doc_id, text; others are ignored).

    A text's ids and ``end_id`` are cut into pieces that together cover them
    once. Each task packs what it reads: its remainders are kept until they have
    ``held_tokens`` tokens and are then packed, so memory is bounded and nothing
    is shuffled. ``sequence_id`` has the task's number in its upper bits. A
    window that no multiset fills to within ``slack`` tokens is closed by cutting
    one remainder; the last window of a task is dealt out in powers of two.
    ``with_ids`` adds the pieces' ids, little-endian unsigned 32-bit.

    A null or empty text has the end id alone. Repeated rows, and rows whose id
    is null, are packed row by row. An empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = PIECE.format(kind=kind) + (", ids binary" if with_ids else "")
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Batches) -> Batches:
        encode, task = encoder(vocabulary).encode, TaskContext.get().partitionId()
        sequence, rest, rest_tokens, out = 0, [], 0, []

        def put(pieces):
            nonlocal sequence
            at = 0
            for doc, start, ids, total in pieces:
                out.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, task << 40 | sequence, at, ids))
                at += len(ids) // 4
            sequence += 1

        def batch():
            columns = list(zip(*out, strict=True)) if out else [()] * 8
            out.clear()
            names = PIECE.split(", ") + ["ids"]
            return pa.RecordBatch.from_pydict(
                {
                    n.split()[0]: pa.array(c, doc_type if i == 0 else pa.binary() if i == 7 else pa.int64())
                    for i, (n, c) in enumerate(zip(names, columns, strict=True))
                    if i < 7 or with_ids
                }
            )

        doc_type = pa.int64()
        for b in batches:
            doc_type = b.schema.field("doc_id").type
            keys = iter(b.column(0).to_pylist())
            for some in in_slices(b.column(1).to_pylist()):
                for ids in encode(some):
                    doc, ids = next(keys), ids + end
                    total = len(ids) // 4
                    full = total - total % capacity
                    for start in range(0, full, capacity):
                        put([(doc, start, ids[4 * start : 4 * (start + capacity)], total)])
                    if full < total:
                        rest.append((doc, full, ids[4 * full :], total))
                        rest_tokens += total - full
                if rest_tokens >= held_tokens:
                    for w in windows(rest, capacity, slack):
                        put(w)
                    rest, rest_tokens = [], 0
                if len(out) >= 20_000 or with_ids:
                    yield batch()
        for w in windows(rest, capacity, slack):
            put(w)
        if out:
            yield batch()

    return in_arrow(docs.select("doc_id", F.col("text").cast("string").alias("text")), run, ddl, keeps=True)
