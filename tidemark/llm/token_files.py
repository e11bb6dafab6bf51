"""Token ids in binary files: frequency ranks in a byte-aligned code.

A file holds whole documents in order. Its ids are replaced by their rank in
the file's own count of ids (ties by id), so that the commonest take one byte,
and written with as many bytes as the rank needs. The byte counts stand apart,
four to a control byte, and are read through a table of 256 rows.

    magic 8 | documents u64 | ids u64 | distinct u64 | doc ids i64 | null flags u8
    | ids per document u64 | table of ids by rank u32 | control bytes | data bytes
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import encoder, in_slices
from tidemark.llm.common import Batches, file_system, in_arrow, new_folder, one_by_one, put_file, start_totals
from tidemark.session import written

MAGIC = b"TIDEIDS1"
SLICE = 1 << 18
#: Bytes of each of the four ids that a control byte describes.
SIZES = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit numbers."""
    controls, data = [], []
    for i in range(0, len(ranks), SLICE):
        r = np.ascontiguousarray(ranks[i : i + SLICE], "<u4")
        size = 1 + (r >= 1 << 8).astype(np.uint8) + (r >= 1 << 16) + (r >= 1 << 24)
        most = int(size.max())
        data.append(r.view(np.uint8).reshape(-1, 4)[:, :most][np.arange(most) < size[:, None]].tobytes())
        four = np.zeros(-(-len(r) // 4) * 4, np.uint8)
        four[: len(r)] = size - 1
        four = four.reshape(-1, 4)
        controls.append((four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8).tobytes())
    return b"".join(controls), b"".join(data)


def decode_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The numbers back, slice by slice, through the table of sizes."""
    out, at = np.empty(n, np.uint32), 0
    data = np.concatenate((data, np.zeros(3, np.uint8)))
    for i in range(0, n, SLICE):
        size = SIZES[control[i // 4 : (i + SLICE) // 4]].ravel()[: n - i].astype(np.int64)
        ends = np.cumsum(size)
        four = data[(at + ends - size)[:, None] + np.arange(4)]
        out[i : i + SLICE] = np.ascontiguousarray(four).view("<u4").ravel() & MASKS[size]
        at += int(ends[-1])
    return out


def file_bytes(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """One file of whole documents."""
    every = np.frombuffer(b"".join(ids), "<u4")
    # Ids are below the vocabulary's size, so a table over them is small.
    counts = np.bincount(every) if len(every) else np.zeros(0, np.int64)
    seen = np.flatnonzero(counts)
    order = np.lexsort((seen, -counts[seen]))
    rank = np.zeros(len(counts), np.uint32)
    rank[seen[order]] = np.arange(len(seen), dtype=np.uint32)
    control, data = encode_ranks(rank[every])
    return b"".join(
        (
            MAGIC,
            np.array([len(ids), len(every), len(seen)], "<u8").tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], np.uint8).tobytes(),
            np.array([len(i) // 4 for i in ids], "<u8").tobytes(),
            seen[order].astype("<u4").tobytes(),
            control,
            data,
        )
    )


def parse_file(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, ids per document, and all ids of a file."""
    if content[:8] != MAGIC:
        raise ValueError("not a token file")
    docs, n, distinct = np.frombuffer(content, "<u8", 3, 8).astype(int).tolist()
    at = 32

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(content, kind, count, at)
        at += found.nbytes
        return found

    keys, nulls = take("<i8", docs), take("u1", docs)
    lengths, table = take("<u8", docs).astype(np.int64), take("<u4", distinct)
    control = take("u1", -(-n // 4))
    ids = table[decode_ranks(control, take("u1", len(content) - at), n)] if n else np.zeros(0, "<u4")
    return [None if null else int(k) for k, null in zip(keys, nulls, strict=True)], lengths, ids


def write_files(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 0, file_ids: int = 8_000_000) -> DataFrame:
    """Write ``docs`` (doc_id, text) in ascending doc_id and return the files' list.

    Documents are dealt out by ranges of (doc_id, text's hash), sorted and
    encoded in one pass; a task closes a file when it has ``file_ids`` ids. A task
    that is run again writes the same files anew, each moved to its place when it
    is whole. The list has ordinal (ascending with doc_id), path, docs and ids.

    Null ids come first; rows with one id stand by text. A null text is empty.
    An empty table gives no files.
    """
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Batches) -> Batches:
        encode, task = encoder(vocabulary).encode, TaskContext.get().partitionId()
        keys, ids, size, closed = [], [], 0, []

        def close():
            nonlocal keys, ids, size
            if keys:
                path = put_file(folder, f"part-{task:06d}-{len(closed):05d}.ids", file_bytes(keys, ids))
                closed.append((task << 20 | len(closed), path, len(keys), size))
                keys, ids, size = [], [], 0

        for b in batches:
            names = iter(b.column(0).to_pylist())
            for some in in_slices(b.column(1).to_pylist()):
                for i in encode(some):
                    keys.append(next(names))
                    ids.append(i + end)
                    size += len(i) // 4 + 1
                    if size >= file_ids:
                        close()
        close()
        if closed:
            yield pa.RecordBatch.from_pydict(
                {k: list(c) for k, c in zip(("ordinal", "path", "docs", "ids"), zip(*closed, strict=True), strict=True)}
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    placed = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return written(in_arrow(placed, run, "ordinal long, path string, docs long, ids long", keeps=True), "token-list")


def read_files(files: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the listed files, in no order: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it, over all files.
    """
    columns = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def run(batches: Batches) -> Batches:
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                store, _ = file_system(folder)
                with store.open_input_stream(path, compression=None) as f:
                    keys, lengths, ids = parse_file(f.read())
                ends = np.cumsum(lengths)
                starts = ends - lengths
                raw = ids.tobytes()
                parts = [raw[4 * s : 4 * e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                found = {
                    "doc_id": pa.array(keys, pa.int64()),
                    "start": pa.array(starts + base),
                    "n_tokens": pa.array(lengths),
                    "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                }
                yield pa.RecordBatch.from_pydict(found | ({"ids": pa.array(parts, pa.binary())} if with_ids else {}))

    based = start_totals(files, "ordinal", "ids", "base", block=1 << 26).select("path", "base")
    return in_arrow(one_by_one(based, files.count()), run, columns)


def token_files(docs: DataFrame, vocabulary: str, end_id: int = 0, file_ids: int = 8_000_000) -> DataFrame:
    """Write and read back; see ``write_files`` and ``read_files``."""
    folder = new_folder(docs, "tokens")
    return read_files(write_files(docs, vocabulary, folder, end_id, file_ids), folder)
