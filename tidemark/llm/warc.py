"""WARC archives: written with one gzip member per record, read back in sequence.

The reader takes a file in small pieces, decompresses member by member, frames
each record by its Content-Length and checks the digests.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Batches, file_system, in_arrow, new_folder, one_by_one, put_file
from tidemark.session import written

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
EPOCH = "1970-01-01T00:00:00Z"


def digest(content: bytes) -> str:
    return base64.b32encode(hashlib.sha1(content).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = EPOCH) -> bytes:
    """One record as a gzip member; a revisit, which has no payload, if ``refers_to`` is given."""
    revisit = refers_to is not None
    block = HTTP if revisit else HTTP + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{url}:{digest(payload)}")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%-._~')}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"X-Refers-To-Page-ID: {refers_to}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def members(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The decompressed content of each gzip member in turn."""
    unpacker, parts = zlib.decompressobj(31), []
    started = False
    for chunk in chunks:
        while chunk:
            started = True
            parts.append(unpacker.decompress(chunk))
            chunk = b""
            if unpacker.eof:
                chunk = unpacker.unused_data
                yield b"".join(parts)
                unpacker, parts, started = zlib.decompressobj(31), [], False
    if started:
        raise ValueError("the archive ends within a member")


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by lower-cased name, and the block."""
    head, mark, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or not lines[0].startswith("WARC/"):
        raise ValueError("not a record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("the block's length differs from Content-Length")
    return headers, rest[:length]


def checked(headers: dict[str, str], block: bytes) -> bytes:
    """The payload, after its digests have been held against the headers."""
    if headers["warc-block-digest"] != f"sha1:{digest(block)}":
        raise ValueError("block digest differs")
    payload = block.partition(b"\r\n\r\n")[2]
    if headers["warc-type"] == "response" and headers["warc-payload-digest"] != f"sha1:{digest(payload)}":
        raise ValueError("payload digest differs")
    return payload


def _payload(column: str = "html") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def with_references(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html and ``refers_to``: the smallest page_id with an equal payload.

    Only narrow rows are grouped by digest, with minima combined before the
    shuffle. Where the pages that refer to another are few, the planner sends
    them to the pages; else both are joined on (page_id, digest), which spreads
    the pages of a common payload.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(_payload()).alias("_sha"))
    narrow = rows.where(F.length(_payload()) >= least_bytes).select("page_id", "_sha")
    first = narrow.groupBy("_sha").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_n"))
    first = first.where("_n > 1 and refers_to is not null").drop("_n")
    later = (
        narrow.groupBy("_sha", "page_id").agg(F.count(F.lit(1)).alias("_n"))
        .join(first, "_sha")
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select(F.col("page_id").alias("_page"), F.col("_sha").alias("_key"), "refers_to")
    )
    same = (F.col("_sha") == F.col("_key")) & F.col("page_id").eqNullSafe(F.col("_page"))
    return rows.join(later, same, "left").select("page_id", "url", "html", "refers_to")


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 0, file_bytes: int = 32 << 20) -> DataFrame:
    """Write a record per row and return the files' list (path, records).

    Of rows with equal payloads of at least ``least_bytes`` bytes, those with the
    smallest page_id are responses and the others revisits of it. Null ids come
    after all others; if all are null, all are responses. Null html is an empty
    payload, a null url gives no target. An empty table gives no files. A file is
    closed at ``file_bytes`` bytes and moved to its place whole.
    """

    def run(batches: Batches) -> Batches:
        task, parts, size, records, closed = TaskContext.get().partitionId(), [], 0, 0, []

        def close():
            nonlocal parts, size, records
            if parts:
                path = put_file(folder, f"part-{task:06d}-{len(closed):05d}.warc.gz", b"".join(parts))
                closed.append((path, records))
                parts, size, records = [], 0, 0

        for b in batches:
            for page_id, url, html, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                parts.append(record(page_id, url, (html or "").encode(), first))
                size += len(parts[-1])
                records += 1
                if size >= file_bytes:
                    close()
        close()
        if closed:
            yield pa.RecordBatch.from_pydict({"path": [c[0] for c in closed], "records": [c[1] for c in closed]})

    rows = with_references(pages, least_bytes)
    return written(in_arrow(rows, run, "path string, records long"), "warc-list")


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_warc(files: DataFrame, folder: str, with_payload: bool = False, piece: int = 1 << 18) -> DataFrame:
    """A row per record of the listed archives; a damaged archive fails the job."""
    columns = READ + (", payload binary" if with_payload else "")

    def chunks(path: str) -> Iterator[bytes]:
        store, _ = file_system(folder)
        with store.open_input_stream(path, compression=None) as f:
            while part := f.read(piece):
                yield part

    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    def run(batches: Batches) -> Batches:
        for b in batches:
            for path in b.column(0).to_pylist():
                rows = []
                for member in members(chunks(path)):
                    headers, block = parse(member)
                    payload = checked(headers, block)
                    rows.append(
                        (
                            number(headers.get("x-page-id")),
                            headers.get("warc-target-uri"),
                            int(headers["x-payload-length"]),
                            headers["warc-payload-digest"].removeprefix("sha1:"),
                            headers["warc-type"],
                            number(headers.get("x-refers-to-page-id")),
                            payload,
                        )
                    )
                    if len(rows) >= (200 if with_payload else 20_000):
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in READ.split(", ")] + ["payload"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kept = len(names) - (not with_payload)
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kinds[i]) for i in range(kept)], names=names[:kept]
        )

    return in_arrow(one_by_one(files.select("path"), files.count()), run, columns)


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the pages as archives and read them back."""
    folder = new_folder(pages, "warc")
    return read_warc(write_warc(pages, folder, least_bytes), folder)
