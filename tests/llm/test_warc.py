import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.llm.common import new_folder


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, least=0):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html in rows:
        text = html or ""
        to = first.get(text) if len(text.encode()) >= least else None
        to = None if to == page else to
        out.append((page, len(text.encode()), sha(text), "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


def got(df):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_pages(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    assert got(warc.archived(pages)) == brute([tuple(r) for r in pages.select("page_id", "url", "html").collect()])


def test_every_archive_is_read_by_a_task_of_its_own(spark, folder):
    """Also under adaptive execution, which would merge the parts of a short list."""
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    home = new_folder(pages, "warc")
    files = warc.write_warc(pages, home, file_bytes=5_000)
    tasks = warc.read_warc(files, home).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == files.count() > 10


@pytest.mark.parametrize("least", [0, 5])
def test_awkward_pages(spark, least):
    rows = [
        (9, "http://a/\r\nX: y", "same <p>"), (3, None, "same <p>"), (5, "u", None), (4, "u", ""), (4, "u", ""),
        (None, "u", "same <p>"), (None, "u", "alone"), (None, "u", "alone"), (6, "ü ?", "é\r\n\r\nx\x00" * 70_000),
    ]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, refers_to int")
    assert got(warc.archived(pages, least)) == brute(rows, least)
    assert warc.archived(pages.limit(0)).count() == 0


def test_reader_frames_and_checks():
    raw = b"".join(warc.record(i, "u", b"payload %d" % i * 500, None) for i in range(5))
    for size in (1, 7, len(raw)):
        chunks = (raw[i : i + size] for i in range(0, len(raw), size))
        found = [warc.parse(m) for m in warc.members(chunks)]
        assert [warc.checked(*f) for f in found] == [b"payload %d" % i * 500 for i in range(5)]
    with pytest.raises(ValueError, match="within a member"):
        list(warc.members([raw[:-3]]))
    headers, block = found[0]
    with pytest.raises(ValueError, match="block digest"):
        warc.checked(headers, block[:-1] + b"x")
    with pytest.raises(ValueError, match="Content-Length"):
        warc.parse(next(warc.members([raw]))[:-1])


def test_payloads_come_back(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html")
    where = warc.new_folder(pages, "warc-test")
    back = warc.read_warc(warc.write_warc(pages, where, file_bytes=20_000), where, with_payload=True)
    kept = {r.page_id: bytes(r.payload).decode() for r in back.where("record_type = 'response'").collect()}
    assert all(kept[r.page_id] == r.html for r in pages.collect() if r.page_id in kept)
