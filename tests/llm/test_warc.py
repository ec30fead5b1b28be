"""WARC archives: exact round trips, revisits, and ranges."""

import gzip
import uuid

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from tidewatch.llm.warc import coalesced_ranges, payload_digest, read_records, write_archives

PAGES = [
    (5, "http://a/x y", "<p>é</p>"), (3, "http://b/", "<p>é</p>"), (9, None, "<p>é</p>"), (1, "http://c/\r\nX: y", ""), (2, "", None), (None, "n", "only"),
    (None, "m", "<p>é</p>"), (7, "http://d/é%20", "a\r\n\r\nb\r\n"), (7, "http://d/é%20", "a\r\n\r\nb\r\n"), (8, "u", "z" * 3_000_000), (11, "q", "\0\x7f😀"),
]


def at(tmp_path):
    return f"file://{tmp_path}/{uuid.uuid4().hex}"


def expected(rows, least=0):
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        revisit = len(raw) >= least and bool(same) and page != min(same)
        out.append((page, len(raw), payload_digest(raw), "revisit" if revisit else "response", min(same) if revisit else None))
    return sorted(out, key=str)


def read(frame):
    return sorted((tuple(r) for r in frame.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip_with_copies_nulls_and_long_pages(spark, tmp_path, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("offset", F.lit("x")).repartition(3)
    index = write_archives(pages, at(tmp_path), least=least, archive_bytes=2000)
    out = read_records(index)
    assert read(out) == expected(PAGES, least)
    bodies = {r.payload_digest: bytes(r.payload) for r in out.collect() if r.payload is not None}
    assert all(bodies[payload_digest((h or "").encode())] == (h or "").encode() for _, _, h in PAGES)
    some = index.filter("page_id in (7, 8, 3)")
    assert {r.page_id for r in read_records(some).collect()} == {7, 8, 3}


def test_archives_are_gzip_members_in_index_order(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    index = write_archives(pages, at(tmp_path)).orderBy("offset").collect()
    files, place = fs.FileSystem.from_uri(index[0].path)
    with files.open_input_file(place) as stream:
        raw = stream.read()
    assert sum(r.length for r in index) == len(raw) and [r.offset for r in index][:1] == [0]
    whole = gzip.decompress(raw)
    assert whole == b"".join(gzip.decompress(raw[r.offset : r.offset + r.length]) for r in index)
    assert whole.count(b"WARC/1.1\r\n") == len(PAGES) and b"%0D%0AX:%20y" in whole


def test_ranges_merge_neighbours(spark):
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 40, 5), ("a", 45, 1), ("b", 3, 4), ("a", 100, 1)]
    index = spark.createDataFrame(rows, "path string, offset long, length long")
    got = sorted((r.path, r.start, r.end, len(r.members)) for r in coalesced_ranges(index, gap=10, most=80).collect())
    assert got == [("a", 0, 15, 2), ("a", 40, 46, 2), ("a", 100, 101, 1), ("b", 3, 7, 1)]


def test_empty_table(spark, tmp_path):
    index = write_archives(spark.createDataFrame([], "page_id long, url string, html string"), at(tmp_path))
    assert read_records(index).count() == 0
