"""WARC archives, index first.

Tasks write records as gzip members of archive files on shared storage and emit an index row per record: file, offset,
length, URL and payload digest. The index is committed as a table, so it names only files of tasks that finished.
Reading starts from the index: selected records are sorted by place, neighbours are coalesced to byte ranges, and each range
is one read. Archives go through ``pyarrow.fs``, which opens local, HDFS and object-store URIs alike.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import stored

INDEX = "path string, offset bigint, length bigint, url string, digest string, record_type string, page_id bigint"
RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"
ARCHIVE_BYTES, RANGE_BYTES, GAP_BYTES = 64 << 20, 4 << 20, 64 << 10
# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    number = (name or "")[len("<urn:page:") : -1]
    return int(number) if number else None


def build_record(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool) -> tuple[bytes, str]:
    """One record, compressed as a member of its own, and the payload's digest. A revisit leaves the payload out."""
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~' + chr(39))}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(first)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n") + packer.flush(), digest


def parse_record(member: bytes) -> dict:
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError("not a record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(h.split(b": ")[1]) for h in http.split(b"\r\n") if h.startswith(b"Content-Length: "))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    return {
        "page_id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
        "refers_to": _page(fields["WARC-Refers-To"]) if revisit else None, "payload_bytes": size, "payload_digest": digest,
        "payload": None if revisit else payload,
    }


class _Archive:
    """A new archive file under a folder, named so that no other attempt can write to it."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        files, place = fs.FileSystem.from_uri(folder)
        files.create_dir(place, recursive=True)
        files, place = fs.FileSystem.from_uri(self.path)
        self.stream, self.size = files.open_output_stream(place, compression=None), 0

    def add(self, member: bytes) -> int:
        self.stream.write(member)
        self.size += len(member)
        return self.size - len(member)


def _write(folder: str, limit: int):
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    names = [c.split()[0] for c in INDEX.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        try:
            for batch in batches:
                columns = [batch.column(n) for n in range(batch.num_columns)]
                rows = []
                for page_id, url, html, first, revisit in zip(*columns):
                    page_id, url, first, revisit = page_id.as_py(), url.as_py(), first.as_py(), revisit.as_py()
                    member, digest = build_record(page_id, url, html.as_py().encode(), first, revisit)
                    if archive is None or archive.size >= limit:
                        if archive is not None:
                            archive.stream.close()
                        archive = _Archive(folder)
                    rows.append((archive.path, archive.add(member), len(member), url, digest, "revisit" if revisit else "response", page_id))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        finally:
            if archive is not None:
                archive.stream.close()

    return run


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write a record per page below ``folder`` and return the index, itself a written table.

    Of pages with equal payloads of at least ``least`` bytes the one with the smallest id is a response and the others
    revisit it; pages that repeat that id and payload are responses as well. Null html is empty. Null ids come after
    all others; if all ids of a payload are null, all are responses. URLs keep their text but for control characters and
    other bytes that a header cannot hold, which are percent-encoded; a null URL is left out. Page ids are integers.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), payload.alias("html"))
    rows = rows.withColumn("key", F.when(F.octet_length("html") >= least, F.unhex(F.sha2("html", 256))))
    firsts = rows.filter("key is not null").groupBy("key").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    firsts = stored(firsts.filter("copies > 1 and first is not null").select("key", "first"))
    joined = rows.join(firsts, "key", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    named = joined.select("page_id", "url", "html", "first", revisit.alias("revisit"))
    return stored(named.mapInArrow(_write(folder, archive_bytes), INDEX))


def coalesced_ranges(index: DataFrame, gap: int = GAP_BYTES, most: int = RANGE_BYTES) -> DataFrame:
    """(path, start, end, members): byte ranges that cover the indexed records, split where ``gap`` bytes lie unused.

    Archives have a bounded size, so the records of one file fit a task. Ranges start anew every ``most`` bytes or so.
    """
    end = F.col("offset") + F.col("length")
    by_place = Window.partitionBy("path").orderBy("offset")
    earlier = F.lag(end).over(by_place)
    fresh = earlier.isNull() | (F.col("offset") - earlier > gap) | (F.floor(F.col("offset") / most) != F.floor(F.lag("offset").over(by_place) / most))
    marked = index.select("path", "offset", "length", fresh.cast("int").alias("fresh"))
    ranged = marked.withColumn("range", F.sum("fresh").over(by_place))
    return ranged.groupBy("path", "range").agg(
        F.min("offset").alias("start"), F.max(end).alias("end"), F.collect_list(F.struct("offset", "length")).alias("members")
    ).drop("range")


def _read(payloads: bool):
    names = [c.split()[0] for c in RECORD.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                files, place = fs.FileSystem.from_uri(r["path"])
                with files.open_input_file(place) as stream:
                    raw = stream.read_at(r["end"] - r["start"], r["start"])
                found = [parse_record(raw[m["offset"] - r["start"] :][: m["length"]]) for m in r["members"]]
                if not payloads:
                    found = [f | {"payload": None} for f in found]
                yield pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], k) for n, k in zip(names, kinds)], names)

    return run


def read_records(index: DataFrame, payloads: bool = True, gap: int = GAP_BYTES, most: int = RANGE_BYTES) -> DataFrame:
    """The records that the rows of ``index`` point to, read by coalesced ranges and checked against their digests."""
    return coalesced_ranges(index, gap, most).mapInArrow(_read(payloads), RECORD)
