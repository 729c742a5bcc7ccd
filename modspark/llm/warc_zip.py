"""Web archives: WARC records in ZIP packages, written and read back by range.

A package is a ZIP file with two stored members: ``archive/data.warc.gz``, one gzip member
per record, and ``indexes/index.cdxj``, one line per record with its place in the archive.
The reader takes the end of the file, follows the central directory (ZIP64 too) to the
members, reads the index, and then reads every record by its own range; nothing is
unpacked. Packages lie in the folder that executors share and are opened through the file
system its address names; only packages named in the written manifest are read, so what a
lost executor left half written is never seen.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modspark.llm.store import saved, shared_folder

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class WarcPackages:
    """Smallest payload that may be a revisit, size at which a package is closed, the records' date."""

    least_bytes: int = 1000
    package_bytes: int = 32 << 20
    date: str = "2000-01-01T00:00:00Z"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def header_value(value: str) -> str:
    """A value fit for one header line."""
    return "".join(c if " " < c else f"%{ord(c):02X}" for c in value)


def record(page_id, url, payload: bytes | None, size: int, digest: str, refers_to, date: str) -> bytes:
    """One gzip member: a response with its payload, or a revisit without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"") if refers_to is None else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"Content-Type: application/http; msgtype=response; payload-bytes={size}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {header_value(url)}")
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def package(members: list[bytes]) -> bytes:
    """The ZIP file of these records."""
    lines, at = [], 0
    for number, member in enumerate(members):
        lines.append(f"record/{number:09d} {json.dumps({'offset': at, 'length': len(member), 'filename': DATA})}\n")
        at += len(member)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as zipped:
        for name, parts in ((DATA, members), (INDEX, [x.encode() for x in lines])):
            entry = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
            with zipped.open(entry, "w", force_zip64=True) as target:
                for part in parts:
                    target.write(part)
    return out.getvalue()


class BrokenPackage(ValueError):
    """The file is not a readable package."""


class RangeZip:
    """Members of a ZIP file through reads of ranges: ``read(offset, n)`` and the size are all it needs."""

    def __init__(self, read, size: int):
        self.read = read
        tail = read(max(0, size - 65_557), min(size, 65_557))
        end = tail.rfind(b"PK\x05\x06")
        while end >= 0 and end + 22 + int.from_bytes(tail[end + 20 : end + 22], "little") != len(tail):
            end = tail.rfind(b"PK\x05\x06", 0, end)
        if end < 0:
            raise BrokenPackage("no end of central directory")
        count, length, start = struct.unpack("<H2L", tail[end + 10 : end + 20])
        if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
            place = max(0, size - 65_557) + end - 20
            locator = read(place, 20)
            if locator[:4] != b"PK\x06\x07":
                raise BrokenPackage("no ZIP64 locator")
            wide = read(struct.unpack("<Q", locator[8:16])[0], 56)
            if wide[:4] != b"PK\x06\x06":
                raise BrokenPackage("no ZIP64 end of central directory")
            count, length, start = struct.unpack("<3Q", wide[32:56])
        self.members = dict(self._directory(read(start, length), count))

    def _directory(self, raw: bytes, count: int) -> Iterator[tuple[str, tuple[int, int]]]:
        at = 0
        for _ in range(count):
            if raw[at : at + 4] != b"PK\x01\x02":
                raise BrokenPackage("broken central directory")
            method, packed, size = struct.unpack("<H8x2L", raw[at + 10 : at + 12] + raw[at + 12 : at + 28])
            n_name, n_extra, n_comment = struct.unpack("<3H", raw[at + 28 : at + 34])
            offset = struct.unpack("<L", raw[at + 42 : at + 46])[0]
            name = raw[at + 46 : at + 46 + n_name].decode()
            extra = raw[at + 46 + n_name : at + 46 + n_name + n_extra]
            size, packed, offset = self._wide(extra, size, packed, offset)
            if method != 0 or size != packed:
                raise BrokenPackage(f"{name} is not stored")
            yield name, (offset, size)
            at += 46 + n_name + n_extra + n_comment

    @staticmethod
    def _wide(extra: bytes, *fields: int) -> list[int]:
        """Fields that do not fit 32 bits stand in the ZIP64 extra field, in this order."""
        out, at = list(fields), 0
        while at + 4 <= len(extra):
            kind, n = struct.unpack("<2H", extra[at : at + 4])
            if kind == 1:
                place = at + 4
                for i, value in enumerate(out):
                    if value == 0xFFFFFFFF:
                        out[i] = struct.unpack("<Q", extra[place : place + 8])[0]
                        place += 8
            at += 4 + n
        return out

    def start(self, name: str) -> tuple[int, int]:
        """(offset, size) of a member's bytes; its local header says where they begin."""
        if name not in self.members:
            raise BrokenPackage(f"no member {name}")
        offset, size = self.members[name]
        head = self.read(offset, 30)
        if head[:4] != b"PK\x03\x04":
            raise BrokenPackage("broken local header")
        n_name, n_extra = struct.unpack("<2H", head[26:30])
        return offset + 30 + n_name + n_extra, size


def parsed(raw: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload) of one record.

    The digest of a response is taken from its payload and must agree with the header.
    """
    plain = zlib.decompress(raw, 31)
    head, _, block = plain.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise BrokenPackage("no WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = block[: int(fields["content-length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    size = int(fields["content-type"].rpartition("payload-bytes=")[2])
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise BrokenPackage("payload and digest differ")
    number = lambda key: int(fields[key]) if key in fields else None
    return number("x-page-id"), size, digest, kind, number("x-refers-to-page-id"), payload if kind == "response" else None


def planned(pages: DataFrame, settings: WarcPackages) -> DataFrame:
    """page_id, url, payload, size, digest, refers_to: revisits carry no payload.

    Only ids and digests are grouped; a payload that a third of all pages share is one row
    there. Pages meet their group by digest in a join that adaptive execution can split.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("size"), F.sha1("payload").alias("digest")
    )
    large = F.col("size") >= settings.least_bytes
    groups = (
        rows.filter(large)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("latest"), F.count("*").alias("copies"))
        .filter("copies > 1 and latest is not null")
        .select(F.col("digest").alias("_digest"), "latest")
    )
    met = rows.join(groups, large & (F.col("digest") == F.col("_digest")), "left")
    refers_to = F.when(F.coalesce(F.col("page_id") != F.col("latest"), F.col("latest").isNotNull()), F.col("latest"))
    return met.select("page_id", "url", "size", "digest", refers_to.alias("refers_to"), "payload").withColumn(
        "payload", F.when(F.col("refers_to").isNull(), F.col("payload"))
    )


def written(pages: DataFrame, settings: WarcPackages = WarcPackages()) -> DataFrame:
    """path, records of the packages written for pages(page_id, url, html): the manifest."""
    folder = shared_folder(pages.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, size = [], 0
        for batch in batches:
            for row in zip(*(c for c in batch.columns), strict=True):
                page_id, url, n, digest, refers_to, payload = (x.as_py() for x in row)
                members.append(record(page_id, url, payload, n, digest, refers_to, settings.date))
                size += len(members[-1])
                if size >= settings.package_bytes:
                    yield close(members)
                    members, size = [], 0
        if members:
            yield close(members)

    def close(members: list[bytes]) -> pa.RecordBatch:
        system, path = fs.FileSystem.from_uri(f"{folder}/{uuid.uuid4().hex}.wacz")
        system.create_dir(path.rpartition("/")[0], recursive=True)
        with system.open_output_stream(path) as out:
            out.write(package(members))
        name = f"{folder}/{path.rpartition('/')[2]}"
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(members)], pa.int64())], names=["path", "records"])

    return saved(planned(pages, settings).mapInArrow(write, "path string, records long"))


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_records(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the packages named in manifest(path), read range by range."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in RECORD.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = fs.FileSystem.from_uri(path)
                with system.open_input_file(place) as file:
                    yield from records(RangeZip(lambda at, n, f=file: f.read_at(n, at), file.size()))

    def records(zipped: RangeZip) -> Iterator[pa.RecordBatch]:
        start, _ = zipped.start(DATA)
        index = zipped.read(*zipped.start(INDEX)).decode()
        rows, size = [], 0
        for line in index.splitlines():
            place = json.loads(line.partition(" ")[2])
            row = parsed(zipped.read(start + place["offset"], place["length"]))
            rows.append(row if payloads else (*row[:-1], None))
            size += row[1]
            if size > 8 << 20:
                yield batch_of(rows)
                rows, size = [], 0
        if rows:
            yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    packages = manifest.select("path")
    # a path is a tiny row for much work: as many tasks as packages, whatever its bytes
    spread = packages.repartition(max(1, packages.count()))
    return spread.mapInArrow(read, RECORD)


def round_trip(pages: DataFrame, settings: WarcPackages = WarcPackages()) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every row of pages.

    A null page is an empty payload. Of equal payloads of at least ``least_bytes`` bytes the
    one with the largest page_id is the response and the others revisit it; rows that share
    that page_id and payload are all responses, and a null page_id always revisits. Groups
    without any page_id are all responses. Other columns are ignored; no rows give no rows.
    """
    return read_records(written(pages, settings), payloads=False).drop("payload")


SQL = """
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), met AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload) AS latest FROM sized
), told AS (
  SELECT *, payload_bytes >= 1000 AND latest IS NOT NULL AND page_id IS DISTINCT FROM latest AS again FROM met
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN latest END AS refers_to
FROM told
"""
