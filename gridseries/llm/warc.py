"""WARC records in ZIP packages: a writer, and a reader that never unpacks.

A package is a ZIP file whose members are stored: ``archive/data.warc.gz`` (one gzip
member for each record), ``indexes/index.cdxj`` (a line for each record with its
offset and length) and ``datapackage.json``. The reader parses the central
directory, ZIP64 or not, finds the stored members and their indexes, and reads
single records by byte range.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridseries.llm.common import scratch_path, staged

DATA, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
#: Signatures and record layouts of the ZIP format.
END_SIGNATURE, END64_SIGNATURE, LOCATOR_SIGNATURE, ENTRY_SIGNATURE, LOCAL_SIGNATURE = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
END, END64, LOCATOR = struct.Struct("<4s4H2LH"), struct.Struct("<4sQ2H2L4Q"), struct.Struct("<4sLQL")
ENTRY, LOCAL = struct.Struct("<4s6H3L5H2L"), struct.Struct("<4s5H3L2H")
#: Fixed value: the profile of a revisit whose payload equals an earlier one.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PACKAGE_BYTES = 128 << 20
RECORDS_PER_TASK = 5_000
PACKAGES_PER_TASK = 4
WARC_DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- ZIP directory ------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int  # offset of the local header


def read_at(f, start: int, size: int) -> bytes:
    f.seek(start)
    data = f.read(size)
    if len(data) != size:
        raise EOFError(f"{size} bytes wanted at {start}, {len(data)} there")
    return data


def zip_members(f, length: int) -> list[Member]:
    """Entries of the central directory of a ZIP file of ``length`` bytes."""
    tail_at = max(0, length - END.size - 0xFFFF)
    tail = read_at(f, tail_at, length - tail_at)
    at = tail.rfind(END_SIGNATURE, 0, max(0, len(tail) - END.size + len(END_SIGNATURE)))
    while at >= 0 and at + END.size + END.unpack_from(tail, at)[7] != len(tail):  # a comment may hold the signature
        at = tail.rfind(END_SIGNATURE, 0, at)
    if at < 0:
        raise ValueError("no end of a central directory: not a ZIP file, or cut short")
    _, _, _, _, count, size, start, _ = END.unpack_from(tail, at)
    if 0xFFFF == count or 0xFFFFFFFF in (size, start):
        where = LOCATOR.unpack(read_at(f, tail_at + at - LOCATOR.size, LOCATOR.size))
        if where[0] != LOCATOR_SIGNATURE:
            raise ValueError("the ZIP64 locator is missing")
        end64 = END64.unpack(read_at(f, where[2], END64.size))
        if end64[0] != END64_SIGNATURE:
            raise ValueError("the ZIP64 end record is missing")
        count, size, start = end64[7:]
    directory, at, out = read_at(f, start, size), 0, []
    for _ in range(count):
        entry = ENTRY.unpack_from(directory, at)
        if entry[0] != ENTRY_SIGNATURE:
            raise ValueError("broken central directory")
        flags, method, packed, full, name_len, extra_len, comment_len, header = entry[3], entry[4], entry[8], entry[9], entry[10], entry[11], entry[12], entry[16]
        at += ENTRY.size
        name = directory[at : at + name_len].decode("utf-8" if flags & 0x800 else "cp437")
        packed, header = _zip64(directory[at + name_len : at + name_len + extra_len], full, packed, header)
        at += name_len + extra_len + comment_len
        out.append(Member(name, method, packed, header))
    return out


def _zip64(extra: bytes, full: int, packed: int, header: int) -> tuple[int, int]:
    """Stored size and header offset; the ZIP64 field holds, in this order, just those that overflow."""
    at = 0
    while at + 4 <= len(extra):
        tag, size = struct.unpack_from("<2H", extra, at)
        if tag == 1:
            values = list(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            if full == 0xFFFFFFFF:
                values.pop(0)
            if packed == 0xFFFFFFFF:
                packed = values.pop(0)
            if header == 0xFFFFFFFF:
                header = values.pop(0)
        at += 4 + size
    return packed, header


def stored_start(f, member: Member) -> int:
    """Offset of a stored member's first byte; its local header has lengths of its own for name and extra field."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed: its records have no byte ranges")
    header = LOCAL.unpack(read_at(f, member.header, LOCAL.size))
    if header[0] != LOCAL_SIGNATURE:
        raise ValueError("broken local header")
    return member.header + LOCAL.size + header[9] + header[10]


# --- records ------------------------------------------------------------------------------


def warc_record(page: str, url: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One response, or a revisit of the response of page ``refers_to``, which keeps the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{page}>",
        "WARC-Target-URI": url.replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Date": WARC_DATE,
        "WARC-Payload-Digest": f"sha1:{digest}",
    }
    if refers_to is not None:
        head |= {"WARC-Refers-To": f"<urn:page:{refers_to}>", "WARC-Profile": PROFILE}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in raw.decode("utf-8", "replace").split("\r\n")[1:])}


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, payload) of one record."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1.") or not found:
        raise ValueError("not a WARC record")
    headers = _headers(head)
    length = int(headers["content-length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    return headers, _headers(http), payload


# --- packages -----------------------------------------------------------------------------


class PackageWriter:
    """Writes one package as a stream: records go out as they come, their index at the end."""

    def __init__(self, filesystem: fs.FileSystem, path: str):
        self.sink = filesystem.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.index: list[str] = []
        self.size = 0

    def add(self, page: str, url: str, record: bytes) -> None:
        packed = gzip.compress(record, 6, mtime=0)
        self.data.write(packed)
        self.index.append(f"{page} {json.dumps({'url': url, 'offset': self.size, 'length': len(packed), 'filename': DATA})}")
        self.size += len(packed)

    def close(self) -> None:
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.index) + "\n")
        described = {"profile": "data-package", "resources": [{"path": p} for p in (DATA, INDEX)], "records": len(self.index)}
        self.zip.writestr(zipfile.ZipInfo(PACKAGE), json.dumps(described))
        self.zip.close()
        self.sink.close()


def index_entries(f, length: int) -> Iterator[tuple[str, int, int]]:
    """(page, absolute offset, length) of every record that a package's indexes list."""
    members = {m.name: m for m in zip_members(f, length)}
    for name, member in members.items():
        if not (name.startswith("indexes/") and name.endswith(".cdxj")):
            continue
        lines = read_at(f, stored_start(f, member), member.size).decode().split("\n")
        starts: dict[str, int] = {}
        for line in filter(None, lines):
            page, _, rest = line.partition(" ")
            entry = json.loads(rest)
            data = entry["filename"]
            if data not in starts:
                starts[data] = stored_start(f, members[data])
            if entry["offset"] + entry["length"] > members[data].size:
                raise ValueError("an index entry reaches beyond its archive")
            yield page, starts[data] + entry["offset"], entry["length"]


def _filesystem(root: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder's URI (local, hdfs, s3, ... as pyarrow knows them)."""
    return fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")


def plan_records(pages: DataFrame, page: str, html: str, least_bytes: int = 0) -> DataFrame:
    """Every row with its payload's digest and what it refers to (null: it is a response).

    Of the records with one payload of at least ``least_bytes``, that with the
    largest page id responds. Digests are grouped before anything is joined, so
    a payload that many pages share is one row, and the join's hot key is split by
    adaptive execution. Rows without a page id are written as responses
    of their own; a repeated page id counts once.
    """
    rows = pages.withColumn("payload_sha1", F.sha1(F.coalesce(F.col(html), F.lit("")).cast("binary")))
    large = F.octet_length(F.coalesce(F.col(html), F.lit(""))) >= least_bytes
    last = rows.where(large & F.col(page).isNotNull()).groupBy("payload_sha1").agg(F.max(page).alias("responds"))
    out = rows.join(last, "payload_sha1", "left")
    return out.withColumn("refers_to", F.when(large & (F.col("responds") != F.col(page)), F.col("responds"))).drop("responds")


def write_packages(pages: DataFrame, page: str, url: str, html: str, root: str, least_bytes: int = 0) -> DataFrame:
    """Write a record for every row into packages below ``root``; returns the staged list (path, size, records).

    Each task writes files under names of its own try and reports them with its
    result: what a lost executor or a repeated task left behind is never listed, so never read.
    """
    planned = plan_records(pages.select(F.col(page).alias("page"), F.col(url).alias("url"), F.col(html).alias("html")), "page", "html", least_bytes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, folder = _filesystem(root)
        filesystem.create_dir(folder, recursive=True)
        package, path, listed = None, "", []

        def close() -> None:
            package.close()
            listed.append((path, filesystem.get_file_info(path).size, len(package.index)))

        for batch in batches:
            for id_, where, text, sha1, refers_to in zip(*batch.columns, strict=True):
                if package is None:
                    path = f"{folder}/{uuid.uuid4().hex}.wacz"
                    package = PackageWriter(filesystem, path)
                name, target, refers = ("" if x.as_py() is None else str(x.as_py()) for x in (id_, where, refers_to))
                digest = base64.b32encode(bytes.fromhex(sha1.as_py())).decode()
                payload = (text.as_py() or "").encode()
                package.add(name, target, warc_record(name, target, payload, digest, refers if refers_to.is_valid else None))
                if package.size >= PACKAGE_BYTES:
                    close()
                    package = None
        if package is not None:
            close()
        columns = list(zip(*listed, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["path", "size", "records"])

    files = planned.select("page", "url", "html", "payload_sha1", "refers_to").mapInArrow(write, "path string, size long, records long")
    return staged(files, "warc-files")


def read_packages(files: DataFrame, root: str, records_per_task: int = RECORDS_PER_TASK) -> DataFrame:
    """(page, payload_bytes, payload_digest, record_type, refers_to, target_uri) of every record in the listed packages.

    First the directories and indexes are read, a package at a time; the byte
    ranges are then dealt evenly to tasks, whatever package they are in, and each
    task reads its ranges in file order. A response's digest is computed from the
    bytes read and must equal its header's. A revisit's size is that in the
    HTTP header it kept.
    """

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, _ = _filesystem(root)
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with filesystem.open_input_file(path) as f:
                    found = list(index_entries(f, size))
                for i in range(0, len(found), 10_000):
                    part = found[i : i + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(part)), pa.array([e[1] for e in part]), pa.array([e[2] for e in part])], names=["path", "start", "length"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, _ = _filesystem(root)
        f, opened = None, None
        for batch in batches:
            rows = []
            for path, start, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path != opened:
                    if f is not None:
                        f.close()
                    f, opened = filesystem.open_input_file(path), path
                headers, http, payload = parse_record(gzip.decompress(read_at(f, start, length)))
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                size = int(http["content-length"])
                if headers["warc-type"] == "response" and (payload_digest(payload) != digest or len(payload) != size):
                    raise ValueError(f"the record at {start} of {path} is damaged")
                id_, refers = (headers.get(k, "").removeprefix("<urn:page:").removesuffix(">") or None for k in ("warc-record-id", "warc-refers-to"))
                rows.append((id_, size, digest, headers["warc-type"], refers, headers["warc-target-uri"]))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
        if f is not None:
            f.close()

    names = ["page", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri"]
    listed = files.select("path", "size")
    listed = listed.repartition(max(1, -(-listed.count() // PACKAGES_PER_TASK)))
    ranges = staged(listed.mapInArrow(entries, "path string, start long, length long"), "warc-ranges")
    tasks = max(1, -(-ranges.count() // records_per_task))
    ranges = ranges.repartition(tasks).sortWithinPartitions("path", "start")
    return ranges.mapInArrow(read, "page string, payload_bytes long, payload_digest string, record_type string, refers_to string, target_uri string")


def archive_round_trip(pages: DataFrame, page: str, url: str, html: str) -> DataFrame:
    """Write every row as a WARC record below the shared folder, then read all records back.

    A null payload or URL counts as empty, a null page id comes back null; an
    empty table writes no record. Other columns are not read.
    """
    root = scratch_path(pages.sparkSession, "warc")
    kind = pages.schema[page].dataType
    out = read_packages(write_packages(pages, page, url, html, root), root)
    return out.select(F.col("page").cast(kind).alias(page), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
