"""WARC packages: exact round trip, ZIP64, damaged files."""

import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from gridseries.llm import warc
from gridseries.llm.common import scratch_path


def expected(rows):
    last = {}
    for page, _, html in rows:
        if page is not None:
            last[html or ""] = max(page, last.get(html or "", page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        refers = last.get(html or "") if page is not None and last[html or ""] != page else None
        out.append((page, len(raw), warc.payload_digest(raw), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


ROWS = [(1, "http://a/", "x"), (2, None, "x"), (3, "http://b/\r\nX: y", "x\r\n\r\ny"), (4, "u", None), (5, "u", ""), (6, "u", "é" * 50000), (7, "ü", "é" * 50000), (None, "u", "x"), (8, "u", "z"), (8, "u", "z")]


def test_every_record_comes_back(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("payload_sha1", F.lit("clash")).withColumn("responds", F.lit(1))
    out = sorted((tuple(r) for r in warc.archive_round_trip(df, "page_id", "url", "html").collect()), key=str)
    assert out == expected(ROWS)
    assert warc.archive_round_trip(df.limit(0), "page_id", "url", "html").count() == 0


def test_pages_round_trip(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    pages = pages.union(pages.selectExpr("page_id + 1000", "url", "html"))
    out = sorted((tuple(r) for r in warc.archive_round_trip(pages, "page_id", "url", "html").collect()), key=str)
    assert out == expected([(r.page_id, r.url, r.html) for r in pages.collect()])


def test_many_packages_and_few_records_a_task(spark, monkeypatch):
    monkeypatch.setattr(warc, "PACKAGE_BYTES", 2000)
    df = spark.createDataFrame([(i, f"http://h/{i}", f"page {i % 40}") for i in range(100)], "page_id long, url string, html string")
    root = scratch_path(spark, "warc-test")
    files = warc.write_packages(df, "page_id", "url", "html", root)
    assert files.count() > 4 and files.agg(F.sum("records")).first()[0] == 100
    out = warc.read_packages(files, root, records_per_task=7)
    assert out.select("page").distinct().count() == 100
    assert sorted(r.target_uri for r in out.collect()) == sorted(f"http://h/{i}" for i in range(100))


def test_small_payloads_can_all_be_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    root = scratch_path(spark, "warc-test")
    out = warc.read_packages(warc.write_packages(df, "page_id", "url", "html", root, least_bytes=4), root).collect()
    assert {r.page: (r.record_type, r.refers_to) for r in out} == {"1": ("response", None), "2": ("response", None), "3": ("revisit", "4"), "4": ("response", None)}


def plain_zip(zip64: bool) -> bytes:
    """Two stored members; with ``zip64`` all sizes and counts only in ZIP64 fields."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("a.txt", b"hello")
        z.writestr("b/é.txt", b"world!")
    raw = buffer.getvalue()
    if not zip64:
        return raw
    at = raw.rfind(b"PK\x05\x06")
    _, _, _, _, n, _, start, _ = warc.END.unpack_from(raw, at)
    directory = b""
    pos = start
    for _ in range(n):
        entry = list(warc.ENTRY.unpack_from(raw, pos))
        name = raw[pos + warc.ENTRY.size : pos + warc.ENTRY.size + entry[10]]
        extra = struct.pack("<2H3Q", 1, 24, entry[9], entry[8], entry[16])
        entry[8] = entry[9] = entry[16] = 0xFFFFFFFF
        entry[11] = len(extra)
        directory += warc.ENTRY.pack(*entry) + name + extra
        pos += warc.ENTRY.size + len(name)
    end64 = warc.END64.pack(b"PK\x06\x06", 44, 45, 45, 0, 0, n, n, len(directory), start)
    locator = warc.LOCATOR.pack(b"PK\x06\x07", 0, start + len(directory), 1)
    end = warc.END.pack(b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    return raw[:start] + directory + end64 + locator + end


@pytest.mark.parametrize("zip64", [False, True])
def test_directories_with_and_without_zip64(zip64):
    raw = plain_zip(zip64)
    f = io.BytesIO(raw)
    members = {m.name: m for m in warc.zip_members(f, len(raw))}
    assert sorted(members) == ["a.txt", "b/é.txt"]
    for name, want in (("a.txt", b"hello"), ("b/é.txt", b"world!")):
        assert warc.read_at(f, warc.stored_start(f, members[name]), members[name].size) == want


def test_damage_is_an_error():
    raw = plain_zip(False)
    with pytest.raises(ValueError):
        warc.zip_members(io.BytesIO(raw[:-10]), len(raw) - 10)
    with pytest.raises(ValueError):
        warc.zip_members(io.BytesIO(b""), 0)
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"x" * 1000)
    raw = packed.getvalue()
    f = io.BytesIO(raw)
    with pytest.raises(ValueError):
        warc.stored_start(f, warc.zip_members(f, len(raw))[0])
    with pytest.raises(ValueError):
        warc.parse_record(b"not a record")
    with pytest.raises(ValueError):
        warc.parse_record(warc.warc_record("1", "u", b"abc", "D", None)[:-6])
    with pytest.raises(EOFError):
        warc.read_at(io.BytesIO(b"abc"), 1, 5)
