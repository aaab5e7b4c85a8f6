"""Archives round trip; the ZIP reader against the standard library's writer."""

import hashlib
import io
import zipfile
from collections import Counter

import duckdb
import pytest
from compare import compare, duck_connect

from tripwise.llm import warc
from tripwise.llm.queries import ORACLE
from tripwise.llm.zip_files import ZipReader, zip_of

LONG = "<p>same</p>" * 20
EDGE = [(5, "http://a", LONG), (3, None, LONG), (9, "http://b c\r\nX: y", LONG), (None, "u", LONG), (3, "http://twice", LONG), (7, "u", None),
        (8, "u", ""), (1, "u", "short"), (2, "u", "short"), (4, "ü", "é" * 60_000 + "\r\n\r\nWARC/1.1\r\n"), (None, None, "x" * 200), (None, None, "x" * 200)]


def expected(rows):
    firsts = {}
    for page, _, html in rows:
        if page is not None:
            firsts[html or ""] = min(page, firsts.get(html or "", page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        first = firsts.get(html or "") if len(raw) >= 100 else page
        revisit = first is not None and first != page
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return Counter(out)


def test_edge_rows(spark):
    pages = spark.createDataFrame([(*r, 1) for r in EDGE], "page_id long, url string, html string, payload int")
    assert Counter(map(tuple, warc.archived(pages).collect())) == expected(EDGE)
    assert warc.archived(pages.limit(0)).collect() == []


def test_oracle(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    ok, why = compare(warc.archived(pages), ORACLE["op10_warc_packages"], duck_connect(sf_dir))
    assert ok, why
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", EDGE)
    ok, why = compare(warc.archived(spark.createDataFrame(EDGE, "page_id long, url string, html string")), ORACLE["op10_warc_packages"], con)
    assert ok, why


def test_small_packages(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<html>{i % 40}</html>" * 10) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write_archives(pages, str(tmp_path), archive_bytes=2000).collect()
    assert len(manifest) > 10 and sum(m.records for m in manifest) == 300
    frame = spark.createDataFrame(manifest, "file string, bytes long, records long")
    assert Counter(map(tuple, warc.read_archives(frame, str(tmp_path)).collect())) == expected(rows)


def records():
    return [(i, f"http://x/{i}", b"payload %d" % i, hashlib.sha256(b"payload %d" % i).hexdigest(), None) for i in range(20)]


@pytest.mark.parametrize("zip64", [False, True])
def test_standard_library_reads_packages(zip64):
    raw = b"".join(warc.package(records(), zip64))
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert z.testzip() is None and len(z.namelist()) == 3
    got = [warc.row_of(*r)[0] for r in warc.read_package(io.BytesIO(raw), len(raw))]
    assert got == list(range(20))


@pytest.mark.parametrize("before,comment", [(b"", b""), (b"#!/bin/sh\n" * 9, b"note PK\x05\x06 in it"), (b"", b"x" * 65_535)])
def test_reads_other_writers(before, comment):
    out = io.BytesIO()
    out.write(before)
    with zipfile.ZipFile(out, "a" if before else "w") as z:
        z.writestr("indexes/notes.txt", "deflated " * 99, zipfile.ZIP_DEFLATED)
        with z.open(zipfile.ZipInfo("archive/big.warc"), "w", force_zip64=True) as f:
            f.write(b"".join(warc.record(*r) for r in records()))
        z.comment = comment
    raw = out.getvalue()
    zipped = ZipReader(io.BytesIO(raw), len(raw))
    assert zipped.whole("indexes/notes.txt") == b"deflated " * 99
    assert zipped.range("archive/big.warc", 0, 8) == b"WARC/1.1"
    # No index: the archive is scanned, also in steps smaller than a record.
    assert [warc.row_of(*r)[0] for r in warc.scan(zipped, "archive/big.warc", 7)] == list(range(20))
    with pytest.raises(ValueError):
        zipped.range("indexes/notes.txt", 0, 1)


def test_gzip_archive_without_index():
    whole = b"".join(warc.package(records()))
    data = ZipReader(io.BytesIO(whole), len(whole)).whole("archive/data.warc.gz")
    raw = b"".join(zip_of([("archive/data.warc.gz", data)]))
    for step in (13, 1 << 20):
        zipped = ZipReader(io.BytesIO(raw), len(raw))
        assert [warc.row_of(*r)[0] for r in warc.scan(zipped, "archive/data.warc.gz", step)] == list(range(20))


def test_damage_is_an_error():
    raw = b"".join(warc.package(records()))
    for broken in (raw[:-5], b"", raw[:len(raw) // 2]):
        with pytest.raises(ValueError):
            ZipReader(io.BytesIO(broken), len(broken))
    fields, block, _ = warc.parse(warc.record(1, "u", b"abc", "0" * 64, None))
    with pytest.raises(ValueError):
        warc.row_of(fields, block)
