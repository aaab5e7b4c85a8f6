"""Web archives: WARC records in ZIP packages, written and read by Spark.

A package holds gzip members of WARC records (``archive/*.warc.gz``, stored),
a CDXJ index of their offsets (``indexes/index.cdxj``) and a listing.  Reading
opens the central directory, takes the record offsets from the index and reads
byte ranges of the stored archive; nothing is extracted, and an archive
without an index is scanned record by record.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwise.session import scratch_path

from . import common
from .zip_files import ZipReader, zip_of

MANIFEST = "file string, bytes long, records long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str = "2020-01-01T00:00:00Z") -> bytes:
    """One WARC record; a revisit (``refers_to`` given) leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    fields = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name_of(page_id)}",
              f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    if url is not None:
        fields.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url))
    if refers_to is not None:
        fields += [f"WARC-Refers-To: {name_of(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def name_of(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(name: str | None):
    digits = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(digits[1]) if digits else None


def parse(raw: bytes) -> tuple[dict, bytes, int]:
    """(fields, block, length) of the WARC record at the start of ``raw``."""
    end = raw.find(b"\r\n\r\n")
    if not raw.startswith(b"WARC/") or end < 0:
        raise ValueError("no WARC record here")
    fields = dict(line.split(": ", 1) for line in raw[:end].decode("utf-8").split("\r\n")[1:])
    length = int(fields["Content-Length"])
    block = raw[end + 4:end + 4 + length]
    if len(block) != length:
        raise ValueError("the WARC record is cut off")
    return fields, block, end + 4 + length + 4


def row_of(fields: dict, block: bytes) -> tuple:
    """page_id, payload_bytes, payload_digest, record_type, refers_to; a
    response's payload is checked against its digest."""
    stated = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    page, kind = page_of(fields.get("WARC-Record-ID")), fields["WARC-Type"]
    if kind == "revisit":
        return page, int(fields["WARC-Payload-Length"]), stated, kind, page_of(fields.get("WARC-Refers-To"))
    payload = block[block.index(b"\r\n\r\n") + 4:]
    digest = hashlib.sha256(payload).hexdigest()
    if digest != stated:
        raise ValueError(f"page {page}: the payload does not match its digest")
    return page, len(payload), digest, kind, None


def package(records: list[tuple], zip64: bool = False):
    """Byte chunks of a package of (page_id, url, payload, digest, refers_to)."""
    members, lines, at = [], [], 0
    for page_id, url, payload, digest, refers_to in records:
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        data = pack.compress(record(page_id, url, payload, digest, refers_to)) + pack.flush()
        entry = {"url": url, "digest": f"sha256:{digest}", "filename": "data.warc.gz", "offset": at, "length": len(data)}
        lines.append(f"{re.sub(r'[\s]', '%20', url or '-')} 20200101000000 {json.dumps(entry)}")
        members.append(data)
        at += len(data)
    listing = json.dumps({"profile": "data-package", "resources": [{"path": "archive/data.warc.gz", "bytes": at}]})
    return zip_of([("archive/data.warc.gz", b"".join(members)), ("indexes/index.cdxj", ("\n".join(sorted(lines)) + "\n").encode()),
                   ("datapackage.json", listing.encode())], zip64)


def read_package(file, size: int):
    """(fields, block) of every record of a package."""
    zipped = ZipReader(file, size)
    indexed = set()
    for index in sorted(n for n in zipped.members if n.startswith("indexes/") and n.endswith((".cdxj", ".cdx"))):
        entries = [json.loads(line.split(" ", 2)[2]) for line in zipped.whole(index).decode().splitlines() if line]
        for e in sorted(entries, key=lambda e: (e["filename"], int(e["offset"]))):
            name = f"archive/{e['filename']}"
            indexed.add(name)
            raw = zipped.range(name, int(e["offset"]), int(e["length"]))
            yield parse(zlib.decompress(raw, 47) if raw[:2] == b"\x1f\x8b" else raw)[:2]
    for name in sorted(n for n in zipped.members if n.startswith("archive/") and n not in indexed):
        yield from scan(zipped, name)


def scan(zipped: ZipReader, name: str, step: int = 1 << 20):
    """(fields, block) of a stored archive without an index, read in steps."""
    size, at, held, text = zipped.members[name]["size"], 0, b"", b""
    gz = zipped.range(name, 0, min(2, size)) == b"\x1f\x8b"
    inflate = zlib.decompressobj(47) if gz else None
    while True:
        # Whole records first, then more of the member.
        while text:
            try:
                fields, block, n = parse(text)
            except ValueError:
                break
            if len(text) < n:
                break
            yield fields, block
            text = text[n:]
        if not held and at < size:
            held = zipped.range(name, at, min(step, size - at))
            at += len(held)
        if not held:
            if text:
                raise ValueError(f"{name} ends within a record")
            return
        if gz:
            text += inflate.decompress(held)
            held = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(47)
        else:
            text, held = text + held, b""


# ---- Spark ----------------------------------------------------------------

def with_revisits(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """page_id, url, payload, payload_digest, refers_to.  Of equal payloads of
    at least ``least_bytes`` the smallest page_id is the response the others
    refer to; smaller ones all stand for themselves.  Rows that repeat the
    smallest id are responses too; a null id comes last and is never referred
    to (if all ids of a payload are null, all are responses)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("payload_digest"))
    firsts = (rows.filter(F.octet_length("payload") >= least_bytes).groupBy("payload_digest")
              .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    refers = F.when(~F.col("first_id").eqNullSafe(F.col("page_id")), F.col("first_id"))
    return rows.join(firsts, "payload_digest", "left").withColumn("refers_to", refers).drop("first_id")


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = 32 << 20) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html; a null html is
    an empty payload, other columns are ignored) into packages of about
    ``archive_bytes`` of payload each; returns file, bytes, records."""
    common.bounded_batches(pages.sparkSession)
    columns = ["page_id", "url", "payload", "payload_digest", "refers_to"]

    def write(batches):
        schema = pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])
        part, files, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            nonlocal files, held, size
            name = f"part-{part:06d}-{files:06d}.wacz"
            written = common.write_file(f"{folder}/{name}", package(held))
            out = pa.RecordBatch.from_pylist([{"file": name, "bytes": written, "records": len(held)}], schema)
            files, held, size = files + 1, [], 0
            return out

        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(batch.column(c).to_pylist() for c in columns)):
                payload = payload.encode("utf-8", "surrogatepass")
                held.append((page_id, url, payload, digest, refers_to))
                size += len(payload)
                if size >= archive_bytes:
                    yield flush()
        if held:
            yield flush()

    return with_revisits(pages).select(*columns).mapInArrow(write, MANIFEST)


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record of the packages that ``manifest`` (file) names."""
    def read(batches):
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            for name in batch.column("file").to_pylist():
                fs, path = common.file_system(f"{folder}/{name}")
                with fs.open_input_file(path) as file:
                    rows = []
                    for fields, block in read_package(file, file.size()):
                        rows.append(row_of(fields, block))
                        if len(rows) == 5000:
                            yield _rows(rows, schema)
                            rows = []
                    if rows:
                        yield _rows(rows, schema)

    n = common.shuffle_partitions(manifest.sparkSession)
    return manifest.select("file").repartition(n).mapInArrow(read, RECORDS)


def _rows(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def archived(pages: DataFrame) -> DataFrame:
    """Write the archives into the shared folder and read them back, a row
    for every page.  A null html is empty; payloads are taken whole; of equal
    payloads the smallest page_id is the response, null ids come last; repeated
    rows are a record each; other columns are not looked at; an empty table
    gives no rows."""
    folder = f"{scratch_path(pages.sparkSession, 'web-archives')}/data"
    return read_archives(common.written(write_archives(pages, folder), "archive-manifest"), folder)
