"""Legacy archive converter: ARC version 1 and 2 images to WARC/1.1 files.

``parse_arc`` reads the version block and takes every URL record by its declared length,
so payloads may hold any bytes, blank lines and header look-alikes.  ``convert`` decides
which records repeat an earlier payload, synthesises WARC identifiers, timestamps, types
and digests, and ``write_warc`` stores gzip WARC files through Spark's own committer, so
a lost executor leaves no half-written archive.  ``read_warc`` takes them back.

Images are rows (archive, content), as ``spark.read.format("binaryFile")`` gives them.

Defined cases
-------------
* null html: an empty payload; null url: ``urn:x-unknown``; white space in a url is
  percent-encoded; null page_id: no sequence header, it comes back as null.
* a date of other than 14 digits is filled up with the lowest valid value of each field;
  one that is no date becomes 1970-01-01T00:00:00Z.
* a declared length beyond the image's end: the rest is taken and WARC-Truncated is set.
* payloads of equal SHA-1 and length of at least ``min_revisit`` bytes form a group; the
  record with the largest (sequence, url, date, archive, offset) is the response.
  Smaller ones are never revisits.  Repeated rows are records of their own.  Archives have names of their own:
  a record is known by archive and offset.
* empty input: no records and no files.
* extra columns of the pages table are ignored, whatever their names.

One image must fit in a task's memory (``image_bytes`` bounds those made here); one page
must stay under 2 GB, the limit of a binary value in Spark.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkframe.plans.lineage import Scratch

# Field names of ARC record lines by version, as the format defines them.
ARC_FIELDS = {
    1: ["url", "ip", "date", "mime", "length"],
    2: ["url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"],
}
ARC_DEFINITION = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Bytes of images that one task converts.
BUCKET_BYTES = 128 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SEQUENCE, LENGTH, REFERS = "X-Sequence", "X-Payload-Length", "X-Refers-To-Sequence"


# --- ARC -----------------------------------------------------------------------------


def arc_image(name: str, records: list[tuple], version: int = 1) -> bytes:
    """An ARC file of (url, ip, date, mime, status, block) records."""
    body = f"{version} 0 linkframe\n{ARC_DEFINITION[version]}\n\n".encode()
    head = f"filedesc://{name} 0.0.0.0 19960101000000 text/plain" + (" 200 - - 0 " + name if version == 2 else "")
    out, at = [f"{head} {len(body)}\n".encode(), body], 0
    at = sum(map(len, out))
    for url, ip, date, mime, status, block in records:
        line = f"{url} {ip} {date} {mime}"
        if version == 2:
            line += f" {status} {hashlib.md5(block).hexdigest()} - {at} {name}"
        part = f"{line} {len(block)}\n".encode() + block + b"\n"
        out.append(part)
        at += len(part)
    return b"".join(out)


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of an ARC image, the version block left out: field names to values, and offset, block, truncated."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    version, at = 1, 0
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        end = data.find(b"\n", at)
        if end < 0:
            return
        line = data[at:end].rstrip(b"\r").decode("utf-8", "surrogateescape")
        names = ARC_FIELDS[version]
        if line.startswith("filedesc://"):
            length = line.rpartition(" ")[2]
            block = data[end + 1 : end + 1 + int(length)] if length.isdigit() else b""
            number = block[:1]
            version = 2 if number == b"2" else 1
            at = end + 1 + len(block)
            continue
        values = line.rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit():
            at = end + 1  # no record line: resume at the next line
            continue
        length = int(values[-1])
        block = data[end + 1 : end + 1 + length]
        yield dict(zip(names, values, strict=True)) | {"offset": at, "block": block, "truncated": len(block) < length}
        at = end + 1 + len(block)


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    """Header with its blank line, and payload; no header if the block isn't an HTTP response."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    ends = [(i, n) for i, n in ((block.find(b"\r\n\r\n"), 4), (block.find(b"\n\n"), 2)) if i >= 0]
    if not ends:
        return block, b""
    at, n = min(ends)
    return block[: at + n], block[at + n :]


def warc_date(date: str) -> str:
    digits = re.sub(r"\D", "", date or "")[:14]
    filled = digits + "00000101000000"[len(digits) :]
    try:
        return datetime.strptime(filled, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ").rjust(20, "0")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def safe_url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f-\xa0]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "") or "urn:x-unknown"


def pages_to_arc(pages: DataFrame, image_bytes: int = 8 << 20) -> DataFrame:
    """ARC images (archive, content) of pages(page_id, url, html), both versions in turn."""
    src = pages.select(
        F.col("page_id").cast("long").alias("id"), F.col("url").cast("string").alias("url"), F.col("html").cast("binary").alias("html")
    )

    def build(batches):
        from pyspark import TaskContext

        part, n, held, total = TaskContext.get().partitionId(), 0, [], 0

        def image():
            name = f"lf-{part:06d}-{n:05d}.arc"
            return pa.RecordBatch.from_pydict({"archive": [name], "content": [arc_image(name, held, 1 + (part + n) % 2)]}, schema)

        for batch in batches:
            for page_id, url, html in zip(*(batch.column(i) for i in range(3)), strict=True):
                url, html, page_id = safe_url(url.as_py()), html.as_py() or b"", page_id.as_py()
                second = zlib.crc32(url.encode()) % 315_360_000
                date = datetime.utcfromtimestamp(1_104_537_600 + second).strftime("%Y%m%d%H%M%S")
                head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (f"{SEQUENCE}: {page_id}\r\n" if page_id is not None else "") + "\r\n"
                held.append((url, "127.0.0.1", date, "text/html", 200, head.encode() + html))
                total += len(html) + 400
                if total >= image_bytes:
                    yield image()
                    n, held, total = n + 1, [], 0
        if held:
            yield image()

    schema = pa.schema([("archive", pa.string()), ("content", pa.binary())])
    return src.mapInArrow(build, "archive string, content binary")


_SEQUENCE = re.compile(rb"(?im)^" + SEQUENCE.encode() + rb":[ \t]*(-?\d+)[ \t]*\r?$")
_KEYS = [
    ("archive", pa.string()), ("offset", pa.int64()), ("seq", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("size", pa.int64()), ("sha1", pa.string()),
]
_RECORD = pa.schema([
    *_KEYS, ("ip", pa.string()), ("mime", pa.string()), ("truncated", pa.bool_()), ("header", pa.binary()), ("payload", pa.binary()),
])
_KEYS_DDL = "archive string, offset long, seq long, url string, date string, size long, sha1 string"


def _records(archive: str, content: bytes) -> Iterator[dict]:
    """Records of an image, with payload and its SHA-1."""
    for r in parse_arc(content or b""):
        header, payload = http_parts(r["block"])
        m = _SEQUENCE.search(header)
        yield {
            "archive": archive, "offset": r["offset"], "seq": int(m[1]) if m else None, "url": r["url"].encode("utf-8", "replace").decode(), "date": r["date"],
            "size": len(payload), "sha1": hashlib.sha1(payload).hexdigest(), "ip": r["ip"], "mime": r["mime"], "truncated": r["truncated"], "header": header, "payload": payload,
        }


def _record_batches(images, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The schema's columns of the records of images (archive, content), about 8 MB a batch."""
    held, total = [], 0
    for batch in images:
        for archive, content in zip(batch.column(0), batch.column(1), strict=True):
            for r in _records(archive.as_py(), content.as_py()):
                held.append({k: r[k] for k in schema.names})
                total += 100 + (len(r["payload"]) + len(r["header"]) if "payload" in held[-1] else 0)
                if total > 8 << 20:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, total = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def arc_records(images: DataFrame) -> DataFrame:
    """Records of ARC images (archive, content), with payload and its SHA-1."""
    ddl = f"{_KEYS_DDL}, ip string, mime string, truncated boolean, header binary, payload binary"
    return images.select("archive", "content").mapInArrow(lambda batches: _record_batches(batches, _RECORD), ddl)


def record_keys(images: DataFrame) -> DataFrame:
    """The same without contents."""
    return images.select("archive", "content").mapInArrow(lambda batches: _record_batches(batches, pa.schema(_KEYS)), _KEYS_DDL)


# --- conversion ------------------------------------------------------------------------


def revisits(keys: DataFrame, min_revisit: int = 1000) -> DataFrame:
    """(archive, offset, target) of the records that repeat a payload: only digests and keys are grouped, with partial
    results before the shuffle, and joined; hot digests are split by Spark."""
    me = F.struct("seq", "url", "date", "archive", "offset")
    large = keys.where(F.col("size") >= min_revisit)
    groups = large.groupBy("sha1", "size").agg(F.max(me).alias("target"), F.count("*").alias("n")).where("n > 1").drop("n")
    found = large.join(groups, ["sha1", "size"])
    return found.where(F.col("target") != me).select("archive", "offset", "target").dropDuplicates(["archive", "offset"])


def convert(records: DataFrame, min_revisit: int = 1000) -> DataFrame:
    """records plus ``target``: what a revisit refers to, null for a record stored in full."""
    found = revisits(records, min_revisit)
    return records.join(found, ["archive", "offset"], "left")


def record_id(archive: str, offset: int, url: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{offset} {url}')}>"


def _b32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def warc_record(r: dict) -> bytes:
    """Bytes of a WARC record without its closing blank lines."""
    http, target = bool(r["header"]), r["target"]
    kind = "revisit" if target else "response" if http else "resource"
    block = r["header"] if target else r["header"] + r["payload"]
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(r["archive"], r["offset"], r["url"])),
        ("WARC-Date", warc_date(r["date"])),
        ("WARC-Target-URI", r["url"]),
        ("WARC-IP-Address", r["ip"]),
        ("WARC-Payload-Digest", _b32(bytes.fromhex(r["sha1"]))),
        ("WARC-Block-Digest", _b32(hashlib.sha1(block).digest())),
    ]
    if r["truncated"]:
        fields.append(("WARC-Truncated", "unspecified"))
    if target:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(target["archive"], target["offset"], target["url"])),
            ("WARC-Refers-To-Target-URI", target["url"]),
            ("WARC-Refers-To-Date", warc_date(target["date"])),
        ]
        if target["seq"] is not None:
            fields.append((REFERS, target["seq"]))
    if r["seq"] is not None:
        fields.append((SEQUENCE, r["seq"]))
    fields += [
        (LENGTH, r["size"]),
        ("Content-Type", "application/http; msgtype=response" if http else r["mime"] or "application/octet-stream"),
        ("Content-Length", len(block)),
    ]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block


def warc_info(part: int) -> bytes:
    block = b"software: linkframe\r\nformat: WARC File Format 1.1\r\nconformsTo: https://iipc.github.io/warc-specifications/specifications/warc-format/warc-1.1/\r\n"
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {record_id('warcinfo', part, '')}\r\nWARC-Date: 1996-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block


_LINES = pa.schema([("value", pa.binary())])


def _warc_batches(records: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    """WARC records, a warcinfo record before them, about 8 MB a batch."""
    out, total, first = [], 0, True
    for r in records:
        if first:
            out.append(warc_info(TaskContext.get().partitionId()))
            first = False
        out.append(warc_record(r))
        total += len(out[-1])
        if total > 8 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], schema=_LINES)
            out, total = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], schema=_LINES)


def _write_lines(lines: DataFrame, path: str) -> None:
    """One gzip WARC file per partition; a record's closing blank lines are the writer's line separator."""
    lines.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def write_warc(records: DataFrame, path: str) -> None:
    """WARC files of converted records."""

    def write(batches):
        yield from _warc_batches(r for batch in batches for r in _rows(batch))

    _write_lines(records.mapInArrow(write, "value binary"), path)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    names = batch.schema.names
    for values in zip(*batch.columns, strict=True):
        yield {k: v.as_py() for k, v in zip(names, values, strict=True)}


def write_images(images: DataFrame, path: str, scratch: Scratch, min_revisit: int = 1000, size: int | None = None) -> None:
    """WARC files of ARC images, of ``size`` bytes (else they are added up).

    Images are written once, in buckets of their archive, and parsed twice: for the keys by which revisits are found, and
    to be converted.  What each archive refers to, one row an archive, comes to its bucket; no payload is shuffled, however
    many digests repeat.
    """
    spark = images.sparkSession
    size = images.agg(F.sum(F.octet_length("content"))).head()[0] if size is None else size
    table = scratch.bucketed(images.select("archive", "content"), "archive", scratch.buckets(size or 0, BUCKET_BYTES), deal=False)
    found = revisits(record_keys(spark.table(table)), min_revisit)
    of = found.groupBy("archive").agg(F.collect_list(F.struct("offset", "target")).alias("targets"))  # of one image's records

    def write(batches):
        def records():
            for batch in batches:
                for row in _rows(batch):
                    targets = {t["offset"]: t["target"] for t in row["targets"] or ()}
                    for r in _records(row["archive"], row["content"]):
                        yield r | {"target": targets.get(r["offset"])}

        yield from _warc_batches(records())

    joined = spark.table(table).join(of, "archive", "left").select("archive", "content", "targets")
    _write_lines(joined.mapInArrow(write, "value binary"), path)
    scratch.drop_table(table)


# --- reading back ------------------------------------------------------------------------


def parse_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict, bytes]]:
    """Header fields (names in lower case) and block of each record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one is due: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode().partition(":")
            fields[k.strip().lower()] = v.strip()
        yield fields, stream.read(int(fields["content-length"]))


def read_warc(spark, path: str) -> DataFrame:
    """Records of the WARC files in path but warcinfo; digests and lengths of stored payloads are computed anew."""
    schema = pa.schema([
        ("seq", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("warc_date", pa.string()), ("target_uri", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("intact", pa.bool_()),
    ])

    def parse(batches):
        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                raw = io.BytesIO(data)
                rows = []
                with io.BufferedReader(gzip.GzipFile(fileobj=raw)) if data[:2] == b"\x1f\x8b" else raw as stream:
                    for f, block in parse_warc(stream):
                        if f["warc-type"] == "warcinfo":
                            continue
                        said = base64.b32decode(f["warc-payload-digest"].partition(":")[2]).hex()
                        size, digest = int(f[LENGTH.lower()]), said
                        if f["warc-type"] != "revisit":
                            payload = http_parts(block)[1] if f["content-type"].startswith("application/http") else block
                            size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                        number = lambda k, f=f: int(f[k.lower()]) if k.lower() in f else None
                        rows.append((
                            number(SEQUENCE), f["warc-record-id"], f["warc-type"], f["warc-date"], f["warc-target-uri"], size, digest,
                            number(REFERS), digest == said and size == int(f[LENGTH.lower()]),
                        ))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(
        parse,
        "seq long, record_id string, record_type string, warc_date string, target_uri string, payload_bytes long, payload_digest string, refers_to long, intact boolean",
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """pages -> ARC images -> WARC files in the shared folder -> one row per record read back."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    path = scratch.path("warc")
    size = pages.agg(F.sum(F.octet_length("html"))).head()[0] or 0
    write_images(pages_to_arc(pages), path, scratch, size=size)
    return read_warc(spark, path)
