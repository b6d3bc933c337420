"""Web archives: legacy ARC files, and their conversion to WARC.

``write_arc`` writes pages as ARC files, ``read_arc`` parses them (the header line of each
record by the fields that its file's version block names, the record by its declared length),
``convert`` synthesises the WARC records: identifiers (name-based UUIDs), timestamps (ISO
from 14 digits), types and digests. ``write_warc`` and ``read_warc`` are the WARC side. Of
records with equal payloads of at least ``REVISIT_BYTES`` one is the response (the largest
page id), the others become revisits that refer to it and carry no payload.

Files are written by Spark's own text writer: a row is one record, the line separator is the
separator between records, and a task's first row is the file's own record (filedesc or
warcinfo). So files appear as a whole, on any file system that Spark knows, and a lost task
leaves nothing behind. They are read as binary files, record by record from the compressed
bytes; a file is as large as the partition that wrote it. A shuffle brings equal payloads
together; only payloads that occur again have a row in the table they meet, and the join is
one that adaptive execution can split, so a payload that a third of all pages have does no harm.

Edge cases: a null payload is empty; a null page id is carried as null and ranks below all
others; a null url is written as ``-``; white space and control characters of urls are
escaped; repeated rows are records of their own (of equal ones the last in file order is the
response); extra columns are ignored; an empty table gives archives without records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import read
from changeflow.session import new_dir, stored

REVISIT_BYTES = 1000
CAPTURED = "20240101000000"
_BATCH_BYTES = 4 << 20
# The field names of the two versions of the ARC format.
ARC_FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_RECORDS = (
    "file string, place long, version string, url string, ip string, date string, page_id long, "
    "http binary, payload binary, payload_bytes long, sha1 string, sha256 binary"
)


def _values(rows: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])


def _batched(records: Iterator[tuple[int, object]], build) -> Iterator[pa.RecordBatch]:
    """Batches of about ``_BATCH_BYTES`` from (size, record)."""
    rows, size = [], 0
    for n, record in records:
        rows.append(record)
        size += n + 200
        if size >= _BATCH_BYTES:
            yield build(rows)
            rows, size = [], 0
    if rows:
        yield build(rows)


def _http(page_id: int | None, length: int) -> bytes:
    named = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {length}\r\n{named}\r\n".encode()


def _http_fields(http: bytes) -> dict[str, str]:
    lines = http.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines) if k}


def write_arc(pages: DataFrame, path: str, captured: str = CAPTURED) -> None:
    """Pages (page_id, url, html) as ARC files, every other one of version 2."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        version = "12"[number % 2]
        name = f"pages-{number:05d}.arc"
        block = f"{version} 0 changeflow\n{ARC_FIELDS[version]}\n".encode()
        more = {"1": "", "2": " 200 - - 0 " + name}[version]
        head = f"filedesc://{name} 0.0.0.0 {captured} text/plain{more} {len(block)}\n".encode() + block

        def rows() -> Iterator[tuple[int, bytes]]:
            offset = len(head) + 1
            yield len(head), head
            for batch in batches:
                for page_id, url, html in zip(*(batch[c] for c in ("page_id", "url", "html")), strict=True):
                    page_id, url, body = page_id.as_py(), url.as_py(), (html.as_py() or "").encode("utf-8")
                    document = _http(page_id, len(body)) + body
                    line = f"{quote(url or '-', safe=':/?#[]@!$&()*+,;=%~-._')} 0.0.0.0 {captured} text/html"
                    if version == "2":
                        line += f" 200 {hashlib.md5(body, usedforsecurity=False).hexdigest()} - {offset} {name}"
                    row = f"{line} {len(document)}\n".encode() + document
                    offset += len(row) + 1
                    yield len(row), row

        yield from _batched(rows(), _values)

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    # The writer copies the bytes as they are: a cast of binary to string does not look at them.
    rows.mapInArrow(records, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\n").option("compression", "gzip").text(path)


def _opened(content: bytes) -> io.BufferedIOBase:
    raw = io.BytesIO(content)
    return gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw


def arc_records(content: bytes) -> Iterator[tuple[str, dict[str, str], bytes]]:
    """(version, header fields, bytes) of each record of an ARC file, the version block left out."""
    stream = _opened(content)
    version, names = "1", ARC_FIELDS["1"].split()
    while line := stream.readline():
        line = line.rstrip(b"\r\n")
        if not line:
            continue
        values = line.decode("utf-8", "replace").split(" ")
        if line.startswith(b"filedesc:"):
            # Its own line has the fields of the version that its block declares.
            block = stream.read(int(values[-1])).decode("utf-8", "replace").split("\n")
            version = block[0].split(" ")[0]
            names = block[1].split() if len(block) > 1 and block[1] else ARC_FIELDS[version].split()
            continue
        if len(values) > len(names):
            # Old writers left spaces in urls; all other fields have none.
            extra = len(values) - len(names)
            values = [" ".join(values[: extra + 1]), *values[extra + 1 :]]
        fields = dict(zip(names, values, strict=False))
        size = int(fields["Archive-length"])
        data = stream.read(size)
        if len(data) != size:
            raise ValueError(f"the archive ends in a record that declares {size} bytes")
        yield version, fields, data


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all ARC files of a folder, payloads apart from their HTTP headers."""
    kinds = [("file", pa.string()), ("place", pa.int64()), ("version", pa.string()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("page_id", pa.int64()),
             ("http", pa.binary()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("sha1", pa.string()), ("sha256", pa.binary())]
    schema = pa.schema(kinds)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, tuple]]:
            for batch in batches:
                for name, content in zip(batch["path"], batch["content"], strict=True):
                    for place, (version, fields, data) in enumerate(arc_records(content.as_py())):
                        http, gap, payload = data.partition(b"\r\n\r\n") if data.startswith(b"HTTP/") else (b"", b"", data)
                        page_id = _http_fields(http).get("x-page-id")
                        yield len(data), (
                            name.as_py(), place, version, fields["URL"], fields["IP-address"], fields["Archive-date"],
                            None if page_id is None else int(page_id), http + gap, payload, len(payload),
                            hashlib.sha1(payload, usedforsecurity=False).hexdigest(), hashlib.sha256(payload).digest(),
                        )

        def build(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

        yield from _batched(rows(), build)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(parse, _RECORDS)


def record_id(*parts: object) -> str:
    """A WARC identifier that depends on what it names only."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(map(str, parts)))}>"


def iso_date(digits: str) -> str:
    """A WARC date from the 14 digits of an ARC date; missing digits are the earliest moment."""
    d = (digits + "00000101000000"[len(digits) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _digest(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def warc_record(row: dict) -> bytes:
    """One record without what separates it from the next."""
    scheme = row["url"].partition(":")[0].lower()
    revisit = row["first_url"] is not None
    kind = "revisit" if revisit else "response" if row["http"] or scheme in ("dns", "http", "https") else "resource"
    block = row["http"] if revisit else row["http"] + row["payload"]
    head = [
        "WARC/1.0",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(row['file'], row['place'], row['url'])}",
        f"WARC-Date: {iso_date(row['date'])}",
        f"WARC-Target-URI: {row['url']}",
        f"WARC-IP-Address: {row['ip']}",
        f"WARC-Payload-Digest: {_digest(row['sha1'])}",
        f"WARC-Block-Digest: {_digest(hashlib.sha1(block, usedforsecurity=False).hexdigest())}",
    ]
    if revisit:
        head += [
            f"WARC-Profile: {_PROFILE}",
            f"WARC-Refers-To: {record_id(row['first_file'], row['first_place'], row['first_url'])}",
            f"WARC-Refers-To-Target-URI: {row['first_url']}",
            f"WARC-Refers-To-Date: {iso_date(row['first_date'])}",
        ]
    media = "application/http; msgtype=response" if row["http"] else "text/dns" if scheme == "dns" else "application/octet-stream"
    head += [f"Content-Type: {media}", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8") + block


def convert(records: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """The rows of ``read_arc`` with first_* of the response that a revisit refers to, else null."""
    order = F.struct(F.col("page_id").isNotNull(), "page_id", "file", "place", "url", "date")
    again = (
        records.where(F.col("payload_bytes") >= least)
        .groupBy("sha256", "payload_bytes")
        .agg(F.count("*").alias("n"), F.max(order).alias("first"))
        .where("n > 1")
        .select(F.col("sha256").alias("again"), *(F.col(f"first.{c}").alias(f"first_{c}") for c in ("file", "place", "url", "date")))
    )
    again = stored(again, "payloads")
    found = records.join(again, records["sha256"] == again["again"], "left")
    own = (F.col("file") == F.col("first_file")) & (F.col("place") == F.col("first_place"))
    for c in ("file", "place", "url", "date"):
        found = found.withColumn(f"first_{c}", F.when(~F.coalesce(own, F.lit(False)), F.col(f"first_{c}")) if c in ("url", "date") else F.col(f"first_{c}"))
    return found.drop("again")


def write_warc(records: DataFrame, path: str) -> None:
    """The rows of ``convert`` as WARC files."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        body = b"software: changeflow\r\nformat: WARC File Format 1.0\r\n"
        number = TaskContext.get().partitionId()
        head = f"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {record_id('warcinfo', path, number)}\r\nWARC-Date: {iso_date(CAPTURED)}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n"

        def each() -> Iterator[tuple[int, bytes]]:
            yield 0, head.encode() + body
            for batch in batches:
                for row in batch.to_pylist():
                    record = warc_record(row)
                    yield len(record), record

        yield from _batched(each(), _values)

    wanted = records.drop("version", "page_id", "sha256", "payload_bytes")
    wanted.mapInArrow(rows, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of a WARC file."""
    stream = _opened(content)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"the archive ends in a record that declares {size} bytes")
        yield fields, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, record_type, page_id, url, payload_bytes, payload_digest, refers_to_id) of the captures.

    The digest of a response is that of the bytes read, and must be the one declared; a
    revisit has the one it declares.
    """
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to_id", pa.string())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, tuple]]:
            for batch in batches:
                for content in batch["content"]:
                    for fields, block in warc_records(content.as_py()):
                        kind = fields["warc-type"]
                        if kind not in ("response", "revisit", "resource"):
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", block)
                        names = _http_fields(http)
                        declared = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                        if kind == "revisit":
                            size = int(names["content-length"]) if "content-length" in names else None
                        else:
                            size = len(payload)
                            if hashlib.sha1(payload, usedforsecurity=False).hexdigest() != declared:
                                raise ValueError(f"{fields['warc-record-id']} does not have the digest it declares")
                        page_id = names.get("x-page-id")
                        yield 0, (fields["warc-record-id"], kind, None if page_id is None else int(page_id), fields["warc-target-uri"], size, declared, fields.get("warc-refers-to"))

        def build(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

        yield from _batched(rows(), build)

    kinds = "record_id string, record_type string, page_id long, url string, payload_bytes long, payload_digest string, refers_to_id string"
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, kinds)


def resolved(captures: DataFrame) -> DataFrame:
    """The captures, revisits with the page id and the payload's size of the response they refer to."""
    captures = stored(captures, "captures")
    first = captures.where("record_type <> 'revisit'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("first_bytes")
    )
    # Only what is referred to is joined back.
    first = stored(first.join(captures.select("refers_to_id").distinct(), "refers_to_id", "left_semi"), "referred")
    return captures.join(first, "refers_to_id", "left").withColumn("payload_bytes", F.coalesce("first_bytes", "payload_bytes")).drop("first_bytes")


def op5_warc_from_arc(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc, warc = new_dir(spark, "arc"), new_dir(spark, "warc")
    write_arc(read(spark, sf_dir, "pages"), arc)
    write_warc(convert(read_arc(spark, arc)), warc)
    return resolved(read_warc(spark, warc)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
  FROM pages)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM p
"""
