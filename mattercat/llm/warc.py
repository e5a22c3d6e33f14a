"""WARC derivatives: responses become linked metadata and plain-text conversion records.

Each response gives two records. The conversion holds the page's visible text, the
metadata the HTTP headers and links found in it as JSON. Both refer to their source by
its record id and carry its target, date and digests, so that they can be joined and
checked without it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_slices
from .html_blocks import ATTRIBUTE, blocks

# Names of the WARC 1.0 standard.
VERSION = "WARC/1.0"
TEXT_TYPES = ("text/html", "application/xhtml+xml", "text/plain")

LINK = re.compile(r"<(a|area|img|link|script|iframe|form)\b([^>]*)>", re.I)
CHARSET = re.compile(r"charset=[\"']?([\w.:-]+)", re.I)

RESPONSE = "record_id string, target_uri string, date string, block binary"
DERIVED = (
    "record_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
    "content_length bigint, block_digest string, source_block_digest string, source_payload_digest string, block string"
)


def digest(data: bytes) -> str:
    """``sha1:`` and the base-32 form, as archives write it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP response; a block without a head is all payload."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not block.startswith(b"HTTP/"):
        return "", [], block
    lines = head.decode("latin-1").split("\r\n")
    headers = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:])]
    return lines[0], headers, payload


def header(headers: list[tuple[str, str]], name: str) -> str:
    return next((v for k, v in headers if k.lower() == name), "")


def decoded(payload: bytes, content_type: str) -> str:
    named = CHARSET.search(content_type)
    try:
        return payload.decode(named[1] if named else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def derive_one(record_id: str | None, target: str | None, date: str | None, block: bytes | None) -> list[tuple]:
    """The metadata and the conversion record of one response, as rows of ``DERIVED``."""
    block = block or b""
    status, headers, payload = split_http(block)
    content_type = header(headers, "content-type")
    text = decoded(payload, content_type)
    plain = content_type.partition(";")[0].strip().lower()
    is_text = not plain or plain in TEXT_TYPES
    of_block, of_payload = digest(block), digest(payload)
    links = []
    if is_text and plain != "text/plain":
        body = "\n".join(b.text for b in blocks(text))
        for tag, attributes in LINK.findall(text):
            for key, value in ATTRIBUTE.findall(attributes):
                if key.lower() in ("href", "src", "action"):
                    links.append({"path": f"{tag.upper()}@/{key.lower()}", "url": value.strip("\"'")})
    else:
        body = text if is_text else ""
    envelope = json.dumps({
        "Envelope": {
            "WARC-Header-Metadata": {
                "WARC-Type": "response", "WARC-Record-ID": record_id, "WARC-Target-URI": target, "WARC-Date": date,
                "WARC-Block-Digest": of_block, "WARC-Payload-Digest": of_payload, "Content-Length": len(block),
            },
            "Payload-Metadata": {"HTTP-Response-Metadata": {
                "Status-Line": status, "Headers": [list(h) for h in headers], "HTML-Metadata": {"Links": links},
            }},
        },
    }, ensure_ascii=False, sort_keys=True)
    rows = []
    for kind, mime, content in (("metadata", "application/json", envelope), ("conversion", "text/plain", body)):
        data = content.encode("utf-8", "replace")
        name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id}#{kind}')}>"
        rows.append((kind, name, record_id, target, date, mime, len(data), digest(data), of_block, of_payload, data.decode()))
    return rows


def derive(responses: DataFrame) -> DataFrame:
    """Two rows of ``DERIVED`` for each response: its metadata, then its conversion.

    ``responses`` holds ``RESPONSE``: record id, target, date and the block, which is the
    whole HTTP response. Ids of derived records follow from that of their source, so a
    task that runs again makes the same records. A null block is empty, and an empty one
    gives empty text; null ids, targets and dates stay null, with derived ids that repeat
    as repeated rows do. A response whose type is not text has an empty conversion. Other
    columns are not read; an empty table gives no rows.
    """
    names = [f.split()[0] for f in DERIVED.split(", ")]
    types = [pa.int64() if "bigint" in f else pa.string() for f in DERIVED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "block"):
            rows = [r for x in zip(*[batch.column(n).to_pylist() for n in ("record_id", "target_uri", "date", "block")])
                    for r in derive_one(*x)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return responses.select("record_id", "target_uri", "date", "block").mapInArrow(run, DERIVED)


def responses_from_pages(pages: DataFrame, date: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages as responses: ``page_id`` and the columns of ``RESPONSE``.

    The record id is a UUID made of the SHA-1 of page id and url (version 5 layout).
    """
    hexed = F.sha1(F.concat_ws("\n", F.coalesce(pages[page_id].cast("string"), F.lit("")), F.coalesce(pages[url], F.lit(""))))
    record = F.concat(
        F.lit("<urn:uuid:"), F.substring(hexed, 1, 8), F.lit("-"), F.substring(hexed, 9, 4), F.lit("-5"),
        F.substring(hexed, 14, 3), F.lit("-a"), F.substring(hexed, 18, 3), F.lit("-"), F.substring(hexed, 21, 12), F.lit(">"),
    )
    body = F.coalesce(pages[html], F.lit(""))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return pages.select(
        pages[page_id].alias("page_id"), record.alias("record_id"), pages[url].alias("target_uri"), F.lit(date).alias("date"),
        F.concat(head, body).cast("binary").alias("block"),
    )


def record_bytes(row: dict) -> bytes:
    """One derived record in archive form."""
    data = row["block"].encode()
    fields = [
        ("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Refers-To", row["refers_to"]),
        ("WARC-Target-URI", row["target_uri"]), ("WARC-Date", row["date"]), ("WARC-Block-Digest", row["block_digest"]),
        ("Content-Type", row["content_type"]), ("Content-Length", str(len(data))),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"{VERSION}\r\n{head}\r\n".encode() + data + b"\r\n\r\n"


def archive_members(derived: DataFrame) -> DataFrame:
    """Each derived record as a gzip member (``record_type``, ``member``); members one after another are an archive."""
    names = [f.split()[0] for f in DERIVED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "block"):
            members = [gzip.compress(record_bytes(row), mtime=0) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("record_type"), pa.array(members, pa.binary())], ["record_type", "member"])

    return derived.select(*names).mapInArrow(run, "record_type string, member binary")


READ = 1 << 16  # bytes given to the unpacker at a time
START = re.compile(rb"WARC/\d+\.\d+\r\n")  # the first line of a record


def members(data: bytes, damage: list[int]) -> Iterator[bytes]:
    """The gzip members of an archive one after another; a plain archive is one. Bytes that can't be unpacked go to ``damage``."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    at = 0
    while at < len(data):
        unpacker, read, parts = zlib.decompressobj(wbits=31), at, []
        try:
            while not unpacker.eof and read < len(data):
                parts.append(unpacker.decompress(data[read: read + READ]))
                read = min(read + READ, len(data))
            if not unpacker.eof:
                raise zlib.error("the last member is cut off")
            at = read - len(unpacker.unused_data)
            yield b"".join(parts)
        except zlib.error:
            after = data.find(b"\x1f\x8b\x08", at + 1)
            after = len(data) if after < 0 else after
            damage.append(after - at)
            at = after


def parse_records(data: bytes, damage: list[int] | None = None) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of an archive, gzipped or plain.

    What is no record is an error, or with ``damage`` skipped up to the next line that starts one, and
    its number of bytes appended there. Members of a gzipped archive are unpacked one at a time.
    """
    lost: list[int] = []
    for part in members(data, lost):
        at = 0
        while at < len(part):
            end = part.find(b"\r\n\r\n", at)
            lines = part[at:end].decode("utf-8", "replace").split("\r\n")[1:]
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
            size = fields.get("content-length", "")
            if START.match(part, at) and end >= 0 and size.isdecimal() and end + 4 + int(size) <= len(part):
                at = end + 4 + int(size)
                yield fields, part[end + 4: at]
                while part.startswith(b"\r\n", at):
                    at += 2
            else:
                after = part.find(b"\nWARC/", at)
                after = len(part) if after < 0 else after + 1
                lost.append(after - at)
                at = after
        if lost and damage is None:
            break
    if lost and damage is None:
        raise ValueError(f"{lost[0]} bytes of an archive are no record")
    if damage is not None:
        damage.extend(lost)


def read_responses(spark: SparkSession, path: str, on_damage: str = "fail") -> DataFrame:
    """Response records of the archives below ``path``, as ``RESPONSE``; a file is one piece of work of at most 2 GB.

    An archive with bytes that are no record stops the job, or with ``on_damage="skip"`` gives all records around them.
    """
    if on_damage not in ("fail", "skip"):
        raise ValueError(f"on_damage is fail or skip, not {on_damage!r}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content").to_pylist():
                rows = [(f.get("warc-record-id"), f.get("warc-target-uri"), f.get("warc-date"), block)
                        for f, block in parse_records(data, [] if on_damage == "skip" else None) if f.get("warc-type") == "response"]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), [pa.string()] * 3 + [pa.binary()])],
                        ["record_id", "target_uri", "date", "block"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RESPONSE)
