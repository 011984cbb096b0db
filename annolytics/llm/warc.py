"""WARC derivatives: metadata and plain-text conversion records of responses.

Every response gives one `metadata` record (JSON: the envelope of the source record, its
HTTP status line and headers, title and links of the page) and one `conversion` record
(the visible text). Both name the response in WARC-Refers-To and keep its target URI,
date and payload digest; each has a digest of its own block.
"""

from __future__ import annotations

import base64
import codecs
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import small_batches
from .html_text import page_parts

#: Capture time given to pages that come without one.
NO_DATE = "1970-01-01T00:00:00Z"
#: Compressed bytes handed to zlib at a time.
CHUNK = 1 << 16
Fields = dict[str, "str | list[str]"]
_CONTENT = {"metadata": "application/json", "conversion": "text/plain"}


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(parts))}>"


def encode_record(headers: dict[str, str], block: bytes) -> bytes:
    lines = "".join(f"{k}: {re.sub(r'[\r\n]+', ' ', v)}\r\n" for k, v in (headers | {"Content-Length": str(len(block))}).items())
    return b"WARC/1.0\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def fields(lines: list[str]) -> Fields:
    """Header lines as names and values. Names stand as first written and are one whatever
    their case; values of a repeated name are a list, a folded line goes on with the one before."""
    found: dict[str, tuple[str, list[str]]] = {}
    last = None
    for line in lines:
        if line[:1] in (" ", "\t") and last:
            last[-1] = f"{last[-1]} {line.strip()}".strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            last = found.setdefault(name.strip().lower(), (name.strip(), []))[1]
            last.append(value.strip())
    return {name: values[0] if len(values) == 1 else values for name, values in found.values()}


def field(headers: Fields, name: str, default: str | None = None) -> str | None:
    """The (first) value of a name in any case."""
    value = next((v for k, v in headers.items() if k.lower() == name.lower()), default)
    return value[0] if isinstance(value, list) else value


def decode_record(record: bytes) -> tuple[Fields, bytes]:
    """Headers and block of a record; ValueError where it is none or is cut short."""
    head, end, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/") or not end:
        raise ValueError("not a WARC record")
    headers = fields(lines[1:])
    length = int(field(headers, "Content-Length", "-1"))
    if not 0 <= length <= len(rest):
        raise ValueError("a block of another length than its header says")
    return headers, rest[:length]


def gzip_members(data: bytes) -> Iterator[bytes]:
    """What the gzip members of a file hold, one at a time; a file not compressed is one.
    zlib.error where a member is damaged, or, once what it holds is given, cut short."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    view, at = memoryview(data), 0
    while at < len(data):
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof and at < len(data):
            parts.append(unpack.decompress(view[at : at + CHUNK]))
            at = min(at + CHUNK, len(data))
        at -= len(unpack.unused_data)
        yield b"".join(parts)
        if not unpack.eof:
            raise zlib.error("a gzip member is cut short")


def split_records(data: bytes) -> Iterator[bytes]:
    """The records that stand end to end; what can't be read as one is given as it stands, to the end."""
    at = 0
    while True:
        while data[at : at + 2] == b"\r\n":
            at += 2
        if at >= len(data):
            return
        end = data.find(b"\r\n\r\n", at)
        length = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)", data[at:end] + b"\r\n") if end >= 0 else None
        stop = end + 4 + int(length[1]) if length else len(data)
        yield data[at:stop]
        at = stop


def response_record(page_id: int | None, url: str | None, html: str | None, date: str = NO_DATE) -> bytes:
    """A page as a WARC response record."""
    body = (html or "").encode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body
    headers = {"WARC-Type": "response", "WARC-Record-ID": record_id("response", str(page_id), url or "", digest(body)), "WARC-Date": date, "WARC-Target-URI": url or "", "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": digest(body), "WARC-Block-Digest": digest(block)}
    return encode_record(headers, block)


def charset(content_type: str) -> str:
    """The text encoding that a Content-Type names; UTF-8 where it names none that is known."""
    named = re.search(r"(?i)charset=[\"']?([\w.:-]+)", content_type)
    try:
        return codecs.lookup(named[1]).name if named and codecs.lookup(named[1])._is_text_encoding else "utf-8"
    except LookupError:
        return "utf-8"


def derive(record: bytes) -> Iterator[tuple[str, dict[str, str], bytes]]:
    """Type, headers and block of the records that come of a response."""
    source, block = decode_record(record)
    source_id = field(source, "WARC-Record-ID")
    if not source_id:
        raise ValueError("a response without WARC-Record-ID")
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *lines = head.decode("utf-8", "replace").split("\r\n")
    http = fields(lines)
    html = payload.decode(charset(field(http, "Content-Type", "")), "replace")
    title, links, text = page_parts(html)
    page = {"Title": title, "Links": links}
    envelope = {"WARC-Header-Metadata": source, "Payload-Metadata": {"Response-Status": status, "Headers": http, "HTML-Metadata": page}, "Actual-Payload-Digest": digest(payload)}
    for kind, out in (("metadata", json.dumps({"Envelope": envelope}, ensure_ascii=False, sort_keys=True).encode()), ("conversion", text.encode())):
        headers = {"WARC-Type": kind, "WARC-Record-ID": record_id(kind, source_id), "WARC-Refers-To": source_id, "WARC-Date": field(source, "WARC-Date", NO_DATE), "WARC-Target-URI": field(source, "WARC-Target-URI", ""), "Content-Type": _CONTENT[kind], "WARC-Block-Digest": digest(out)}
        if field(source, "WARC-Payload-Digest"):
            headers["WARC-Source-Payload-Digest"] = field(source, "WARC-Payload-Digest")
        yield kind, headers, out


_ROW = "page_id long, record_type string, record_id string, refers_to string, target_uri string, source_digest string, block_digest string, content_length long, block string"


def derivative_records(pages: DataFrame) -> DataFrame:
    """Metadata and conversion records of pages.

    pages: page_id long, url string, html string; other columns are left out. Two rows
    per input row. A null url is an empty one, a null html an empty payload; repeated
    rows have equal records; an empty table gives an empty result.
    """
    small_batches(pages.sparkSession)

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page_id, url, html in batch.itertuples(index=False):
                for kind, h, block in derive(response_record(None if pd.isna(page_id) else int(page_id), url, html)):
                    rows.append((page_id, kind, h["WARC-Record-ID"], h["WARC-Refers-To"], h["WARC-Target-URI"], h["WARC-Source-Payload-Digest"], h["WARC-Block-Digest"], len(block), block.decode()))
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in _ROW.split(", ")]).astype({"page_id": "Int64"})

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInPandas(convert, _ROW)


def derivative_files(pages: DataFrame) -> DataFrame:
    """The same records as gzip members (one row each: kind, member), which laid end to
    end form .warc.gz files."""

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(kind, gzip.compress(encode_record(h, block), mtime=0)) for page_id, url, html in batch.itertuples(index=False) for kind, h, block in derive(response_record(None if pd.isna(page_id) else int(page_id), url, html))]
            yield pd.DataFrame(rows, columns=["kind", "member"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInPandas(convert, "kind string, member binary")


_FROM_FILE = "file string, record_type string, record_id string, refers_to string, target_uri string, source_digest string, block_digest string, content_length long, headers map<string, string>, block string"


def derivatives_of_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Metadata and conversion records of the responses in WARC files, plain or .warc.gz.

    Two rows for each response, with the headers of the new record. Records of other types
    give none. What can't be read as a record gives one row of the type `malformed`, whose
    block says why, and reading goes on with the next gzip member; so does a gzip member that
    is damaged or cut short, and there its file ends. A file is read by one task, which holds it (at most 2 GB, as Spark reads it) and one unpacked member. Equal
    records give equal rows; an empty file gives none.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def malformed(size: int, why: Exception) -> tuple:
        return "malformed", None, None, None, None, None, size, {}, str(why)

    def rows_of_record(record: bytes) -> Iterator[tuple]:
        try:
            source, _ = decode_record(record)
            found = list(derive(record)) if (field(source, "WARC-Type") or "").lower() == "response" else []
        except ValueError as why:
            yield malformed(len(record), why)
            return
        for kind, h, block in found:
            yield kind, h["WARC-Record-ID"], h["WARC-Refers-To"], h["WARC-Target-URI"], h.get("WARC-Source-Payload-Digest"), h["WARC-Block-Digest"], len(block), h, block.decode()

    def rows_of(data: bytes) -> Iterator[tuple]:
        try:
            for member in gzip_members(data):
                for record in split_records(member):
                    yield from rows_of_record(record)
        except zlib.error as why:
            yield malformed(len(data), why)

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in _FROM_FILE.replace("<string, string>", "").split(", ")]
        for batch in batches:
            for name, data in batch.itertuples(index=False):
                held = []
                for row in rows_of(data):
                    held.append((name, *row))
                    if len(held) == 200:
                        yield pd.DataFrame(held, columns=names)
                        held = []
                if held:
                    yield pd.DataFrame(held, columns=names)

    return files.mapInPandas(convert, _FROM_FILE)
