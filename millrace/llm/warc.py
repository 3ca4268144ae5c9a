"""WARC derivatives: metadata and plain-text conversion records of response records.

A response record becomes two linked records. The metadata record holds what the
response's headers and markup say (status, HTTP headers, title, language, link
count), the conversion record the page's text. Both name the response in
WARC-Refers-To, keep its target URI and date, and carry its payload digest next
to digests of their own. Record ids are derived from the content, so a task that
runs again makes the same records.

Defined results: very long pages are parsed whole, a batch of pages at a time; equal pages
under one id make equal records, there are no other ties; null html is an empty payload, null url an empty URI; pages that
repeat keep their records, ids and all; a record that cannot be parsed raises; extra
columns are ignored; an empty table gives no rows. All work is per row: no shuffle.
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

DATE = "1970-01-01T00:00:00Z"
CRLF = "\r\n"
RECORD = "page_id long, warc_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, content_length long, block_digest string, payload_digest string, source_digest string, source_headers string"

_BREAKS = frozenset("address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre section table tbody td tfoot th thead title tr ul".split())
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|title)\b[^<>]*>.*?(?:</\1\s*>|\Z)|</?([a-zA-Z][a-zA-Z0-9]*)[^<>]*>|<[!?][^<>]*>", re.S | re.I)
_TITLE = re.compile(r"<title\b[^<>]*>(.*?)(?:</title\s*>|\Z)", re.S | re.I)
_LANG = re.compile(r"<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
_LINK = re.compile(r"<a\b[^<>]*?\bhref\s*=", re.I)
_BLANKS = re.compile(r"[^\S\n]+")
_GAPS = re.compile(r" ?\n[ \n]*")


def digest(data: bytes) -> str:
    """The digest form of WARC headers."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(kind: str, *parts: str) -> str:
    """An identifier that follows from what the record holds."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1('|'.join((kind, *parts)).encode()).digest()[:16], version=5)}>"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record's bytes; WARC-Block-Digest and Content-Length are added."""
    lines = [f"{k}: {v}" for k, v in [*headers, ("WARC-Block-Digest", digest(block)), ("Content-Length", str(len(block)))]]
    return CRLF.join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """A record's headers and block; raises ValueError for what is no record or has a wrong digest."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split(CRLF)
    if not gap or not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[: int(headers["Content-Length"])]
    if len(block) != int(headers["Content-Length"]) or digest(block) != headers["WARC-Block-Digest"]:
        raise ValueError("the block is not what its headers say")
    return headers, block


def response(page_id: int | None, url: str | None, html: str | None, date: str = DATE) -> bytes:
    """A page as a response record."""
    payload, uri = (html or "").encode(), " ".join((url or "").split())
    block = CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", ""]).encode() + payload
    headers = [
        ("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", str(page_id), uri, digest(payload))), ("WARC-Target-URI", uri), ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", digest(payload)),
    ]
    return record(headers, block)


def text_of(html: str) -> str:
    """The visible text: block elements break lines, white space is collapsed, character references are resolved."""
    if "<" in html:
        html = _MARKUP.sub(lambda m: "\n" if m[2] is None or m[2].lower() in _BREAKS else "", html)
    text = _GAPS.sub("\n", _BLANKS.sub(" ", entities.unescape(html)))
    return text.strip(" \n")


def derive(data: bytes) -> list[bytes]:
    """The metadata and the conversion record of a response record."""
    headers, block = parse(data)
    if headers.get("WARC-Type") != "response":
        raise ValueError("only responses have derivatives")
    http, _, payload = block.partition(b"\r\n\r\n")
    status, *http_lines = http.decode("latin-1").split(CRLF)
    if digest(payload) != headers["WARC-Payload-Digest"]:
        raise ValueError("the payload is not what its digest says")
    html, source = payload.decode("utf-8", "replace"), headers["WARC-Record-ID"]
    title, lang = _TITLE.search(html), _LANG.search(html)
    fields = [("http-status", status), *(("http-header", line) for line in http_lines), ("title", " ".join(entities.unescape(title[1]).split()) if title else ""), ("language", lang[1].lower() if lang else ""), ("outlinks", str(len(_LINK.findall(html))))]
    about = "".join(f"{k}: {v}{CRLF}" for k, v in fields).encode()
    text = text_of(html).encode()
    linked = [("WARC-Refers-To", source), ("WARC-Target-URI", headers["WARC-Target-URI"]), ("WARC-Date", headers["WARC-Date"]), ("WARC-Refers-To-Payload-Digest", headers["WARC-Payload-Digest"])]
    meta_id, text_id = record_id("metadata", source, digest(about)), record_id("conversion", source, digest(text))
    return [
        record([("WARC-Type", "metadata"), ("WARC-Record-ID", meta_id), *linked, ("WARC-Concurrent-To", source), ("Content-Type", "application/warc-fields"), ("WARC-Payload-Digest", digest(about))], about),
        record([("WARC-Type", "conversion"), ("WARC-Record-ID", text_id), *linked, ("WARC-Concurrent-To", meta_id), ("Content-Type", "text/plain; charset=utf-8"), ("WARC-Payload-Digest", digest(text))], text),
    ]


def _responses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True)
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array([response(*row) for row in rows], pa.binary())], ["page_id", "record"])


def _derived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, records = [], []
        for page, data in zip(batch.column("page_id").to_pylist(), batch.column("record"), strict=True):
            made = derive(data.as_py())
            ids += [page] * len(made)
            records += made
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(records, pa.binary())], ["page_id", "record"])


_FIELDS = ("WARC-Type", "WARC-Record-ID", "WARC-Refers-To", "WARC-Target-URI", "WARC-Date", "Content-Type", "Content-Length", "WARC-Block-Digest", "WARC-Payload-Digest", "WARC-Refers-To-Payload-Digest")


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, notes = [], []
        for data in batch.column("record"):
            headers, block = parse(data.as_py())
            rows.append([headers.get(k) for k in _FIELDS])
            notes.append(block.decode().split(CRLF + "title: ")[0] if headers["WARC-Type"] == "metadata" else None)
        columns = [pa.array([int(r[i]) if k == "Content-Length" else r[i] for r in rows], pa.int64() if k == "Content-Length" else pa.string()) for i, k in enumerate(_FIELDS)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), *columns, pa.array(notes, pa.string())], [x.split()[0] for x in RECORD.split(", ")])


def responses(pages: DataFrame) -> DataFrame:
    """(page_id, record) of every page as a response record."""
    common.prepare(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return pages.mapInArrow(_responses, "page_id long, record binary")


def derivatives(records: DataFrame) -> DataFrame:
    """(page_id, record) of the two records derived from every response record."""
    common.prepare(records.sparkSession)
    return records.select("page_id", "record").mapInArrow(_derived, "page_id long, record binary")


def describe(records: DataFrame) -> DataFrame:
    """The headers and digests of records, read back from their bytes."""
    common.prepare(records.sparkSession)
    return records.select("page_id", "record").mapInArrow(_described, RECORD)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10 over the whole pages table."""
    return describe(derivatives(responses(common.table(spark, sf_dir, "pages"))))
