"""WARC derivatives: metadata and plain-text conversion records linked to their responses.

``responses`` makes response records (WARC/1.1, an HTTP message as block) from
pages; ``parse_records`` reads records from whole WARC files (Spark's
``binaryFile``, gzip members or plain); ``derive`` turns every response into

* a *conversion* record: the page's plain text, and
* a *metadata* record: the response's own headers, title, outlinks and sizes,

both with a ``WARC-Refers-To`` to the response, its target URI and date, the
response's payload digest, and digests of their own block. Record ids are
derived from the response's id, so a repeated run writes the same records.
``warc_files`` packs records into gzip members, ready to be written.

Everything works on a DataFrame of records (record_id, type, target_uri, date,
headers, block), where it lies: nothing is shuffled or gathered.

Defined results: a null html is an empty payload; a null url leaves the target
URI out; a response that is no HTTP message has no HTTP headers and its whole
block as payload; other record types are left out by ``derive``; malformed
records end the file they are in, with an ``error`` row; repeated rows give
repeated records with equal ids; empty tables give empty results.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import BATCH_ROWS
from .html_main import ATTRIBUTE, INLINE, RAW

VERSION = b"WARC/1.1"
RECORD = "record_id string, type string, target_uri string, date string, headers map<string,string>, block binary"
MEMBER = "record_id string, member binary"
_NAMES = ["record_id", "type", "target_uri", "date", "headers", "block"]
_TYPES = [pa.string(), pa.string(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]
#: Date of records made from pages, which carry none.
PAGE_DATE = "2024-01-01T00:00:00Z"
_TITLE = re.compile(r"<title(?=[\s/>])", re.I)
_TITLE_END = re.compile(r"</title\s*>", re.I)
_REST = r"""[^>"']*(?:(?:"[^"]*(?:"|$)|'[^']*(?:'|$))[^>"']*)*(?:>|$)"""
_SKIPPED = re.compile(rf"<!--.*?(?:-->|$)|<({'|'.join(sorted(RAW))})(?=[\s/>]){_REST}.*?(?:</\1\s*>|$)|<[!?][^>]*(?:>|$)",
                      re.I | re.S)
_INLINE_TAG = re.compile(rf"</?(?:{'|'.join(sorted(INLINE))})(?=[\s/>]){_REST}", re.I | re.S)
_TAG = re.compile(rf"</?[a-zA-Z]{_REST}", re.S)
#: The usual anchor: its first attribute is the href.
_FIRST_HREF = re.compile(r"""\s+href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_ANCHOR = re.compile(rf"<a(?=\s)({_REST})", re.I | re.S)
#: Level of the gzip members: two thirds of the default level's time, 1 % more bytes.
GZIP_LEVEL = 4
#: Bytes of record blocks after which read records are handed on: small files share a batch.
BATCH_OUT = 1 << 20
#: Headers that every record has by itself; the response's others are carried over.
OWN = {"warc-type", "warc-record-id", "warc-date", "warc-target-uri", "content-length", "content-type",
       "warc-block-digest", "warc-payload-digest", "warc-refers-to"}


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def named_id(*parts: str) -> str:
    """A record id that depends on the parts alone."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def _record(kind: str, record_id: str, uri: str | None, date: str | None, content_type: str, block: bytes,
            extra: dict[str, str]) -> tuple:
    headers = {"WARC-Type": kind, "WARC-Record-ID": record_id}
    headers |= {"WARC-Date": date} if date else {}
    headers |= {"WARC-Target-URI": uri} if uri else {}
    headers |= extra
    headers |= {"Content-Type": content_type, "WARC-Block-Digest": digest(block), "Content-Length": str(len(block))}
    return record_id, kind, uri, date, list(headers.items()), block


def _batch(rows: list[tuple], names=_NAMES, types=_TYPES) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=list(names))


def response_record(page_id, url: str | None, html: str | None) -> tuple:
    """The response record of a page."""
    payload = (html or "").encode("utf-8", "replace")
    head = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            + f"Content-Length: {len(payload)}\r\n\r\n".encode())
    sha = digest(payload)
    return _record("response", named_id("response", str(page_id), url or "", sha), url, PAGE_DATE,
                   "application/http; msgtype=response", head + payload,
                   {"WARC-Payload-Digest": sha, "WARC-Identified-Payload-Type": "text/html"})


def responses(pages: DataFrame) -> DataFrame:
    """Response records of pages (page_id, url, html)."""
    def emit(batches):
        for batch in batches:
            rows = [response_record(*r) for r in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")))]
            yield _batch(rows)
    return pages.select("page_id", "url", "html").mapInArrow(emit, RECORD)


def to_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as it stands in a WARC file."""
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def _members_of(rows) -> pa.RecordBatch:
    """(record_id, member) of (record id, headers, block) rows."""
    return _batch([(i, gzip.compress(to_bytes(h, b), GZIP_LEVEL, mtime=0)) for i, h, b in rows],
                  ["record_id", "member"], [pa.string(), pa.binary()])


def warc_files(records: DataFrame) -> DataFrame:
    """(record_id, member): every record as a gzip member; members one after the other are a WARC file."""
    def emit(batches):
        for batch in batches:
            yield _members_of(zip(*(batch.column(c).to_pylist() for c in ("record_id", "headers", "block"))))
    return records.mapInArrow(emit, MEMBER)


def _members(data: bytes):
    """The plain bytes of a file, gzip member by gzip member; a plain file as it is."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    while data:
        opener = zlib.decompressobj(31)
        part = opener.decompress(data)
        if not opener.eof:
            raise ValueError("a gzip member is cut short")
        yield part
        data = opener.unused_data


def split_records(data: bytes):
    """(headers, block) of every record of a WARC file's bytes; raises ValueError on what is none."""
    for part in _members(data):
        at = 0
        while at < len(part):
            end = part.find(b"\r\n\r\n", at)
            if not part.startswith(b"WARC/", at) or end < 0:
                raise ValueError(f"no record at byte {at}")
            lines = part[at:end].decode("utf-8", "replace").split("\r\n")[1:]
            headers = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines)]
            size = int(next((v for k, v in headers if k.lower() == "content-length"), "-1"))
            if size < 0 or end + 4 + size > len(part):
                raise ValueError(f"record at byte {at} is cut short")
            yield headers, part[end + 4:end + 4 + size]
            at = end + 4 + size
            while part.startswith(b"\r\n", at):
                at += 2


def parse_records(files: DataFrame) -> DataFrame:
    """Records of WARC files given as (content binary), e.g. ``spark.read.format("binaryFile")``.

    A malformed file ends with a row of type ``error`` that names the fault.
    """
    def emit(batches):
        rows, held = [], 0
        for batch in batches:
            for content in batch.column("content").to_pylist():
                try:
                    for headers, block in split_records(content or b""):
                        get = {k.lower(): v for k, v in headers}.get
                        rows.append((get("warc-record-id"), get("warc-type"), get("warc-target-uri"),
                                     get("warc-date"), headers, block))
                        held += len(block)
                        if held >= BATCH_OUT or len(rows) >= BATCH_ROWS:
                            yield _batch(rows)
                            rows, held = [], 0
                except (ValueError, zlib.error) as e:
                    rows.append((None, "error", None, None, [("error", str(e))], None))
        if rows:
            yield _batch(rows)
    return files.select("content").mapInArrow(emit, RECORD)


def http_parts(block: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """HTTP headers and payload of a response block; no headers if it is no HTTP message."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        return [], block
    lines = head.decode("latin-1").split("\r\n")
    return [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:])], payload


def plain_text(html: str) -> str:
    """All text of a page outside comments and raw elements (scripts, styles, ...), one block or line a line.

    Character references are decoded, white space inside a block is one space.
    """
    text = _TAG.sub("\n", _INLINE_TAG.sub("", _SKIPPED.sub("", html.replace("\n", " "))))
    lines = (" ".join(unescape(line).split()) for line in text.split("\n") if line)
    return "\n".join(filter(None, lines))


def title_of(html: str) -> str:
    """The text of the first title element; a title that does not end is none."""
    start = _TITLE.search(html)
    opened = html.find(">", start.end()) if start else -1
    end = _TITLE_END.search(html, opened) if opened >= 0 else None
    return " ".join(unescape(html[opened + 1:end.start()]).split()) if end else ""


def outlinks(html: str) -> list[str]:
    """The href of every anchor, in page order."""
    found = []
    for anchor in _ANCHOR.finditer(html):
        first = _FIRST_HREF.match(anchor[1])
        href = first[1] if first else next(
            (m[2] for m in ATTRIBUTE.finditer(anchor[1]) if m[1].lower() == "href"), None)
        if href:
            found.append(unescape(href.strip("\"'")))
    return found


def derived_records(record_id: str, uri: str | None, date: str | None, headers: list[tuple[str, str]],
                    block: bytes) -> list[tuple]:
    """The conversion and the metadata record of a response."""
    http, payload = http_parts(block)
    get = {k.lower(): v for k, v in headers}.get
    charset = next((v.lower().partition("charset=")[2].strip(' "\'') for k, v in http
                    if k.lower() == "content-type"), "") or "utf-8"
    try:
        html = payload.decode(charset, "replace")
    except LookupError:
        html = payload.decode("utf-8", "replace")
    carried = {k: v for k, v in headers if k.lower() not in OWN}
    carried["WARC-Refers-To"] = record_id
    carried |= {"WARC-Refers-To-Target-URI": uri} if uri else {}
    carried |= {"WARC-Refers-To-Date": date} if date else {}
    carried["WARC-Source-Payload-Digest"] = get("warc-payload-digest") or digest(payload)
    text = plain_text(html).encode("utf-8", "replace")
    fields = [("title", title_of(html)),
              ("charset", charset), ("payload-length", str(len(payload))), ("text-length", str(len(text))),
              *[(f"http-{k.lower()}", v) for k, v in http],
              *[("outlink", link) for link in outlinks(html)]]
    meta = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields).encode("utf-8", "replace")
    return [_record("conversion", named_id("conversion", record_id), uri, date, "text/plain; charset=utf-8", text, carried),
            _record("metadata", named_id("metadata", record_id), uri, date, "application/warc-fields", meta, carried)]


def _derived_rows(batch: pa.RecordBatch) -> list[tuple]:
    rows = []
    for i, uri, date, headers, block in zip(*(batch.column(c).to_pylist() for c in (
            "record_id", "target_uri", "date", "headers", "block"))):
        rows += derived_records(i, uri, date, headers or [], block or b"")
    return rows


def _sources(records: DataFrame) -> DataFrame:
    return records.where("type = 'response' AND record_id IS NOT NULL").select(_NAMES)


def derive(records: DataFrame) -> DataFrame:
    """The derived records of all responses among ``records``."""
    def emit(batches):
        for batch in batches:
            yield _batch(_derived_rows(batch))
    return _sources(records).mapInArrow(emit, RECORD)


def derivative_files(records: DataFrame) -> DataFrame:
    """``warc_files(derive(records))`` in one pass: the records go from derivation to their members."""
    def emit(batches):
        for batch in batches:
            yield _members_of((r[0], r[4], r[5]) for r in _derived_rows(batch))
    return _sources(records).mapInArrow(emit, MEMBER)


def page_derivative_files(pages: DataFrame) -> DataFrame:
    """``derivative_files(responses(pages))`` in one pass over the pages."""
    def emit(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")))
            made = (response_record(*r) for r in rows)
            yield _members_of((d[0], d[4], d[5]) for i, _, uri, date, headers, block in made
                              for d in derived_records(i, uri, date, headers, block))
    return pages.select("page_id", "url", "html").mapInArrow(emit, MEMBER)


def query(pages: DataFrame) -> DataFrame:
    """Digests of every derived record, read back from the WARC bytes that are written."""
    written = page_derivative_files(pages)
    return parse_records(written.selectExpr("member AS content")).selectExpr(
        "record_id", "type", "target_uri", "headers['WARC-Refers-To'] AS refers_to",
        "headers['WARC-Refers-To-Date'] AS refers_to_date",
        "headers['WARC-Source-Payload-Digest'] AS source_digest",
        "headers['WARC-Identified-Payload-Type'] AS source_type",
        "headers['WARC-Block-Digest'] AS block_digest", "octet_length(block) AS n_bytes",
        "sha2(block, 256) AS block_sha256")
