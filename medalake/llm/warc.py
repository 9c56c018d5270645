"""WARC derivatives: metadata and plain-text conversion records of response records.

``response_records`` wraps crawled pages as WARC/1.1 response records. ``derivatives`` takes response records from any
source, parses them, and makes for each one

* a ``conversion`` record: the page's text (UTF-8, text/plain), and
* a ``metadata`` record (application/warc-fields): status, source headers, title, language, links, text size.

Both carry WARC-Refers-To with the response's record id, its target URI and date, the response's payload digest, and
digests of their own block. Record ids are derived from the response's id, so a repeated run or a retried task makes
the same records.

Defined results: null html is an empty page; null url has no target URI line; repeated rows make equal records;
bytes that are no response record raise ValueError; an empty table gives no records; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from medalake.llm.common import pick, rows

_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122
RESPONSE_SCHEMA = "page_id long, record binary"
SCHEMA = ("page_id long, record_type string, record_id string, refers_to string, target_uri string, "
          "source_digest string, block_digest string, content_length long, record binary")

_SKIP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>"
                   r".*?(?:</\1\s*>|\Z)|<[!?][^>]*>", re.S | re.I)
_BLOCK = re.compile(r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form|h[1-6]|head|header"
                    r"|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)\b"
                    r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>", re.I)
_TAG = re.compile(r"</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
_BLANKS, _LINES = re.compile(r"[^\S\n]+"), re.compile(r" ?\n[ \n]*")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([\w-]+)", re.I)
_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in fields if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def response_record(page_id: int | None, url: str | None, page: str | None, date: str) -> bytes:
    body = (page or "").encode()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n").encode()
    url = None if url is None else re.sub(r"[\r\n]", "", url)
    return _record([
        ("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id} {url}')}>"),
        ("WARC-Date", date), ("WARC-Target-URI", url), ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", digest(body)), ("WARC-Block-Digest", digest(http + body))], http + body)


def _fields(head: bytes) -> tuple[str, list[tuple[str, str]]]:
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    return first, [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines) if v]


def parse_response(record: bytes) -> tuple[dict[str, str], str, list[tuple[str, str]], bytes]:
    """WARC fields (names in lower case), HTTP status line, HTTP headers and payload of a response record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, listed = _fields(head)
    fields = {k.lower(): v for k, v in listed}
    if not version.startswith("WARC/") or fields.get("warc-type") != "response":
        raise ValueError("not a WARC response record")
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    status, headers = _fields(http)
    return fields, status, headers, payload


def page_text(source: str) -> str:
    """The readable text of an HTML page: blocks on lines of their own, white space collapsed."""
    text = _SKIP.sub(" ", source)
    text = html.unescape(_TAG.sub("", _BLOCK.sub("\n", text)))
    return _LINES.sub("\n", _BLANKS.sub(" ", text)).strip()


def _charset(headers: list[tuple[str, str]]) -> str:
    kind = next((v for k, v in headers if k.lower() == "content-type"), "")
    found = re.search(r"charset\s*=\s*\"?([\w.-]+)", kind, re.I)
    return found[1] if found else "utf-8"


def derive(record: bytes) -> list[tuple]:
    """(type, record id, refers-to, target URI, source digest, block digest, length, bytes) of both derivatives."""
    fields, status, headers, payload = parse_response(record)
    refers, uri = fields["warc-record-id"], fields.get("warc-target-uri")
    source = fields.get("warc-payload-digest") or digest(payload)
    try:
        page = payload.decode(_charset(headers), "replace")
    except LookupError:
        page = payload.decode("utf-8", "replace")
    text = page_text(page).encode()
    title, lang = _TITLE.search(page), _LANG.search(page)
    links = [html.unescape(next(g for g in m.groups() if g is not None)) for m in _LINK.finditer(page)]
    plain = lambda s: " ".join(s.split())
    told = [("http-status", status), *[(f"http-header-{k.lower()}", v) for k, v in headers],
            ("source-payload-digest", source), ("title", plain(html.unescape(title[1])) if title else None),
            ("language", lang[1] if lang else None), ("text-length", str(len(text))), ("text-digest", digest(text)),
            *[("outlink", plain(x)) for x in links]]
    meta = "".join(f"{k}: {v}\r\n" for k, v in told if v is not None).encode()
    out = []
    for kind, mime, block in (("metadata", "application/warc-fields", meta),
                              ("conversion", "text/plain; charset=utf-8", text)):
        own, name = digest(block), f"<urn:uuid:{uuid.uuid5(_SPACE, f'{kind} {refers}')}>"
        made = _record([
            ("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", fields.get("warc-date")),
            ("WARC-Refers-To", refers), ("WARC-Refers-To-Target-URI", uri),
            ("WARC-Refers-To-Date", fields.get("warc-date")), ("WARC-Target-URI", uri),
            ("WARC-Source-Payload-Digest", source), ("Content-Type", mime), ("WARC-Block-Digest", own)], block)
        out.append((kind, name, refers, uri, source, own, len(block), made))
    return out


def response_records(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """(page_id, record) of crawled pages (page_id, url, html); ``date`` is the crawl's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [response_record(p, u, h, date) for p, u, h in rows(batch, "page_id", "url", "html")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["page_id", "record"])

    return pick(pages, "page_id", "url", "html").mapInArrow(run, RESPONSE_SCHEMA)


def derivatives(responses: DataFrame) -> DataFrame:
    """Two rows per response record (page_id, record): its metadata and its conversion record."""
    names = ["page_id", "record_type", "record_id", "refers_to", "target_uri", "source_digest", "block_digest",
             "content_length", "record"]
    kinds = [pa.int64(), *[pa.string()] * 6, pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):  # derived records of some pages at a time
                made = [(p, *d) for p, r in rows(batch.slice(at, 500), "page_id", "record") for d in derive(r)]
                yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], k) for i, k in enumerate(kinds)], names)

    return pick(responses, "page_id", "record").mapInArrow(run, SCHEMA)
