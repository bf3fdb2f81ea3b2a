r"""WARC derivatives: responses become linked metadata and plain-text conversion records.

`responses` frames pages as WARC/1.1 response records. `derive` reads such records and makes two of each: a metadata
record (JSON: the source's headers, its HTTP headers and digests, title, language and links) and a conversion record
(the visible text). Both name the response in WARC-Refers-To, keep its target, date and payload digest, and have ids
that follow from the response's; the conversion names the metadata record in WARC-Concurrent-To.

`write` and `read` keep records in files: each record is followed by two line breaks, as the format asks for.

Scale: a record is made from one response alone, so nothing is shuffled; files are written and committed by Spark and
read with its binary reader, in pieces of FILE_BYTES.

Edge cases: a null page is an empty payload; a null address leaves the target header out; control characters in an
address are percent-encoded; equal rows make equal records; markup that never ends is taken as text or skipped to the
end, in time proportional to its length; an empty table gives no records. A damaged record raises an error.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION, END = b"WARC/1.1\r\n", b"\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
FILE_BYTES = 64_000_000

_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*+)>""")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-a-zA-Z0-9_:.]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_BLOCKS = frozenset("address article aside blockquote br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th title tr ul".split())
_SKIPPED = frozenset(("script", "style", "noscript", "template"))


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(chr(0).join(parts).encode()).digest()[:16], version=5)}>"


def pack(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record without the two line breaks behind it."""
    lines = [f"{k}: {v}\r\n" for k, v in headers if v is not None]
    return VERSION + "".join(lines).encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.decode("utf-8", "replace").split("\r\n") if ":" in line)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def unpack(data: bytes, offset: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers with names in lower case, block, offset behind the block)."""
    end = data.find(b"\r\n\r\n", offset)
    if not data.startswith(VERSION, offset) or end < 0:
        raise ValueError(f"no WARC record at {offset}")
    headers = _fields(data[offset + len(VERSION) : end])
    start = end + 4
    stop = start + int(headers["content-length"])
    if stop > len(data):
        raise ValueError(f"record at {offset}: cut off")
    return headers, data[start:stop], stop


def _address(url: str | None) -> str | None:
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)


def response(page_id: int | None, url: str | None, page: str | None, date: str = DATE) -> bytes:
    body = (page or "").encode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body
    return pack(
        [
            ("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", str(page_id), url or "", digest(body))),
            ("WARC-Date", date), ("WARC-Target-URI", _address(url)), ("WARC-Payload-Digest", digest(body)),
            ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/http; msgtype=response"),
        ],
        block,
    )


def _clean(text: str) -> str:
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def extract(page: str) -> dict:
    """{text, title, lang, links} of a page; text has a line for each block, without white space around it."""
    lower, out, title, links, lang, at, n = None, [], None, [], None, 0, len(page)
    title_from = None
    while at < n:
        begin = page.find("<", at)
        if begin < 0:
            out.append(page[at:])
            break
        out.append(page[at:begin])
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), begin):
            end = page.find(">", begin)
            at = n if end < 0 else end + 1
            continue
        tag = _TAG.match(page, begin)
        if not tag:
            out.append("<")
            at = begin + 1
            continue
        at, name, closing = tag.end(), tag.group(2).lower(), tag.group(1) == "/"
        if name in _SKIPPED and not closing:
            lower = page.lower() if lower is None else lower
            if len(lower) != n:
                lower = re.sub("[A-Z]", lambda m: m.group().lower(), page)
            end = lower.find(f"</{name}", at)
            at = n if end < 0 else end
        elif name == "a" and not closing or name == "html" and not closing:
            found = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(tag.group(3))}
            if name == "a" and "href" in found:
                links.append(found["href"])
            if name == "html":
                lang = lang or found.get("lang")
        elif name == "title":
            if closing and title_from is not None and title is None:
                title = _clean(html.unescape("".join(out[title_from:]).replace("\0", " "))).replace("\n", " ")
            title_from = len(out)
        if name in _BLOCKS:
            out.append("\0")
    text = html.unescape("".join(out).replace("\n", " ").replace("\0", "\n"))
    return {"text": _clean(text), "title": title, "lang": lang, "links": links}


def derivatives(record: bytes) -> list[tuple[list[tuple[str, str | None]], bytes]]:
    """(headers, block) of the metadata and the conversion record of a response record."""
    headers, block, _ = unpack(record)
    head, _, body = block.partition(b"\r\n\r\n")
    status, _, lines = head.partition(b"\r\n")
    found = extract(body.decode("utf-8", "replace"))
    source, target, date = headers["warc-record-id"], headers.get("warc-target-uri"), headers.get("warc-date")
    ids = record_id("metadata", source), record_id("conversion", source)
    text = found.pop("text").encode()
    payload = {"source": headers, "http": {"status": status.decode("utf-8", "replace"), "headers": _fields(lines)},
               "payload_digest": digest(body), "intact": digest(body) == headers.get("warc-payload-digest"),
               "conversion": ids[1], "html": found}
    meta = json.dumps(payload, ensure_ascii=False, sort_keys=True).encode()

    def fields(kind: str, own: str, with_: str | None, block: bytes, type_: str) -> list[tuple[str, str | None]]:
        return [
            ("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Date", date), ("WARC-Refers-To", source),
            ("WARC-Concurrent-To", with_), ("WARC-Target-URI", target),
            ("WARC-Refers-To-Payload-Digest", headers.get("warc-payload-digest")), ("WARC-Block-Digest", digest(block)),
            ("Content-Type", type_),
        ]

    return [
        (fields("metadata", ids[0], None, meta, "application/json"), meta),
        (fields("conversion", ids[1], ids[0], text, "text/plain; charset=utf-8"), text),
    ]


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", date: str = DATE) -> DataFrame:
    """(key, record): a response record for each page."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [response(*row, date) for row in zip(*(batch.column(c).to_pylist() for c in ("key", "url", "page")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(made, pa.binary())], names=["key", "record"])

    rows = pages.select(pages[key].alias("key"), pages[url].alias("url"), pages[page].alias("page"))
    return rows.mapInArrow(run, f"key {pages.schema[key].dataType.simpleString()}, record binary")


_MADE = ("warc_type", "record_id", "refers_to", "concurrent_to", "target_uri", "source_digest", "block_digest")


def derive(records: DataFrame) -> DataFrame:
    """(key, warc_type, record_id, refers_to, concurrent_to, target_uri, source_digest, block_digest, record)."""
    names = ("WARC-Type", "WARC-Record-ID", "WARC-Refers-To", "WARC-Concurrent-To", "WARC-Target-URI", "WARC-Refers-To-Payload-Digest", "WARC-Block-Digest")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                keys, rows = [], []
                for key, record in zip(part.column("key").to_pylist(), part.column("record"), strict=True):
                    for headers, block in derivatives(record.as_py()):
                        fields = dict(headers)
                        keys.append(key)
                        rows.append((*(fields[n] for n in names), pack(headers, block)))
                *fields, made = zip(*rows, strict=True)
                columns = [pa.array(keys, part.column("key").type), *(pa.array(f, pa.string()) for f in fields), pa.array(made, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", *_MADE, "record"])

    kind = records.schema["key"].dataType.simpleString()
    return records.mapInArrow(run, f"key {kind}, " + ", ".join(f"{c} string" for c in _MADE) + ", record binary")


def write(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Writes records as WARC files of about `file_bytes`."""
    most = max(1, file_bytes // 20_000)
    rows = records.select(F.col("record").cast("string"))
    rows.write.option("lineSep", END.decode()).option("maxRecordsPerFile", most).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, record) of every record in the files."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                data, offset, rows = content.as_py(), 0, []
                while offset < len(data):
                    stop = unpack(data, offset)[2]
                    rows.append((file, offset, data[offset:stop]))
                    offset = stop + len(END)
                for at in range(0, len(rows), 500):
                    files, offsets, records = zip(*rows[at : at + 500], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(files), pa.array(offsets, pa.int64()), pa.array(records, pa.binary())], names=["file", "offset", "record"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, offset long, record binary")
