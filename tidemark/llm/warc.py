"""Derived WARC records (operator 7).

From every ``response`` record the builder makes

* a ``metadata`` record (``application/warc-fields``): the status line and all
  header fields of the response as it came, its digests and lengths, the
  character set that was used, and the id of the conversion record;
* a ``conversion`` record (``text/plain``): the text that the page shows, for
  responses of status 2xx whose content is HTML or text.

Both carry ``WARC-Refers-To`` (the response's record id), its target URI and
date, and ``WARC-Block-Digest``.  Texts are made from the body as its author wrote
it: chunks are put together and gzip, deflate and zstd are undone; digests and
lengths are those of the bytes as they came.  Ids are derived from the response's id, so a
run that is repeated gives the same records.  ``write`` stores records as WARC
files through Spark's text writer.

Work is per record, in tasks, without any shuffle, so neither hot hosts nor
copies matter.

Defined cases: a null or empty response is taken as status 200 with an empty
body of unknown type and gets a metadata record only; a response without an
empty line after its header is all header; a header field without a value is
kept with the empty one; a body that is cut off gives what it holds, one in an
unknown coding, or that doesn't follow its coding, no text; an unknown or wrong character set
falls back to UTF-8, bytes that don't decode become U+FFFD; null keys, URIs
and dates are carried (left out of headers); repeated rows give repeated
records with equal ids; an empty table gives an empty table; other columns are
left out; long bodies are converted whole.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_columns, read
from tidemark.llm.markup import visible_text

#: Date of records whose capture time is not known.
NO_DATE = "1970-01-01T00:00:00Z"
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:x-derived-records")
_CHARSET = re.compile(r"""charset\s*=\s*["']?([A-Za-z0-9._:-]+)""")


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, chr(0).join(parts))}>"


def parse_response(content: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, header fields in order (folded lines joined) and body."""
    head, gap, body = content.partition(b"\r\n\r\n")
    bare = content.partition(b"\n\n")
    if len(bare[0]) < len(head):
        head, gap, body = bare
    lines = head.decode("latin-1").replace("\r\n", "\n").split("\n")
    fields: list[tuple[str, str]] = []
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and fields:
            fields[-1] = (fields[-1][0], f"{fields[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            fields.append((name.strip(), value.strip()))
    return lines[0].strip(), fields, body


def _chunks(body: bytes) -> bytes:
    """A chunked body put together; what doesn't follow the form ends it."""
    out, at = [], 0
    while (end := body.find(b"\n", at)) >= 0:
        size = re.match(rb"\s*([0-9A-Fa-f]+)\s*(?:;|\r?$)", body[at:end])
        if not size or not (n := int(size[1], 16)):
            break
        out.append(body[end + 1 : end + 1 + n])
        at = end + 1 + n
        at += 2 if body[at : at + 2] == b"\r\n" else body[at : at + 1] == b"\n"
    return b"".join(out) if out or re.match(rb"\s*0+\s*(?:;|\r?\n)", body) else body


def _inflated(body: bytes, coding: str) -> bytes:
    """A body without its content coding; a cut-off body gives what it holds."""
    if coding == "zstd":
        return zstandard.ZstdDecompressor().decompressobj().decompress(body)
    if coding == "deflate":  # with or without the frame that belongs to it
        try:
            return zlib.decompressobj().decompress(body)
        except zlib.error:
            return zlib.decompressobj(-zlib.MAX_WBITS).decompress(body)
    out = []
    while body:  # members of gzip one after the other
        member = zlib.decompressobj(16 + zlib.MAX_WBITS)
        try:
            out.append(member.decompress(body))
        except zlib.error:
            if not out:
                raise
            break
        body = member.unused_data
    return b"".join(out)


def decoded(fields: list[tuple[str, str]], body: bytes) -> bytes | None:
    """The body as its author wrote it: without transfer and content codings, the
    last one first.  None where a coding isn't known or the bytes don't follow it."""
    told = lambda name: [c.strip().lower() for k, v in fields if k.lower() == name for c in v.split(",")]
    for coding in [*told("content-encoding"), *told("transfer-encoding")][::-1]:
        if coding == "chunked":
            body = _chunks(body)
        elif coding in ("gzip", "x-gzip", "deflate", "zstd"):
            # a crawler may have kept the header and stored the plain body
            if coding.endswith("gzip") and body[:2] != b"\x1f\x8b":
                continue
            try:
                body = _inflated(body, coding)
            except (zlib.error, zstandard.ZstdError):
                return None
        elif coding not in ("", "identity"):
            return None
    return body


def to_text(fields: list[tuple[str, str]], body: bytes) -> tuple[str, str]:
    """The character set used and the plain text of a body."""
    kind = next((v for k, v in fields if k.lower() == "content-type"), "text/html")
    named = _CHARSET.search(kind) or _CHARSET.search(body[:2048].decode("latin-1"))
    try:
        charset = codecs.lookup(named[1]).name if named else "utf-8"
        text = body.decode(charset, "replace")
    except (LookupError, UnicodeError):
        charset = "utf-8"
        text = body.decode("utf-8", "replace")
    if "html" not in kind.lower() and "xml" not in kind.lower():
        return charset, text
    return charset, visible_text(text.removeprefix("\ufeff"))


def _record(kind: str, ident: str, refers: str | None, uri: str | None, date: str | None, content_type: str, block: str):
    data = block.encode("utf-8", "surrogatepass")
    told = digest(data)
    headers = [("WARC-Type", kind), ("WARC-Record-ID", ident), ("WARC-Date", date or NO_DATE), ("WARC-Target-URI", uri),
               ("WARC-Refers-To", refers), ("WARC-Block-Digest", told), ("Content-Type", content_type),
               ("Content-Length", str(len(data)))]
    header = "WARC/1.1\r\n" + "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in headers if v is not None)
    return kind, ident, refers, uri, date or NO_DATE, content_type, len(data), told, header, block


RECORD = ["record_type", "record_id", "refers_to", "target_uri", "date", "content_type", "content_length",
          "block_digest", "header", "block"]


def derivatives(ident: str | None, uri: str | None, date: str | None, content: bytes | None) -> list[tuple]:
    """The records derived from one response."""
    content = bytes(content or b"")
    status, fields, body = parse_response(content) if content else ("", [], b"")
    ident = ident or record_id("response", uri or "", digest(content))
    code = re.match(r"HTTP/\S+\s+(\d{3})", status)
    kind = next((v for k, v in fields if k.lower() == "content-type"), "")
    out, conversion = [], None
    charset = None
    if body and (not code or code[1][0] == "2") and re.match(r"\s*(text/|application/(xhtml\+)?xml|$)", kind, re.I):
        plain = decoded(fields, body)
        if plain:
            charset, text = to_text(fields, plain)
            conversion = record_id("conversion", ident)
            out.append(_record("conversion", conversion, ident, uri, date, "text/plain; charset=utf-8", text))
    told = [("source-record-id", ident), ("source-block-digest", digest(content)), ("source-payload-digest", digest(body)),
            ("source-content-length", str(len(content))), ("source-payload-length", str(len(body))),
            ("source-status", status or None), *((f"source-header-{k.lower()}", v) for k, v in fields),
            ("charset", charset), ("conversion-record-id", conversion)]
    block = "".join(f"{k}: {v}\r\n" for k, v in told if v is not None)
    out.insert(0, _record("metadata", record_id("metadata", ident), ident, uri, date, "application/warc-fields", block))
    return out


def derive(responses: DataFrame, key: str, record: str = "record_id", uri: str = "target_uri", date: str = "date",
           content: str = "content") -> DataFrame:
    """(key, record columns): the records derived from response records, whose
    ``content`` is the HTTP response in bytes."""
    schema = T.StructType(
        [responses.select(key).schema[0]]
        + [T.StructField(c, T.LongType() if c == "content_length" else T.StringType()) for c in RECORD]
    )

    def make():
        def step(columns):
            for at in range(0, len(columns[0]) if columns else 0, 64):
                rows = [
                    (k, *r)
                    for k, *response in zip(*(c[at : at + 64] for c in columns), strict=True)
                    for r in derivatives(*response)
                ]
                yield [list(c) for c in zip(*rows, strict=True)]

        return step

    return map_columns(responses.select(key, record, uri, date, F.col(content).cast("binary")), schema, make)


def write(records: DataFrame, path: str, compression: str = "gzip", software: str = "tidemark") -> None:
    """Records as WARC files, one for each partition, each begun by a ``warcinfo``
    record; two line ends close a record, which is what the writer puts after
    each row.  With gzip a file is one member, to be read from its beginning;
    with ``compression="none"`` records can be read at their places."""
    told = records.select(F.concat("header", F.lit("\r\n"), "block").alias("value"))
    block = f"software: {software}\r\nformat: WARC File Format 1.1\r\n"

    def begun(batches):
        first = True
        for batch in batches:
            if first and batch.num_rows:
                part = record_id("warcinfo", path, str(TaskContext.get().partitionId()))
                header = _record("warcinfo", part, None, None, None, "application/warc-fields", block)[-2]
                yield pa.RecordBatch.from_arrays([pa.array([f"{header}\r\n{block}"])], ["value"])
                first = False
            yield batch

    told = told.mapInArrow(begun, "value string")
    told.write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", date: str = NO_DATE) -> DataFrame:
    """Response records of a table of pages, as a crawler would have kept them
    (status 200, HTML in UTF-8)."""
    body = F.coalesce(F.col(html), F.lit(""))
    size = F.octet_length(body).cast("string")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n\r\n")
    )
    h = F.sha2(F.concat_ws("\u0000", F.col(key).cast("string"), F.col(url), body).cast("binary"), 256)
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return pages.select(
        F.col(key),
        F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
        F.col(url).alias("target_uri"),
        F.lit(date).alias("date"),
        F.concat(head, body).cast("binary").alias("content"),
    )


def q_op7_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every row of ``pages``."""
    return derive(responses(read(spark, sf_dir, "pages")), "page_id")


QUERIES = {"op7_warc_derivatives": q_op7_warc_derivatives}
