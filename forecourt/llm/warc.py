"""Legacy archive converter: ARC files in, WARC files out, with revisit records for equal payloads.

An ARC file opens with a ``filedesc://`` record whose second line names the version; the version fixes the fields of
every header line after it (1: url, address, date, type, length; 2: also result code, checksum, location, offset and
file name before the length; a url may hold spaces). A record's body is as long as its header line declares, whatever
bytes it holds. An HTTP response has a head of its own, told from the payload by the first empty line; any other body
(``dns:`` lookups and the like) is passed on whole as a ``resource``. The converter gives every record an identifier
(a UUID made from what names the record and its digest, so that a re-run task makes the same one; records without a
page number are named by url, date and offset), a ``WARC-Date`` from the 14-digit date, a type, and SHA-1 digests of
block and payload.

Of responses with equal payloads of at least ``min_bytes``, the one with the largest page_id is the response and the
others are revisits without a payload that refer to it; smaller payloads are all responses.

Archives are written by Spark's own text writer, to the shared folder: a row is one record as a gzip member of its
own, so that a reader can seek to it, and what the writer puts between rows is an empty member. Payloads are bytes of
any charset. Files to convert may be gzipped, by record or whole, or plain.

Defined cases: a null html is an empty payload; a null url is written as ``-`` and read back as null; white space in
a url is percent-encoded in headers; rows that repeat a page_id and payload give one record each, and a payload whose
pages all have a null page_id has responses only; an empty table gives archives without records. Further columns are
left alone. One archive file must stay below Spark's 2 GB for a binary value.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.common import query, table
from forecourt.session import fresh_path, materialize

#: Fixed values of the two ARC versions: the line that names the fields.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARRIVED = "20240101000000"
_SPACE = re.compile(r"[\s%\x00-\x20\x7f]")
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122
#: Records and bytes in one batch of a task's output.
ROWS, BYTES = 256, 4 << 20

RECORD = "page_id long, name string, url string, arrived string, content_type string, head binary, sha1 string, sha256 string, bytes long"


def sha1_32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def quoted(url: str | None) -> str:
    """A url without white space, controls or a bare ``%``; ``-`` for null, ``%`` for an empty one."""
    if url is None or url == "":
        return "-" if url is None else "%"
    return "%2D" if url == "-" else _SPACE.sub(lambda m: quote(m[0]), url)


def unquoted(url: str) -> str | None:
    return None if url == "-" else "" if url == "%" else unquote(url)


def said(data: bytes) -> str:
    """Header bytes as text: UTF-8, or Latin-1 where they are not that."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        return data.decode("latin-1")


# --- files ----------------------------------------------------------------


def member(data: bytes) -> bytes:
    """A gzip member, at the fastest level."""
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def write_archive(records: DataFrame, path: str) -> None:
    """Write ``records`` (value: a gzip member per row), an empty member after each."""
    text = records.select(F.col("value").cast("string").alias("value"))
    text.write.option("lineSep", member(b"").decode("latin-1")).option("encoding", "ISO-8859-1").text(path)


def binary_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def inflated(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, in pieces; those of any other file as they are."""
    at, packed = 0, None if bytes(data[:2]) == b"\x1f\x8b" else False
    while at < len(data):
        piece = bytes(data[at : at + step])
        at += len(piece)
        if packed is False:
            yield piece
            continue
        while piece:
            packed = packed or zlib.decompressobj(31)
            yield packed.decompress(piece)
            piece = packed.unused_data
            if packed.eof:
                packed = None


def batched(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """``rows`` in batches of up to ROWS rows and about BYTES bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if len(held) >= ROWS or size >= BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
VALUE = pa.schema([("value", pa.binary())])


def _schema(text: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in text.split(", ")])


class Cursor:
    """Lines and declared lengths out of a stream of pieces."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.buffer, self.at, self.before = pieces, bytearray(), 0, 0

    @property
    def offset(self) -> int:
        return self.before + self.at

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        del self.buffer[: self.at]
        self.before += self.at
        self.at = 0
        self.buffer += piece
        return True

    def upto(self, mark: bytes) -> bytes | None:
        """What stands before ``mark``, which is passed; None at the end."""
        seen = 0
        while (found := self.buffer.find(mark, self.at + seen)) < 0:
            seen = max(0, len(self.buffer) - self.at - len(mark) + 1)
            if not self._more():
                return None
        out = bytes(self.buffer[self.at : found])
        self.at = found + len(mark)
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) - self.at < n:
            if not self._more():
                raise ValueError(f"the archive ends {n - len(self.buffer) + self.at} bytes early")
        out = bytes(self.buffer[self.at : self.at + n])
        self.at += n
        return out


# --- ARC ------------------------------------------------------------------


def arc_records(pages: DataFrame, version: int) -> DataFrame:
    """ARC records, each partition opened by its file description."""
    fields = ARC_FIELDS[version]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        body = f"{version} 0 local\n{fields}\n"
        stand = "" if version == 1 else " 200 - - 0 pages.arc"

        def rows() -> Iterator[tuple]:
            yield (member(f"filedesc://pages.arc 0.0.0.0 {ARRIVED} text/plain{stand} {len(body)}\n{body}\n".encode()),)
            for batch in batches:
                for page, url, html in zip(*batch.columns):
                    page, html = page.as_py(), (html.as_py() or "").encode()
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {'' if page is None else page}\r\n\r\n".encode()
                    line = f"{quoted(url.as_py())} 0.0.0.0 {ARRIVED} text/html{stand} {len(head) + len(html)}\n".encode()
                    yield (member(b"".join((line, head, html, b"\n"))),)

        yield from batched(rows(), VALUE)

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, "value binary")


def arc_pages(data: bytes) -> Iterator[tuple]:
    """(page_id, name, url, date, content type, head, payload) of every record of one ARC file, after its description.

    ``head`` is None for a body that is no HTTP response; ``name`` is the page number, or url, date and offset.
    """
    read = Cursor(inflated(data))
    first = read.upto(b"\n")
    if first is None:
        return
    described = read.take(int(first.rsplit(b" ", 1)[1]))
    version = int(described.split(b" ", 1)[0])
    names = said(described.split(b"\n")[1].rstrip(b"\r")).split(" ")
    if names != ARC_FIELDS[version].split(" "):
        raise ValueError(f"unknown ARC fields: {names}")
    while True:
        offset = read.offset
        line = read.upto(b"\n")
        if line is None:
            rest = read.take(len(read.buffer) - read.at)
            if rest.strip():
                raise ValueError(f"the archive ends within a header line: {rest[:40]!r}")
            return
        if not line.strip():
            continue
        field = dict(zip(names, said(line.rstrip(b"\r")).rsplit(" ", len(names) - 1), strict=True))
        body = read.take(int(field["Archive-length"]))
        head, payload = None, body
        if body.startswith(b"HTTP/"):
            end = re.search(rb"\r?\n\r?\n", body)
            head, payload = (body, b"") if end is None else (body[: end.start()], body[end.end() :])
        page = re.search(rb"(?m)^X-Page-Id: (-?\d+)\r?$", head) if head is not None else None
        page = int(page[1]) if page else None
        url, date = unquoted(field["URL"]), field["Archive-date"]
        yield page, f"{url} {date} {offset}" if page is None else str(page), url, date, field["Content-type"], head, payload


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record of the ARC files under ``path``: the columns of RECORD, and with ``payloads`` its payload, as bytes."""
    kind = RECORD + (", payload binary" if payloads else "")
    schema = _schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for value in batch.column(0):
                    for *named, head, payload in arc_pages(memoryview(value.as_buffer())):
                        digests = (hashlib.sha1(payload).hexdigest(), hashlib.sha256(payload).hexdigest(), len(payload))
                        yield (*named, head, *digests, payload) if payloads else (*named, head, *digests)

        yield from batched(rows(), schema)

    return binary_files(spark, path).mapInArrow(run, kind)


# --- WARC -----------------------------------------------------------------


def judged(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Per distinct payload that several responses share: its SHA-1, SHA-256 and length, and the largest page_id of them."""
    key = records.where((F.col("bytes") >= min_bytes) & F.col("head").isNotNull()).select("page_id", "sha1", "sha256", "bytes")
    return key.groupBy("sha1", "sha256", "bytes").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")


def warc_records(spark: SparkSession, arc_path: str, min_bytes: int = 0) -> DataFrame:
    """WARC records for the ARC files under ``arc_path``.

    A first pass reads digests and lengths only. Its repeats are written, so that Spark knows their size: while few
    payloads repeat, the records need no shuffle.
    """
    repeats = materialize(judged(read_arc(spark, arc_path, payloads=False), min_bytes), "warc-repeats")
    met = read_arc(spark, arc_path).join(repeats, ["sha1", "sha256", "bytes"], "left")
    other = F.col("head").isNotNull() & (F.col("first") != F.coalesce("page_id", F.col("first") - 1))
    refers = F.when(other, F.col("first"))
    rows = met.select("page_id", "name", "url", "arrived", "content_type", "head", F.when(refers.isNull(), F.col("payload")).alias("payload"), refers.alias("refers_to"), "sha1", "bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(((member(warc_record(*(v.as_py() for v in row))),) for batch in batches for row in zip(*batch.columns)), VALUE)

    return rows.mapInArrow(run, "value binary")


def warc_record(page, name, url, arrived, content_type, head, payload, refers_to, sha1, size) -> bytes:
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    block = (payload or b"") if head is None else b"".join((head, b"\r\n\r\n", payload or b""))
    at = arrived + "19700101000000"[len(arrived) :]
    fields = [
        "WARC/1.0",
        f"WARC-Type: {'resource' if head is None else 'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{record_id(name, digest)}>",
        f"WARC-Date: {at[:4]}-{at[4:6]}-{at[6:8]}T{at[8:10]}:{at[10:12]}:{at[12:14]}Z",
        f"WARC-Target-URI: {quoted(url)}",
        f"Content-Type: {content_type if head is None else 'application/http; msgtype=response'}",
        f"WARC-Block-Digest: sha1:{sha1_32(block)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
        f"X-Page-Id: {'' if page is None else page}",
    ]
    if refers_to is not None:
        fields.append("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")
        fields.append(f"WARC-Refers-To: <urn:uuid:{record_id(str(refers_to), digest)}>")
        fields.append(f"X-Refers-To-Page-Id: {refers_to}")
    fields.append(f"Content-Length: {len(block)}")
    return b"".join(("\r\n".join(fields).encode(), b"\r\n\r\n", block, b"\r\n\r\n"))


def record_id(name: str, digest: str) -> uuid.UUID:
    return uuid.uuid5(_NAMESPACE, f"{name} {digest}")


def warc_rows(data: bytes) -> Iterator[tuple]:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of every record of one WARC file."""
    read = Cursor(inflated(data))
    while (head := read.upto(b"\r\n\r\n")) is not None:
        version, *lines = said(head).split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        field = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
        block = read.take(int(field["Content-Length"]))
        if f"sha1:{sha1_32(block)}" != field["WARC-Block-Digest"]:
            raise ValueError(f"a damaged block: {field['WARC-Record-ID']}")
        read.take(4)
        kind, refers = field["WARC-Type"], field.get("X-Refers-To-Page-Id")
        payload = block if kind == "resource" else block.split(b"\r\n\r\n", 1)[1] if kind == "response" else None
        digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
        if payload is not None and sha1_32(payload) != digest:
            raise ValueError(f"a damaged payload: {field['WARC-Record-ID']}")
        size = int(field["X-Payload-Length"]) if payload is None else len(payload)
        page = field["X-Page-Id"]
        yield int(page) if page else None, unquoted(field["WARC-Target-URI"]), size, digest, kind, int(refers) if refers else None, payload


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Every record of the WARC files under ``path``, checked against its digests; ``payloads`` adds the payload, as bytes."""
    kind = READ + (", payload binary" if payloads else "")
    schema = _schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row if payloads else row[:-1] for batch in batches for value in batch.column(0) for row in warc_rows(memoryview(value.as_buffer())))
        yield from batched(rows, schema)

    return binary_files(spark, path).mapInArrow(run, kind)


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_bytes: int = 0) -> None:
    """ARC files under ``arc_path`` to WARC files under ``warc_path``."""
    write_archive(warc_records(spark, arc_path, min_bytes), warc_path)


# The same rows in SQL; base 32 is five bits at a time of the digest's hexadecimal digits.
_BITS = "array_to_string(list_transform(range(1, 41), lambda i: right(bin(16 + strpos('0123456789abcdef', h[i]) - 1), 4)), '')"
_VALUE = " + ".join(f"{1 << (4 - k)} * (b[5 * i + {k + 1}])::int" for k in range(5))
SQL = f"""
with p as (select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as h from pages),
g as (select payload, max(page_id) as first from p group by payload),
d as (select h, {_BITS} as b from (select distinct h from p)),
e as (select h, array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[{_VALUE} + 1]), '') as digest from d)
select page_id, strlen(payload)::bigint as payload_bytes, digest as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type, case when page_id <> first then first end as refers_to
from p join g using (payload) join e using (h)
"""


@query("op7_warc", SQL)
def op7(spark, folder):
    """Pages go to ARC files of both versions, these through the converter, and the WARC files are read back."""
    pages = table(spark, folder, "pages")
    root = fresh_path(spark, "warc")
    odd = F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(2)) == 1
    for version, part in ((1, odd), (2, ~odd)):
        write_archive(arc_records(pages.where(part), version), f"{root}/arc/version={version}")
    convert(spark, f"{root}/arc/*", f"{root}/warc")
    return read_warc(spark, f"{root}/warc").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
