"""WARC archives with revisit resolution (operator 3).

Archives are written by Spark's text writer: a row is a record's head and block, the line separator is the
blank line that ends a record, so each part file is a valid WARC 1.1 file (compressed as a whole). Payloads are
written by size classes, each with as many records to a file as keep its payloads below ``FILE_BYTES`` (a larger
payload has a file of its own), at most ``FILE_RECORDS``. Equal payloads are of one class, so each class is resolved
by itself and only the scan is repeated. Files are read as binary files, unpacked in portions, cut into records by
Content-Length and handed on in batches of at most ``BATCH_BYTES`` or one record.

Only headers are shuffled by payload digest to find each group's original; a page joins the original of its
digest (one row per digest, so AQE can split a digest that holds a third of all pages) and is written either
whole or, as a revisit, without payload. After reading, revisits join the originals they refer to.

Defined results: null html is an empty payload, and equal empty payloads are revisits too; the largest id is
the original; rows repeated with the same id and payload are all originals; with null ids only, all are
originals; a null url gives no target header; control characters of a url are percent-encoded in the header;
an empty table gives an archive without records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fluxsieve.llm.common import BATCH_BYTES

FILE_RECORDS, FILE_BYTES, PORTION = 2000, 64 << 20, 1 << 20
#: How much larger the payloads of the next class are.
CLASS_STEP = 16
WARC_DATE = "2026-01-01T00:00:00Z"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: five hex digits are 20 bits, four base32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), HEX32, BASE32)


def records(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest of every page."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    return pages.select("page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias(
        "payload_bytes"), base32_sha1(F.encode(payload, "UTF-8")).alias("payload_digest"))


def originals(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """payload_digest, original of every payload of at least ``least_bytes`` bytes: the largest page_id."""
    return headers.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(
        F.max("page_id").alias("original"))


def _record_id(page: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws(":", F.coalesce(page.cast("string"), F.lit("null")), digest))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _header_url(url: Column) -> Column:
    out = url
    for code in [*range(32), 127]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(url.rlike(r"[\x00-\x1F\x7F]"), out).otherwise(url)


def classes(file_records: int = FILE_RECORDS, file_bytes: int = FILE_BYTES) -> list[tuple[int, int | None, int]]:
    """(least payload bytes, bytes below which the class ends or None, records to a file) of every size class."""
    out, least, end, records_each = [], 0, file_bytes // file_records + 1, file_records
    while records_each > 1:
        out.append((least, end, records_each))
        least, end = end, end * CLASS_STEP
        records_each = max(1, file_bytes // end)
    return [*out, (least, None, 1)]


def write(pages: DataFrame, path: str, least_bytes: int = 0, file_records: int = FILE_RECORDS,
          file_bytes: int = FILE_BYTES) -> None:
    """Write one record per page below ``path``; payloads of equal bytes are stored once."""
    size = F.octet_length(F.coalesce(F.col("html"), F.lit("")))
    (_, small, _), *larger = classes(file_records, file_bytes)
    number = F.lit(0)
    for i, (least, _, _) in enumerate(larger, 1):
        number = F.when(size >= least, i).otherwise(number)
    present = {r["k"] for r in pages.groupBy(number.alias("k")).count().collect()}
    bodies(pages.where(size < small), least_bytes, None, path + "/class-0", file_records)
    for i, (least, end, each) in enumerate(larger, 1):
        if i in present:
            own = pages.where(size >= least) if end is None else pages.where((size >= least) & (size < end))
            bodies(own, least_bytes, "response", f"{path}/class-{i}", each)
    if present - {0}:
        bodies(pages.where(size >= small), least_bytes, "revisit", path + "/revisits", file_records)


def bodies(pages: DataFrame, least_bytes: int, kind: str | None, path: str, file_records: int) -> None:
    """Write the records of one kind, or of both, for pages that hold all copies of their payloads."""
    found = records(pages)
    rows = found.join(originals(found.select("page_id", "payload_bytes", "payload_digest"), least_bytes),
                      "payload_digest", "left")
    original = F.coalesce("original", "page_id")
    first = F.col("page_id").eqNullSafe(original)
    if kind:
        rows = rows.where(first if kind == "response" else ~first)
    digest = F.concat(F.lit("sha1:"), F.col("payload_digest"))
    http = F.concat(F.lit(HTTP_HEAD + "Content-Length: "), F.col("payload_bytes"), F.lit("\r\n\r\n"))
    length = F.octet_length(http) + F.when(first, F.col("payload_bytes")).otherwise(0)
    revisit = lambda value: F.when(~first, value)
    head = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.when(first, "response").otherwise("revisit")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("payload_digest"))),
        _line("WARC-Date", F.lit(WARC_DATE)), _line("WARC-Target-URI", _header_url(F.col("url"))),
        _line("WARC-Payload-Digest", digest), _line("X-Page-ID", F.col("page_id").cast("string")),
        _line("WARC-Profile", revisit(F.lit(PROFILE))),
        _line("WARC-Refers-To", revisit(_record_id(original, F.col("payload_digest")))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", length.cast("string")), F.lit("\r\n"))
    body = F.concat(head, http, F.when(first, F.col("payload")).otherwise(""))
    rows.select(body.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", file_records).text(path)


def _unpacked(content: bytes):
    """The bytes of an archive, plain or of any number of gzip members, in portions."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    at, member = 0, zlib.decompressobj(wbits=47)
    rest = b""
    while rest or at < len(content):
        if not rest:
            rest, at = content[at:at + PORTION], at + PORTION
        found = member.decompress(rest, PORTION)
        rest = member.unconsumed_tail
        if member.eof:
            rest, member = member.unused_data, zlib.decompressobj(wbits=47)
        if found:
            yield found
    yield member.flush()


def _parse(portions):
    """(headers, payload) of each record of one archive that comes in portions."""
    held, at, more = bytearray(), 0, True

    def until(enough) -> bool:
        """Hold more of the archive until ``enough()``; whether that came about."""
        nonlocal more, at
        while more and not enough():
            part = next(portions, None)
            more = part is not None
            if more:
                del held[:at]
                at = 0
                held.extend(part)
        return enough()

    while until(lambda: len(held) > at):
        if not until(lambda: held.find(b"\r\n\r\n", at) >= 0):
            raise ValueError(f"WARC headers without an end: {bytes(held[at:at + 40])!r}")
        end = held.index(b"\r\n\r\n", at)
        lines = held[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:40]!r}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        head, size = end + 4 - at, int(headers["Content-Length"])
        if not until(lambda: len(held) >= at + head + size):
            raise ValueError(f"block of {headers.get('WARC-Record-ID')} is cut off")
        block = bytes(held[at + head:at + head + size])
        until(lambda: len(held) >= at + head + size + 4)  # the blank line that ends the record
        at += head + size + 4
        yield headers, block[block.index(b"\r\n\r\n") + 4:]


RECORD = ("page_id long, record_id string, record_type string, refers_to_record string, url string, "
          "payload_digest string, payload_bytes long, payload binary")


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives below ``path``; a payload that differs from its digest is an error."""

    names = ["page_id", "record_id", "record_type", "refers_to_record", "url", "payload_digest", "payload_bytes", "payload"]
    kinds = [pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def parse(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for h, payload in _parse(_unpacked(content.as_py())):
                    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    whole = h["WARC-Type"] == "response"
                    if whole and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"payload of {h['WARC-Record-ID']} differs from its digest")
                    page, own = h.get("X-Page-ID"), payload if whole and payloads else None
                    if rows and held + len(own or b"") > BATCH_BYTES:
                        yield table(rows)
                        rows, held = [], 0
                    rows.append((page and int(page), h["WARC-Record-ID"], h["WARC-Type"], h.get("WARC-Refers-To"),
                                 h.get("WARC-Target-URI"), digest, len(payload) if whole else None, own))
                    held += len(own or b"")
                if rows:
                    yield table(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse, RECORD)


def resolve(found: DataFrame) -> DataFrame:
    """Every record with the size of its full payload and, for revisits, the page it refers to."""
    whole = found.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_record")).agg(
        F.first("page_id").alias("refers_to"), F.first("payload_bytes").alias("_bytes"))
    return found.join(whole, "refers_to_record", "left").select(
        "page_id", "url", "record_type", "refers_to", "payload_digest",
        F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"))
