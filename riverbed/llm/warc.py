"""WARC archives: writer with revisit records, and a salvage reader.

Writing. Every page becomes one record, compressed as a gzip member of its
own. Of pages with equal payloads the one with the largest id is written as
``response`` and the others as ``revisit`` records that refer to it. Payload
digests are grouped by narrow rows; payloads cross the network once, beside
their role. Files go through Spark's text sink, so they can live on any file
system Spark writes to: a member is one value, and the line separator is an
empty gzip member, which decodes to nothing.

Reading. Each file is scanned from its start. A record is taken only if it
passes all checks (version line, Content-Length, end of record, block and
payload digests). After a failed check the reader searches for the next valid
member or version line and goes on there; the bytes between are logged as a
``gap`` row (file, offset, length, reason) and nothing else is lost. Gzip members
and plain records may be mixed in a file, and a member may hold any number of
records: its inflated bytes are searched in the same way, so a gap inside a
member is logged too (``inside``: its place in the inflated bytes; ``offset`` and
``length`` are the member's). A member whose data end early or fail its CRC gives
the records before the damage, and the search goes on behind its start.

A file is one task and must be under 2 GB, as Spark hands it over whole. The
writer rolls files by bytes (``file_bytes``): pages of up to ``LARGE_PAGE`` bytes
go so many to a file that the file cannot outgrow it, larger ones by the size of
the largest.

Defined cases: a NULL payload is empty; NULL urls give no target header and
control characters in urls are percent-encoded; NULL page ids are written as
an empty id and sort below all others; repeated rows are records of their own
(record ids carry the row id); an empty table gives an archive without
records, and an empty or wholly unreadable file gives at most one gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.llm.common import stage_table
from riverbed.session import scratch_path

VERSION = b"WARC/1.1"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A gzip member without content.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
GZIP_MAGIC = b"\x1f\x8b\x08"
FEED_BYTES = 1 << 14


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def make_member(body: bytes, level: int = 4) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(body) + z.flush()


def make_record(record_id: bytes, kind: bytes, payload: bytes, extra: list[tuple[bytes, bytes]],
                digest: str) -> bytes:
    head = [VERSION, b"WARC-Type: " + kind, b"WARC-Record-ID: <" + record_id + b">",
            b"WARC-Date: 1970-01-01T00:00:00Z", b"Content-Type: text/html; charset=utf-8",
            b"WARC-Payload-Digest: sha1:" + digest.encode(),
            b"WARC-Block-Digest: sha1:" + (digest if kind == b"response" else sha1_base32(payload)).encode(),
            *[k + b": " + v for k, v in extra], b"Content-Length: %d" % len(payload)]
    return b"\r\n".join(head) + b"\r\n\r\n" + payload + b"\r\n\r\n"


def _header_value(s: str) -> bytes:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: "%%%02X" % ord(m[0]), s).encode()


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for rid, page, url, html, top, top_page in zip(*(b.column(i) for i in range(6)), strict=True):
            payload = html.as_buffer().to_pybytes()
            rid, page, top, top_page = rid.as_py(), page.as_py(), top.as_py(), top_page.as_py()
            extra = [(b"X-Page-Id", b"" if page is None else b"%d" % page)]
            if url.is_valid:
                extra.append((b"WARC-Target-URI", _header_value(url.as_py())))
            digest, kind = sha1_base32(payload), b"response"
            if top != rid:
                kind, payload = b"revisit", b""
                extra += [(b"WARC-Profile", PROFILE), (b"WARC-Refers-To", b"<urn:page:%d>" % top),
                          (b"X-Refers-To-Page-Id", b"" if top_page is None else b"%d" % top_page)]
            out.append(make_member(make_record(b"urn:page:%d" % rid, kind, payload, extra, digest)))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])


LARGE_PAGE, FILE_BYTES, RECORD_BYTES = 64 << 10, 512 << 20, 4 << 10


def write_warc(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write ``pages`` (page_id, url, html; read from files) as WARC archives
    of at most about ``file_bytes`` (one page at least) below ``path``."""
    rows = pages.select(F.monotonically_increasing_id().alias("rid"),
                        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string"),
                        F.coalesce("html", F.lit("")).cast("binary").alias("html"))
    ids = rows.select("rid", "page_id", F.sha2("html", 256).alias("h"), F.sha1("html").alias("h1"),
                      F.octet_length("html").alias("n"))
    ids = stage_table(ids, "payload-ids")
    tops = ids.groupBy("h", "h1", "n").agg(F.max(F.struct("page_id", "rid")).alias("top"))
    roles = ids.join(tops, ["h", "h1", "n"]).select(
        F.col("rid").alias("role_rid"), F.col("top.rid").alias("top"), F.col("top.page_id").alias("top_page"))
    told = rows.join(roles, F.col("rid") == F.col("role_rid")).select(
        "rid", "page_id", "url", "html", "top", "top_page")
    url_bytes = F.coalesce(F.octet_length("url"), F.lit(0)) * 3  # percent-encoded at worst
    largest = rows.agg(F.max(F.octet_length("html") + url_bytes)).first()[0] or 0
    size = F.octet_length("html") + url_bytes
    parts = [(told, LARGE_PAGE)] if largest <= LARGE_PAGE else [
        (told.filter(size <= LARGE_PAGE), LARGE_PAGE), (told.filter(size > LARGE_PAGE), largest)]
    for part, most in parts:
        per_file = max(1, min(20_000, file_bytes // (most + RECORD_BYTES)))
        (part.mapInArrow(_members, "member binary").select(F.col("member").cast("string"))
         .write.mode("append").option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1")
         .option("maxRecordsPerFile", per_file).text(path))


# -- salvage reader -------------------------------------------------------------------
class Bad(Exception):
    pass


class Short(Bad):
    """The bytes end before the record does."""


def _parse_record(data: bytes, at: int) -> tuple[dict, bytes, int]:
    """The record that starts at ``at``: (headers, block, end)."""
    if data[at: at + 7] != b"WARC/1."[: len(data) - at] or data[at + 8: at + 10] != b"\r\n"[: max(0, len(data) - at - 8)]:
        raise Bad("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise Short("header not ended")
    head = {}
    for line in bytes(data[at:end]).split(b"\r\n")[1:]:
        k, colon, v = line.partition(b":")
        if not colon:
            raise Bad("malformed header")
        k = k.strip().lower()
        if k in head and k != b"warc-concurrent-to":  # two headers run together
            raise Bad("header field repeated")
        head[k] = v.strip()
    size = head.get(b"content-length", b"")
    if not size.isdigit():
        raise Bad("no content length")
    start, stop = end + 4, end + 4 + int(size)
    if stop + 4 > len(data):
        raise Short("content length does not meet the record's end")
    if data[stop: stop + 4] != b"\r\n\r\n":
        raise Bad("content length does not meet the record's end")
    block = bytes(data[start:stop])
    want = head.get(b"warc-block-digest", b"")
    if want[:5] == b"sha1:" and sha1_base32(block).encode() != want[5:]:
        raise Bad("block digest differs")
    want = head.get(b"warc-payload-digest", b"")
    if head.get(b"warc-type") == b"response" and want[:5] == b"sha1:" \
            and not head.get(b"content-type", b"").startswith(b"application/http") \
            and sha1_base32(block).encode() != want[5:]:
        raise Bad("payload digest differs")
    return head, block, stop + 4


_STARTS = re.compile(rb"\x1f\x8b\x08|WARC/1\.[0-9]\r\n")
_VERSIONS = re.compile(rb"WARC/1\.[0-9]\r\n")
VERSION_BYTES = 10
KEPT_BYTES = 16 << 20


def _member(data: bytes, at: int) -> Iterator[tuple]:
    """The records and gaps (start, end, headers or None, block, reason) of
    the member that starts at ``at``, by place in its inflated bytes, then one
    row (None, end in the file, None, None, what is wrong with the member). The
    bytes are inflated in steps, and those of records that are done are let go."""
    z, buf, base, pos = zlib.decompressobj(31), bytearray(), 0, 0
    end, error, gap, why = at, "", None, ""
    while True:
        done = bool(error) or z.eof or end >= len(data)
        while pos < len(buf):
            if len(buf) - pos <= 64 and not buf[pos:].strip(b"\r\n"):  # blank space between records
                if done and gap is None:
                    pos = len(buf)
                break
            try:
                head, block, stop = _parse_record(buf, pos)
            except Bad as e:
                if isinstance(e, Short) and not done:
                    break
                if gap is None:
                    gap, why = base + pos, str(e)
                nxt = _VERSIONS.search(buf, pos + 1)
                if nxt is None and not done:
                    pos = max(pos + 1, len(buf) - VERSION_BYTES)
                    break
                pos = nxt.start() if nxt else len(buf)
                continue
            if gap is not None:
                yield gap, base + pos, None, b"", why
                gap = None
            yield base + pos, base + stop, head, block, ""
            pos = stop
        if done:
            break
        del buf[:pos]
        base, pos = base + pos, 0
        size, before = FEED_BYTES, z.copy()
        while not error:
            try:
                buf += z.decompress(data[end: end + size])
                end = min(end + size, len(data))
            except zlib.error as e:
                if size > 1:  # a failed step gives nothing: take it byte by byte up to the damage
                    z, size = before, 1
                    continue
                error = "member: " + str(e).split(":")[-1].strip()
            if size > 1 or z.eof or end >= len(data):
                break
    if not error and not z.eof:
        error = "member cut short"
    if gap is not None and not error:
        yield gap, base + len(buf), None, b"", why
    yield None, end - len(z.unused_data), None, None, error


def _member_rows(data: bytes, at: int) -> tuple[Iterator[tuple], int, str, bool]:
    """(records and gaps, end, what is wrong, whether there are records) of a
    member. Large members are gone through twice rather than held."""
    kept, size, any_record, first_gap = [], 0, False, ""
    for row in _member(data, at):
        if row[0] is None:
            _, end, _, _, error = row
        else:
            any_record |= row[2] is not None
            first_gap = first_gap or row[4]
            size += len(row[3])
            if size <= KEPT_BYTES:
                kept.append(row)
    rows = kept if size <= KEPT_BYTES else (r for r in _member(data, at) if r[0] is not None)
    return iter(rows), end, error or ("" if any_record else first_gap), any_record


def _starts_here(data: bytes, at: int) -> tuple[Iterator[tuple], int, str, bool]:
    """What starts at ``at``, as ``_member_rows`` has it; a plain record is
    told by a start of -1."""
    if data[at: at + 3] == GZIP_MAGIC:
        return _member_rows(data, at)
    try:
        head, block, end = _parse_record(data, at)
    except Bad as e:
        return iter(()), at, str(e), False
    return iter([(-1, end, head, block, "")]), end, "", True


def salvage(data: bytes) -> Iterator[tuple]:
    """(offset, length, inside, headers, block, reason) of each record, and of
    each gap with headers None; together they cover the file but for empty
    members and blank space between records. ``inside`` is the place in a
    member's inflated bytes, None for plain records and gaps of the file; all
    records and gaps of one member share its offset and length."""
    at, gap, why = 0, None, ""
    while at < len(data):
        rows, end, error, any_record = _starts_here(data, at)
        if error and not any_record:
            if gap is None:
                if not data[at:].strip(b"\r\n"):
                    return
                gap, why = at, error
            nxt = _STARTS.search(data, at + 1)
            at = nxt.start() if nxt else len(data)
            continue
        if gap is not None:
            yield gap, at - gap, None, None, b"", why
            gap = None
        if error:  # good records before the damage; the next sound start ends what is lost
            nxt = _STARTS.search(data, at + 1)
            while nxt:
                _, _, wrong, some = _starts_here(data, nxt.start())
                if some or not wrong:
                    break
                nxt = _STARTS.search(data, nxt.start() + 1)
            end = nxt.start() if nxt else len(data)
        last = 0
        for inside, stop, head, block, reason in rows:
            yield at, end - at, None if inside < 0 else inside, head, block, reason
            last = stop
        if error:
            yield at, end - at, last, None, b"", error
        at = end
    if gap is not None:
        yield gap, len(data) - gap, None, None, b"", why


RECORDS = ("file string, offset bigint, length bigint, inside bigint, kind string, record_id string, page_id bigint, "
           "target_uri string, refers_to string, refers_to_page bigint, payload_bytes bigint, "
           "payload_digest string, reason string")


def read_warc(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """Records and gaps (kind ``gap``) of the archives below ``path``;
    payload_bytes and payload_digest are computed from the block read, for
    revisits the digest is the header's. ``payload`` adds the block."""
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                        ("inside", pa.int64()), ("kind", pa.string()), ("record_id", pa.string()), ("page_id", pa.int64()),
                        ("target_uri", pa.string()), ("refers_to", pa.string()),
                        ("refers_to_page", pa.int64()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("reason", pa.string()),
                        *([("payload", pa.binary())] if payload else [])])

    def rows(batches):
        number = lambda v: int(v) if v and v.lstrip(b"-").isdigit() else None
        text = lambda v: None if v is None else v.decode("utf-8", "replace")
        for b in batches:
            for name, content in zip(b.column(0), b.column(1), strict=True):
                name, out, held = name.as_py(), [], 0
                for off, size, inside, head, block, why in salvage(content.as_buffer().to_pybytes()):
                    if head is None:
                        out.append((name, off, size, inside, "gap", None, None, None, None, None, None, None, why,
                                    None))
                    else:
                        kind = text(head.get(b"warc-type"))
                        digest = (text(head.get(b"warc-payload-digest")) or "").removeprefix("sha1:") \
                            if kind == "revisit" else sha1_base32(block)
                        out.append((name, off, size, inside, kind, text(head.get(b"warc-record-id")),
                                    number(head.get(b"x-page-id")), text(head.get(b"warc-target-uri")),
                                    text(head.get(b"warc-refers-to")),
                                    number(head.get(b"x-refers-to-page-id")), len(block), digest, "",
                                    block if payload else None))
                        held += len(block) if payload else 0
                    if len(out) >= 5000 or held > 8 << 20:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=False)],
                            schema=schema)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=False)],
                        schema=schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(rows, RECORDS + (", payload binary" if payload else ""))


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write the pages, read the archives back and describe every record:
    page_id, payload_bytes, payload_digest, record_type, refers_to. A
    revisit's payload size is that of the response it refers to."""
    spark = pages.sparkSession
    path = scratch_path(spark, "llm/warc")
    write_warc(pages, path)
    got = stage_table(read_warc(spark, path).filter("kind IN ('response', 'revisit')"), "warc-records")
    full = got.filter("kind = 'response'").select(
        F.col("record_id").alias("full_id"), F.col("payload_bytes").alias("full_bytes"),
        F.col("payload_digest").alias("full_digest"))
    seen = got.filter("kind = 'revisit'").join(
        full, F.col("refers_to") == F.col("full_id"), "left")
    return (got.filter("kind = 'response'")
            .select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"),
                    F.lit(None).cast("bigint").alias("refers_to"))
            .unionByName(seen.select(
                "page_id", F.col("full_bytes").alias("payload_bytes"),
                F.col("full_digest").alias("payload_digest"), F.col("kind").alias("record_type"),
                F.col("refers_to_page").alias("refers_to"))))
