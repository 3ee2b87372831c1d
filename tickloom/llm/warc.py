"""Web archives: records written as gzip members by Spark's text writer, and a reader that salvages damaged files.

Writing. A record is one gzip member; members are separated by an empty member, which gzip readers skip. Bytes pass
through the text writer unchanged, so Spark's commit protocol covers the files and any store that Spark reaches will do.
Payloads are compressed before the shuffle that brings each page what it revisits.

Reading. Spark's text reader cuts files at every gzip magic number (or, for plain archives, at every ``WARC/1.``), so the
pieces are the places at which reading can resume. The pieces of a file go through one task in their order, one record
at a time. A record starts at a piece and is lengthened piece by piece while it is incomplete, as its bytes may hold the
magic number by chance. If its checks fail (gzip checksum and length, version line, header, block length, block digest),
the bytes up to the next piece that starts a valid record are logged as a gap.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import BATCH_ROWS, map_batches, rows_in
from tickloom.session import stored

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
#: Equal payloads of at least so many bytes are stored once.
REVISIT_BYTES = 100
#: A record that would be longer counts as damaged: a cell of a table holds no more. Whatever the writer makes of a cell is
#: shorter, so a lower limit, for archives from elsewhere, is the caller's to give.
RECORD_BYTES = (1 << 31) - 1
#: A header that has not ended after so many bytes counts as damaged, where the record's own end is not known.
HEADER_BYTES = 1 << 20
#: Payload bytes of an output batch, beyond which it is sent off.
BATCH_BYTES = 8 << 20
LEVEL = 4
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


EMPTY_MEMBER = member(b"")


def _labelled(digest: bytes) -> bytes:
    return b"sha256:" + base64.b32encode(digest).rstrip(b"=")


def _record_id(page: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"" if page is None else b"%d" % page)


def _line(value: str | None) -> bytes:
    """Header values are one line."""
    return " ".join((value or "").split()).encode("utf-8", "replace")


def record(page: int | None, url: str | None, size: int, digest: bytes, payload: bytes = b"", first: int | None = None) -> bytes:
    """A response record, or a revisit record of ``first``, which carries the HTTP header only; ``size`` and ``digest`` are
    of the full payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + payload
    lines = [
        b"WARC/1.1", b"WARC-Type: " + (b"response" if first is None else b"revisit"),
        b"WARC-Record-ID: " + _record_id(page), b"WARC-Target-URI: " + _line(url),
        b"WARC-Date: 1970-01-01T00:00:00Z", b"Content-Type: application/http; msgtype=response",
        b"WARC-Payload-Digest: " + _labelled(digest),
        b"WARC-Block-Digest: " + _labelled(hashlib.sha256(block).digest()),
    ]
    if first is not None:
        lines += [b"WARC-Refers-To: " + _record_id(first), b"WARC-Profile: " + PROFILE]
    return b"\r\n".join([*lines, b"Content-Length: %d" % len(block), b"", block]) + b"\r\n\r\n"


def _first_pages(pages: DataFrame, least: int) -> DataFrame:
    """``page_id, digest, first``: pages whose payload another page with a smaller id holds too.

    Only ids and digests are shuffled; both sides of the join are stored, so Spark can split a frequent payload there.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    slim = stored(
        pages.filter("page_id is not null").filter(F.octet_length("html") >= least)
        .select("page_id", F.unhex(F.sha2(payload, 256)).alias("digest")), "digests")
    firsts = stored(
        slim.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
        .filter("first < last").select("digest", "first"), "firsts")
    return stored(slim.join(firsts, "digest").filter("page_id > first").distinct(), "revisits")


def write_archives(pages: DataFrame, folder: str, least: int = REVISIT_BYTES) -> None:
    """One record per row of ``pages`` (``page_id, url, html``); a null html is an empty payload.

    Of equal payloads of at least ``least`` bytes the page with the smallest id is the response, the others revisit it.
    A page without id is a response, and so are repeated rows of the page with the smallest id.
    """

    def responses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, members = [], [], []
            for page, url, html in rows_in(batch, "page_id", "url", "html"):
                payload = (html or "").encode("utf-8", "replace")
                sizes.append(len(payload))
                digests.append(hashlib.sha256(payload).digest())
                members.append(member(record(page, url, sizes[-1], digests[-1], payload)))
            yield pa.record_batch([
                batch.column("page_id"), batch.column("url"), pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()), pa.array(members, pa.binary()),
            ], names=["page_id", "url", "bytes", "digest", "member"])

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("page_id", "url", "bytes", "digest", "member", "first")
        for batch in batches:
            out = [
                kept if first is None else member(record(page, url, size, digest, first=first))
                for page, url, size, digest, kept, first in rows_in(batch, *names)
            ]
            yield pa.record_batch([pa.array(out, pa.binary())], names=["member"])

    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    made = map_batches(rows, responses, "page_id bigint, url string, bytes bigint, digest binary, member binary")
    joined = made.join(_first_pages(rows, least), ["page_id", "digest"], "left")
    members = map_batches(joined.select("page_id", "url", "bytes", "digest", "member", "first"), final, "member binary")
    (
        members.select(F.col("member").cast("string").alias("value")).write
        .option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(folder)
    )


@dataclass
class Damage(Exception):
    reason: str
    #: So many bytes may make the record whole; 0 if none can.
    need: int = 0


def parse_record(data: bytes, header: int = HEADER_BYTES) -> tuple[dict[str, str], bytes, int]:
    """Header fields, block and length of the record at the start of ``data``; ``Damage`` if a check fails. Its header has
    at most ``header`` bytes."""
    if not data.startswith(VERSION):
        raise Damage("version line")
    end = data.find(b"\r\n\r\n", 0, header)
    if end < 0:
        raise Damage("header", len(data) + 1 if len(data) < header else 0)
    fields: dict[str, str] = {}
    for line in data[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damage("header")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    given = fields.get("content-length", "")
    if not (given.isascii() and given.isdigit()):
        raise Damage("content length")
    start, size = end + 4, int(given)
    if len(data) < start + size + 4:
        raise Damage("block length", start + size + 4)
    block = data[start:start + size]
    if data[start + size:start + size + 4] != b"\r\n\r\n":
        raise Damage("record end")
    _check("block digest", fields.get("warc-block-digest"), block)
    if fields.get("warc-type") == "response":
        _check("payload digest", fields.get("warc-payload-digest"), http_payload(fields, block)[1])
    return fields, block, start + size + 4


def digest_bytes(given: str | None) -> tuple[str, bytes] | None:
    """Algorithm and value of a digest field in hexadecimal or base 32; null for others."""
    name, _, value = (given or "").partition(":")
    length = {"sha256": 32, "sha1": 20}.get(name.lower())
    if length is None:
        return None
    try:
        found = bytes.fromhex(value) if len(value) == 2 * length else base64.b32decode(value.upper() + "=" * (-len(value) % 8))
    except (ValueError, binascii.Error):
        return None
    return (name.lower(), found) if len(found) == length else None


def _check(what: str, given: str | None, data: bytes) -> None:
    if not given:
        return
    known = digest_bytes(given)
    if known is None and given.lower().startswith(("sha256:", "sha1:")):
        raise Damage(what)
    if known and hashlib.new(known[0], data).digest() != known[1]:
        raise Damage(what)


def http_payload(fields: dict[str, str], block: bytes) -> tuple[int, bytes]:
    """Content length by the HTTP header and the payload, if the block is an HTTP response, else the block."""
    if "application/http" not in fields.get("content-type", ""):
        return len(block), block
    head, _, payload = block.partition(b"\r\n\r\n")
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return int(value), payload
    return len(payload), payload


def open_member(data: bytes, limit: int) -> tuple[bytes, int]:
    """Content and length of the gzip member at the start of ``data``."""
    unpacker = zlib.decompressobj(31)
    try:
        content = unpacker.decompress(data, limit)
    except zlib.error:
        raise Damage("gzip data") from None
    if not unpacker.eof:
        raise Damage("gzip member is cut", 0 if unpacker.unconsumed_tail else len(data) + 1)
    return content, len(data) - len(unpacker.unused_data)


class Salvage:
    """Sequential reading of one file from its pieces; each piece but perhaps the first starts with ``mark``."""

    def __init__(self, mark: bytes, limit: int = RECORD_BYTES):
        self.mark, self.limit = mark, limit
        self.waiting: deque[bytes] = deque()
        self.held = self.offset = self.need = 0
        self.gap: tuple[int, str] | None = None

    def feed(self, piece: bytes) -> Iterator[dict]:
        if piece:
            self.waiting.append(piece)
            self.held += len(piece)
            if self.held >= self.need:
                yield from self._drain(ended=False)

    def close(self, size: int) -> Iterator[dict]:
        """The file has ended; ``size`` is its length, as the text reader drops a mark at the very end."""
        yield from self._drain(ended=True)
        if self.offset < size:
            self.gap = self.gap or (self.offset, "cut")
            self.offset = size
        yield from self._close_gap()

    def _drain(self, ended: bool) -> Iterator[dict]:
        while self.waiting:
            self.need = 0
            try:
                found, length = self._next(ended)
            except Damage as damage:
                if self.need:
                    return
                self.gap = self.gap or (self.offset, damage.reason)
                self._advance(len(self.waiting[0]))
                continue
            yield from self._close_gap()
            for fields, block in found:
                yield {"kind": "record", "offset": self.offset, "length": length, "fields": fields, "block": block}
            self._advance(length)

    def _next(self, ended: bool) -> tuple[list[tuple[dict[str, str], bytes]], int]:
        """Records at the start of what waits and their length; ``Damage`` otherwise, with ``self.need`` set if more
        bytes have to be waited for."""
        data, taken = self.waiting[0], 1
        if not data.startswith(self.mark):
            raise Damage("no record")
        while True:
            try:
                return self._records(data)
            except Damage as damage:
                if not damage.need or damage.need > self.limit or ended and damage.need > self.held:
                    raise
                if damage.need > self.held:
                    self.need = damage.need
                    raise
                parts = [data]
                while sum(map(len, parts)) < damage.need:
                    parts.append(self.waiting[taken])
                    taken += 1
                data = b"".join(parts)

    def _records(self, data: bytes) -> tuple[list[tuple[dict[str, str], bytes]], int]:
        if self.mark != MAGIC:
            fields, block, length = parse_record(data)
            return [(fields, block)], length
        content, length = open_member(data, self.limit)
        found = []
        while content:
            try:
                fields, block, used = parse_record(content, len(content))
            except Damage as damage:
                raise Damage(damage.reason) from None  # the member is whole: more bytes will not come
            found.append((fields, block))
            content = content[used:]
        return found, length

    def _advance(self, count: int) -> None:
        self.offset += count
        self.held -= count
        while count:
            piece = self.waiting.popleft()
            if len(piece) > count:
                self.waiting.appendleft(piece[count:])
                return
            count -= len(piece)

    def _close_gap(self) -> list[dict]:
        if self.gap is None:
            return []
        (start, reason), self.gap = self.gap, None
        return [{"kind": "gap", "offset": start, "length": self.offset - start, "reason": reason}]


def read_archives(spark: SparkSession, folder: str, plain: bool = False, limit: int = RECORD_BYTES) -> DataFrame:
    """Records and gaps of all files in ``folder``, gzip members or, if ``plain``, uncompressed records: ``file, kind,
    offset, length, reason, warc_type, record_id, target_uri, refers_to, payload_digest, payload_bytes, payload``.

    ``kind`` is ``record`` or ``gap``; a gap has file, offset, length and reason only. Offsets count bytes of the file, and
    a record has those of its member. ``payload_bytes`` is the content length that the HTTP header gives, or the length of
    the payload; ``payload_digest`` is the recorded one in hexadecimal. A record of more than ``limit`` bytes is a gap. An empty
    file gives no rows.
    """
    mark = VERSION if plain else MAGIC

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, size, reader = None, 0, Salvage(mark, limit)
        entries: list[tuple[str, dict]] = []
        weight = 0
        for batch in batches:
            for path, length, piece in rows_in(batch, "file", "size", "piece"):
                if path == file:
                    found = reader.feed(mark + piece)
                else:
                    if file is not None:
                        entries += [(file, e) for e in reader.close(size)]
                    file, size, reader = path, length, Salvage(mark, limit)
                    found = reader.feed(piece)  # no mark stands before the first piece
                for entry in found:
                    entries.append((file, entry))
                    weight += len(entry.get("block", b""))
                if len(entries) >= BATCH_ROWS or weight >= BATCH_BYTES:
                    yield _entry_batch(entries)
                    entries, weight = [], 0
        if file is not None:
            entries += [(file, e) for e in reader.close(size)]
        yield _entry_batch(entries)

    pieces = (
        spark.read.option("encoding", "ISO-8859-1").option("lineSep", mark.decode("latin-1")).text(folder)
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_block_start").alias("block_start"), F.monotonically_increasing_id().alias("number"),
            F.col("value").cast("binary").alias("piece"))
    )
    ordered = pieces.repartition("file").sortWithinPartitions("file", "block_start", "number")
    return map_batches(ordered.select("file", "size", "piece"), run, ENTRY)


ENTRY = (
    "file string, kind string, offset bigint, length bigint, reason string, warc_type string, record_id string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes bigint, payload binary"
)


def _entry_batch(entries: list[tuple[str, dict]]) -> pa.RecordBatch:
    rows = []
    for file, entry in entries:
        fields = entry.get("fields", {})
        size, payload = http_payload(fields, entry["block"]) if "block" in entry else (None, None)
        digest = digest_bytes(fields.get("warc-payload-digest"))
        rows.append((
            file, entry["kind"], entry["offset"], entry["length"], entry.get("reason"), fields.get("warc-type"),
            fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-refers-to"),
            digest[1].hex() if digest else None, size, payload,
        ))
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    columns = [part.split() for part in ENTRY.split(", ")]
    return pa.record_batch(
        [pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(columns)], names=[n for n, _ in columns])


PAGE_URN = r"^<urn:page:(-?\d+)>$"


def page_records(records: DataFrame) -> DataFrame:
    """Per record of a page ``page_id, payload_bytes, payload_digest, record_type, refers_to``: size and digest of a
    response are those of the payload that was read, of a revisit those recorded for the full payload."""
    response = F.col("warc_type") == "response"
    return records.filter("kind = 'record' and warc_type in ('response', 'revisit')").select(
        _page("record_id").alias("page_id"),
        F.when(response, F.octet_length("payload").cast("bigint")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"), _page("refers_to").alias("refers_to"),
    )


def _page(column: str) -> Column:
    found = F.regexp_extract(column, PAGE_URN, 1)
    return F.when(found != "", found.cast("bigint"))
