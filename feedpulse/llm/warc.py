"""WARC archives: a writer, and a reader that salvages what is left of them.

The writer makes one gzip member per record. The reader checks members, version
lines, headers, lengths and digests. Where a check fails it searches for the next
place at which a whole record stands (the next member, or version line in archives
that are not compressed), goes on from there, and logs the bytes between as a gap.
A member of several records is searched in the same way, as far as it unpacks.

Archives are read and written through the file system of their folder's URI, by the
tasks. A task names its archives after its attempt; only those in the manifest of
attempts that Spark committed count, so a lost executor leaves nothing behind that
is read twice.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.llm.common import ROW, keyed_rows, text_or_empty, written
from feedpulse.session import shared_folder

VERSION = b"WARC/1.1\r\n"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads under this length are never revisits.
LEAST_REVISIT = 1000
#: Marks of revisits, of some 16 bytes, that are sent to all tasks at most.
BROADCAST_ROWS = 1_000_000
#: A task begins a new archive beyond this many bytes.
ARCHIVE_BYTES = 64 << 20
MEMBER = b"\x1f\x8b\x08"


class Damaged(ValueError):
    """What stands here is no whole record, but for ``records`` that were unpacked."""

    def __init__(self, reason: str, records: list[Record] | None = None):
        super().__init__(reason)
        self.records = records or []


def folder_of(uri: str):
    """File system and path of a folder; ``file:/x`` and plain paths are local."""
    from pyarrow import fs

    uri = re.sub("^file:/(?!/)", "file:///", uri)
    return fs.FileSystem.from_uri(uri)


def page_uri(page_id: int) -> str:
    return f"urn:page:{page_id}"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in [*headers, ("Content-Length", str(len(block)))]]
    return VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response, or a revisit of the response of page ``refers_to``."""
    sha1 = hashlib.sha1(payload).digest()
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Date", DATE)]
    if page_id is not None:
        headers.append(("WARC-Record-ID", f"<{page_uri(page_id)}>"))
    if url:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", "%20", url)))
    block = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    if refers_to is None:
        block += payload
    else:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{page_uri(refers_to)}>")]
    headers += [
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(sha1).decode()),
        ("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()),
    ]
    return record(headers, block)


def member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


@dataclass
class Record:
    """A record that passed its checks."""

    headers: dict[str, str]
    block: bytes

    def payload(self) -> bytes:
        """The HTTP body; the whole block where it is no HTTP message."""
        if "application/http" not in self.headers.get("content-type", ""):
            return self.block
        return self.block.partition(b"\r\n\r\n")[2]

    def http_length(self) -> int | None:
        found = re.search(rb"(?im)^content-length: *(\d+)\r?$", self.block.partition(b"\r\n\r\n")[0])
        return int(found[1]) if found else None


@dataclass
class Gap:
    """Bytes that belong to no whole record."""

    reason: str = field(default="")


def sha1_of(value: str) -> bytes | None:
    """A digest header's SHA-1, in base 32 or hex; None for other algorithms."""
    name, _, text = value.partition(":")
    if name.strip().lower() != "sha1":
        return None
    text = text.strip()
    try:
        return bytes.fromhex(text) if len(text) == 40 else base64.b32decode(text.upper())
    except ValueError:
        raise Damaged("digest header") from None


def parse_record(data, at: int) -> tuple[Record, int]:
    """The record at ``at`` and where it ends; raises ``Damaged``."""
    if not re.match(rb"WARC/1\.\d\r?\n", bytes(data[at : at + 12])):
        raise Damaged("version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise Damaged("headers")
    headers: dict[str, str] = {}
    for line in bytes(data[at:stop]).decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise Damaged("headers")
        headers[name.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    if not length.isascii() or not length.isdigit():
        raise Damaged("content length")
    first = stop + 4
    last = first + int(length)
    if bytes(data[last : last + 4]) != b"\r\n\r\n":
        raise Damaged("record end")
    own = Record(headers, bytes(data[first:last]))
    if "warc-block-digest" in headers:
        wanted = sha1_of(headers["warc-block-digest"])
        if wanted and hashlib.sha1(own.block).digest() != wanted:
            raise Damaged("block digest")
    if "warc-payload-digest" in headers and headers.get("warc-type") == "response":
        wanted = sha1_of(headers["warc-payload-digest"])
        if wanted and hashlib.sha1(own.payload()).digest() != wanted:
            raise Damaged("payload digest")
    return own, last + 4


def unpacked(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """What the gzip member at ``at`` holds, where it ends, and why it ends early, if so."""
    unpacker, parts, view, place, step = zlib.decompressobj(31), [], memoryview(data), at, 1 << 16
    try:
        while not unpacker.eof:
            if place >= len(data):
                return b"".join(parts), place, "member cut short"
            parts.append(unpacker.decompress(view[place : place + step]))
            place += step
    except zlib.error:
        # A step that fails returns nothing: once more, and its bytes one at a time.
        unpacker, parts = zlib.decompressobj(31), []
        if place > at:
            parts.append(unpacker.decompress(view[at:place]))
        try:
            for k in range(place, len(data)):
                parts.append(unpacker.decompress(view[k : k + 1]))
        except zlib.error:
            pass
        return b"".join(parts), place, "member data"
    return b"".join(parts), min(place, len(data)) - len(unpacker.unused_data), None


def parse_member(data: bytes, at: int) -> tuple[list[Record], int, str | None]:
    """The sound records of the gzip member at ``at``, where it ends, and what the first
    damage between them is, if any.

    Raises ``Damaged``, with the records, where the end of the member is not known.
    Where its data fail, only records with a block digest that holds are sound; their
    headers have no digest, so the gap of the same range tells what they came from.
    """
    if data[at : at + 3] != MEMBER:
        raise Damaged("member header")
    text, stop, cut = unpacked(data, at)
    records, inside, damage = [], 0, None
    while 0 <= inside < len(text):
        try:
            own, inside = parse_record(text, inside)
        except Damaged as why:
            damage = damage or str(why)
            inside = text.find(b"WARC/1.", inside + 1)
            continue
        if cut != "member data" or sha1_of(own.headers.get("warc-block-digest", "")):
            records.append(own)
    if cut:
        raise Damaged(cut, records)
    if not records:
        raise Damaged(damage or "empty member")
    return records, stop, damage


def parse_plain(data: bytes, at: int) -> tuple[list[Record], int, None]:
    own, stop = parse_record(data, at)
    return [own], stop, None


def salvage(data: bytes) -> Iterator[tuple[int, int, Record | Gap]]:
    """``(start, stop, record or gap)`` of an archive, in order, without holes.

    Records and gaps cover every byte. Compressed and plain stretches may follow
    one another. A gap ends where a whole record begins, or with the file. Records of
    one member share its range; a damaged one is a gap, followed by what is sound in it.
    """

    def parse(at: int) -> tuple[list[Record], int, str | None]:
        return parse_member(data, at) if data[at : at + 2] == MEMBER[:2] else parse_plain(data, at)

    at = 0
    while at < len(data):
        try:
            records, stop, damage = parse(at)
        except Damaged as why:
            records, stop, damage = why.records, len(data), str(why)
            for place in re.compile(b"\x1f\x8b\x08|WARC/1\\.").finditer(data, at + 1):
                try:
                    parse(place.start())
                except Damaged as other:
                    if not other.records:
                        continue
                stop = place.start()
                break
        if damage:
            yield at, stop, Gap(damage)
        for own in records:
            yield at, stop, own
        at = stop


def write_pages(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per row of ``pages (page_id, url, html)``; the manifest of archives.

    Of rows with equal payloads of ``LEAST_REVISIT`` bytes or more, that with the
    largest ``page_id`` (null counts as least, the later row wins a tie) is a
    response and the others revisit it. Null html is an empty payload. Columns of
    other names are not read.

    Rows are stored under a key first. Payloads long enough are grouped by digest with
    map-side combine; only digests that come twice are joined back, digests alone, in a
    sort-merge join of stored tables that Spark splits where one payload is hot. Rows to
    be revisits then get their mark by key: sent to all tasks where there are few, by a
    shuffle of the pages beyond ``BROADCAST_ROWS``. The manifest has a row per archive.
    """
    payload = text_or_empty("html")
    long_enough = F.octet_length(payload) >= LEAST_REVISIT
    rows = keyed_rows(
        pages,
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").alias("url"),
        payload.alias("html"),
        F.when(long_enough, F.sha2(payload, 256)).alias("digest"),
    )
    best = F.struct(F.col("page_id").isNotNull().alias("has_id"), "page_id", ROW)
    digests = rows.where("digest IS NOT NULL").select(ROW, "page_id", "digest")
    kept = written(
        digests.groupBy("digest")
        .agg(F.max(best).alias("best"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "best"),
        "warc-kept",
    )
    again = written(
        digests.select(ROW, "digest")
        .join(kept, "digest")
        .where(F.col("best")[ROW] != F.col(ROW))
        .select(ROW, F.lit(True).alias("again"), F.col("best.page_id").alias("refers_to")),
        "warc-again",
    )
    few = again.count() <= BROADCAST_ROWS
    planned = rows.join(F.broadcast(again) if few else again, ROW, "left").select(
        "page_id", "url", "html", F.coalesce("again", F.lit(False)).alias("again"), "refers_to"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, path = folder_of(folder)
        system.create_dir(path, recursive=True)
        out, name, n, number, size = None, "", 0, 0, 0

        def closed():
            out.close()
            return pa.RecordBatch.from_pylist([{"name": name, "records": n, "bytes": size}])

        for batch in batches:
            for page_id, url, html, again, refers_to in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    name = f"pages-{task.partitionId():05d}-{task.taskAttemptId()}-{number:04d}.warc.gz"
                    out, n, size = system.open_output_stream(f"{path}/{name}", compression=None), 0, 0
                    number += 1
                data = member(page_record(page_id, url, html.encode(), refers_to if again else None))
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return written(planned.mapInArrow(write, "name string, records long, bytes long"), "warc-manifest")


READ = (
    "name string, start long, stop long, gap string, record_type string, page_id long, "
    "target_uri string, payload_bytes long, payload_digest string, refers_to long, payload binary"
)


def read_archives(manifest: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Records and quarantined gaps of the archives ``name`` of ``manifest``, salvaged.

    A gap has its reason in ``gap`` and nulls in the record's columns. Length and
    digest are those of the full payload, for revisits by their headers. An archive
    is read whole by one task; those of ``write_pages`` are ``ARCHIVE_BYTES`` long
    and one record more at most. ``payloads`` adds the bytes themselves.
    """

    def id_of(value: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
        return int(found[1]) if found else None

    def row(name: str, start: int, stop: int, own: Record | Gap) -> dict:
        out = dict.fromkeys(c.split()[0] for c in READ.split(", "))
        out |= {"name": name, "start": start, "stop": stop}
        if isinstance(own, Gap):
            return out | {"gap": own.reason}
        kind, payload = own.headers.get("warc-type"), own.payload()
        out |= {
            "record_type": kind,
            "page_id": id_of(own.headers.get("warc-record-id")),
            "target_uri": own.headers.get("warc-target-uri"),
            "refers_to": id_of(own.headers.get("warc-refers-to")),
        }
        if kind == "revisit":
            digest = sha1_of(own.headers.get("warc-payload-digest", ""))
            return out | {"payload_bytes": own.http_length(), "payload_digest": digest and digest.hex()}
        return out | {
            "payload_bytes": len(payload),
            "payload_digest": hashlib.sha1(payload).hexdigest(),
            "payload": payload if payloads else None,
        }

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = folder_of(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_stream(f"{path}/{name}", compression=None) as file:
                    data = file.read()
                some, size = [], 0
                for start, stop, own in salvage(data):
                    some.append(row(name, start, stop, own))
                    size += len(some[-1]["payload"] or b"") + 1000
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(some, schema=READ_SCHEMA)
                        some, size = [], 0
                if some:
                    yield pa.RecordBatch.from_pylist(some, schema=READ_SCHEMA)

    files = max(1, manifest.count())
    return manifest.select("name").repartition(files).mapInArrow(read, READ)


READ_SCHEMA = pa.schema(
    [
        (c.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]])
        for c in READ.split(", ")
    ]
)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    manifest = write_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return (
        read_archives(manifest, folder)
        .where("gap IS NULL")
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    )


OP2_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (
  SELECT page_id, octet_length(payload) AS n, sha1(payload) AS h,
         max(page_id) OVER (PARTITION BY payload) AS last FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND last <> page_id THEN last END AS refers_to
FROM d
"""
