"""WARC archives, written from a table of pages and read back record by record (operator 11).

Writing. Equal payloads of ``REVISIT_BYTES`` or more are stored once: the page with
the largest id becomes the ``response``, the others ``revisit`` records that name it.
Only payload digests are grouped (with partial aggregates); the pages themselves meet
the result on the map side while the groups' table is proven small by the bytes of its
files, and otherwise by a shuffle that the hot digests do not take part in. Every task
then writes archives of its own: one gzip member per record, a new file beyond
``ARCHIVE_BYTES``. A file's name holds a random part and only files that a finished task
has listed are read, so a lost executor or a second attempt leaves nothing but an
unlisted file.

Reading. One task takes one archive from front to back: it inflates a member by bounded
pieces, frames the record by its Content-Length, hashes block and payload as they pass
and compares both with the digests of the header. Nothing but the record's header (and,
on request, the payload) is held. A damaged member is reported, and the next one is found
by its magic bytes.

Defined results: a null or empty text is a payload of no bytes; a null id is written as
``none`` and comes back null, ranks lowest, and is a response when its group has no other
id; rows that repeat an id with an equal payload are all responses when that id is the
largest; a null address is left out and comes back null; control characters in an address
are percent-encoded; other columns of the table, whatever their names, are not read; an
empty table gives no archive and no record; a text of any length is one record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.store import BROADCAST_BYTES, estimated_bytes, stage
from tributary.session import scratch_path

#: A payload of fewer bytes is always stored.
REVISIT_BYTES = 1000
#: A task closes its archive and opens another when it holds as many bytes.
ARCHIVE_BYTES = 256 << 20
#: A digest that holds this share of the pages never takes part in a shuffle; by
#: counting, at most 65,536 digests can.
HOT_SHARE = 1 / 65536
#: Bytes read from an archive, and inflated, at once.
PIECE = 1 << 18
#: A header longer than this is malformed.
HEAD_BYTES = 1 << 20
LEVEL = 1
MAGIC = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILES = "path string, n_records long, n_bytes long"
RECORDS = ("path string, offset long, record_type string, record_id string, target_uri string, "
           "refers_to string, payload_bytes long, payload_digest string, status string, "
           "payload binary")


# -- writing ---------------------------------------------------------------------------


def equal_payloads(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(digest, keep_id, copies) of payloads of ``least`` bytes or more that occur repeatedly."""
    return (pages.where(F.col("n_bytes") >= least).groupBy("digest")
            .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


def with_targets(pages: DataFrame, groups: DataFrame, least: int = REVISIT_BYTES,
                 broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``pages`` with keep_id (null where the payload is stored whatever its copies).

    ``groups`` is a staged table, so that its size is that of written files."""
    if 4 * estimated_bytes(groups) <= broadcast_bytes:
        return pages.join(F.broadcast(groups.drop("copies")), "digest", "left")
    hot = F.col("copies") >= HOT_SHARE * pages.count()
    small = pages.where(F.col("n_bytes") < least)
    large = pages.where(F.col("n_bytes") >= least)
    marked = large.join(F.broadcast(groups.where(hot).drop("copies")), "digest", "left")
    rest = (marked.where(F.col("keep_id").isNull()).drop("keep_id")
            .join(groups.where(~hot).drop("copies").hint("shuffle_hash"), "digest", "left"))
    none = F.lit(None).cast(groups.schema["keep_id"].dataType)
    return (marked.where(F.col("keep_id").isNotNull()).unionByName(rest)
            .unionByName(small.withColumn("keep_id", none)))


def file_of(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI, also in Hadoop's form ``file:/...``."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


def sha1_label(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def member(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as one gzip member."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields),
             f"WARC-Block-Digest: {sha1_label(hashlib.sha1(block).digest())}",
             f"Content-Length: {len(block)}"]
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return (squeeze.compress("\r\n".join(lines).encode() + END) + squeeze.compress(block)
            + squeeze.compress(END) + squeeze.flush())


def address(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode())
                   for c in url)


def page_record(ident: str | None, url: str | None, payload: bytes, target: str | None,
                date: str) -> bytes:
    """A response, or a revisit of ``target``; the HTTP head tells the payload's full length."""
    fields = [("WARC-Record-ID", f"<urn:page:{'none' if ident is None else ident}>"),
              ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", address(url)))
    fields += [("Content-Type", "application/http; msgtype=response"),
               ("WARC-Payload-Digest", sha1_label(hashlib.sha1(payload).digest()))]
    block = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             f"Content-Length: {len(payload)}").encode() + END
    if target is None:
        return member("response", fields, block + payload)
    return member("revisit", [*fields, ("WARC-Profile", PROFILE),
                              ("WARC-Refers-To", f"<urn:page:{target}>")], block)


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                   text_col: str = "html", least: int = REVISIT_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES, date: str = "2024-01-01T00:00:00Z",
                   broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Writes the pages under the shared scratch folder; one row per archive (path, n_records,
    n_bytes). ``date`` is the capture time, which the table does not have."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumn("n_bytes", F.octet_length("payload")).withColumn(
        "digest", F.unhex(F.sha2("payload", 256)))
    groups = stage(equal_payloads(rows, least), "payloads")
    fated = with_targets(rows, groups, least, broadcast_bytes).select(
        F.col("id").cast("string").alias("id"), "url", "payload",
        F.when((F.col("keep_id") > F.col("id")) | F.col("id").isNull(), F.col("keep_id"))
        .cast("string").alias("target"))
    folder = scratch_path(spark, "llm", "warc")

    def write(batches):
        disk, base = file_of(folder)
        out = path = None
        count = size = 0
        for batch in batches:
            for ident, url, body, target in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    disk.create_dir(base, recursive=True)
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    path, count, size = f"{folder}/{name}", 0, 0
                    out = disk.open_output_stream(f"{base}/{name}", compression=None)
                    info = member("warcinfo", [
                        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
                        ("WARC-Filename", name),
                        ("Content-Type", "application/warc-fields")], b"format: WARC 1.1\r\n")
                    out.write(info)
                    size += len(info)
                record = page_record(ident, url, body, target, date)
                out.write(record)
                count, size = count + 1, size + len(record)
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield listed(path, count, size)
        if out is not None:
            out.close()
            yield listed(path, count, size)

    return stage(fated.mapInArrow(write, FILES), "archives")


def listed(path: str, count: int, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count], pa.int64()),
                                       pa.array([size], pa.int64())],
                                      names=["path", "n_records", "n_bytes"])


# -- reading ---------------------------------------------------------------------------


class Record:
    """What is known of a record while its bytes pass."""

    def __init__(self, keep_payload: bool) -> None:
        self.head, self.fields, self.left, self.fault = bytearray(), None, 0, ""
        self.block, self.body = hashlib.sha1(), hashlib.sha1()
        self.http, self.http_fields, self.body_bytes, self.tail = None, {}, 0, b""
        self.pieces = [] if keep_payload else None

    def feed(self, data: bytes) -> None:
        if self.fault:
            return
        if self.fields is None:
            self.head += data
            at = self.head.find(END)
            if at < 0:
                if len(self.head) > HEAD_BYTES:
                    self.fault = "malformed"
                return
            first, self.fields = named(bytes(self.head[:at]))
            size = self.fields.get("content-length", "")
            if not first.startswith("WARC/") or not size.isdigit():
                self.fault = "malformed"
                return
            self.left = int(size)
            if self.fields.get("content-type", "").startswith("application/http"):
                self.http = bytearray()
            data, self.head = bytes(self.head[at + 4:]), bytearray()
        part, rest = data[:self.left], data[self.left:]
        self.left -= len(part)
        self.block.update(part)
        self.enter(part)
        self.tail = (self.tail + rest)[:5]

    def enter(self, part: bytes) -> None:
        """Bytes of the block: of the HTTP head first, then of the payload."""
        if self.http is not None:
            self.http += part
            at = self.http.find(END)
            if at < 0:
                if len(self.http) > HEAD_BYTES:
                    self.fault = "malformed"
                return
            self.http_fields = named(bytes(self.http[:at]))[1]
            part, self.http = bytes(self.http[at + 4:]), None
        self.body.update(part)
        self.body_bytes += len(part)
        if self.pieces is not None:
            self.pieces.append(part)

    def row(self, path: str, offset: int, whole: bool) -> tuple:
        fields = self.fields or {}
        kind = fields.get("warc-type")
        declared = hex_digest(fields.get("warc-payload-digest"))
        n_bytes, digest = self.body_bytes, self.body.hexdigest()
        status = self.fault
        if not status and (not whole or self.fields is None or self.left):
            status = "truncated"
        if not status and (self.tail != END or self.http is not None):
            status = "malformed"
        if not status and hex_digest(fields.get("warc-block-digest")) not in (
                None, self.block.hexdigest()):
            status = "block digest"
        if kind == "revisit":  # the payload is elsewhere: its digest and length are declared
            size = self.http_fields.get("content-length", "")
            n_bytes, digest = int(size) if size.isdigit() else None, declared
        elif not status and declared not in (None, digest):
            status = "payload digest"
        payload = None if self.pieces is None or kind == "revisit" else b"".join(self.pieces)
        return (path, offset, kind, bare(fields.get("warc-record-id")),
                fields.get("warc-target-uri"), bare(fields.get("warc-refers-to")),
                n_bytes, digest, status or "ok", payload)


def named(head: bytes) -> tuple[str, dict[str, str]]:
    """The first line and the named fields (names in lower case) of a header."""
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    pairs = (line.split(":", 1) for line in lines if ":" in line)
    return first, {k.strip().lower(): v.strip() for k, v in pairs}


def hex_digest(label: str | None) -> str | None:
    """``sha1:`` in base 32 or hex as bare hex; other algorithms are not compared."""
    algorithm, _, value = (label or "").partition(":")
    if algorithm.lower() != "sha1":
        return None
    if len(value) == 40:
        return value.lower()
    try:
        return base64.b32decode(value.upper()).hex()
    except ValueError:
        return value


def bare(uri: str | None) -> str | None:
    return None if uri is None else uri.removeprefix("<").removesuffix(">")


def records(stream, path: str, keep_payload: bool = False, piece: int = PIECE):
    """The records of one archive, in order, with bounded memory (see the module's text)."""
    held, at, lost = b"", 0, False
    while True:
        held = held or stream.read(piece)
        if not held:
            return
        start, record, inflate = at, Record(keep_payload), zlib.decompressobj(31)
        try:
            while not inflate.eof:
                held = held or stream.read(piece)
                if not held:
                    record.feed(inflate.flush())
                    break
                data = inflate.decompress(held, piece)
                left = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
                at += len(held) - len(left)
                held = left
                record.feed(data)
        except zlib.error:
            if not lost or record.fields is not None:
                record.fault = "corrupt"
                yield record.row(path, start, False)
            held, at = next_member(stream, held, at, 1 if at == start else 0, piece)
            lost = True
            continue
        if not lost or record.fields is not None:
            yield record.row(path, start, inflate.eof)
        lost = False


def next_member(stream, held: bytes, at: int, skip: int, piece: int) -> tuple[bytes, int]:
    """What follows up to the next magic bytes is passed over."""
    while True:
        found = held.find(MAGIC, skip)
        if found >= 0:
            return held[found:], at + found
        drop = max(skip, len(held) - 2)
        more = stream.read(piece)
        if not more:
            return b"", at + len(held)
        held, at, skip = held[drop:] + more, at + drop, 0


def read_archives(files: DataFrame, keep_payload: bool = False) -> DataFrame:
    """One row per record of the archives in column ``path`` (warcinfo included)."""
    schema = pa.schema([("path", pa.string()), ("offset", pa.int64()),
                        *((c, pa.string()) for c in ("record_type", "record_id", "target_uri",
                                                     "refers_to")),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("status", pa.string()), ("payload", pa.binary())])

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def read(batches):
        rows, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                disk, name = file_of(path)
                with disk.open_input_stream(name, compression=None) as stream:
                    for row in records(stream, path, keep_payload):
                        rows.append(row)
                        size += len(row[-1] or b"") + 512
                        if size >= 4 << 20:
                            yield packed(rows)
                            rows, size = [], 0
        if rows:
            yield packed(rows)

    paths = files.select("path")
    return paths.repartition(max(1, paths.count())).mapInArrow(read, RECORDS)


def unresolved_revisits(found: DataFrame) -> DataFrame:
    """(refers_to, payload_digest, payload_bytes, revisits) of revisits without a sound response
    of that id, digest and length. Revisits are counted per target before they are joined."""
    wanted = (found.where("record_type = 'revisit'")
              .groupBy("refers_to", "payload_digest", "payload_bytes")
              .agg(F.count(F.lit(1)).alias("revisits")))
    held = (found.where("record_type = 'response' AND status = 'ok'")
            .select(F.col("record_id").alias("refers_to"), "payload_digest", "payload_bytes"))
    return wanted.join(held, ["refers_to", "payload_digest", "payload_bytes"], "left_anti")


def page_archives(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Writes ``pages`` to archives and reads them back: one row per page, read from them alone."""
    kind = pages.schema[id_col].dataType
    found = read_archives(write_archives(pages, id_col)).where("record_type <> 'warcinfo'")

    def ident(name: str):
        text = F.expr(f"substring({name}, {len('urn:page:') + 1})")
        return F.when(text != "none", text).cast(kind)

    return found.select(ident("record_id").alias(id_col), "payload_bytes", "payload_digest",
                        "record_type", ident("refers_to").alias("refers_to"), "target_uri",
                        "status")
