"""Operator 13: WARC archives, and a normaliser of archives gzipped as one whole.

``write`` puts a record per page into WARC files, each one gzip stream (what many crawlers leave behind:
no record can be reached without inflating all before it). ``normalise`` inflates such a stream once, from
one end to the other, rewrites every record as a gzip member of its own, and gives a sidecar index: file,
offset and length of each member. ``read`` fetches records by that index and inflates only their members.

The normaliser also takes decisions: a record whose payload another record holds is rewritten as a
``revisit`` of that one, without payload. Decisions come from the narrow listing that ``write`` leaves (one
row per record), so no page is ever shuffled. A payload that a third of all pages share is one row per task
in the aggregate, and in the join that follows the one row on the other side of it is what is copied.

Files are written by tasks under names of their own attempt, and named by the table that Spark commits: what
a lost or repeated attempt left is never read. A task holds a record at a time when pages are written or read;
when an archive is normalised, blocks of ``chunk_bytes`` and one compressed record.

Defined results: a null page is an empty payload; a null id is smaller than any; of rows that repeat the largest
id with one payload, one is the response; a null url leaves the field out, and white space and control characters
in a url are percent-encoded; other columns are ignored. Where an archive is cut off or its bytes are no record,
the whole records before are kept and the archive gets a row that says so. A payload that does not have the
digest its header states raises an error.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, stored

VERSION = b"WARC/1.0"
GZIP = 16 + zlib.MAX_WBITS
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"


@dataclass(frozen=True)
class Settings:
    file_bytes: int = 128 << 20      # of records before compression, after which a new file begins
    file_records: int = 50_000
    chunk_bytes: int = 1 << 20
    header_bytes: int = 1 << 20      # a record's header is never longer; else the bytes are no WARC file
    min_payload: int = 0             # equal payloads of fewer bytes do not make revisits
    date: str = "2024-01-01T00:00:00Z"


def shared_file(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path within, for a path or URI that all executors see."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith(("file:", "/")) else (
        pafs.LocalFileSystem(), path)


# --------------------------------------------------------------------------------------- records
def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header(fields: list[tuple[str, str]]) -> bytes:
    lines = [VERSION, *[f"{k}: {v}".encode() for k, v in fields]]
    return b"\r\n".join(lines) + b"\r\n\r\n"


def record(name: str, page_id, url: str | None, payload: bytes, sha1: str, date: str) -> bytes:
    """A response record. ``Page-ID`` and ``Payload-Length`` are fields of our own, which the format allows."""
    block = HTTP.format(size=len(payload)).encode() + payload
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(
            r"[\x00-\x20\x7f-\x9f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)))
    if page_id is not None:
        fields.append(("Page-ID", str(page_id)))
    fields += [("WARC-Payload-Digest", f"sha1:{sha1}"), ("Payload-Length", str(len(payload))),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return header(fields) + block + b"\r\n\r\n"


def parse_header(raw: bytes) -> list[tuple[str, str]]:
    lines = raw.decode("utf-8", "surrogateescape").split("\r\n")
    return [(k, v.strip(" \t")) for k, _, v in (x.partition(":") for x in lines[1:] if x)]


class NotWarc(ValueError):
    pass


class Truncated(Exception):
    pass


class Stream:
    """The inflated bytes of one archive, front to back: plain, one gzip stream, or many members."""

    def __init__(self, source, settings: Settings):
        self.source, self.settings = source, settings
        self.buffer = bytearray()
        self.inflate, self.compressed, self.waiting = None, None, b""

    def _more(self) -> bool:
        """Inflate some more; false at the end."""
        data = self.waiting or self.source.read(self.settings.chunk_bytes)
        self.waiting = b""
        if self.compressed is None and data:
            self.compressed = data[:2] == b"\x1f\x8b"
        if not data:
            if self.inflate is not None:
                raise Truncated
            return False
        if not self.compressed:
            self.buffer += data
            return True
        if self.inflate is None:
            data = data.lstrip(b"\0")  # members may be padded with zeros
            if not data:
                return True
            self.inflate = zlib.decompressobj(GZIP)
        try:
            self.buffer += self.inflate.decompress(data, self.settings.chunk_bytes)
        except zlib.error as e:
            raise NotWarc(str(e)) from e
        if self.inflate.eof:
            self.waiting, self.inflate = self.inflate.unused_data, None
        else:
            self.waiting = self.inflate.unconsumed_tail
        return True

    def header(self) -> bytes | None:
        """The next record's header without its empty line; none at the end."""
        searched = 0
        while True:
            while not searched and self.buffer[:2] == b"\r\n":
                del self.buffer[:2]
            at = self.buffer.find(b"\r\n\r\n", searched)
            if at >= 0:
                out = bytes(self.buffer[:at])
                del self.buffer[:at + 4]
                if not out.startswith(b"WARC/"):
                    raise NotWarc(repr(out[:40]))
                return out
            if len(self.buffer) > self.settings.header_bytes or (
                    len(self.buffer) >= 5 and not self.buffer.startswith(b"WARC/")):
                raise NotWarc(repr(bytes(self.buffer[:40])))
            searched = max(0, len(self.buffer) - 3)
            if not self._more():
                if self.buffer.strip():
                    raise Truncated
                return None

    def take(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes in pieces."""
        while size:
            if not self.buffer and not self._more():
                raise Truncated
            piece = bytes(self.buffer[:size])
            del self.buffer[:len(piece)]
            size -= len(piece)
            if piece:
                yield piece


def length_of(fields: list[tuple[str, str]]) -> int:
    for k, v in fields:
        if k.lower() == "content-length" and v.isdigit():
            return int(v)
    raise NotWarc("no Content-Length")


def fields_of(fields: list[tuple[str, str]]) -> dict[str, str]:
    return {k.lower(): v for k, v in fields}


# ---------------------------------------------------------------------------------------- writing
LISTED = pa.schema([("file", pa.string()), ("ordinal", pa.int64()), ("record_id", pa.string()), ("page_id", pa.int64()),
                    ("payload_bytes", pa.int64()), ("sha1", pa.string()), ("sha256", pa.string())])
LISTED_DDL = "file string, ordinal long, record_id string, page_id long, payload_bytes long, sha1 string, sha256 string"


def write(pages: DataFrame, folder: str, settings: Settings = Settings()) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC files below ``folder``, each gzipped as one whole, and
    return the listing of what was written, a row per record."""
    spark = pages.sparkSession
    small_batches(spark)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = shared_file(folder)
        fs.create_dir(base)
        out = pack = None
        listed = {n: [] for n in LISTED.names}

        def close():
            out.write(pack.flush())
            out.close()
            return pa.RecordBatch.from_pydict(listed, LISTED)

        for batch in batches:
            for page_id, url, html in zip(*(batch.column(c) for c in ("page_id", "url", "html")), strict=True):
                if out is None:
                    name, size, listed = uuid.uuid4().hex, 0, {n: [] for n in LISTED.names}
                    out = fs.open_output_stream(f"{base}/{name}.warc.gz", compression=None)
                    pack = zlib.compressobj(1, zlib.DEFLATED, GZIP)
                payload = html.as_py().encode()
                ordinal, sha1 = len(listed["file"]), digest(payload)
                rid = str(uuid.uuid5(uuid.UUID(name), str(ordinal)))
                whole = record(rid, page_id.as_py(), url.as_py(), payload, sha1, settings.date)
                out.write(pack.compress(whole))
                for n, v in zip(LISTED.names, (f"{folder}/{name}.warc.gz", ordinal, rid, page_id.as_py(), len(payload), sha1,
                                               hashlib.sha256(payload).hexdigest()), strict=True):
                    listed[n].append(v)
                size += len(whole)
                if size >= settings.file_bytes or len(listed["file"]) >= settings.file_records:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return stored(spark, rows.mapInArrow(run, LISTED_DDL), "warc-listing")


def revisits(listing: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(file, ordinal, refers_to, refers_to_page) of the records whose payload another one holds: the one with
    the largest page id, and of those the last by record id."""
    large = listing.filter(F.col("payload_bytes") >= settings.min_payload)
    first = F.struct(F.col("page_id").isNotNull().alias("has"), "page_id", "record_id")
    kept = large.groupBy("sha256", "payload_bytes").agg(F.max(first).alias("kept"), F.count("*").alias("copies")).filter(
        "copies > 1")
    # One row per payload that repeats; a payload with very many rows is split by Spark's skew handling, its row copied.
    return large.join(kept.select("sha256", "payload_bytes", "kept"), ["sha256", "payload_bytes"]).filter(
        F.col("record_id") != F.col("kept.record_id")).select(
        "file", "ordinal", F.col("kept.record_id").alias("refers_to"), F.col("kept.page_id").alias("refers_to_page"))


# ------------------------------------------------------------------------------------ normalising
INDEX = pa.schema([("source", pa.string()), ("ordinal", pa.int64()), ("file", pa.string()), ("offset", pa.int64()),
                   ("length", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
                   ("target_uri", pa.string()), ("problem", pa.string())])
INDEX_DDL = ("source string, ordinal long, file string, offset long, length long, record_type string, record_id string, "
             "target_uri string, problem string")


def revisit_fields(fields: list[tuple[str, str]], head: bytes, refers_to: str, page) -> list[tuple[str, str]]:
    """A response's header as that of a revisit whose block is ``head`` alone."""
    out = [(k, {"warc-type": "revisit", "content-length": str(len(head))}.get(k.lower(), v)) for k, v in fields]
    own = [("WARC-Refers-To", f"<urn:uuid:{refers_to}>"), ("WARC-Profile", PROFILE)]
    if page is not None:
        own.append(("Refers-To-Page-ID", str(page)))
    return [*out[:-1], *own, out[-1]]


class Rewriter:
    """One archive into another with a gzip member per record."""

    def __init__(self, stream: Stream, out, decisions: dict[int, tuple]):
        self.stream, self.out, self.decisions, self.at = stream, out, decisions, 0

    def records(self) -> Iterator[tuple]:
        """(ordinal, offset, length, type, id, uri) of each whole record."""
        ordinal = 0
        while (raw := self.stream.header()) is not None:
            version = raw.partition(b"\r\n")[0]
            fields = parse_header(raw)
            size, begin = length_of(fields), self.at
            block = self.stream.take(size)
            decision = self.decisions.get(ordinal)
            if decision:
                # Of the block only what comes before the payload stays.
                head = bytearray()
                for piece in block:
                    if b"\r\n\r\n" not in head:
                        head += piece
                head = bytes(head[:head.index(b"\r\n\r\n") + 4])
                fields, block = revisit_fields(fields, head, *decision), iter([head])
            pack = zlib.compressobj(6, zlib.DEFLATED, GZIP)
            lines = b"".join(f"{k}: {v}\r\n".encode("utf-8", "surrogateescape") for k, v in fields)
            # Written when it is whole, so an archive that breaks off leaves no half member.
            member = [pack.compress(piece) for piece in chain([version + b"\r\n" + lines + b"\r\n"], block, [b"\r\n\r\n"])]
            member.append(pack.flush())
            self.out.write(b"".join(member))
            self.at += sum(map(len, member))
            known = fields_of(fields)
            yield (ordinal, begin, self.at - begin, known.get("warc-type"),
                   known.get("warc-record-id", "").strip("<>").removeprefix("urn:uuid:") or None, known.get("warc-target-uri"))
            ordinal += 1


def normalise(files: DataFrame, folder: str, decisions: DataFrame | None = None,
              settings: Settings = Settings()) -> DataFrame:
    """Rewrite the archives named by ``files`` (column file) below ``folder`` with a gzip member per record;
    return the index, a row per record. ``decisions`` are those of ``revisits``. An archive that is cut off
    or broken has one more row, without a place, with the ``problem``."""
    spark = files.sparkSession
    archives = max(1, files.select("file").distinct().count())
    wanted = files.select("file").distinct().select("file", F.lit(-1).cast("long").alias("ordinal"),
                                                    F.lit(None).cast("string").alias("refers_to"),
                                                    F.lit(None).cast("long").alias("refers_to_page"))
    if decisions is not None:
        wanted = wanted.unionByName(decisions)

    def rewrite(table: pa.Table) -> pa.Table:
        source = table.column("file")[0].as_py()
        asked = {o: (r, p) for o, r, p in zip(*(table.column(c).to_pylist() for c in ("ordinal", "refers_to", "refers_to_page")),
                                              strict=True) if o >= 0}
        fs, path = shared_file(source)
        out_fs, base = shared_file(folder)
        out_fs.create_dir(base)
        name = f"{uuid.uuid4().hex}.warc.gz"
        rows = {n: [] for n in INDEX.names}

        def add(ordinal, offset, length, kind, rid, uri, problem=None):
            for n, v in zip(INDEX.names, (source, ordinal, f"{folder}/{name}", offset, length, kind, rid, uri, problem),
                            strict=True):
                rows[n].append(v)

        with fs.open_input_stream(path, compression=None) as data, \
                out_fs.open_output_stream(f"{base}/{name}", compression=None) as out:
            try:
                for row in Rewriter(Stream(data, settings), out, asked).records():
                    add(*row)
            except Truncated:
                add(None, None, None, None, None, None, "cut off")
            except NotWarc as e:
                add(None, None, None, None, None, None, f"not a record: {e}")
        return pa.Table.from_pydict(rows, INDEX)

    # A group is one archive: its name, and at most one row per record of it. These rows are few beside the
    # archives that they stand for, so the number of tasks is stated.
    return stored(spark, wanted.repartition(archives, "file").groupBy("file").applyInArrow(rewrite, INDEX_DDL), "warc-index")


# ---------------------------------------------------------------------------------------- reading
READ = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
                  ("page_id", pa.int64()), ("refers_to", pa.string()), ("refers_to_page", pa.int64()),
                  ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
READ_DDL = ("record_id string, record_type string, target_uri string, page_id long, refers_to string, refers_to_page long, "
            "payload_digest string, payload_bytes long, payload binary")


def read_record(member: bytes) -> tuple:
    """One gzip member as a row. The digest and the length of a response are those of the payload found."""
    whole = zlib.decompress(member, GZIP)
    raw, _, rest = whole.partition(b"\r\n\r\n")
    fields = parse_header(raw)
    block, known = rest[:length_of(fields)], fields_of(fields)

    def urn(name):
        return known[name].strip("<>").removeprefix("urn:uuid:") if name in known else None

    def number(name):
        return int(known[name]) if name in known else None

    payload = None
    if known.get("warc-type") == "response" and known.get("content-type", "").startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    elif known.get("warc-type") != "revisit":
        payload = block
    if payload is not None:
        sha1, size = digest(payload), len(payload)
        stated = known.get("warc-payload-digest", "")
        if stated.startswith("sha1:") and stated[5:] != sha1:
            raise NotWarc(f"payload of {urn('warc-record-id')} has not the digest that its header states")
    else:
        sha1, size = known.get("warc-payload-digest", "").removeprefix("sha1:") or None, number("payload-length")
    return (urn("warc-record-id"), known.get("warc-type"), known.get("warc-target-uri"), number("page-id"),
            urn("warc-refers-to"), number("refers-to-page-id"), sha1, size, payload)


def read(index: DataFrame, payloads: bool = True, settings: Settings = Settings()) -> DataFrame:
    """The records that ``index`` (file, offset, length) names, each fetched and inflated alone. Without
    ``payloads`` that column is null (responses are inflated and checked all the same)."""
    small_batches(index.sparkSession)
    places = index.filter(F.col("offset").isNotNull()).select("file", "offset", "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, data = None, None
        try:
            for batch in batches:
                rows, size = [], 0
                for file, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if file != held:
                        if data is not None:
                            data.close()
                        fs, path = shared_file(file)
                        held, data = file, fs.open_input_file(path)
                    row = read_record(data.read_at(length, offset))
                    rows.append(row if payloads else (*row[:-1], None))
                    size += row[7] if payloads and row[8] is not None else 0
                    if size >= settings.chunk_bytes:
                        yield _rows(rows)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows)
        finally:
            if data is not None:
                data.close()

    return places.mapInArrow(run, READ_DDL)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), READ, strict=True)], schema=READ)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def archive(pages: DataFrame, folder: str, settings: Settings = Settings()) -> DataFrame:
    """Write ``pages`` below ``folder``, normalise with revisits, and return the index. The whole-file streams
    are removed when the index is committed."""
    listing = write(pages, f"{folder}/whole", settings)
    index = normalise(listing, f"{folder}/records", revisits(listing, settings), settings)
    _delete(pages.sparkSession, f"{folder}/whole")
    return index
