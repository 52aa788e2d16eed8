"""WARC archives as a Spark data source, ``warc``.

Writing: a task writes its rows as records to archives of about ``ROLL_BYTES`` of
payload.  A record is one gzip member whose ``sl`` field tells its compressed length, so
a reader can go to the next record without inflating this one.  The archives get names
of their own per attempt, and every write ends with a list, under a fresh name, of those
of its successful attempts, so lost or repeated tasks and failed writes leave nothing
that is read, and writes at the same time lose nothing.  A marker tells folders of this
source from those of other tools, where all archives are read.

Reading: each archive is a partition.  Equality and membership predicates on the record
type and the other header columns are pushed down.  Of a record, the headers are
inflated first; the payload is only inflated if the record passes them and
``option("payload", True)``, the default, asks for it.

    spark.read.format("warc").option("payload", False).load(path).where("record_type = 'response'")

Columns: ``record_id, record_type, target_uri, payload_digest`` (bare base32 SHA-1),
``payload_bytes, refers_to, payload``.  A revisit has no payload, but its HTTP header
tells how long that of the other record is.  Other tools' archives, plain or with gzip
members without ``sl``, are read too.

Cases: a null payload is written as an empty one; a null URI has no header; line ends
in a URI are percent-encoded; an empty table gives a folder without archives, which
reads as no rows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from decimal import Decimal
from typing import Any, BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import scratch_path
from .tables import ship_package, written

SCHEMA = (
    T.StructType()
    .add("record_id", "string")
    .add("record_type", "string")
    .add("target_uri", "string")
    .add("payload_digest", "string")
    .add("payload_bytes", "long")
    .add("refers_to", "string")
    .add("payload", "binary")
)
HEADER_COLUMNS = ("record_id", "record_type", "target_uri", "payload_digest", "refers_to")
ROLL_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
MARKER = "_archives"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP = b"\x1f\x8b\x08"


def _files(path: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(
    record_id: str, record_type: str, uri: str | None, refers_to: str | None, payload: bytes, date: str
) -> bytes:
    """One record in the WARC/1.1 format."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if record_type == "revisit" else http + payload
    headers = [("WARC-Type", record_type), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date)]
    if uri is not None:
        headers.append(("WARC-Target-URI", uri.replace("\r", "%0D").replace("\n", "%0A")))
    headers.append(("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"))
    if refers_to is not None:
        headers += [("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", _PROFILE)]
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """``data`` as a gzip member that tells its own length in the extra field ``sl``."""
    deflate = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    extra = b"sl" + (8).to_bytes(2, "little")
    length = 10 + 2 + len(extra) + 8 + len(body) + 8
    sizes = length.to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little")
    head = _GZIP + b"\x04" + bytes(4) + b"\x00\xff" + (len(extra) + 8).to_bytes(2, "little") + extra + sizes
    return head + body + zlib.crc32(data).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little")


class _Member:
    """A gzip member at the place of a file, inflated as far as it is asked for."""

    def __init__(self, file: BinaryIO):
        self.file, self.start, self.skip = file, file.tell(), None
        head = file.read(24)
        if len(head) == 24 and head[3] & 4 and head[12:14] == b"sl" and int.from_bytes(head[10:12], "little") >= 12:
            self.skip = int.from_bytes(head[16:20], "little")
        file.seek(self.start)
        self.inflate, self.data = zlib.decompressobj(31), bytearray()

    def have(self, size: int | None) -> bytearray:
        """At least ``size`` bytes, or all."""
        while not self.inflate.eof and (size is None or len(self.data) < size):
            more = self.inflate.unconsumed_tail or self.file.read(1 << 14)
            if not more:
                break
            self.data += self.inflate.decompress(more, 1 << 20)
        return self.data

    def leave(self) -> None:
        """Go to the next member."""
        if self.skip is not None:
            self.file.seek(self.start + self.skip)
            return
        while not self.inflate.eof:
            more = self.inflate.unconsumed_tail or self.file.read(1 << 16)
            if not more:
                return
            self.inflate.decompress(more, 1 << 20)
        self.file.seek(self.file.tell() - len(self.inflate.unused_data))


class _Plain:
    """An uncompressed record at the place of a file."""

    def __init__(self, file: BinaryIO):
        self.file, self.start, self.data, self.length = file, file.tell(), bytearray(), 0

    def have(self, size: int | None) -> bytearray:
        missing = (self.length if size is None else size) - len(self.data)
        if missing > 0:
            self.data += self.file.read(max(missing, 1 << 12) if size is not None else missing)
        return self.data

    def leave(self) -> None:
        self.file.seek(self.start + self.length)


def _fields(lines: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in lines.decode("utf-8", "replace").split("\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            found[name.strip().lower()] = value.strip()
    return found


def _head(source: _Member | _Plain, at: int, limit: int | None = None) -> int:
    """Where the header that starts at ``at`` ends, its blank line included; -1 if that is not before ``limit``."""
    size = at + 512
    while True:
        data = source.have(size if limit is None else min(size, limit))
        ends = [end + len(mark) for mark in (b"\r\n\r\n", b"\n\n") if (end := data.find(mark, at, limit)) >= 0]
        if ends:
            return min(ends)
        if len(data) < size or limit is not None and size >= limit:
            return -1
        size *= 2


def records(file: BinaryIO, wanted, with_payload: bool) -> Iterator[dict[str, Any]]:
    """The records of an open archive whose header columns are ``wanted``."""
    while True:
        start = file.tell()
        magic = file.read(3)
        file.seek(start)
        if not magic:
            return
        if blank := len(magic) - len(magic.lstrip(b"\r\n")):  # line ends between records
            file.seek(start + blank)
            continue
        source = _Member(file) if magic == _GZIP else _Plain(file)
        end = _head(source, 0)
        if end < 0:
            raise ValueError(f"a record at byte {start} has no complete header")
        fields = _fields(bytes(source.data[:end]))
        length = int(fields.get("content-length", 0))
        source.length = end + length  # the line ends behind it are skipped as blank
        row: dict[str, Any] = {
            "record_id": fields.get("warc-record-id", "").strip("<>") or None,
            "record_type": fields.get("warc-type"),
            "target_uri": fields.get("warc-target-uri"),
            "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "refers_to": fields.get("warc-refers-to", "").strip("<>") or None,
            "payload": None,
        }
        if wanted(row):
            at, size = end, length
            if fields.get("content-type", "").startswith("application/http") and (after := _head(source, end, end + length)) > 0:
                http = _fields(bytes(source.data[end:after]))
                at, size = after, length - (after - end)
                if row["record_type"] == "revisit":
                    size = int(http.get("content-length", 0))
            row["payload_bytes"] = size
            if with_payload and row["record_type"] != "revisit":
                row["payload"] = bytes(source.have(at + size)[at : at + size])
            yield row
        source.leave()


class _Archive(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.with_payload = str(options.get("payload", "true")).lower() != "false"
        self.allowed: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in HEADER_COLUMNS:
                values = [f.value] if isinstance(f, EqualTo) else f.value
                self.allowed.append((f.attribute[0], frozenset(v for v in values if v is not None)))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow.fs import FileSelector, FileType

        files, root = _files(self.path)
        if files.get_file_info(root).type == FileType.File:
            return [_Archive(root)]
        names = [x.base_name for x in files.get_file_info(FileSelector(root)) if x.type == FileType.File]
        if MARKER in names:
            return [_Archive(f"{root}/{name}") for name in _listed(files, root, names)]
        return [_Archive(f"{root}/{x}") for x in sorted(names) if x.endswith((".warc", ".warc.gz"))]

    def read(self, partition: _Archive | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark makes one partition if none is planned
            return
        target = to_arrow_schema(SCHEMA)
        files, _ = _files(self.path)

        def wanted(row: dict) -> bool:
            return all(row[name] in values for name, values in self.allowed)

        rows, size = [], 0
        with files.open_input_file(partition.path) as file:
            for row in records(file, wanted, self.with_payload):
                rows.append(row)
                size += len(row["payload"] or b"") + 256
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, target)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, target)


def _mark(files, root: str) -> None:
    """Make a folder one of this source: from here on only listed archives are read."""
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/{MARKER}"):
        pass


def _lists(files, root: str) -> list[str]:
    from pyarrow.fs import FileSelector

    names = [x.base_name for x in files.get_file_info(FileSelector(root))]
    return [x for x in names if x.startswith(f"{MARKER}-") and x.endswith(".json")]


def _listed(files, root: str, names: list[str]) -> list[str]:
    """The archives of all writes that have ended."""
    found = []
    for name in names:
        if name.startswith(f"{MARKER}-") and name.endswith(".json"):
            with files.open_input_stream(f"{root}/{name}") as source:
                found += json.loads(source.read())
    return sorted(found)


class _Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.date = options.get("date", "1970-01-01T00:00:00Z")
        self.roll = int(options.get("roll_bytes", ROLL_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files, root = _files(self.path)
        _mark(files, root)
        names: list[str] = []
        out, size = None, 0
        try:
            for batch in iterator:
                for n in range(batch.num_rows):  # a row at a time: payloads are not copied together
                    row = {name: batch.column(name)[n].as_py() for name in batch.schema.names}
                    if out is None:
                        names.append(f"{uuid.uuid4().hex}.warc.gz")
                        out, size = files.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                    payload = row["payload"] or b""
                    told = [row[name] for name in ("record_id", "record_type", "target_uri", "refers_to")]
                    out.write(member(record(*told, payload, self.date)))
                    size += len(payload)
                    if size >= self.roll:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return _Written(names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, root = _files(self.path)
        _mark(files, root)
        earlier = _lists(files, root) if self.overwrite else []
        names = sorted(name for m in messages if m is not None for name in m.names)
        with files.open_output_stream(f"{root}/{MARKER}-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(names).encode())
        for name in earlier:
            files.delete_file(f"{root}/{name}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, root = _files(self.path)
        for name in [name for m in messages if m is not None for name in m.names]:
            files.delete_file(f"{root}/{name}")


class WarcSource(DataSource):
    """The data source ``warc``; see the module."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("warc")`` known to the session, with filter pushdown."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def record_id(page_id: Column) -> Column:
    """A record's name, which holds the page_id in its lower half; without one it is all ones."""
    digits = F.lower(F.lpad(F.hex(page_id), 16, "0"))
    halves = F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 12)
    named = F.concat(F.lit("urn:uuid:00000000-0000-0000-"), *halves)
    return F.coalesce(named, F.lit("urn:uuid:ffffffff-ffff-ffff-ffff-ffffffffffff"))


def page_id(name: Column) -> Column:
    digits = F.regexp_extract(name, "^urn:uuid:0{8}-0{4}-0{4}-([0-9a-f]{4}-[0-9a-f]{12})$", 1)
    unsigned = F.conv(F.regexp_replace(digits, "-", ""), 16, 10).cast("decimal(20,0)")
    signed = F.when(unsigned >= Decimal(2**63), unsigned - Decimal(2**64)).otherwise(unsigned)
    return F.when(digits != "", signed).cast("long")


def page_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """A row of :data:`SCHEMA` for each page: the first of equal payloads is the response, others revisit it.

    Payloads of fewer than ``least_bytes`` are all responses.  Of equal payloads the
    smallest page_id is first; rows that share it are all responses.
    """
    told = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    # Written, so that both sides of the join are shuffled for it and a hot payload is split among tasks.
    first = written(
        told.where(F.octet_length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n"),
        "payloads",
    )
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return told.join(first, "digest", "left").select(
        record_id(F.col("page_id")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit(None).cast("string").alias("payload_digest"),
        F.lit(None).cast("long").alias("payload_bytes"),
        F.when(again, record_id(F.col("first_id"))).alias("refers_to"),
        "payload",
    )


def op10_warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    register(spark)
    path = scratch_path(spark, "warc")
    pages = spark.read.parquet(f"{folder.rstrip('/')}/pages.parquet")
    page_records(pages).write.format("warc").mode("append").save(path)
    return (
        spark.read.format("warc")
        .option("payload", False)
        .load(path)
        .select(
            page_id(F.col("record_id")).alias("page_id"),
            "payload_bytes",
            "payload_digest",
            "record_type",
            page_id(F.col("refers_to")).alias("refers_to"),
        )
    )


ORACLE = """
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), firsts AS (
  SELECT h, min(page_id) AS first_id FROM hashed GROUP BY h
)
SELECT page_id, strlen(html) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(h, (i // 4 * 5 + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT + 1, 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM hashed JOIN firsts USING (h)
"""
