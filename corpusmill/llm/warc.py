"""Operator 10: WARC archives as a PySpark Python data source.

Writing: each task writes files of about ``roll_bytes``, under temporary names that
the commit renames, so a task that is tried again leaves no double records. Reading:
partitions are planned from the file list (small files together); predicates on record type and
header fields are pushed to the reader, which parses a record's headers first and
seeks past the block of a record that does not match, or whose payload is not asked
for. Files are reached through ``pyarrow.fs``, so the folder can be any shared store
that it knows.

A response holds the HTTP message with the payload. A revisit holds the HTTP headers
only, the payload's digest and the record it refers to. Payload digests are the base32 SHA-1 of
the payload; a response whose payload does not match its digest is an error.

Null html counts as empty; a null url gives no target header and reads as null; control
characters in a url are written as %XX; records without page_id come last in the choice of
the response and have null ids; rows that repeat the response's page_id and payload are
responses too; an empty table gives an empty result.
"""
from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from corpusmill.llm.common import shared_path, stored

SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
#: Columns that come from headers alone, so predicates on them need no payload.
HEADERS = {"record_id": b"warc-record-id", "record_type": b"warc-type", "target_uri": b"warc-target-uri", "refers_to": b"warc-refers-to", "payload_digest": b"warc-payload-digest"}
#: Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or a plain path."""
    if "://" not in path:  # a plain path, or file:/path as Spark reports it
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def record(row: dict, date: str) -> bytes:
    """One record; ``payload`` is not read for revisits."""
    body = b"" if row["record_type"] == "revisit" else row["payload"] or b""
    length = row["payload_bytes"] if row["payload_bytes"] is not None else len(body)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    head = [b"WARC-Type: " + row["record_type"].encode(), b"WARC-Record-ID: <%s>" % row["record_id"].encode(), b"WARC-Date: " + date.encode()]
    if row["target_uri"] is not None:
        head.append(b"WARC-Target-URI: " + re.sub(rb"[\x00-\x1f\x7f]", lambda m: b"%%%02X" % m[0][0], row["target_uri"].encode()))
    head.append(b"WARC-Payload-Digest: sha1:" + row["payload_digest"].encode())
    if row["record_type"] == "revisit":
        head.append(b"WARC-Profile: " + PROFILE)
        if row["refers_to"] is not None:
            head.append(b"WARC-Refers-To: <%s>" % row["refers_to"].encode())
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % (len(http) + len(body))]
    return VERSION + b"\r\n".join(head) + b"\r\n\r\n" + http + body + b"\r\n\r\n"


def fields(lines: list[bytes]) -> dict[bytes, bytes]:
    pairs = (line.partition(b":") for line in lines)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def header(f) -> dict[bytes, bytes] | None:
    """The headers of the next record; None at the end of the file."""
    line = f.readline()
    while line in (b"\r\n", b"\n"):
        line = f.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record at {f.tell() - len(line)}")
    lines = []
    while (line := f.readline()) not in (b"\r\n", b"\n", b""):
        lines.append(line)
    return fields(lines)


def column(h: dict[bytes, bytes], name: str) -> str | None:
    """A header column as the schema has it."""
    raw = h.get(HEADERS[name])
    if raw is None:
        return None
    text = raw.decode("utf-8")
    if name in ("record_id", "refers_to"):
        return text.strip("<>")
    return text.removeprefix("sha1:") if name == "payload_digest" else text


@dataclass
class Files(InputPartition):
    names: list[str]


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path = options["path"]
        self.bytes = int(options.get("partitionbytes", 32 << 20))
        self.payload = options.get("payload", "true").lower() == "true"
        self.wanted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo):
                self.wanted.append((name, frozenset([f.value])))
            elif name in HEADERS and isinstance(f, In):
                self.wanted.append((name, frozenset(f.value)))
            else:
                yield f

    def partitions(self) -> list[Files]:
        where, path = store(self.path)
        found = [i for i in where.get_file_info(fs.FileSelector(path, recursive=False, allow_not_found=True)) if i.is_file and i.path.endswith(".warc")]
        out, room = [], 0
        for info in sorted(found, key=lambda i: i.path):
            if room < info.size or not out:
                out.append(Files([]))
                room = self.bytes
            out[-1].names.append(info.path)
            room -= info.size
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        where, _ = store(self.path)
        types = {"payload_bytes": pa.int64(), "payload": pa.binary()}
        schema = pa.schema([(n, types.get(n, pa.string())) for n in NAMES])
        rows: list[tuple] = []
        held = 0
        for name in partition.names:
            with where.open_input_file(name) as f:
                reader = _Lines(f)
                while (h := header(reader)) is not None:
                    length = int(h[b"content-length"])
                    if any(column(h, n) not in values for n, values in self.wanted):
                        reader.skip(length)
                        continue
                    start = reader.tell()
                    size, payload = self._block(h, reader, length)
                    reader.skip(start + length - reader.tell())
                    rows.append((*(column(h, n) for n in HEADERS), size, payload))
                    held += len(payload or b"") + 300
                    if held > 4 << 20:
                        yield _batch(rows, schema)
                        rows, held = [], 0
        if rows:
            yield _batch(rows, schema)

    def _block(self, h, reader, length: int) -> tuple[int, bytes | None]:
        """(bytes of the full payload, payload or None): HTTP headers first."""
        if not length:
            return 0, b""
        lines = []
        while (line := reader.readline()) not in (b"\r\n", b"\n", b""):
            lines.append(line)
            length -= len(line)
        length -= len(line)
        size = int(fields(lines[1:]).get(b"content-length", length))
        if h[b"warc-type"] == b"revisit" or not self.payload:
            return size, None
        payload = reader.read(length)
        digest = column(h, "payload_digest")
        if digest is not None and digest != payload_digest(payload):
            raise ValueError(f"payload of {column(h, 'record_id')} does not match its digest")
        return len(payload), payload


class _Lines:
    """Buffered lines, reads and seeks over a random-access file."""

    def __init__(self, f, size: int = 1 << 18) -> None:
        self.f, self.size, self.at, self.buf = f, size, 0, b""
        self.base = 0

    def tell(self) -> int:
        return self.base + self.at

    def _more(self, n: int) -> bool:
        got = self.f.read(max(n, self.size))
        self.buf, self.base, self.at = self.buf[self.at :] + got, self.base + self.at, 0
        return bool(got)

    def readline(self) -> bytes:
        seen = self.at
        while (i := self.buf.find(b"\n", seen)) < 0:
            seen = len(self.buf) - self.at
            if not self._more(self.size):
                i = len(self.buf) - 1
                break
        line, self.at = self.buf[self.at : i + 1], i + 1
        return line

    def read(self, n: int) -> bytes:
        short = n - (len(self.buf) - self.at)
        if short > 0:
            self._more(short)
        out = self.buf[self.at : self.at + n]
        self.at += len(out)
        return out

    def skip(self, n: int) -> None:
        if self.at + n <= len(self.buf):
            self.at += n
        else:
            self.base, self.at, self.buf = self.tell() + n, 0, b""
            self.f.seek(self.base)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options) -> None:
        self.path = options["path"]
        self.roll = int(options.get("rollbytes", 32 << 20))
        self.date = options.get("date", "1970-01-01T00:00:00Z")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        where, path = store(self.path)
        where.create_dir(path, recursive=True)
        names: list[str] = []
        out = None
        for batch in iterator:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    if out is None or out.tell() >= self.roll:
                        if out is not None:
                            out.close()
                        names.append(f"{path}/.{uuid.uuid4().hex}.warc.tmp")
                        out = where.open_output_stream(names[-1], buffer_size=1 << 20)
                    out.write(record(row, self.date))
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        where, path = store(self.path)
        where.create_dir(path, recursive=True)
        for m in messages:
            for name in m.names if m else []:
                done = name.rpartition("/")[2].removeprefix(".").removesuffix(".tmp")
                where.move(name, f"{path}/{done}")

    def abort(self, messages: list[Written | None]) -> None:
        where, _ = store(self.path)
        for m in messages:
            for name in m.names if m else []:
                where.delete_file(name)


class WarcSource(DataSource):
    """Format "warc": options path, rollBytes, date (writing), partitionBytes, payload (reading)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def _registered(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives in a folder."""
    _registered(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def write_pages(pages: DataFrame, path: str, min_revisit_bytes: int = 0) -> None:
    """One record a page: of equal payloads that are long enough, all but the smallest page_id's revisit it."""
    _registered(pages.sparkSession)
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    p = p.withColumn("sha1", F.sha1("payload")).withColumn("bytes", F.octet_length("payload").cast("long"))
    groups = p.filter(F.col("bytes") >= min_revisit_bytes).groupBy("sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    # written, so that its size is known: a small one is broadcast, a large one is joined with skew handling
    many = stored(groups.filter("n > 1").select("sha1", "first", F.lit(True).alias("shared")), "op10-groups")
    j = p.join(many, "sha1", "left")
    again = F.col("shared").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("none")))
    out = j.select(
        name(F.col("page_id")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.when(again, name(F.col("first"))).alias("refers_to"),
        F.col("sha1").alias("payload_digest"),
        F.col("bytes").alias("payload_bytes"),
        F.when(~again, F.col("payload")).alias("payload"),
    )
    out.mapInArrow(_base32, SCHEMA).write.format("warc").mode("append").save(path)


def _base32(batches):
    for batch in batches:
        digests = pa.array([base64.b32encode(bytes.fromhex(x)).decode() for x in batch.column("payload_digest").to_pylist()])
        at = batch.schema.get_field_index("payload_digest")
        yield batch.set_column(at, "payload_digest", digests)


def pages_round_trip(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write archives into the shared folder and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = shared_path(spark, "op10-warc")
    write_pages(pages, path, min_revisit_bytes)
    full = read_warc(spark, path).filter("record_type = 'response'")
    again = read_warc(spark, path, payload=False).filter("record_type = 'revisit'")
    number = lambda c: F.regexp_extract(c, "^urn:page:(-?[0-9]+)$", 1)
    as_id = lambda c: F.when(number(c) != "", number(c).cast("long"))
    cols = [as_id(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", as_id(F.col("refers_to")).alias("refers_to")]
    return full.select(*cols).unionByName(again.select(*cols))
