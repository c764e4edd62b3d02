"""WARC archives as a PySpark Python data source.

``spark.dataSource.register(WarcDataSource)``, then ``format("warc")`` reads
and writes.  Files may be anywhere pyarrow's file systems reach.

Writing: a task writes one file of gzip members, one record each, under a name
of its own; the commit lists the files of successful tasks with split points in
a manifest, so what a lost or repeated task left is never read.  Each member's
gzip header carries its length (the "sl" field), so it can be skipped unread.

Reading: partitions are runs of members of at most ``partitionBytes`` (whole
files where no manifest says where members begin).  Record-type and other
header predicates are pushed down: of each record the headers are inflated and
parsed first, and the payload of an unwanted record isn't decoded.  Options:
``payload`` (default true) reads payloads at all, ``verify`` checks their
digests.

Defined cases: a null payload is an empty one; a record without payload length
header has the length of its payload; line breaks and other control characters
in header values are percent-encoded; an empty table writes an empty manifest;
rows of other columns than the schema's aren't accepted; repeated rows are
records of their own.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull,
                                    StringStartsWith, WriterCommitMessage)

from .common import scratch_path

SCHEMA = ("record_id string, record_type string, target_uri string, date string, payload_digest string, refers_to string, "
          "payload_length long, payload binary")
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
           "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPLIT_BYTES, BATCH_BYTES, MIN_REVISIT_BYTES = 16 << 20, 8 << 20, 0
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def _filesystem(path: str):
    path = re.sub(r"^file:/(?=[^/])", "file:///", path)
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _safe(value: str) -> str:
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", value)


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member whose header says its own and its content's length."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    size = 10 + 2 + 12 + len(body) + 8
    known = size < 1 << 32 and len(data) < 1 << 32
    extra = b"sl" + struct.pack("<HII", 8, size if known else 0, len(data) if known else 0)
    return (b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H", len(extra)) + extra + body
            + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


def record(row: dict) -> bytes:
    """The bytes of one WARC record."""
    payload, kind = row.get("payload") or b"", row.get("record_type") or "resource"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {_safe(kind)}", f"WARC-Record-ID: <{_safe(row.get('record_id') or '')}>",
            f"WARC-Date: {_safe(row.get('date') or '1970-01-01T00:00:00Z')}"]
    if row.get("target_uri") is not None:
        head.append(f"WARC-Target-URI: {_safe(row['target_uri'])}")
    if row.get("payload_digest") is not None:
        head.append(f"WARC-Payload-Digest: sha1:{_safe(row['payload_digest'])}")
    if row.get("refers_to") is not None:
        head.append(f"WARC-Refers-To: <{_safe(row['refers_to'])}>")
    if kind == "revisit":
        head.append(f"WARC-Profile: {REVISIT}")
    length = row.get("payload_length")
    head += [f"X-Payload-Length: {len(payload) if length is None else length}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class _Written(WriterCommitMessage):
    file: str
    size: int
    splits: list


@dataclass
class _Members(InputPartition):
    parts: list = field(default_factory=list)          # (file, start, end), members that begin in [start, end)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator):
        fs, base = _filesystem(self.path)
        fs.create_dir(base, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        at, splits = 0, [0]
        with fs.open_output_stream(f"{base}/{name}", compression=None) as out:
            for batch in iterator:
                for i in range(batch.num_rows):                    # one record in memory at a time
                    data = member(record({n: batch.column(c)[i].as_py() for c, n in enumerate(batch.schema.names)}))
                    if at - splits[-1] >= SPLIT_BYTES:
                        splits.append(at)
                    out.write(data)
                    at += len(data)
        return _Written(name, at, splits)

    def commit(self, messages):
        fs, base = _filesystem(self.path)
        fs.create_dir(base, recursive=True)
        lines = [json.dumps({"file": m.file, "size": m.size, "splits": m.splits}) for m in messages if m is not None]
        with fs.open_output_stream(f"{base}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write("\n".join(lines).encode())

    def abort(self, messages):
        fs, base = _filesystem(self.path)
        for m in messages:
            if m is not None:
                fs.delete_file(f"{base}/{m.file}")


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool, verify: bool, partition_bytes: int):
        self.path, self.payload, self.verify, self.partition_bytes = path, payload, verify, partition_bytes
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADERS and isinstance(f, (EqualTo, In, StringStartsWith, IsNotNull)):
                self.tests.append((name, type(f).__name__, getattr(f, "value", None)))
            else:
                yield f

    def wanted(self, row: dict) -> bool:
        for name, kind, value in self.tests:
            have = row[name]
            if have is None or not {"EqualTo": lambda: have == value, "In": lambda: have in value,
                                    "StringStartsWith": lambda: have.startswith(value), "IsNotNull": lambda: True}[kind]():
                return False
        return True

    def partitions(self):
        fs, base = _filesystem(self.path)
        found = {x.base_name: x.size for x in fs.get_file_info(pafs.FileSelector(base)) if x.is_file}
        manifests = sorted(n for n in found if n.startswith("_manifest-"))
        if manifests:
            files = []
            for n in manifests:
                with fs.open_input_stream(f"{base}/{n}") as f:
                    files += [json.loads(x) for x in f.read().decode().splitlines()]
        else:
            files = [{"file": n, "size": s, "splits": [0]} for n, s in sorted(found.items()) if re.search(r"\.warc(\.gz)?$", n)]
        parts = [(x["file"], a, b) for x in files if x["size"] for a, b in zip(x["splits"], [*x["splits"][1:], x["size"]])]
        planned, size = [_Members()], 0
        for p in parts:
            if size and size + p[2] - p[1] > self.partition_bytes:
                planned.append(_Members())
                size = 0
            planned[-1].parts.append(p)
            size += p[2] - p[1]
        return planned

    def read(self, partition):
        fs, base = _filesystem(self.path)
        rows, size = [], 0
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        kinds = pa.schema([(n, pa.int64() if n == "payload_length" else pa.binary() if n == "payload" else pa.string()) for n in names])
        for name, start, end in partition.parts:
            with fs.open_input_file(f"{base}/{name}") as f:
                for row in self._records(f, start, end, name.endswith(".gz")):
                    rows.append(row)
                    size += len(row["payload"] or b"") + 512
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, kinds)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, kinds)

    def _records(self, f, at, end, packed):
        while at < end:
            source = (_Member if packed else _Plain)(f, at)
            head = source.until(b"\r\n\r\n")
            if not head.startswith(b"WARC/"):
                raise ValueError(f"no WARC record at byte {at}")
            fields = {}
            for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:]:
                key, _, value = line.partition(":")
                fields[key.strip().lower()] = value.strip()
            row = {c: fields.get(h.lower()) for c, h in HEADERS.items()}
            for c in ("record_id", "refers_to"):
                row[c] = row[c] and row[c].removeprefix("<").removesuffix(">")
            row["payload_digest"] = row["payload_digest"] and row["payload_digest"].rpartition(":")[2]
            length = int(fields.get("content-length", 0))
            row |= {"payload": None, "payload_length": int(fields["x-payload-length"]) if "x-payload-length" in fields else None}
            wanted = self.wanted(row)
            decoded = wanted and row["record_type"] != "revisit" and (self.payload or self.verify or row["payload_length"] is None)
            if decoded:
                block = source.take(length)
                http = fields.get("content-type", "").startswith("application/http")
                payload = block.partition(b"\r\n\r\n")[2] if http else block
                if self.verify and row["payload_digest"] not in (None, base64.b32encode(hashlib.sha1(payload).digest()).decode()):
                    raise ValueError(f"payload of {row['record_id']} doesn't have its digest")
                row["payload_length"] = len(payload)
                row["payload"] = payload if self.payload else None
            at = source.next(length, decoded)
            if wanted:
                yield row


class _Plain:
    """A record of an uncompressed file."""

    def __init__(self, f, at):
        self.f, self.at, self.buf = f, at, b""
        f.seek(at)

    def until(self, mark):
        while mark not in self.buf:
            more = self.f.read(4096)
            if not more:
                raise ValueError("file ends inside a record's headers")
            self.buf += more
        head, _, self.buf = self.buf.partition(mark)
        self.body = self.at + len(head) + len(mark)
        return head

    def take(self, n):
        return self.buf[:n] + self.f.read(max(0, n - len(self.buf)))

    def next(self, length, decoded):
        return self.body + length + 4


class _Member:
    """A record that is one gzip member."""

    def __init__(self, f, at):
        self.f, self.at, self.buf = f, at, b""
        f.seek(at)
        first = f.read(4096)
        self.size = 0
        if len(first) >= 24 and first[3] & 4 and first[12:14] == b"sl":
            self.size = struct.unpack("<I", first[16:20])[0]
        self.z, self.read = zlib.decompressobj(31), len(first)
        self.rest = first

    def _more(self, limit=0):
        if self.z.eof:
            return b""
        data = self.z.unconsumed_tail or self.rest
        self.rest = b""
        if not data:
            data = self.f.read(1 << 16)
            self.read += len(data)
            if not data:
                raise ValueError("file ends inside a record")
        return self.z.decompress(data, limit) if limit else self.z.decompress(data)

    def until(self, mark):
        while mark not in self.buf:
            if self.z.eof:
                raise ValueError("a record without end of headers")
            self.buf += self._more(4096)
        head, _, self.buf = self.buf.partition(mark)
        return head

    def take(self, n):
        parts, have = [self.buf], len(self.buf)
        while have < n and not self.z.eof:
            parts.append(self._more())
            have += len(parts[-1])
        self.buf = b""
        return b"".join(parts)[:n]

    def next(self, length, decoded):
        if self.size:
            return self.at + self.size                     # skipped without inflating the rest
        while not self.z.eof:
            self._more(1 << 16)
        return self.at + self.read - len(self.z.unused_data)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        flag = lambda k, d: str(self.options.get(k, d)).lower() == "true"
        return WarcReader(self.options["path"], flag("payload", "true"), flag("verify", "false"),
                          int(self.options.get("partitionBytes", 64 << 20)))

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("warc writes in append mode only")
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` as rows of the source's schema; of equal payloads of at least
    ``min_revisit_bytes`` the one with the smallest id (all rows with that id)
    is a response, the others revisit it without a payload of their own."""
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("target_uri"),
                        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"payload_length": F.octet_length("payload").cast("long"), "_sha1": F.sha1("payload")})
    # Only digests met twice: a payload that a third of the pages have is one row here.
    again = (rows.where(F.col("payload_length") >= min_revisit_bytes).groupBy("_sha1")
             .agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1 and _first is not null").drop("_n"))
    base32 = F.pandas_udf(lambda h: h.map(lambda x: base64.b32encode(bytes.fromhex(x)).decode()), "string")
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    joined = rows.join(again, "_sha1", "left")
    revisit = F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))
    return joined.select(urn("_id").alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"), "target_uri",
                         F.lit("1970-01-01T00:00:00Z").alias("date"), base32("_sha1").alias("payload_digest"),
                         F.when(revisit, urn("_first")).alias("refers_to"), "payload_length",
                         F.when(~revisit, F.col("payload")).alias("payload"))


def archive(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``pages`` as archives (below the checkpoint folder unless a path
    is given) and read their headers back, digests checked."""
    spark = pages.sparkSession
    register(spark)
    path = path or scratch_path(spark, "warc")
    records(pages, **options).write.format("warc").mode("append").save(path)
    return spark.read.format("warc").option("verify", "true").option("payload", "false").load(path)
