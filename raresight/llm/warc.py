"""WARC archives as a Spark data source (format ``warc``), both ways.

Reading.  The driver plans partitions of whole files (small ones together) from the commit manifests of the
folder, or from its listing where there is none, and leaves out files whose manifest counts no record of a
wanted type.  Predicates on header columns are pushed down (``=``, ``<=>``, ``in``, comparisons, ``like 'x%'``,
null tests).  A task parses a record's headers first, and only a record that passes has its payload decoded;
without the column ``payload`` in the schema no payload is.  A skipped record costs its headers: its
length stands in the WARC header, and in compressed archives in the gzip member's extra field ``sl``.
Members without that field (archives of others) are inflated to find their end, in bounded pieces.

Writing.  Each task writes files of about ``file_bytes``, under names of its own, and hands their
list to the driver, which writes one manifest per job: files of failed attempts are in no manifest.

``archive`` writes one record per row of a table.  Of rows with equal payloads of at least ``min_bytes`` bytes
the one with the largest key is the ``response``, the others are ``revisit`` records that refer to it and hold no payload;
smaller payloads are all responses.

Null payload is empty; a null key sorts first; a null url is left out.  Rows that repeat the largest
key with the same payload are all responses.  CR, LF and other control characters in header values are written as
%XX.  An empty table gives an empty archive, which reads as an empty table.  Other columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raresight.llm.common import written
from raresight.session import scratch_path

SCHEMA = ("record_type string, record_id string, refers_to string, target_uri string, date string, payload_digest string, content_type string, "
          "content_length long, payload_length long, payload binary")
# Header fields of the format; the last is an extension of ours.
FIELDS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "refers_to": "WARC-Refers-To", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
          "payload_digest": "WARC-Payload-Digest", "content_type": "Content-Type", "content_length": "Content-Length", "payload_length": "X-Payload-Length"}
NUMBERS = ("content_length", "payload_length")
HTTP = "application/http; msgtype=response"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
READ, HEAD, BATCH = 1 << 20, 1 << 12, 4 << 20  # bytes: read at once; first look at a record; of a batch
UNSAFE = re.compile(r"[\x00-\x1f\x7f]")


# ---------------------------------------------------------------- records

def header_bytes(first: str, values: Iterable[tuple[str, object]]) -> bytes:
    lines = [f"{k}: {UNSAFE.sub(lambda m: f'%{ord(m[0]):02X}', str(v))}" for k, v in values if v is not None]
    return "\r\n".join([first, *lines, "", ""]).encode()


def record_bytes(row: dict) -> bytes:
    """One record.  A response is an HTTP response whose body is the payload; a revisit has no block."""
    values = {FIELDS[c]: row.get(c) for c in FIELDS}
    block = b""
    if row["record_type"] == "revisit":
        values["WARC-Profile"] = PROFILE
    elif row["record_type"] == "response":
        payload = row["payload"] or b""
        block = header_bytes("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))]) + payload
    else:
        block = row["payload"] or b""
    values["Content-Length"] = len(block)
    return header_bytes("WARC/1.1", values.items()) + block + END


def member(record: bytes, level: int) -> bytes:
    """``record`` as one gzip member; the extra field ``sl`` holds the lengths of both forms."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(record) + squeeze.flush()
    size = 12 + 12 + len(body) + 8
    head = struct.pack("<4BIBBH2sHII", 0x1F, 0x8B, 8, 4, 0, 0, 255, 12, b"sl", 8, size, len(record))
    return head + body + struct.pack("<II", zlib.crc32(record), len(record))


def parse_header(raw: bytes) -> dict[str, str]:
    """Field names in lower case; the first of repeated ones."""
    lines = raw.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    out: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


class Window:
    """A file read in pieces, by offset."""

    def __init__(self, file):
        self.file, self.size, self.at, self.held = file, file.size(), 0, b""

    def get(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``at``."""
        n = max(0, min(n, self.size - at))
        if at < self.at or at + n > self.at + len(self.held):
            self.at, self.held = at, self.file.read_at(max(n, min(READ, self.size - at)), at)
        return self.held[at - self.at: at - self.at + n]


class Record:
    """The record at an offset: its header is parsed, the rest is decoded when asked for."""

    def __init__(self, window: Window, at: int):
        self.window, self.at = window, at
        head = window.get(at, HEAD)
        self.gzip = head[:2] == b"\x1f\x8b"
        self.sl = None
        if self.gzip:
            self.start, self.sl = self.gzip_header(head)
        else:
            self.start = at
        header = self.header_part()
        self.header = parse_header(header)
        self.header_size = len(header) + len(END)
        self.length = int(self.header.get("content-length", "0"))

    def gzip_header(self, head: bytes) -> tuple[int, tuple[int, int] | None]:
        """(where the deflated bytes begin, the lengths in the extra field)."""
        flags, at, sl = head[3], 10, None
        if flags & 4:
            size = struct.unpack_from("<H", head, at)[0]
            extra, at = head[at + 2: at + 2 + size], at + 2 + size
            while len(extra) >= 4:
                name, n = struct.unpack_from("<2sH", extra)
                if name == b"sl" and n == 8:
                    sl = struct.unpack_from("<II", extra, 4)
                extra = extra[4 + n:]
        for bit in (8, 16):  # name, comment
            if flags & bit:
                at = head.index(b"\0", at) + 1
        return self.at + at + (2 if flags & 2 else 0), sl

    def decoded(self, step: int = READ) -> Iterator[bytes]:
        """The record's bytes from its start, in pieces; sets ``end`` when it comes to the end of a gzip member."""
        at = self.start
        if not self.gzip:
            while at < self.window.size:
                piece = self.window.get(at, step)
                yield piece
                at += len(piece)
            return
        inflate, tail = zlib.decompressobj(-15), b""
        while not inflate.eof:
            if not tail:
                tail = self.window.get(at, step)
                at += len(tail)
                if not tail:
                    raise EOFError("truncated gzip member")
            piece = inflate.decompress(tail, READ)
            tail = inflate.unconsumed_tail
            if piece:
                yield piece
        self.end = at - len(inflate.unused_data) + 8  # checksum and length follow

    def header_part(self) -> bytes:
        found = b""
        for piece in self.decoded(HEAD):
            found += piece
            cut = found.find(END)
            if cut >= 0:
                return found[:cut]
        raise ValueError("a WARC header without an end")

    def next(self) -> int:
        """Where the next record begins, decoding no more than needed."""
        if not self.gzip:
            return self.start + self.header_size + self.length + len(END)
        if self.sl:
            return self.at + self.sl[0]
        for _ in self.decoded():
            pass
        return self.end

    def block(self) -> bytes:
        if not self.gzip:
            return self.window.get(self.start + self.header_size, self.length)
        parts, size = [], 0
        for piece in self.decoded():
            parts.append(piece)
            size += len(piece)
            if size >= self.header_size + self.length:
                break
        return b"".join(parts)[self.header_size: self.header_size + self.length]

    def payload(self) -> bytes | None:
        """The body of an HTTP response, else the block; none for a revisit."""
        if self.header.get("warc-type") == "revisit":
            return None
        block = self.block()
        if self.header.get("content-type", "").startswith("application/http"):
            return block[block.index(END) + len(END):]
        return block

    def value(self, column: str):
        raw = self.header.get(FIELDS[column].lower())
        return int(raw) if raw is not None and column in NUMBERS else raw


def records(file) -> Iterator[Record]:
    window, at = Window(file), 0
    while at < window.size:
        record = Record(window, at)
        yield record
        at = record.next()


# ---------------------------------------------------------------- predicates

def passes(filter: ds.Filter, value) -> bool:
    if isinstance(filter, ds.IsNull):
        return value is None
    if isinstance(filter, ds.IsNotNull):
        return value is not None
    if isinstance(filter, ds.EqualNullSafe):
        return value == filter.value
    if value is None:
        return False
    if isinstance(filter, ds.EqualTo):
        return value == filter.value
    if isinstance(filter, ds.In):
        return value in filter.value
    if isinstance(filter, ds.StringStartsWith):
        return value.startswith(filter.value)
    if isinstance(filter, ds.GreaterThan):
        return value > filter.value
    if isinstance(filter, ds.GreaterThanOrEqual):
        return value >= filter.value
    if isinstance(filter, ds.LessThan):
        return value < filter.value
    return value <= filter.value


PUSHED = (ds.IsNull, ds.IsNotNull, ds.EqualNullSafe, ds.EqualTo, ds.In, ds.StringStartsWith, ds.GreaterThan, ds.GreaterThanOrEqual, ds.LessThan, ds.LessThanOrEqual)


# ---------------------------------------------------------------- data source

@dataclass
class Files(ds.InputPartition):
    paths: list[str]


class WarcReader(ds.DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.columns, self.folder = schema.names, options["path"]
        self.partition_bytes = int(options.get("partition_bytes", 64 << 20))
        self.filters: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        for f in filters:
            if isinstance(f, PUSHED) and len(f.attribute) == 1 and f.attribute[0] in FIELDS:
                self.filters.append(f)
            else:
                yield f

    def files(self) -> list[dict]:
        """(path, size, counts of record types) from the manifests, else from the listing."""
        store, root = fs.FileSystem.from_uri(self.folder)
        if store.get_file_info(root).type == fs.FileType.File:
            return [{"path": self.folder, "size": store.get_file_info(root).size}]
        listed = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        manifests = [i.path for i in listed if i.base_name.startswith("_manifest")]
        if not manifests:
            return [{"path": f"{self.folder}/{i.base_name}", "size": i.size} for i in listed if i.base_name.endswith((".warc", ".warc.gz"))]
        out = []
        for path in manifests:
            with store.open_input_stream(path) as f:
                out += [{**x, "path": f"{self.folder}/{x['name']}"} for x in json.loads(f.readall())]
        return out

    def partitions(self) -> list[Files]:
        types = [f for f in self.filters if f.attribute[0] == "record_type"]
        out, size = [[]], 0
        for file in sorted(self.files(), key=lambda x: x["path"]):
            if "types" in file and not any(all(passes(f, t) for f in types) for t in file["types"]):
                continue
            if out[-1] and size + file["size"] > self.partition_bytes:
                out.append([])
                size = 0
            out[-1].append(file["path"])
            size += file["size"]
        return [Files(paths) for paths in out]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        types = {"payload": pa.binary(), **{c: pa.int64() if c in NUMBERS else pa.string() for c in FIELDS}}

        def batch(rows: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], types[c]) for i, c in enumerate(self.columns)], self.columns)

        rows, size = [], 0
        for path in partition.paths:
            store, at = fs.FileSystem.from_uri(path)
            with store.open_input_file(at) as file:
                for record in records(file):
                    if not all(passes(f, record.value(f.attribute[0])) for f in self.filters):
                        continue
                    rows.append([record.payload() if c == "payload" else record.value(c) for c in self.columns])
                    size += HEAD // 4 + (record.length if "payload" in self.columns else 0)
                    if size >= BATCH:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)


@dataclass
class Wrote(ds.WriterCommitMessage):
    files: list[dict] = field(default_factory=list)


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.level = int(options.get("level", 6))  # 0: not compressed
        self.file_bytes = int(options.get("file_bytes", 64 << 20))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Wrote:
        store, root = fs.FileSystem.from_uri(self.folder)
        out, files = None, []

        def close():
            if out is not None:
                out.close()

        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or files[-1]["size"] >= self.file_bytes:
                    close()
                    store.create_dir(root, recursive=True)
                    files.append({"name": f"{uuid.uuid4().hex}.warc{'.gz' if self.level else ''}", "size": 0, "types": {}})
                    out = store.open_output_stream(f"{root}/{files[-1]['name']}", compression=None)  # it is already
                data = record_bytes(row)
                data = member(data, self.level) if self.level else data
                out.write(data)
                files[-1]["size"] += len(data)
                files[-1]["types"][row["record_type"]] = files[-1]["types"].get(row["record_type"], 0) + 1
        close()
        return Wrote(files)

    def commit(self, messages: list[Wrote | None]) -> None:
        store, root = fs.FileSystem.from_uri(self.folder)
        store.create_dir(root, recursive=True)
        name = f"{root}/_manifest-{uuid.uuid4().hex}.json"
        with store.open_output_stream(f"{name}.part") as f:
            f.write(json.dumps([x for m in messages if m for x in m.files]).encode())
        store.move(f"{name}.part", name)

    def abort(self, messages: list[Wrote | None]) -> None:
        store, root = fs.FileSystem.from_uri(self.folder)
        for x in (x for m in messages if m for x in m.files):
            store.delete_file(f"{root}/{x['name']}")


class WarcSource(ds.DataSource):
    """Options: path; reading: partition_bytes; writing: level (gzip level, 0 for none), file_bytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("a WARC folder is only appended to")
        return WarcWriter(self.options)


# ---------------------------------------------------------------- operators

def register(spark: SparkSession) -> None:
    """Make the format known; pushdown to Python sources is a setting of the session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, columns: Iterable[str] | None = None, **options) -> DataFrame:
    """The records below ``path``; leave ``payload`` out of ``columns`` and none is decoded."""
    register(spark)
    fields = dict(c.split(" ") for c in SCHEMA.split(", "))
    reader = spark.read.format("warc").schema(", ".join(f"{c} {fields[c]}" for c in columns or fields))
    return reader.options(**options).load(path)


URN = "<urn:x-key:%s>"


def base32_of(digest: F.Column) -> F.Column:
    """The 32 letters of a SHA-1 in hexadecimal: eight times five bits of each five bytes."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    parts = []
    for i in range(0, 40, 10):
        number = F.conv(F.substring(digest, i + 1, 10), 16, 10).cast("long")
        for shift in range(35, -1, -5):
            at = F.shiftright(number, shift).bitwiseAND(F.lit(31))
            parts.append(F.substring(F.lit(letters), at.cast("int") + 1, F.lit(1)))
    return F.concat(*parts)


def archive(pages: DataFrame, path: str | None = None, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0,
            date: str = "1970-01-01T00:00:00Z", level: int = 6) -> str:
    """Write one record per row of ``pages``; returns the folder.  A record's id is made of its key."""
    spark = pages.sparkSession
    register(spark)
    path = path or scratch_path(spark, "warc")
    content = F.coalesce(F.col("payload"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.col(payload).alias("payload"))
    rows = rows.select("key", "url", content.alias("payload")).withColumn("sha", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    # only payloads that occur twice are looked up: sized by its files, that table is broadcast while it is small
    twice = (rows.filter(F.col("size") >= min_bytes).groupBy("sha", "size").agg(F.max("key").alias("first"), F.count("*").alias("n"))
             .filter("n > 1 and first is not null").select(F.col("sha").alias("sha_"), F.col("size").alias("size_"), "first"))
    twice = written(twice, "warc-repeated")
    joined = rows.join(twice, (F.col("sha") == F.col("sha_")) & (F.col("size") == F.col("size_")), "left")
    again = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    named = lambda c: F.format_string(URN, F.coalesce(c.cast("string"), F.lit("null")))
    out = joined.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), named(F.col("key")).alias("record_id"),
        F.when(again, named(F.col("first"))).alias("refers_to"), F.col("url").alias("target_uri"), F.lit(date).alias("date"),
        F.concat(F.lit("sha1:"), base32_of(F.col("sha"))).alias("payload_digest"), F.lit(HTTP).alias("content_type"),
        F.col("size").alias("payload_length"), F.when(~again, F.col("payload")).alias("payload"))
    out.write.format("warc").mode("append").option("level", level).save(path)
    return path


def key_of(record_id: str) -> F.Column:
    """The key that ``archive`` put into a record's id."""
    return F.regexp_extract(record_id, r"^<urn:x-key:(-?\d+)>$", 1).try_cast("long")


def bare_digest(digest: str) -> F.Column:
    return F.regexp_extract(digest, "^sha1:([A-Z2-7]{32})$", 1)
