"""WARC archives as a PySpark data source, and writing pages with revisits of equal payloads.

``spark.read.format("warc").load(path)`` reads records, ``df.write.format("warc").save(path)`` writes them.

Reading plans partitions of whole files, small ones together. Filters on the columns of :data:`HEADER_COLUMNS` are pushed down: a record's WARC
header is parsed first, and a record that fails is skipped. Payloads are decoded only for records that pass, and only if
the read schema has ``payload``: ``spark.read.format("warc").schema("record_id string, record_type string")`` decodes none. Skipping
seeks where the archive says how long a record is, which plain files do, and compressed files by the "sl" field of their members, as written here;
other compressed files are inflated in pieces that are thrown away.

Writing gives each record a gzip member of its own. Files of lost or repeated tasks are never read: the job's commit
writes a manifest that names its files, and where a folder has manifests only those files count. Paths are local or those that Arrow's file
systems open (file, hdfs, s3, gs). Reading needs ``spark.sql.python.filterPushdown.enabled``
(:func:`pushdown`), without which Spark refuses sources that take filters; Spark then keeps the filters of a loaded frame for all that is made of this frame, so load anew for each filter (:func:`read`).

A null date becomes 1970; null target, digest and reference have no header. Line ends and other control characters in
header values are written as %XX. A null payload is empty. A record without a known length, or a file that ends in a record, is an error.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan,
    LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Columns that come from a record's WARC header; the others are payload_bytes (of revisits: of the payload they stand for), headers, payload, file and offset.
HEADER_COLUMNS = ["record_id", "record_type", "target_uri", "date", "refers_to", "payload_digest", "content_type", "content_length"]
SCHEMA = ", ".join(f"{c} {'long' if c == 'content_length' else 'string'}" for c in HEADER_COLUMNS) + ", payload_bytes long, headers map<string, string>, payload binary, file string, offset long"
#: Fixed values of the format.
NAMES = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest",
    "content_type": "Content-Type", "content_length": "Content-Length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http;msgtype=response"
#: Bytes read at once, of a batch, of files read by one task, and after which a task begins a new file.
PIECE, BATCH, SPLIT, FILE = 1 << 18, 4 << 20, 128 << 20, 256 << 20
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


@contextmanager
def pushdown(spark: SparkSession) -> Iterator[None]:
    """Jobs started in this block pass filters to Python sources."""
    before = spark.conf.get(PUSHDOWN)
    spark.conf.set(PUSHDOWN, "true")
    try:
        yield
    finally:
        spark.conf.set(PUSHDOWN, before)


def _open(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(path)


# Reading


class _Bytes:
    """The bytes of a file from a place that can move on without reading."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.buf, self.at, self.start = file, b"", 0, 0

    @property
    def offset(self) -> int:
        return self.start + self.at

    def more(self, least: int = 1) -> bool:
        """Whether ``least`` bytes lie ahead; they are then in ``buf`` from ``at``."""
        while len(self.buf) - self.at < least:
            new = self.file.read(PIECE)
            if not new:
                return False
            self.buf, self.start, self.at = self.buf[self.at :] + new, self.offset, 0
        return True

    def take(self) -> bytes:
        out, self.start = self.buf[self.at :], self.start + len(self.buf)
        self.buf, self.at = b"", 0
        return out

    def back(self, n: int, last: bytes) -> None:
        """The last ``n`` of the bytes just taken were not needed."""
        self.buf, self.at = last[len(last) - n :] if n else b"", 0
        self.start -= n

    def seek(self, offset: int) -> None:
        if self.start <= offset <= self.start + len(self.buf):
            self.at = offset - self.start
        else:
            self.file.seek(offset)
            self.buf, self.at, self.start = b"", 0, offset


class _Plain:
    """The content of a plain file."""

    def __init__(self, raw: _Bytes):
        self.raw = raw

    def begin(self) -> int | None:
        while self.raw.more() and self.raw.buf[self.raw.at] in b"\r\n":
            self.raw.at += 1
        return self.raw.offset if self.raw.more() else None

    def until(self, end: bytes) -> bytes:
        seen = 0
        while (k := self.raw.buf.find(end, self.raw.at + max(0, seen - len(end)))) < 0:
            seen = len(self.raw.buf) - self.raw.at
            if not self.raw.more(seen + 1):
                raise EOFError("a header has no end")
        out, self.raw.at = self.raw.buf[self.raw.at : k], k + len(end)
        return out

    def read(self, n: int) -> bytes:
        if not self.raw.more(n):
            raise EOFError("a record has no end")
        out, self.raw.at = self.raw.buf[self.raw.at : self.raw.at + n], self.raw.at + n
        return out

    def skip(self, n: int, read: int) -> None:
        self.raw.seek(self.raw.offset + n)


class _Inflate:
    """Reads the content of gzip members as one file."""

    def __init__(self, source: _Bytes):
        self.source, self.z, self.member, self.whole = source, None, 0, None

    def _begin(self) -> bool:
        if not self.source.more(12):
            return False
        self.member, self.whole = self.source.offset, None
        head = self.source.buf[self.source.at : self.source.at + 12]
        if head[:2] != b"\x1f\x8b":
            raise ValueError("no gzip member")
        if head[3] & 4 and self.source.more(12 + (n := struct.unpack("<H", head[10:])[0])):
            extra = self.source.buf[self.source.at + 12 : self.source.at + 12 + n]
            while len(extra) >= 4:
                size = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"sl" and size == 8:
                    self.whole = struct.unpack("<II", extra[4:12])  # bytes of the member, and of its content
                extra = extra[4 + size :]
        self.z = zlib.decompressobj(31)
        return True

    def read(self, n: int) -> bytes:
        """Some more content, of one member; nothing at the end of the file."""
        while self.z or self._begin():
            if not self.source.more():
                raise EOFError("a member has no end")
            given = self.source.take()
            out = self.z.decompress(given, n)
            left = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            self.source.back(len(left), given)
            if self.z.eof:
                self.z = None
            if out:
                return out
        return b""


class _Gzip(_Plain):
    """The content of a file of gzip members."""

    def __init__(self, raw: _Bytes):
        self.inner = _Inflate(raw)
        super().__init__(_Bytes(self.inner))

    def begin(self) -> int | None:
        return None if super().begin() is None else self.inner.member

    def skip(self, n: int, read: int) -> None:
        """Go on after ``n`` more bytes of a record of which ``read`` were read."""
        whole = self.inner.whole
        if whole and whole[1] == n + read + 4:
            self.inner.source.seek(self.inner.member + whole[0])
            self.inner.z = None
            self.raw.take()
            return
        while n:
            if not self.raw.more():
                raise EOFError("a record has no end")
            k = min(n, len(self.raw.buf) - self.raw.at)
            self.raw.at += k
            n -= k


def _headers(block: bytes) -> dict[str, str]:
    """Header lines by name in lower case; a line that begins with white space goes on with the one before."""
    out, last = {}, None
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = name.strip().lower()
            out[last] = value.strip()
    return out


def _values(h: dict[str, str]) -> dict[str, object]:
    """The header columns of a record."""
    v = {c: h.get(n.lower()) for c, n in NAMES.items()}
    for c in ("record_id", "refers_to"):
        v[c] = v[c] and v[c].removeprefix("<").removesuffix(">")
    if v["content_length"] is None:
        raise ValueError("a record has no length")
    v["content_length"] = int(v["content_length"])
    return v


_TESTS: dict[type, Callable] = {
    EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b,
    In: lambda a, b: True if a in b else None if None in b else False, StringStartsWith: str.startswith, StringEndsWith: str.endswith, StringContains: lambda a, b: b in a,
}


def _passes(f: Filter, v: dict[str, object]) -> bool | None:
    """A filter's value for a record, by the logic of SQL."""
    if isinstance(f, Not):
        x = _passes(f.child, v)
        return None if x is None else not x
    a = v[f.attribute[0]]
    if isinstance(f, IsNull):
        return a is None
    if isinstance(f, IsNotNull):
        return a is not None
    if isinstance(f, EqualNullSafe):
        return a == f.value
    return None if a is None or f.value is None else _TESTS[type(f)](a, f.value)


def _pushable(f: Filter) -> bool:
    if isinstance(f, Not):
        return _pushable(f.child)
    return len(f.attribute) == 1 and f.attribute[0] in HEADER_COLUMNS and isinstance(f, (IsNull, IsNotNull, EqualNullSafe, *_TESTS))


def records(file: pa.NativeFile, compressed: bool, filters: list[Filter], columns: set[str]) -> Iterator[dict[str, object]]:
    """The records of a file that pass; payloads, and HTTP headers, are read only if ``columns`` have what needs them."""
    content = _Gzip(_Bytes(file)) if compressed else _Plain(_Bytes(file))
    while (offset := content.begin()) is not None:
        block = content.until(b"\r\n\r\n")
        if not block.startswith(b"WARC/"):
            raise ValueError(f"no record at {offset}")
        headers = _headers(block)
        v = _values(headers)
        length, read = v["content_length"], len(block) + 4
        if not all(_passes(f, v) is True for f in filters):
            content.skip(length, read)
            continue
        v |= {"headers": headers, "offset": offset}
        http = length and (v["content_type"] or "").replace(" ", "").startswith("application/http")
        if http and columns & {"payload", "payload_bytes"}:
            own = content.until(b"\r\n\r\n")
            read, length = read + len(own) + 4, length - len(own) - 4
            v["payload_bytes"] = int(_headers(own).get("content-length", 0)) if v["record_type"] == "revisit" else length
        else:
            v["payload_bytes"] = length
        if "payload" in columns:
            v["payload"] = content.read(length)
            length, read = 0, read + length
        content.skip(length, read)
        yield v


@dataclass
class Files(InputPartition):
    files: list[tuple[str, int]]


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.columns, self.arrow = schema.fieldNames(), to_arrow_schema(schema)
        self.path, self.split, self.filters = options["path"], int(options.get("splitbytes", SPLIT)), []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if _pushable(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, root = _open(self.path)
        if fs.get_file_info(root).type == arrow_fs.FileType.File:
            found = [(root, fs.get_file_info(root).size)]
        else:
            infos = fs.get_file_info(arrow_fs.FileSelector(root))
            manifests = [i.path for i in infos if re.fullmatch(r"_manifest-\w+\.json", i.base_name)]
            named = {f for m in manifests for f in json.loads(fs.open_input_stream(m).read())["files"]}
            found = [(i.path, i.size) for i in infos if re.search(r"\.warc(\.gz)?$", i.base_name) and (i.base_name in named or not manifests)]
        groups, room = [], 0
        for path, size in sorted(found, key=lambda x: (-x[1], x[0])):
            if not groups or room < size:
                groups.append(Files([]))
                room = self.split
            groups[-1].files.append((path, size))
            room -= size
        return groups or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(self.path)
        rows, held = [], 0
        for path, _ in partition.files:
            with fs.open_input_file(path) as f:
                for v in records(f, path.endswith(".gz"), self.filters, set(self.columns)):
                    v["file"] = path
                    rows.append({c: v.get(c) for c in self.columns})
                    held += len(v.get("payload") or b"") + 500
                    if held > BATCH:
                        yield pa.RecordBatch.from_pylist(rows, self.arrow)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, self.arrow)


# Writing


def _value(x: object) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", str(x))


def record_bytes(row: dict[str, object]) -> bytes:
    """A record of the format: its header, and an HTTP response with the payload, or of a revisit without it."""
    revisit, payload = row["record_type"] == "revisit", row.get("payload") or b""
    size = row.get("payload_bytes") if revisit else len(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size or 0}\r\n\r\n".encode() + (b"" if revisit else payload)
    lines = ["WARC/1.1"]
    for c in ("record_type", "record_id", "date", "target_uri", "payload_digest", "refers_to"):
        x = row.get(c)
        if c == "date" and x is None:
            x = "1970-01-01T00:00:00Z"
        if x is not None:
            lines.append(f"{NAMES[c]}: {f'<{_value(x)}>' if c in ('record_id', 'refers_to') else _value(x)}")
    if revisit:
        lines.append(f"WARC-Profile: {PROFILE}")
    lines += [f"Content-Type: {HTTP}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(content: bytes, level: int = 6) -> bytes:
    """A gzip member whose "sl" field holds its own length and that of its content."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(content) + z.flush() + struct.pack("<II", zlib.crc32(content), len(content) & 0xFFFFFFFF)
    if 24 + len(body) >= 1 << 32 or len(content) >= 1 << 32:
        return b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + body
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, 24 + len(body), len(content)) + body


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.compressed, self.file_bytes = options.get("compression", "gzip") == "gzip", int(options.get("filebytes", FILE))
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        self.old = [i.path for i in fs.get_file_info(arrow_fs.FileSelector(root)) if re.search(r"\.warc(\.gz)?$|/_manifest-", i.path)] if overwrite else []

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = _open(self.path)
        names, out, size = [], None, 0
        info = "software: strataflux\r\nformat: WARC File Format 1.1\r\n"
        try:
            for b in batches:
                for row in b.to_pylist():
                    if out is None or size > self.file_bytes:
                        if out:
                            out.close()
                        names.append(f"{uuid.uuid4().hex}.warc{'.gz' * self.compressed}")
                        out, size = fs.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                        head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n{info}\r\n\r\n"
                        out.write(gzip_member(head.encode()) if self.compressed else head.encode())
                    data = record_bytes(row)
                    data = gzip_member(data) if self.compressed else data
                    size += len(data)
                    out.write(data)
        finally:
            if out:
                out.close()
        return Written(names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = _open(self.path)
        with fs.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json", compression=None) as f:
            f.write(json.dumps({"files": [n for m in messages if m for n in m.files]}).encode())
        for path in self.old:
            fs.delete_file(path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = _open(self.path)
        for name in (n for m in messages if m for n in m.files):
            fs.delete_file(f"{root}/{name}")


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)


def read(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    """The records of a folder or file, or only the columns of ``schema``; a frame of its own at each call, for one filter under :func:`pushdown`."""
    register(spark)
    return spark.read.format("warc").schema(schema).load(path)


def with_revisits(pages: DataFrame, least: int = 100) -> DataFrame:
    """Records (page_id, url, html) as the source writes them: of equal payloads of ``least`` bytes the smallest page_id is the response.

    Rows that share the smallest page_id are all responses. A null page_id counts as larger than all others; where a
    payload has no other, its rows are responses.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    # Grouped by digest with sums on each side of the shuffle; only digests found twice or more are joined back.
    first = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    out = rows.join(first.select("digest", "first"), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.octet_length("payload") >= least)
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return out.select(
        name("page_id").alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.col("url").alias("target_uri"), F.lit(None).cast("string").alias("date"),
        F.when(revisit, name("first")).alias("refers_to"), F.concat(F.lit("sha256:"), "digest").alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def round_trip(pages: DataFrame, path: str) -> DataFrame:
    """Write pages to archives at ``path`` and read page_id, payload_bytes, payload_digest, record_type and refers_to back; read under :func:`pushdown`."""
    spark = pages.sparkSession
    register(spark)
    with_revisits(pages).write.format("warc").mode("append").save(path)

    def kind(name: str, schema: str) -> DataFrame:
        return read(spark, path, schema).where(F.col("record_type") == name)

    base = "record_id string, record_type string, refers_to string, payload_digest string, payload_bytes long"
    responses = kind("response", f"{base}, payload binary").withColumn("digest", F.sha2("payload", 256)).drop("payload")
    revisits = kind("revisit", base).withColumn("digest", F.regexp_replace("payload_digest", "^sha256:", ""))
    page = lambda c: F.nullif(F.regexp_replace(c, "^urn:page:", ""), F.lit("")).cast("long")
    return responses.unionByName(revisits).select(page("record_id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"))
