"""WARC files: a writer, and a Python data source that reads them.

Every record is a gzip member of its own. Its extra field ``sl`` holds the
member's compressed and plain size, so a reader can step over a record it does
not want; records of other writers without that field are inflated in small
pieces and thrown away. The source plans partitions of files of about the same
size, takes over predicates on record type and other header columns, parses a
record's header first, and inflates the rest only if the record is wanted and
its payload asked for.

    read_warc(spark, folder, payload="keep").where("record_type = 'response'")

Option ``payload``: ``keep`` returns it, ``check`` compares it with the digest
in the header and returns null, ``skip`` leaves it alone. Option ``pushdown``
takes predicates; Spark wants spark.sql.python.filterPushdown.enabled for it.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull,
    IsNull, LessThan, LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith,
)

from candlewick.llm import text as T
from candlewick.session import fresh_path

#: Size at which the writer begins a new file, and bytes of files that a reader's task takes.
FILE_BYTES = 64 << 20
TASK_BYTES = 64 << 20
CHUNK = 1 << 16
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")


def member(record: bytes, level: int = 1) -> bytes:
    """A gzip member that says how long it is."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = deflate.compress(record) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    sizes = struct.pack("<II", size & 0xFFFFFFFF, len(record) & 0xFFFFFFFF) if size < 1 << 32 else b"\0" * 8
    head = struct.pack("<BBBBIBB", 0x1F, 0x8B, 8, 4, 0, 0, 255) + struct.pack("<H", 12) + b"sl" + struct.pack("<H", 8) + sizes
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _line(value: str) -> bytes:
    return value.replace("\r", "%0D").replace("\n", "%0A").encode()


def record_id(page_id: int | None, where: str = "") -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, where)}>"


def record(kind: str, name: str, payload: bytes, url: str | None, date: str, refers_to: str | None) -> bytes:
    """A response with its payload, or a revisit with the response's HTTP header alone."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    lines = [b"WARC/1.1", b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: " + name.encode(), b"WARC-Date: " + date.encode()]
    if url is not None:
        lines.append(b"WARC-Target-URI: " + _line(url))
    lines.append(b"WARC-Payload-Digest: sha1:" + digest(payload).encode())
    if kind == "revisit":
        lines += [b"WARC-Profile: " + REVISIT.encode(), b"WARC-Refers-To: " + (refers_to or "").encode()]
    else:
        block += payload
    lines += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _writer(folder: str, date: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        part, number, row, done = context.partitionId(), 0, 0, []
        out, size, count = None, 0, 0

        def close() -> None:
            nonlocal out
            out.close()
            name = f"{root}/part-{part:06d}-{number:04d}.warc.gz"
            system.move(temp, name)  # a task that runs again writes the same file again
            done.append((name, size, count))
            out = None

        for batch in batches:
            for page_id, url, payload, first, revisit in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "first", "revisit"))):
                if out is None:
                    number, size, count = number + 1, 0, 0
                    temp = f"{root}/.{part}-{number}-{context.taskAttemptId()}"
                    out = system.open_output_stream(temp, compression=None)
                row += 1
                name = record_id(page_id, f"{part}/{row}")
                data = member(record("revisit" if revisit else "response", name, payload, url, date, record_id(first) if revisit else None))
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= most:
                    close()
        if out is not None:
            close()
        names, sizes, counts = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=["file", "bytes", "records"])

    return run


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of (page_id, url, html); returns the files written.

    Of equal payloads of at least ``min_bytes`` the row with the smallest
    page_id is a response and the others revisit it. A null html is an empty
    payload; a null url has no header line; a null page_id gets a name of its
    own and is a response only if all rows of its payload have null ids;
    repeated rows of the smallest id are responses each.
    """
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    firsts = rows.where(F.length("payload") >= min_bytes).groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    rows = rows.join(firsts.where("n > 1").select("sha", "first"), "sha", "left")
    rows = rows.withColumn("revisit", F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")))
    rows = rows.select("page_id", "url", "payload", "first", "revisit")
    return T.staged(rows.mapInArrow(_writer(folder, date, file_bytes), "file string, bytes long, records long"), "manifest")


class Buffered:
    """A file read onwards in chunks: what is read once is sliced, and what lies beyond the chunk may be skipped."""

    def __init__(self, stream):
        self.stream, self.base, self.data, self.at, self.bytes_read = stream, 0, b"", 0, 0

    def seek(self, offset: int) -> None:
        self.at = offset

    def read(self, most: int, least: int = 64) -> bytes:
        """Up to ``most`` bytes from here on; fewer than ``least`` only at the end of the file."""
        here = self.at - self.base
        if not 0 <= here <= len(self.data):
            self.stream.seek(self.at)
            self.base, self.data, here = self.at, b"", 0
        while len(self.data) - here < least:
            more = self.stream.read(CHUNK)
            self.bytes_read += len(more)
            self.base, self.data, here = self.base + here, self.data[here:] + more, 0
            if not more:
                break
        out = self.data[here : here + most]
        self.at += len(out)
        return out


def first_member(stream: Buffered, begin: int, end: int) -> int:
    """Where the first record in a range of a file begins; ``end`` if none does."""
    at = begin
    while at < end:
        stream.seek(at)
        part = stream.read(CHUNK)
        found = part.find(b"\x1f\x8b\x08")
        if found < 0:
            if len(part) < 3:
                return end
            at += len(part) - 2
            continue
        at += found
        if at >= end:
            return end
        try:
            record = Member(stream, at)
            while len(record.data) < 5 and record.more():
                pass
            if record.data[:5] == b"WARC/":
                return at
        except (zlib.error, EOFError):
            pass
        at += 1
    return end


class Member:
    """One gzip member of an open file, inflated as far as asked for."""

    def __init__(self, stream, offset: int):
        self.stream, self.offset = stream, offset
        stream.seek(offset)
        self.inflate, self.size, self.ended = zlib.decompressobj(zlib.MAX_WBITS | 16), None, False
        self.raw = stream.read(CHUNK)
        if self.raw[:4] == b"\x1f\x8b\x08\x04" and self.raw[12:14] == b"sl" and len(self.raw) >= 24:
            self.size = struct.unpack("<I", self.raw[16:20])[0] or None
        self.used, self.read_all, self.data = 0, False, b""

    def more(self) -> bool:
        """Inflate some more; false at the end of the member."""
        if self.inflate.eof:
            return False
        if not self.raw:
            self.raw = self.stream.read(CHUNK)
            if not self.raw:
                raise EOFError(f"record at {self.offset} is cut off")
        before = len(self.raw)
        self.data += self.inflate.decompress(self.raw, CHUNK)
        rest = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        self.used += before - len(rest)
        self.raw = b"" if self.inflate.eof else rest
        return True

    def upto(self, mark: bytes) -> int:
        while (at := self.data.find(mark)) < 0:
            if not self.more():
                raise ValueError(f"record at {self.offset} has no header")
        return at

    def all(self) -> bytes:
        parts = [self.data]
        self.data = b""
        while self.more():
            parts.append(self.data)
            self.data = b""
        self.data = b"".join(parts)
        return self.data

    def end(self) -> int:
        """Where the next member begins."""
        if self.size is not None:
            return self.offset + self.size
        while self.more():
            self.data = b""
        return self.offset + self.used


SCHEMA = (
    "record_id string, record_type string, date string, target_uri string, payload_digest string, refers_to string,"
    " content_type string, content_length long, http_status int, payload_bytes long, payload binary, file string, offset long"
)
#: Columns that the record's own header gives.
_HEADERS = {
    "record_id": "warc-record-id", "record_type": "warc-type", "date": "warc-date", "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to", "content_type": "content-type", "content_length": "content-length",
}


def _fields(head: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    last = ""
    for line in head.split(b"\r\n")[1:]:
        if line[:1] in (b" ", b"\t") and last:
            out[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, _, value = line.partition(b":")
        last = name.strip().lower().decode("utf-8", "replace")
        out[last] = value.strip().decode("utf-8", "replace")
    return out


_TESTS = {
    EqualTo: lambda a, b: a is not None and a == b,
    EqualNullSafe: lambda a, b: a == b,
    In: lambda a, b: a is not None and a in b,
    GreaterThan: lambda a, b: a is not None and a > b,
    GreaterThanOrEqual: lambda a, b: a is not None and a >= b,
    LessThan: lambda a, b: a is not None and a < b,
    LessThanOrEqual: lambda a, b: a is not None and a <= b,
    StringStartsWith: lambda a, b: a is not None and a.startswith(b),
    StringEndsWith: lambda a, b: a is not None and a.endswith(b),
    StringContains: lambda a, b: a is not None and b in a,
    IsNull: lambda a, _: a is None,
    IsNotNull: lambda a, _: a is not None,
}


class Files(InputPartition):
    """Ranges of files: path, begin, end. The records that begin in a range belong to it."""

    def __init__(self, files: list[tuple[str, int, int]]):
        self.files = files


class WarcReader(DataSourceReader):
    """Reads whole tables; PushdownReader is handed predicates."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "keep")
        self.task_bytes = int(options.get("task_bytes", TASK_BYTES))
        self.tests: list[tuple[str, str, object]] = []

    def partitions(self):
        system, root = file_system(self.path)
        found = system.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)) if system.get_file_info(root).type != pafs.FileType.File else [system.get_file_info(root)]
        files = sorted((x.path, x.size) for x in found if x.type == pafs.FileType.File and x.size and not os.path.basename(x.path).startswith((".", "_")))
        out, held = [], 0
        for path, size in files:
            for begin in range(0, size, self.task_bytes):
                end = min(size, begin + self.task_bytes)
                if not out or held + end - begin > self.task_bytes:
                    out.append([])
                    held = 0
                out[-1].append((path, begin, end))
                held += end - begin
        return [Files(x) for x in out] or [Files([])]

    def _wanted(self, row: dict) -> bool:
        tests = {t.__name__: f for t, f in _TESTS.items()}
        return all(tests[name](row[column], value) for column, name, value in self.tests)

    def _row(self, record: Member, path: str) -> dict | None:
        at = record.upto(b"\r\n\r\n")
        fields = _fields(record.data[:at])
        row = {c: fields.get(h) for c, h in _HEADERS.items()}
        row["content_length"] = int(row["content_length"] or 0)
        if not self._wanted(row):
            return None
        row |= {"file": path, "offset": record.offset, "http_status": None, "payload_bytes": None, "payload": None}
        keep = self.payload != "skip" and row["record_type"] != "revisit"
        http = (row["content_type"] or "").startswith("application/http")
        block, size = at + 4, row["content_length"]
        if keep:
            body = record.all()[block : block + size]
        elif http:
            while record.data.find(b"\r\n\r\n", block) < 0 and record.more():
                pass
            body = record.data[block : block + size]
        else:
            body = None
        start = 0
        if http and body is not None:
            cut = body.find(b"\r\n\r\n")
            start = len(body) if cut < 0 else cut + 4
            status = body[:start].split(b"\r\n", 1)[0].split()
            row["http_status"] = int(status[1]) if len(status) > 1 and status[1].isdigit() else None
            told = _fields(body[: max(0, cut)]).get("content-length", "")
            row["payload_bytes"] = size - start
            if row["record_type"] == "revisit":
                row["payload_bytes"] = int(told) if told.isdigit() else None
        elif not http:
            row["payload_bytes"] = size
        if keep:
            payload = body[start:]
            told = row["payload_digest"] or ""
            if self.payload == "check" and told.startswith("sha1:") and told != f"sha1:{digest(payload)}":
                raise ValueError(f"{path}, record at {record.offset}: the payload does not have its digest")
            row["payload_bytes"] = len(payload)
            row["payload"] = payload if self.payload == "keep" else None
        return row

    def read(self, partition):
        kinds = {"content_length": pa.int64(), "http_status": pa.int32(), "payload_bytes": pa.int64(), "payload": pa.binary(), "offset": pa.int64()}
        names = [f.split()[0] for f in SCHEMA.split(",")]

        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names=names)

        rows, held = [], 0
        for path, begin, end in partition.files:
            system, _ = file_system(self.path)
            with system.open_input_file(path) as opened:
                stream = Buffered(opened)
                at = begin and first_member(stream, begin, end)
                while at < end:
                    record = Member(stream, at)
                    row = self._row(record, path)
                    at = record.end()
                    if row is not None:
                        rows.append(row)
                        held += len(row["payload"] or b"")
                    if len(rows) >= 4096 or held > 16 << 20:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)


class PushdownReader(WarcReader):
    def pushFilters(self, filters):
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in _HEADERS:
                self.tests.append((f.attribute[0], type(f).__name__, getattr(f, "value", None)))
            else:
                yield f


class WarcDataSource(DataSource):
    """Records of gzipped WARC files below a folder."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        options = dict(self.options)
        return PushdownReader(options) if options.get("pushdown", "false") == "true" else WarcReader(options)


def read_warc(spark: SparkSession, folder: str, payload: str = "keep") -> DataFrame:
    """Records below a folder; predicates are pushed down if the session allows it for Python sources."""
    spark.dataSource.register(WarcDataSource)
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format("warc").options(path=folder, payload=payload, pushdown=pushdown).load()


def op1_warc(spark, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), folder)
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("long"))
    return read_warc(spark, folder, payload="check").select(
        number(F.col("record_id")).alias("page_id"), "payload_bytes", F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
        "record_type", number(F.col("refers_to")).alias("refers_to"),
    )


#: Base32 takes five bits of the digest at a time.
OP1_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT *, list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(hex, CAST(floor(i * 5 / 4) AS BIGINT) + 1, 1) AS INTEGER) * 16
       + CAST('0x' || coalesce(nullif(substr(hex, CAST(floor(i * 5 / 4) AS BIGINT) + 2, 1), ''), '0') AS INTEGER))
       // CAST(pow(2, 3 - (i * 5) % 4) AS INTEGER)) % 32, 1)), 'string_agg', '') AS payload_digest,
    min(page_id) OVER (PARTITION BY hex) AS first
  FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""
