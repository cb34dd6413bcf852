"""WARC archives: a PySpark Python data source that writes and reads them.

Each record is a gzip member of its own, whose header tells its length (the extra field `sl` of the WARC standard's annex on compression). So the reader
inflates the headers of a record first, and passes over the rest of the member without decoding it, if predicates on headers or the columns asked for
don't want the payload. The source plans partitions from the files' sizes. Archives that were compressed as a whole, or not at all, are read too.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import operator
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from .common import shared_dir, small_batches

#: Payloads from this size on are written once.
LEAST_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"
#: Bytes of files that a partition reads, and rows of a batch it gives.
PARTITION_BYTES, BATCH = 64 << 20, 500
HEADERS = {
    "warc_type": ("warc-type", str), "record_id": ("warc-record-id", str), "date": ("warc-date", str), "target_uri": ("warc-target-uri", str), "content_type": ("content-type", str),
    "content_length": ("content-length", int), "payload_digest": ("warc-payload-digest", str), "refers_to_record": ("warc-refers-to", str),
    "page_id": ("x-page-id", int), "payload_length": ("x-payload-length", int), "refers_to_page": ("x-refers-to-page", int),
}
SCHEMA = ", ".join([*(f"{k} {'string' if t is str else 'long'}" for k, (_, t) in HEADERS.items()), "payload string, read_bytes long, read_digest string, file string"])
ARROW = pa.schema([(k, pa.string() if t is str else pa.int64()) for k, (_, t) in HEADERS.items()] + [("payload", pa.string()), ("read_bytes", pa.int64()), ("read_digest", pa.string()), ("file", pa.string())])


def _header(name: str, value: Column) -> Column:
    """The header's line, nothing if the value is null; control characters can't end it."""
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\x00-\x1f\x7f]", " "), F.lit(CRLF)))


def warc_records(pages: DataFrame, least: int = LEAST_REVISIT, date: str = DATE) -> DataFrame:
    """One column `record` with a WARC/1.1 record per row of page_id, url and html, without the blank that ends it.

    A payload is the html in UTF-8, null as empty. Rows with equal payloads of `least` bytes or more revisit the one with the
    smallest page_id; all rows with that page_id are responses (repeated rows too, and where every page_id is null).
    A null page_id or url has no header. Other columns of `pages` are not read. Which rows revisit another is told from digests alone, and pages meet that by their own
    ids, so a page that is everywhere isn't a task.
    """
    html = F.coalesce("html", F.lit(""))
    digest, n = F.sha2(html.cast("binary"), 256), F.octet_length(html).cast("long")
    row = F.concat(digest, F.lit("/"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    large = pages.select("page_id", digest.alias("digest"), row.alias("row"), n.alias("n")).where(F.col("n") >= least).groupBy("row", "digest", "page_id").agg(F.count("*").alias("rows"))
    first = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.sum("rows").alias("same")).where("same > 1").select("digest", "first")
    again = large.join(first, "digest").where("first is not null and (page_id is null or page_id <> first)").select("row", "first")
    told = pages.select("page_id", "url", html.alias("html"), digest.alias("digest"), row.alias("row"), n.alias("n")).join(again, "row", "left")
    revisit = F.col("first").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("n").cast("string"), F.lit(CRLF * 2))
    block = F.when(revisit, http).otherwise(F.concat(http, "html"))

    def urn(page: Column) -> Column:
        h = F.md5(F.concat_ws("/", page.cast("string"), "digest"))
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, b) for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))

    lines = [
        F.lit(f"WARC/1.1{CRLF}"),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", urn(F.col("page_id"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _header("WARC-Refers-To", F.when(revisit, urn(F.col("first")))),
        _header("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _header("X-Page-Id", F.col("page_id")),
        _header("X-Payload-Length", F.col("n")),
        _header("X-Refers-To-Page", F.when(revisit, F.col("first"))),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block)),
        F.lit(CRLF),
        block,
    ]
    return told.select(F.concat(*lines).alias("record"))


def write_warc(pages: DataFrame, path: str, *, least: int = LEAST_REVISIT, date: str = DATE, compression: str = "gzip", file_bytes: int = PARTITION_BYTES) -> None:
    """Write the records of `pages` as archives under `path`, each begun by a warcinfo record; no rows leave an empty folder.

    Tasks write under names of their own, and the driver moves what committed tasks wrote, so a task that is lost or repeated leaves nothing.
    """
    spark = pages.sparkSession
    small_batches(spark)
    spark.dataSource.register(WarcSource)
    made = warc_records(pages, least, date)
    made.write.format("warc").mode("append").option("compression", compression).option("fileBytes", str(file_bytes)).option("date", date).option("path", path).save()


def member(record: bytes, level: int = 6) -> bytes:
    """A gzip member with its lengths, packed and plain, in the extra field."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    size = 24 + len(body) + 8
    head = struct.pack("<4BIBBH2sHII", 0x1F, 0x8B, 8, 4, 0, 0, 255, 12, b"sl", 8, size & 0xFFFFFFFF, len(record) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def info(date: str) -> bytes:
    body = "software: corpusloom\r\nformat: WARC File Format 1.1\r\n"
    return f"WARC/1.1{CRLF}WARC-Type: warcinfo{CRLF}WARC-Record-ID: {uuid.uuid4().urn.join('<>')}{CRLF}WARC-Date: {date}{CRLF}Content-Type: application/warc-fields{CRLF}Content-Length: {len(body)}{CRLF * 2}{body}{CRLF * 2}".encode()


@dataclass
class Written(WriterCommitMessage):
    names: tuple[str, ...]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path, self.packed = options["path"], options.get("compression", "gzip") == "gzip"
        self.most, self.date = int(options.get("fileBytes", PARTITION_BYTES)), options.get("date", DATE)

    def at(self, name: str) -> tuple[pyarrow.fs.FileSystem, str]:
        store, top = pyarrow.fs.FileSystem.from_uri(self.path)
        return store, f"{top}/{name}" if name else top

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        pack = member if self.packed else bytes
        names: list[str] = []
        out, size = None, 0
        for batch in iterator:
            for record in batch.column(0).to_pylist():
                if out is None or size >= self.most:
                    if out:
                        out.close()
                    names.append(f"{uuid.uuid4().hex}.warc{'.gz' if self.packed else ''}")
                    store, name = self.at(f"_writing/{names[-1]}")
                    store.create_dir(self.at("_writing")[1], recursive=True)
                    out = store.open_output_stream(name, compression=None)
                    size = out.write(pack(info(self.date)))
                size += out.write(pack(f"{record}{CRLF * 2}".encode()))
        if out:
            out.close()
        return Written(tuple(names))

    def commit(self, messages: list[Written | None]) -> None:
        store, top = self.at("")
        store.create_dir(top, recursive=True)
        for name in (n for m in messages if m for n in m.names):
            store.move(f"{top}/_writing/{name}", f"{top}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        store, unfinished = self.at("_writing")
        if store.get_file_info(unfinished).type == pyarrow.fs.FileType.Directory:
            store.delete_dir(unfinished)


@dataclass
class Files(InputPartition):
    names: tuple[tuple[str, str], ...]


_TESTS: dict[type, Callable] = {
    EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le,
    In: lambda x, many: x in many, StringStartsWith: str.startswith, StringEndsWith: str.endswith, StringContains: operator.contains,
}


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload = options["path"], options.get("payload", "text")
        if self.payload not in ("text", "digest", "none"):
            raise ValueError(f"payload is text, digest or none, not {self.payload}")
        self.most = int(options.get("partitionBytes", PARTITION_BYTES))
        self.tests: list[tuple[type, str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if len(f.attribute) == 1 and f.attribute[0] in HEADERS and type(f) in {*_TESTS, EqualNullSafe, IsNull, IsNotNull}:
                self.tests.append((type(f), f.attribute[0], getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> list[Files]:
        store, top = pyarrow.fs.FileSystem.from_uri(self.path)
        found = store.get_file_info(pyarrow.fs.FileSelector(top, recursive=True))
        files = sorted((x.path, x.size) for x in found if x.is_file and not x.base_name.startswith(("_", ".")))
        parts, held, size = [], [], 0
        for name, n in files:
            if held and size + n > self.most:
                parts.append(Files(tuple(held)))
                held, size = [], 0
            held.append((self.path, name))
            size += n
        return [*parts, Files(tuple(held))]

    def wanted(self, row: dict) -> bool:
        for kind, name, value in self.tests:
            x = row[name]
            if kind in (IsNull, IsNotNull):
                ok = (x is None) == (kind is IsNull)
            elif kind is EqualNullSafe:
                ok = x == value
            else:
                ok = x is not None and _TESTS[kind](x, value)
            if not ok:
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for uri, name in partition.names:
            store, _ = pyarrow.fs.FileSystem.from_uri(uri)
            with store.open_input_file(name) as raw, io.BufferedReader(raw, 1 << 20) as stream:
                found = members(stream, self.wanted, self.payload) if name.endswith(".gz") else records(stream, self.wanted, self.payload)
                for row in found:
                    rows.append(row | {"file": name})
                    if len(rows) >= BATCH:
                        yield pa.RecordBatch.from_pylist(rows, ARROW)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)


def _skip(stream, n: int) -> None:
    if stream.seekable():
        stream.seek(n, io.SEEK_CUR)
    else:
        while n and (got := len(stream.read(min(n, 1 << 20)))):
            n -= got


class Unpacked:
    """A gzip member as a stream that inflates no more than is read."""

    def __init__(self, packed, size: int):
        self.packed, self.left, self.held = packed, size, b""
        self.inflate = zlib.decompressobj(-15)

    def fill(self) -> bool:
        raw = self.inflate.unconsumed_tail
        if not raw and self.left:
            raw = self.packed.read(min(self.left, 1 << 14))
            self.left -= len(raw)
        more = self.inflate.decompress(raw, 1 << 14) if raw else b""
        self.held += more
        return bool(raw)

    def seekable(self) -> bool:
        return True

    def seek(self, n: int, whence: int) -> None:
        """What is passed over is not inflated: the next member begins behind the packed bytes."""

    def readline(self) -> bytes:
        while (end := self.held.find(b"\n")) < 0 and self.fill():
            pass
        end = len(self.held) if end < 0 else end + 1
        line, self.held = self.held[:end], self.held[end:]
        return line

    def read(self, n: int) -> bytes:
        parts, size = [self.held], len(self.held)
        self.held = b""
        while size < n and self.fill():
            parts.append(self.held)
            size += len(self.held)
            self.held = b""
        got = b"".join(parts)
        self.held = got[n:]
        return got[:n]


def members(stream, wanted: Callable[[dict], bool], payload: str) -> Iterator[dict]:
    """Records of a packed archive. A member without its length, or one of several records, is inflated with all that follows it."""
    while head := stream.read(24):
        fields = struct.unpack("<4BIBBH2sHII", head) if len(head) == 24 else None
        if not fields or fields[:4] != (0x1F, 0x8B, 8, 4) or fields[7:10] != (12, b"sl", 8):
            stream.seek(-len(head), io.SEEK_CUR)
            yield from records(gzip.GzipFile(fileobj=stream), wanted, payload)
            return
        begin = stream.tell()
        body = Unpacked(stream, fields[10] - 32)
        row = record(body, wanted, payload)
        stream.seek(begin + fields[10] - 24)
        if row:
            yield row


def records(stream, wanted: Callable[[dict], bool], payload: str) -> Iterator[dict]:
    """Records that stand one after another."""
    while (row := record(stream, wanted, payload)) is not None:
        if row:
            yield row


def record(stream, wanted: Callable[[dict], bool], payload: str) -> dict | None:
    """The next record: headers first; the block is read only if the record is wanted and its payload asked for. Empty if it isn't wanted, none at the end."""
    while (line := stream.readline()) and not line.strip():
        pass
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record begins with {line[:40]!r}")
    found: dict[str, str] = {}
    while (line := stream.readline()).strip():
        key, _, value = line.decode("utf-8", "replace").partition(":")
        found[key.strip().lower()] = value.strip()
    row: dict = {k: (kind(found[h]) if h in found else None) for k, (h, kind) in HEADERS.items()}
    row |= {"payload": None, "read_bytes": None, "read_digest": None}
    size = row["content_length"] or 0
    if not wanted(row):
        _skip(stream, size)
        return {}
    if payload == "none" or row["warc_type"] == "revisit":
        _skip(stream, size)
        return row
    block = stream.read(size)
    if len(block) < size:
        raise ValueError("the archive ends inside a record")
    body = block.partition(b"\r\n\r\n")[2] if (row["content_type"] or "").startswith("application/http") else block
    row["read_bytes"] = len(body)
    row["read_digest"] = hashlib.sha256(body).hexdigest()
    if payload == "text":
        row["payload"] = body.decode("utf-8", "replace")
    return row


class WarcSource(DataSource):
    """`spark.read.format("warc").load(folder)`; options: payload (text, digest or none), partitionBytes; to write: compression (gzip or none), fileBytes, date."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are appended; choose another folder")
        return WarcWriter(self.options)


def read_warc(spark: SparkSession, path: str, payload: str = "text") -> DataFrame:
    """The records under `path`, with header columns, payload text, and the size and digest of what was read of the payload."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", payload).load(path)


def archive_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per response and revisit: size and digest of the full payload, the record's type, and the page that it refers to. One pass; other records are passed over.

    Of responses they are computed from the payload that is read back, of revisits they are those of the headers.
    """
    found = read_warc(spark, path, "digest").where(F.col("warc_type").isin("response", "revisit"))
    again = F.col("warc_type") == "revisit"
    return found.select(
        "page_id",
        F.when(again, F.col("payload_length")).otherwise(F.col("read_bytes")).alias("payload_bytes"),
        F.when(again, F.regexp_replace("payload_digest", "^sha256:", "")).otherwise(F.col("read_digest")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.when(again, F.col("refers_to_page")).alias("refers_to"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return archive_digests(spark, path)


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.h AS payload_digest,
  CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.h = f.h AND p.n >= 100
"""
