"""WARC archives as a Spark data source: ``format("warc")``.

Writing makes one gzip-per-record file per task and, at commit, a manifest of byte ranges, so files of failed or
repeated attempts are never read. Reading plans one partition per range (per file where there is no
manifest), pushes predicates on record type and headers down to the tasks, inflates the headers of a record
first, and steps over the payloads of records that are not wanted. Option ``payload=false`` decodes no payload at all.

Null payloads are empty, null record types are ``response``, other null fields are left out of the headers and read as
null; repeated records are kept; an empty table gives an archive without records; extra columns are not written.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from gridzonal.llm.skew import attach_group
from gridzonal.storage import arrow_uri, fresh_path, materialise

SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, date string, "
    "payload_digest string, payload_length bigint, payload binary"
)
COLUMNS = [field.strip().split()[0] for field in SCHEMA.split(",")]

# Header names of the format for the columns above.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_START = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff"

RANGE_BYTES = 32 << 20
MANIFEST = "_manifest"
SHORTEST_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    # ``read_warc`` and ``write_warc`` name the session's file system; a bare path, given to the format itself, is local.
    return pafs.FileSystem.from_uri(path)


def _one_line(value: str) -> str:
    """Line ends can't stand in a header: they and the escape sign are percent-coded."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _plain(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def pack_record(fields: dict[str, str | None], payload: bytes, length: int) -> bytes:
    """One gzip member; its extra field holds the sizes of the member and of the record."""
    kind = fields.get("record_type") or "response"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + payload if kind != "revisit" else http
    lines = ["WARC/1.1"]
    for column, header in HEADERS.items():
        value = kind if column == "record_type" else fields.get(column)
        if value is not None:
            lines.append(f"{header}: {_one_line(value)}")
    if kind == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    record = "\r\n".join(lines).encode() + block + b"\r\n\r\n"
    deflate = zlib.compressobj(4, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    whole = len(GZIP_START) + 2 + 12 + len(body) + 8
    extra = b"sl\x08\x00" + whole.to_bytes(4, "little") + (len(record) & 0xFFFFFFFF).to_bytes(4, "little")
    tail = zlib.crc32(record).to_bytes(4, "little") + (len(record) & 0xFFFFFFFF).to_bytes(4, "little")
    return GZIP_START + len(extra).to_bytes(2, "little") + extra + body + tail


@dataclass
class Ranges(WriterCommitMessage):
    file: str
    ranges: list[tuple[int, int]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Ranges:
        context = TaskContext.get()
        fs, root = _fs(self.path)
        fs.create_dir(root, recursive=True)
        name = f"part-{context.partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        ranges, start, end = [], 0, 0
        out = None
        for batch in iterator:
            held = [c for c in COLUMNS if c in batch.schema.names]
            for row in zip(*(batch.column(c).to_pylist() for c in held)):
                record = dict(zip(held, row))
                payload = record.pop("payload", None) or b""
                length = record.pop("payload_length", None)
                packed = pack_record(record, payload, len(payload) if length is None else length)
                if out is None:
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                out.write(packed)
                end += len(packed)
                if end - start >= RANGE_BYTES:
                    ranges.append((start, end - start))
                    start = end
        if out is not None:
            out.close()
        if end > start:
            ranges.append((start, end - start))
        return Ranges(name, ranges)

    def commit(self, messages: list[Ranges | None]) -> None:
        fs, root = _fs(self.path)
        fs.create_dir(root, recursive=True)
        listed = {m.file: m.ranges for m in messages if m is not None and m.ranges}
        # Every commit has a manifest of its own, so what earlier ones wrote stays listed.
        with fs.open_output_stream(f"{root}/{MANIFEST}-{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps(listed).encode())


@dataclass
class FileRange(InputPartition):
    file: str
    start: int
    length: int


def _inflate_head(inflate, data: memoryview) -> bytes:
    """The start of a record, up to the end of its HTTP header or of the record."""
    head, rest = b"", data
    while True:
        got = inflate.decompress(rest, 1024)
        head += got
        rest = inflate.unconsumed_tail
        first = head.find(b"\r\n\r\n")
        if first >= 0 and head.find(b"\r\n\r\n", first + 4) >= 0:
            return head
        if inflate.eof or (not got and not rest):
            return head


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.partition(b":") for line in lines)
    return {name.decode().strip().lower(): value.decode().strip() for name, _colon, value in pairs}


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.wanted = path, payload, []

    def pushFilters(self, filters):
        for item in filters:
            attribute = getattr(item, "attribute", ())
            known = len(attribute) == 1 and attribute[0] in HEADERS
            if known and isinstance(item, (EqualTo, In, StringStartsWith)):
                kind = type(item).__name__
                self.wanted.append((kind, attribute[0], item.value))
            elif known and isinstance(item, IsNotNull):
                self.wanted.append(("IsNotNull", attribute[0], None))
            else:
                yield item

    def partitions(self) -> list[FileRange]:
        fs, root = _fs(self.path)
        infos = fs.get_file_info(pafs.FileSelector(root))
        manifests = [info.path for info in infos if info.base_name.startswith(MANIFEST)]
        if manifests:
            found = []
            for path in sorted(manifests):
                with fs.open_input_stream(path, compression=None) as source:
                    listed = json.loads(source.read())
                found += [FileRange(name, start, size) for name, all_ in listed.items() for start, size in all_]
        else:
            found = [FileRange(i.base_name, 0, i.size) for i in infos if i.base_name.endswith(".warc.gz")]
        return found or [FileRange("", 0, 0)]

    def _matches(self, values: dict[str, str | None]) -> bool:
        for kind, column, wanted in self.wanted:
            value = values[column]
            if value is None:
                return False
            if kind == "EqualTo" and value != wanted:
                return False
            if kind == "In" and value not in wanted:
                return False
            if kind == "StringStartsWith" and not value.startswith(wanted):
                return False
        return True

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        if not partition.length:
            return
        fs, root = _fs(self.path)
        with fs.open_input_file(f"{root}/{partition.file}") as source:
            source.seek(partition.start)
            data = memoryview(source.read(partition.length))
        at, rows, held = 0, [], 0
        while at < len(data):
            if bytes(data[at : at + 2]) != b"\x1f\x8b":
                raise ValueError(f"{partition.file}: no record at byte {partition.start + at}")
            body, whole = at + 10, 0
            flags = data[at + 3]
            if flags & 4:
                size = int.from_bytes(data[body : body + 2], "little")
                if bytes(data[body + 2 : body + 6]) == b"sl\x08\x00":
                    whole = int.from_bytes(data[body + 6 : body + 10], "little")
                body += 2 + size
            for flag in (8, 16):  # file name and comment, each ended by a zero byte
                if flags & flag:
                    body += bytes(data[body:]).index(0) + 1
            inflate = zlib.decompressobj(-15)
            head = _inflate_head(inflate, data[body : at + whole] if whole else data[body:])
            top, _gap, block = head.partition(b"\r\n\r\n")
            named = _fields(top.split(b"\r\n")[1:])
            values = {c: _plain(named[h.lower()]) if h.lower() in named else None for c, h in HEADERS.items()}
            wanted = self._matches(values)
            if wanted:
                size = int(named["content-length"])
                if block.startswith(b"HTTP/"):
                    http, _gap, start = block.partition(b"\r\n\r\n")
                    length = _fields(http.split(b"\r\n")[1:]).get("content-length")
                    values["payload_length"] = int(length) if length else None
                    size -= len(http) + 4
                else:
                    # A record of another kind, such as warcinfo or metadata: the block is the payload.
                    start, values["payload_length"] = block, size
                values["payload"] = None
                if self.payload:
                    payload = bytearray(start)
                    while len(payload) < size:
                        payload += inflate.decompress(inflate.unconsumed_tail, 1 << 20)
                    values["payload"] = bytes(payload[:size])
                    held += size
                rows.append(values)
                if len(rows) >= 1000 or held > 8 << 20:
                    yield self._batch(rows)
                    rows, held = [], 0
            if not whole:
                while not inflate.eof:
                    inflate.decompress(inflate.unconsumed_tail, 1 << 20)
                whole = len(data) - len(inflate.unused_data) - at + 8
            at += whole
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[dict]) -> pa.RecordBatch:
        kinds = {"payload_length": pa.int64(), "payload": pa.binary()}
        return pa.RecordBatch.from_arrays(
            [pa.array([row[c] for row in rows], kinds.get(c, pa.string())) for c in COLUMNS], names=COLUMNS
        )


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(arrow_uri(spark, path))


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Response and revisit records of (page_id, url, html).

    Of equal payloads of ``SHORTEST_REVISIT`` bytes or more the smallest page_id is the response (all its rows, if it
    is repeated), the others revisit it. A null page_id revisits unless its group has no other.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    records = pages.select("page_id", "url", payload.alias("payload"))
    records = records.withColumn("payload_length", F.length("payload").cast("long"))
    records = records.withColumn("digest", F.sha2("payload", 256))
    shared = F.when(F.col("payload_length") >= SHORTEST_REVISIT, F.col("digest"))
    keyed = records.withColumn("shared", shared)
    groups = (
        keyed.filter("shared IS NOT NULL")
        .groupBy("shared")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("held"))
        .filter("held > 1")
    )
    placed = attach_group(keyed, materialise(groups, "payloads"), "shared", "held", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return placed.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("first_id").cast("string"), F.lit(">"))).alias("refers_to"),
        F.lit(DATE).alias("date"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        "payload_length",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_warc(records: DataFrame, path: str) -> None:
    register(records.sparkSession)
    records.write.format("warc").mode("append").save(arrow_uri(records.sparkSession, path))


def page_archive(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages below ``path`` and read them back: one row per page.

    Length and digest come from the stored payload of a response and from the headers of a revisit.
    """
    spark = pages.sparkSession
    path = path or fresh_path(spark, "warc")
    write_warc(records_of_pages(pages), path)
    read = read_warc(spark, path)
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1)
    whole = F.col("record_type") == "response"
    return read.select(
        F.expr("try_cast(regexp_extract(record_id, '<urn:page:(-?[0-9]+)>', 1) AS BIGINT)").alias("page_id"),
        F.when(whole, F.length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(whole, F.sha2("payload", 256)).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type",
        F.when(~whole, number("refers_to").cast("bigint")).alias("refers_to"),
    )
