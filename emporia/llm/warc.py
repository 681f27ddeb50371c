"""WARC archives: a writer of Spark jobs and a PySpark data source.

Writing.  Of pages with equal payloads the one with the smallest identifier
becomes the ``response``; the others become ``revisit`` records without payload
that refer to it.  Who refers to whom is settled on identifiers and digests
alone; payloads move once, dealt by identifier, to leave the revisits out.
Files are written by Spark's own text writer, so any file system Spark writes
to will do and a lost task's file is replaced by the commit protocol.
Compressed archives hold one gzip member a record, as the format wants it; the
member's extra field ``rl`` says where the next record begins.

Reading.  ``spark.read.format("warc")`` plans partitions of whole files up to
a size, takes predicates on the record type and other header columns, parses a
record's headers first, and passes over the payload of a record that the
predicates reject, or of every record if the payload column isn't asked for
(``.schema(...)`` without it): of a member with a length only the headers are
decompressed.  Other archives, gzip without lengths too, are read through.
"""

from __future__ import annotations

import gzip
import io
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull,
    StringStartsWith,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from emporia.llm.common import written
from emporia.session import ship_package

# Fixed values of the format.
VERSION = "WARC/1.0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADER_COLUMNS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "record_date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "payload_length": "X-Payload-Length",
    "content_length": "Content-Length",
}
SCHEMA = ("record_id string, record_type string, target_uri string, record_date string, "
          "refers_to string, payload_digest string, payload_length long, content_length long, "
          "payload binary")
LONG_COLUMNS = {"payload_length", "content_length"}
#: Records of one Arrow batch hold at most about this many payload bytes.
BATCH_BYTES = 8 << 20
#: Start of a gzip member whose extra field ``rl`` holds the bytes from here to
#: the next record (the number follows), and a member of nothing.
MEMBER = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H2sH", 8, b"rl", 4)
NOTHING = b"\x1f\x8b\x08\x00" + bytes(4) + b"\x00\xff\x03\x00" + bytes(8)
#: Compressed bytes that are read at a time in search of the headers' end.
HEAD_BYTES = 1024


def _urn(ident: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(ident.cast("string"), F.lit("null")), F.lit(">"))


def find_revisits(keys: DataFrame, min_bytes: int = 100) -> DataFrame:
    """The rows of ``keys`` (``id``, ``bytes``, ``digest``, ...) whose digest
    a smaller identifier has too, and at least ``min_bytes``; ``first`` is the
    smallest.

    A digest with more than a partition's fair share of the repeated rows is
    joined where its rows are read (there are fewer such digests than shuffle
    partitions, which bounds the broadcast); the others are joined by digest.
    """
    spark = keys.sparkSession
    groups = written(keys.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "warc-groups")
    repeated = groups.agg(F.sum("n")).first()[0] or 0
    heavy = F.col("n") > repeated / int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(groups.where(heavy).drop("n"))
    rows = keys.join(hot, "digest").unionByName(
        keys.join(hot, "digest", "left_anti").join(groups.where(~heavy).drop("n"), "digest"))
    return rows.where(F.col("id") != F.col("first"))


def members(records: DataFrame) -> DataFrame:
    """``value``: each (``head``, ``payload``) as a gzip member of its own,
    without its last byte.

    That byte, 0, is left to the text writer: it is the highest of the size
    modulo 2^32, and where it isn't 0 a member of nothing follows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = []
            size = 0
            for head, payload in zip(batch.column(0), batch.column(1)):
                record = b"".join((head.as_py(), payload.as_py() or b"", b"\r\n\r\n"))
                packer = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS)
                packed = packer.compress(record) + packer.flush() + struct.pack("<II", zlib.crc32(record), len(record))
                if packed[-1]:
                    packed += NOTHING
                out.append(MEMBER + struct.pack("<I", len(MEMBER) + 4 + len(packed)) + packed[:-1])
                size += len(packed)
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    ship_package(records.sparkSession)
    return records.select("head", "payload").mapInArrow(run, "value binary")


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", min_bytes: int = 100,
               capture_date: str = "1970-01-01T00:00:00Z", compression: str = "gzip") -> None:
    """One record per row of ``pages`` under ``path``; ``compression`` is
    'gzip' (a member a record) or 'none'.

    A null payload is empty.  A null or empty table gives archives without
    records.  A row with a null identifier is always a response, and so are
    the rows that repeat the first identifier of a group.  Control characters
    and blanks of a URL are percent-encoded; without URL there is no target
    header.  Other columns are not read.
    """
    if compression not in ("gzip", "none"):
        raise ValueError(f"compression {compression!r} is neither 'gzip' nor 'none'")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn(
        "digest", F.sha2("payload", 256))
    again = written(find_revisits(written(rows.drop("payload"), "warc-keys"), min_bytes), "warc-revisits")
    url = F.col("url")
    for c in "\r\n\t ":
        url = F.replace(url, F.lit(c), F.lit(f"%{ord(c):02X}"))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    revisit = F.col("first").isNotNull()
    head = F.concat(
        F.lit(VERSION + "\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _urn(F.col("id"))),
        line("WARC-Date", F.lit(capture_date)),
        line("WARC-Target-URI", url),
        line("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        line("WARC-Refers-To", F.when(revisit, _urn(F.col("first")))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("X-Payload-Length", F.col("bytes").cast("string")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length("payload").cast("string")),
        F.lit("\r\n")).cast("binary")
    first_seen = rows.join(again.select("id", "digest").distinct(), ["id", "digest"], "left_anti")
    records = first_seen.withColumn("first", F.lit(None).cast(again.schema["first"].dataType)).unionByName(
        again.withColumn("payload", F.lit(b""))).select(head.alias("head"), "payload")
    if compression == "gzip":
        value, end = members(records), "\0"
    else:  # the writer ends each value with the last line feed of the record
        value, end = records.select(F.concat("head", "payload", F.lit(b"\r\n\r")).alias("value")), "\n"
    value.select(F.col("value").cast("string")).write.option("lineSep", end).text(path)


@dataclass
class FileGroup(InputPartition):
    files: list[str]


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


class WarcReader(DataSourceReader):
    """Plans groups of files and reads the records that pass the predicates."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema = schema
        self.path = options["path"]
        self.group_bytes = int(options.get("groupbytes", options.get("groupBytes", 64 << 20)))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else ""
            if name not in HEADER_COLUMNS:
                yield f
            elif isinstance(f, (EqualTo, EqualNullSafe)):
                self.tests.append((name, "in", frozenset([f.value])))
            elif isinstance(f, In):
                self.tests.append((name, "in", frozenset(f.value)))
            elif isinstance(f, StringStartsWith):
                self.tests.append((name, "prefix", f.value))
            elif isinstance(f, IsNotNull):
                self.tests.append((name, "present", None))
            else:
                yield f

    def partitions(self) -> list[FileGroup]:
        fs, root = _filesystem(self.path)
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True)) if (
            fs.get_file_info(root).type == pafs.FileType.Directory) else [fs.get_file_info(root)]
        files = sorted(((f.size, f.path) for f in found if f.type == pafs.FileType.File
                        and f.size and f.base_name[0] not in "._"), reverse=True)
        groups: list[tuple[int, list[str]]] = []
        for size, path in files:
            if groups and groups[-1][0] + size <= self.group_bytes:
                groups[-1] = (groups[-1][0] + size, groups[-1][1] + [path])
            else:
                groups.append((size, [path]))
        return [FileGroup(g) for _, g in groups] or [FileGroup([])]

    def _passes(self, values: dict) -> bool:
        for name, kind, want in self.tests:
            v = values[name]
            if kind == "in" and v not in want:
                return False
            if kind == "prefix" and not (v or "").startswith(want):
                return False
            if kind == "present" and v is None:
                return False
        return True

    def read(self, partition: FileGroup) -> Iterator[pa.RecordBatch]:
        fs, _ = _filesystem(self.path)
        names = self.schema.fieldNames()
        arrow = to_arrow_schema(self.schema)
        rows: list[tuple] = []
        size = 0
        for path in partition.files:
            for values, payload in self._open(fs, path, "payload" in names):
                values["payload"] = payload
                rows.append(tuple(values[n] for n in names))
                size += 256 + len(payload or b"")
                if size > BATCH_BYTES:
                    yield self._batch(rows, arrow)
                    rows, size = [], 0
        if rows:
            yield self._batch(rows, arrow)

    @staticmethod
    def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    def _open(self, fs: pafs.FileSystem, path: str, payloads: bool):
        if path.endswith((".bz2", ".zst", ".lz4")):
            with io.BufferedReader(fs.open_input_stream(path), 1 << 20) as stream:
                yield from self._records(stream, path, payloads, False)
            return
        # a small buffer where payloads aren't wanted, so that they aren't fetched either
        with io.BufferedReader(fs.open_input_file(path), 1 << (20 if payloads else 16)) as stream:
            if stream.peek(2)[:2] != MEMBER[:2]:
                yield from self._records(stream, path, payloads, True)
                return
            try:
                yield from self._members(stream, path, payloads)
            except (zlib.error, EOFError, gzip.BadGzipFile) as e:
                raise ValueError(f"{path}: {e}") from e

    def _members(self, stream: io.BufferedReader, path: str, payloads: bool):
        """Records of gzip members, by their lengths as long as they have one."""
        start = stream.tell()
        while head := stream.read(len(MEMBER) + 4):
            if head[:len(MEMBER)] != MEMBER or len(head) < len(MEMBER) + 4:
                stream.seek(start)
                with io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 20) as rest:
                    yield from self._records(rest, path, payloads, False)
                return
            left = struct.unpack("<I", head[len(MEMBER):])[0] - len(head)
            end = stream.tell() + left
            unpacker = zlib.decompressobj(-zlib.MAX_WBITS)
            text, at = b"", -1
            while at < 0:
                got = stream.read(min(left, HEAD_BYTES))
                if not got:
                    raise ValueError(f"{path}: the archive ends within a record's headers")
                left -= len(got)
                text += unpacker.decompress(got)
                at = text.find(b"\r\n\r\n")
            values = self._headers(io.BytesIO(text[:at + 4]), path)
            if self._passes(values):
                payload = None
                if payloads:
                    text += unpacker.decompress(stream.read(left)) + unpacker.flush()
                    size = at + 4 + values["content_length"]
                    if text[size:] != b"\r\n\r\n":
                        raise ValueError(f"{path}: a record's content doesn't end where its length says")
                    if unpacker.unused_data[:8] != struct.pack("<II", zlib.crc32(text), len(text)):
                        raise ValueError(f"{path}: a record's check sum is wrong")
                    payload = text[at + 4:size]
                yield values, payload
            start = stream.seek(end)

    @staticmethod
    def _headers(stream, path: str) -> dict | None:
        """Header columns of the record that begins here; None at the end."""
        first = stream.readline()
        if not first:
            return None
        if not first.startswith(b"WARC/"):
            raise ValueError(f"{path}: a record was expected, not {first[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n"):
            if not line:
                raise ValueError(f"{path}: the archive ends within a record's headers")
            key, _, value = line.decode("utf-8", "replace").partition(":")
            headers[key.strip().lower()] = value.strip()
        values = {c: headers.get(h.lower()) for c, h in HEADER_COLUMNS.items()}
        for c in LONG_COLUMNS:
            values[c] = None if values[c] is None else int(values[c])
        if values["content_length"] is None:
            raise ValueError(f"{path}: a record without Content-Length")
        return values

    def _records(self, stream: io.BufferedReader, path: str, payloads: bool, seekable: bool):
        while (values := self._headers(stream, path)) is not None:
            length = values["content_length"]
            wanted = self._passes(values)
            payload = None
            if wanted and payloads:
                payload = stream.read(length)
            elif seekable:
                stream.seek(length, io.SEEK_CUR)
            else:
                left = length
                while left and (got := len(stream.read(min(left, 1 << 20)))):
                    left -= got
            if stream.read(4) != b"\r\n\r\n":
                raise ValueError(f"{path}: a record's content doesn't end where its length says")
            if wanted:
                yield values, payload


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)


def register_warc(spark: SparkSession) -> None:
    """Make ``spark.read.format("warc")`` known, with predicate push-down."""
    ship_package(spark)
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """``response`` records with their payloads."""
    return spark.read.format("warc").load(path).where("record_type = 'response'")


def read_revisits(spark: SparkSession, path: str) -> DataFrame:
    """``revisit`` records: headers only."""
    headers = ", ".join(c for c in SCHEMA.split(", ") if not c.startswith("payload binary"))
    return spark.read.format("warc").schema(headers).load(path).where("record_type = 'revisit'")
