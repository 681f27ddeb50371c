"""File scans and sinks (S1-S3, S5).

CSV columns are bound by the names in the header, never by position, and no
value is dropped silently: a file whose header differs from the others' fails
the load, and a record that isn't well-formed or holds a value that doesn't fit
its declared type does too (``read_csv``) or is told apart with the reason
(``scan_csv``), so that a load can set it aside.

Quoted line breaks are allowed in every table.  Files that one task reads
anyway go to Spark's multi-line reader; larger ones are read by many tasks,
line by line where no record has a line break, else through ``csv_ranges``.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.sources import csv_ranges
from emporia.sources.publish import file_system
from emporia.sources.schemas import SOURCE_SCHEMAS

# The raw files' CSV dialect.
CSV_DIALECT = {"header": "true", "escape": '"', "quote": '"'}
#: Columns of a scan beside the table's own: the record as CSV text, why it
#: can't be loaded (null if it can), and the file it is from.
RECORD, REASON, FILE = "__record", "__reason", "__file"
_CORRUPT = "__corrupt"
#: An empty field is NULL and a quoted empty field the empty text: no text a
#: file could hold stands for NULL.
READ_OPTIONS = CSV_DIALECT | {"mode": "FAILFAST", "enforceSchema": "false", "nullValue": "\u0001NULL\u0001"}
#: Parquet files of the layers.
LAYER_OPTIONS = {"compression": "zstd"}
WRITE_OPTIONS = CSV_DIALECT | {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                               "emptyValue": '""'}


def _data_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files of a CSV file or folder that aren't empty."""
    fs, where = file_system(spark, path)
    found = fs.listStatus(where)  # of a file: itself
    return sorted((str(f.getPath().toString()), f.getLen()) for f in found
                  if f.isFile() and f.getLen() and f.getPath().getName()[0] not in "._")


def _codec(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    return hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(
        hadoop.fs.Path(path))


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names in the header of the CSV file or folder: the first line of
    its first file that isn't empty, read by the driver."""
    parts = _data_files(spark, path)
    if not parts:  # nested folders, or nothing: left to Spark
        return spark.read.options(**CSV_DIALECT).csv(path).columns
    java = spark.sparkContext._jvm.java.io
    fs, first = file_system(spark, parts[0][0])
    codec, stream = _codec(spark, parts[0][0]), fs.open(first)
    lines = java.BufferedReader(java.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        return next(csv.reader([lines.readLine().lstrip("\ufeff")]))
    finally:
        lines.close()


def _larger_than_a_split(spark: SparkSession, parts: list[tuple[str, int]]) -> bool:
    """Whether Spark would cut one of the files into several byte ranges."""
    conf = spark._jsparkSession.sessionState().conf()
    share = sum(n + conf.filesOpenCostInBytes() for _, n in parts) // max(1, spark.sparkContext.defaultParallelism)
    split = min(conf.filesMaxPartitionBytes(), max(conf.filesOpenCostInBytes(), share))
    return any(n > split and _codec(spark, p) is None for p, n in parts)


@dataclass(frozen=True)
class CsvScan:
    """``rows``: every record of a table's files, as the table's columns,
    ``RECORD``, ``REASON`` and ``FILE``.  ``schema``: what is declared, as widened;
    ``open``: the other columns, which are text.  ``texts``: for each declared
    column that may be widened (integers) the column that holds it as text."""

    path: str
    table: str
    schema: T.StructType
    open: tuple[str, ...]
    texts: dict[str, str]
    rows: DataFrame
    files: DataFrame | None

    @property
    def columns(self) -> list[str]:
        return [*self.schema.fieldNames(), *self.open]

    def good(self) -> DataFrame:
        return self.rows.where(F.col(REASON).isNull()).select(*[F.col(f"`{c}`") for c in self.columns])

    def bad(self) -> DataFrame:
        """(table_name, file, record, reason) of the records that can't be loaded."""
        found = self.rows.where(F.col(REASON).isNotNull()).select(
            F.lit(self.table).alias("table_name"), F.col(FILE).alias("file"), F.col(RECORD).alias("record"),
            F.col(REASON).alias("reason"))
        if self.files is None:
            return found
        return found.join(self.files, "file").select("table_name", F.col("path").alias("file"), "record", "reason")


def whole_number(text: Column, kind: T.DataType) -> Column:
    """Text as an integer of a type; it may be written as a decimal without fraction."""
    number = text.try_cast(T.DecimalType(38, 10))
    return F.coalesce(text.try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))


def _typed(text: Column, kind: T.DataType) -> Column:
    """Text to a declared type, null where it doesn't fit.  Only a text column
    knows the empty text."""
    if isinstance(kind, T.StringType):
        return text
    return whole_number(text, kind) if isinstance(kind, (T.IntegerType, T.LongType)) else text.try_cast(kind)


def _text_rows(spark: SparkSession, path: str, header: list[str],
               by_ranges: bool | None) -> tuple[DataFrame, DataFrame | None]:
    """Every record as text columns, ``_CORRUPT`` (the record if it isn't
    well-formed) and ``FILE``; and, if ``FILE`` is a number, the files' names."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*header, _CORRUPT]])
    options = READ_OPTIONS | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parts = _data_files(spark, path)
    lines = bool(parts) and (_larger_than_a_split(spark, parts) if by_ranges is None else by_ranges)
    if lines:
        states = csv_ranges.has_line_breaks(spark, path)
        if states is not None:
            for k in ("header", "enforceSchema"):
                options.pop(k)
            found = csv_ranges.read_records(spark, path, states, header)
            rows = found.select("file", F.from_csv("record", schema.toDDL(), options).alias("r"))
            return rows.select("r.*", F.col("file").alias(FILE)), csv_ranges.file_names(spark, path)
    reader = spark.read.options(**options).option("multiLine", str(not lines).lower())
    return reader.schema(schema).csv(path).select("*", F.col("_metadata.file_path").alias(FILE)), None


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, table: str = "csv",
             widened: Mapping[str, T.DataType] | None = None, by_ranges: bool | None = None) -> CsvScan:
    """Columns of ``schema`` (in its order, found by header name, whatever
    their case), then the file's other columns as text, and what makes a record
    unfit.  ``widened``: other types for declared columns.  ``by_ranges``: whether
    files are cut into byte ranges (default: where one is larger than a split).  Fails when a
    declared column is missing or a part file's header differs."""
    header = csv_header(spark, path)
    place = {name.lower(): name for name in header}
    fields = [T.StructField(f.name, (widened or {}).get(f.name, f.dataType)) for f in (schema or T.StructType()).fields]
    missing = [f.name for f in fields if f.name.lower() not in place]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header {header}")
    rows, names = _text_rows(spark, path, header, by_ranges)
    declared = {f.name.lower() for f in fields}
    others = [n for n in header if n.lower() not in declared]
    text = {f.name: F.col(f"`{place[f.name.lower()]}`") for f in fields}
    told = {f.name: text[f.name] if isinstance(f.dataType, T.StringType) else F.nullif(text[f.name], F.lit(""))
            for f in fields}
    typed = {f.name: _typed(told[f.name], f.dataType) for f in fields}
    reasons = [F.when(F.col(_CORRUPT).isNotNull(), F.lit(f"{table}: the record doesn't have {len(header)} fields"))]
    reasons += [F.when(told[f.name].isNotNull() & typed[f.name].isNull(), F.concat(
        F.lit(f"{table}.{f.name}: not {f.dataType.simpleString()}: "), text[f.name]))
        for f in fields if not isinstance(f.dataType, T.StringType)]
    whole = {f.name: f"__text_{f.name}" for f in fields if isinstance(f.dataType, (T.IntegerType, T.LongType))}
    record = F.coalesce(F.col(_CORRUPT), F.to_csv(F.struct(*[F.col(f"`{n}`") for n in header]),
                                                  {"escape": '"', "quote": '"', "emptyValue": '""'}))
    reason = F.coalesce(*reasons)
    return CsvScan(
        path, table, T.StructType(fields), tuple(others), whole,
        rows.select(*[typed[f.name].alias(f.name) for f in fields], *[F.col(f"`{n}`") for n in others],
                    *[told[c].alias(t) for c, t in whole.items()], reason.alias(REASON),
                    F.when(reason.isNotNull(), record).alias(RECORD), FILE), names)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, table: str = "csv") -> DataFrame:
    """Columns as ``scan_csv`` gives them; a record that can't be loaded fails
    the read.  Without a schema all types are inferred (an extra pass)."""
    if schema is None:
        return spark.read.options(**READ_OPTIONS).option("multiLine", "true").option("inferSchema", "true").csv(path)
    scan = scan_csv(spark, path, schema, table)
    fits = F.when(F.col(REASON).isNull(), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.col(REASON), F.lit(" in "), F.col(RECORD))).cast("boolean"))
    return scan.rows.where(fits).select(*[F.col(f"`{c}`") for c in scan.columns])


def file_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Number of data files under a table's folder and bytes of the largest."""
    fs, where = file_system(spark, path)
    sizes = [f.getLen() for f in fs.listStatus(where) if f.getPath().getName()[0] not in "._"]
    return {"files": len(sizes), "largest_bytes": max(sizes, default=0)}


def list_csv(spark: SparkSession, raw_dir: str) -> dict[str, str]:
    """Stem -> path of every ``*.csv`` file or folder in ``raw_dir``."""
    fs, base = file_system(spark, raw_dir)
    if not fs.exists(base):
        raise ValueError(f"no folder {raw_dir}")
    paths = [str(s.getPath().toString()) for s in fs.listStatus(base)]
    return {p.rstrip("/").rsplit("/", 1)[1][:-4]: p for p in sorted(paths) if p.lower().endswith(".csv")}


def read_source_csv(spark: SparkSession, raw_dir: str, table: str) -> DataFrame:
    """One declared source table from ``<raw_dir>/<table>.csv``."""
    return read_csv(spark, f"{raw_dir.rstrip('/')}/{table}.csv", SOURCE_SCHEMAS[table], table)


def source_files(spark: SparkSession, raw_dir: str, tables: Iterable[str] | None = None,
                 stems: Mapping[str, str] | None = None) -> dict[str, str]:
    """Table -> path of every CSV in the folder: the table is the file's stem,
    or what ``stems`` (stem -> table) makes of it.  ``tables`` are those that
    must be there (default: all declared ones)."""
    wanted = list(SOURCE_SCHEMAS) if tables is None else list(tables)
    if not wanted:
        raise ValueError("no source tables declared")
    found: dict[str, str] = {}
    for stem, path in list_csv(spark, raw_dir).items():
        table = (stems or {}).get(stem, stem)
        if table in found:
            raise ValueError(f"{found[table]} and {path} are both {table}")
        found[table] = path
    missing = [t for t in wanted if t not in found]
    if missing:
        raise ValueError(f"no file for {', '.join(missing)} in {raw_dir}")
    return found


def discover_sources(spark: SparkSession, raw_dir: str, tables: Iterable[str] | None = None,
                     stems: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Every table of ``source_files`` as a lazy scan.  Declared tables get
    their declared types, others inferred ones."""
    found = source_files(spark, raw_dir, tables, stems)
    with ThreadPoolExecutor(max_workers=8) as pool:  # each reads a header
        return dict(zip(found, pool.map(lambda t: read_csv(spark, found[t], SOURCE_SCHEMAS.get(t), t), found)))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none",
              file_records: int = 0) -> None:
    """CSV in the source dialect (header, doubled quotes), read back by
    ``read_csv`` value for value: blanks, empty texts and NULLs included.
    ``file_records``: most records of a file (0: no limit), as a compressed file is read by one task."""
    df.write.mode(mode).options(**WRITE_OPTIONS, compression=compression, maxRecordsPerFile=file_records).csv(path)
