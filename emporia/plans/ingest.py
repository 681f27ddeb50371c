"""L1: every source CSV to Bronze Parquet, in one pass over the files.

While a table's records are written, the same pass counts its rows, the records
that don't fit their declared types and, for columns and tables that aren't
declared, what types the values need (``observe``).  Only what turns out to
need it is done again:

* a declared integer column with larger numbers becomes a bigint, one with
  fractions a double, and the table is read again;
* columns that aren't declared were written as text and are cast, from Parquet;
* records that can't be loaded are read again and set aside: table, file,
  record and reason, beside the layer's tables.  More than ``bad_share`` of a
  table's records fail the load, and nothing is published.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.sources import publish, value_types
from emporia.sources.files import LAYER_OPTIONS, REASON, CsvScan, scan_csv, source_files, whole_number
from emporia.sources.schemas import SOURCE_SCHEMAS

SET_ASIDE = "_set_aside"
SET_ASIDE_SCHEMA = "table_name string, file string, record string, reason string"


class TooManyBadRecords(ValueError):
    """A table has more records that can't be loaded than the load allows."""


@dataclass
class TableLoad:
    """What was loaded of one table: good rows, records set aside, declared
    columns whose type was widened, and types found for the others."""

    table: str
    rows: int
    bad: int
    widened: dict[str, T.DataType] = field(default_factory=dict)
    found: dict[str, T.DataType] = field(default_factory=dict)


def _needed(scan: CsvScan) -> dict[str, T.DataType]:
    """The types that integer columns need instead of theirs, from the records
    that don't fit: bigint for larger numbers, double for any other number."""
    told = []
    for k, (name, text) in enumerate(scan.texts.items()):
        value, large = F.col(f"`{text}`"), whole_number(F.col(f"`{text}`"), T.LongType())
        misfit = F.col(f"`{name}`").isNull() & value.isNotNull()
        told += [F.count_if(misfit & large.isNotNull()).alias(f"large{k}"),
                 F.count_if(misfit & large.isNull() & value.try_cast("double").isNotNull()).alias(f"other{k}")]
    if not told:
        return {}
    seen = scan.rows.where(F.col(REASON).isNotNull()).agg(*told).first()
    return {name: T.DoubleType() if seen[f"other{k}"] else T.LongType()
            for k, name in enumerate(scan.texts) if seen[f"other{k}"] or seen[f"large{k}"]}


def _write(scan: CsvScan, path: str) -> TableLoad:
    """Write the good rows, counting all."""
    told = Observation(scan.table)
    opened = [m for k, name in enumerate(scan.open) for m in value_types.counts(name, f"open{k}_")]
    rows = scan.rows.select(*[F.col(f"`{c}`") for c in scan.columns], REASON).observe(
        told, F.count(F.lit(1)).alias("records"), F.count_if(F.col(REASON).isNotNull()).alias("bad"), *opened)
    rows.where(F.col(REASON).isNull()).drop(REASON).write.options(**LAYER_OPTIONS).parquet(path)
    seen = told.get
    found = {name: value_types.type_of({kind: seen[f"open{k}_{kind}"] for kind in value_types.KINDS})
             for k, name in enumerate(scan.open)}
    return TableLoad(scan.table, seen["records"] - seen["bad"], seen["bad"], found=found)


def load_table(spark: SparkSession, source: str, table: str, path: str, build: str) -> tuple[TableLoad, CsvScan]:
    """One table from its CSV files to ``path``; ``build`` is where tables
    are written that are not yet right."""
    schema = SOURCE_SCHEMAS.get(table, T.StructType())
    scan, widened = scan_csv(spark, source, schema, table), {}
    target, attempt = path, 0
    while True:
        opened = bool(scan.open)
        target = f"{build}/_text/{table}-{attempt}" if opened else path
        load = _write(scan, target)
        need = _needed(scan) if load.bad else {}
        if not need:
            break
        # a double holds all that a bigint does, so a column is widened twice at most
        widened |= need
        attempt += 1
        if not opened:
            publish.remove(spark, target)
        scan = scan_csv(spark, source, schema, table, widened)
    load.widened = widened
    if scan.open:
        text = spark.read.parquet(target)
        text.select(*[value_types.cast(c, load.found[c]).alias(c) if c in load.found else F.col(f"`{c}`")
                      for c in text.columns]).write.options(**LAYER_OPTIONS).parquet(path)
    return load, scan


def ingest_report(spark: SparkSession, raw_dir: str, bronze_dir: str, stems: Mapping[str, str] | None = None,
                  bad_share: float = 0.01, parallelism: int = 4) -> dict[str, TableLoad]:
    """Load every CSV of ``raw_dir`` and publish the layer; per table what
    was loaded.  ``stems``: file stem -> table, for files not named like their
    table.  ``bad_share``: the share of a table's records that may be set aside."""
    found, base = source_files(spark, raw_dir, stems=stems), bronze_dir.rstrip("/")
    build = publish.new_build(base)
    pool = ThreadPoolExecutor(max_workers=max(1, parallelism))
    loads = [pool.submit(load_table, spark, source, table, f"{base}/{build}/{table}", f"{base}/{build}")
             for table, source in found.items()]
    try:
        done = {load.table: (load, scan) for load, scan in (x.result() for x in as_completed(loads))}
        for load, scan in done.values():
            if load.bad > bad_share * (load.rows + load.bad):
                first = "; ".join(r["reason"] for r in scan.bad().select("reason").limit(3).collect())
                raise TooManyBadRecords(
                    f"{load.table}: {load.bad} of {load.rows + load.bad} records can't be loaded, among them: {first}")
        bad = [scan.bad() for load, scan in done.values() if load.bad]
        if bad:
            reduce(DataFrame.unionByName, bad).write.parquet(f"{base}/{build}/{SET_ASIDE}")
    except BaseException:
        pool.shutdown(wait=True, cancel_futures=True)
        publish.discard(spark, base, build)
        raise
    pool.shutdown()
    publish.remove(spark, f"{base}/{build}/_text")
    publish.publish(spark, base, build, [*found, SET_ASIDE] if bad else list(found), () if bad else (SET_ASIDE,))
    return {table: done[table][0] for table in found}


def set_aside(spark: SparkSession, bronze_dir: str) -> DataFrame:
    """(table_name, file, record, reason) of the records that the layer's ingest set aside."""
    where = publish.current(spark, bronze_dir).get(SET_ASIDE)
    return spark.read.schema(SET_ASIDE_SCHEMA).parquet(where) if where else spark.createDataFrame([], SET_ASIDE_SCHEMA)


def ingest(spark: SparkSession, raw_dir: str, bronze_dir: str, stems: Mapping[str, str] | None = None,
           bad_share: float = 0.01) -> dict[str, int]:
    """``ingest_report``'s row counts."""
    return {t: x.rows for t, x in ingest_report(spark, raw_dir, bronze_dir, stems, bad_share).items()}
