"""Incremental Bronze ingest as a Structured Streaming file source.

Only CSV files not seen before are read (the source's file log in the
checkpoint remembers processed files), rows are appended to Parquet
partitioned by the year and month of a date-time column, and the run stops
when the backlog is empty (``availableNow``).  The checkpoint lives in
shared storage, so a lost executor or a restarted run neither loses nor
duplicates files (exactly-once file sink).

Before the write, rows are dealt by (year, month, salt), so a batch writes at
most ``files_per_month`` files into a partition, however many files it read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from emporia.functions.dates import parse_timestamp
from emporia.sources.files import READ_OPTIONS


@dataclass(frozen=True)
class IngestRun:
    """A finished run and the rows of all its batches."""

    query: StreamingQuery
    rows: int


PROGRESS_KEPT = "spark.sql.streaming.numRecentProgressUpdates"


def incremental_ingest(spark: SparkSession, source_dir: str, schema: T.StructType,
                       out_dir: str, checkpoint_dir: str, date_column: str,
                       multiline: bool = True, max_files_per_trigger: int | None = None,
                       files_per_month: int = 4) -> IngestRun:
    """Append new CSV files under ``source_dir`` to ``out_dir`` (Parquet,
    partitioned by year / month of ``date_column``).  A file whose header
    isn't the schema's, or with a malformed record, fails the run."""
    reader = spark.readStream.schema(schema).options(**READ_OPTIONS)
    if multiline:
        reader = reader.option("multiLine", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = reader.csv(source_dir)
    ts = parse_timestamp(date_column, schema[date_column].dataType)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{f.name}`") for f in schema.fields]), F.lit(files_per_month))
    out = rows.withColumns({"year": F.year(ts), "month": F.month(ts)}).repartition("year", "month", salt)
    kept = spark.conf.get(PROGRESS_KEPT)
    spark.conf.set(PROGRESS_KEPT, str(10 ** 6))  # else only the latest batches are counted
    try:
        q = (out.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint_dir)
             .partitionBy("year", "month")
             .trigger(availableNow=True)
             .start(out_dir))
        q.awaitTermination()
    finally:
        spark.conf.set(PROGRESS_KEPT, kept)
    return IngestRun(q, sum(p["numInputRows"] for p in q.recentProgress))
