"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emporia.session import scratch_path, ship_package

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` is the fast path where it can touch
    nothing else, that is where every character is one byte."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder.  Cuts lineage:
    an executor lost later costs a re-read, never a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_of_id(id_col: str = "doc_id") -> Column:
    """crc32 of an identifier's decimal text; a null identifier counts as ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def splitmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public-domain splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return splitmix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt * 1_000_003))
                        * np.uint64(0x9E3779B97F4A7C15))


def bounded_sample(rows: DataFrame, label: str, rows_per_label: int, max_labels: int) -> DataFrame:
    """Rows (``label``, ``h``, ...) with the smallest ``h``, a uniform 64-bit
    hash, at most ``rows_per_label`` of each label.

    The labels' counts, at most ``max_labels`` numbers, say which part of the
    hash range holds a little more than that many rows; only those rows are
    ranked, so what is shuffled doesn't grow with the input."""
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(max_labels + 1).collect()
    if len(counts) > max_labels:
        raise ValueError(f"more than {max_labels} values of {label}")
    wanted = 1.25 * rows_per_label + 100  # far beyond the random spread of a hash range's rows
    top = F.lit(None).cast("long")
    for r in counts:
        part = min(1.0, wanted / r["n"])
        top = F.when(F.col(label) == r[label], F.lit(min((1 << 63) - 1, int((part * 2 - 1) * (1 << 63))))).otherwise(top)
    order = Window.partitionBy(label).orderBy("h")
    return rows.where(F.col("h") <= top).withColumn("__rank", F.row_number().over(order)).where(
        F.col("__rank") <= rows_per_label).drop("__rank")


def chunks(rows: Iterator, weight, limit: int) -> Iterator[list]:
    """Rows in lists of at most ``limit`` total weight (at least one row each)."""
    held, total = [], 0
    for row in rows:
        w = weight(row)
        if held and total + w > limit:
            yield held
            held, total = [], 0
        held.append(row)
        total += w
    if held:
        yield held


def keep_rows(docs: DataFrame, text_col: str, judge) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text passes.
    ``judge()`` is called in the task and returns a function from a list of
    texts (nulls among them) to a list of booleans."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = judge()
        for batch in batches:
            kept: list[bool] = []
            for part in chunks((x.as_py() for x in batch.column(at)), lambda t: len(t or ""), 1 << 20):
                kept += passes(part)
            yield batch.filter(pa.array(kept, pa.bool_()))

    ship_package(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
