"""Relational operators used by the layers (P1-P8, J1-J4, A5, A9-A10).

No join hint is forced: Spark broadcasts a side only when its size
estimate is under ``spark.sql.autoBroadcastJoinThreshold`` (and AQE
re-checks with runtime shuffle sizes); otherwise it shuffles both sides
on the key (sort-merge), with AQE splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    return df.select(*columns)


def distinct_project(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """SELECT DISTINCT over a projection (partial distinct map-side)."""
    return df.select(*columns).distinct()


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop whole-row duplicates."""
    return df.dropDuplicates()


def lookup_join(left: DataFrame, lookup: DataFrame, key: str,
                columns: list[str | Column]) -> DataFrame:
    """Left outer equi-join on ``key`` followed by an explicit projection,
    so the output keeps the caller's column order (a USING join would move
    the key to the front).  Unmatched rows keep NULLs for lookup columns."""
    l, r = left.alias("l"), lookup.alias("r")
    return l.join(r, F.col(f"l.{key}") == F.col(f"r.{key}"), "left").select(*columns)


def enrich_join(facts: DataFrame, lookup: DataFrame, key: str,
                columns: list[str | Column]) -> DataFrame:
    """Inner equi-join: fact rows without a lookup row are dropped."""
    f, r = facts.alias("f"), lookup.alias("r")
    return f.join(r, F.col(f"f.{key}") == F.col(f"r.{key}"), "inner").select(*columns)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def positive(df: DataFrame, column: str) -> DataFrame:
    """``x IS NOT NULL AND x > 0`` (pushed to the scan when on a source column)."""
    return df.filter(F.col(column).isNotNull() & (F.col(column) > 0))


def bounds_with_default(df: DataFrame, value: Column, first_default: Column,
                        last_default: Column, first_name: str = "first",
                        last_name: str = "last") -> DataFrame:
    """Global MIN / MAX without GROUP BY; defaults replace NULL (empty
    input).  Always exactly one row."""
    return df.agg(F.coalesce(F.min(value), first_default).alias(first_name),
                  F.coalesce(F.max(value), last_default).alias(last_name))
