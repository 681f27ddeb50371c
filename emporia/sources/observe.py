"""Load reports (S14).

During a write, row counts are gathered with ``observe`` in the same pass
that writes the data (no extra counting job).  As a query, the report is a
union of distributed single-row counts folded per table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def with_row_count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def rows_before_after(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``{table: (input, output)}`` -> (table_name, rows_before, rows_after,
    rows_removed); each count is a partial + final aggregate of its plan."""
    parts = []
    for name, (before, after) in pairs.items():
        parts.append(before.agg(F.count(F.lit(1)).alias("n"))
                     .select(F.lit(name).alias("table_name"), F.col("n").alias("rows_before"),
                             F.lit(0).cast(T.LongType()).alias("rows_after")))
        parts.append(after.agg(F.count(F.lit(1)).alias("n"))
                     .select(F.lit(name).alias("table_name"),
                             F.lit(0).cast(T.LongType()).alias("rows_before"),
                             F.col("n").alias("rows_after")))
    u = reduce(DataFrame.unionByName, parts)
    return (u.groupBy("table_name")
            .agg(F.sum("rows_before").alias("rows_before"), F.sum("rows_after").alias("rows_after"))
            .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after")))
