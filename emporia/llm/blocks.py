"""Comparing the members of buckets block by block inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACE = ["key", "p", "q"]


def deal_blocks(members: DataFrame, block: int) -> DataFrame:
    """Rows of buckets (key, m: the bucket's members, rep, ...) dealt over
    the bucket's pairs of blocks (p, q), p <= q, of about ``block`` members;
    ``second`` tells the two blocks of a pair apart.  Sorted by place, so that
    a task streams through its groups, none larger than two blocks."""
    blocks = F.ceil(F.col("m") / block).cast("int")
    return _dealt(members.withColumn("own", F.pmod(F.xxhash64("rep"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("m"))


def deal_apart(members: DataFrame, block: int) -> DataFrame:
    """As ``deal_blocks``, for buckets whose members ``inside`` a part of
    ``big`` members are not to meet one another: blocks of the ``rest`` meet all
    blocks, blocks of the part only those."""
    rest = F.greatest(F.lit(1), F.ceil(F.col("rest") / block).cast("int"))
    big = F.greatest(F.lit(1), F.ceil(F.col("big") / block).cast("int"))
    place = F.xxhash64("rep")
    own = F.when(F.col("inside"), rest + F.pmod(place, big)).otherwise(F.pmod(place, rest)).cast("int")
    last = F.when(F.col("inside"), rest).otherwise(rest + big) - 1
    return _dealt(members.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), last))).drop("rest", "big", "inside"))


def _dealt(rows: DataFrame) -> DataFrame:
    rest = [c for c in rows.columns if c not in ("key", "own", "other")]
    return rows.select(
        "key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
        (F.col("own") > F.col("other")).alias("second"), *rest
    ).repartition(*PLACE).sortWithinPartitions(*PLACE)


def groups_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple]]]:
    """Tables of whole groups with, for each group, its key and the positions
    of both its sides (the same positions if the block meets itself)."""
    held = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now])
        at = np.stack([held.column(c).to_numpy() for c in PLACE])
        starts = np.flatnonzero(np.append(True, (at[:, 1:] != at[:, :-1]).any(axis=0)))
        # the last group may go on in the next batch
        if len(starts) > 1:
            yield _described(held.slice(0, starts[-1]).combine_chunks(), starts[:-1])
            held = held.slice(starts[-1])
    if held is not None and held.num_rows:
        yield _described(held.combine_chunks(), np.zeros(1, np.int64))


def _described(rows: pa.Table, starts: np.ndarray) -> tuple[pa.Table, list[tuple]]:
    key, p, q = (rows.column(c).to_numpy() for c in PLACE)
    second = rows.column("second").to_numpy(zero_copy_only=False)
    found = []
    for begin, end in zip(starts.tolist(), np.append(starts[1:], rows.num_rows).tolist()):
        at = np.arange(begin, end)
        alone = p[begin] == q[begin]
        found.append((key[begin], at if alone else at[~second[at]], at if alone else at[second[at]]))
    return rows, found


def matrix(rows: pa.Table, name: str) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    return rows.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
