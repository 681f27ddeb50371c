"""Distributed data-quality operators (C1-C5).

Each check is one aggregation per table (partial aggregation map-side, so a
key or row repeated a billion times collapses before the shuffle); results
are small report frames.  Only ``key_report`` collects, at most ``k`` rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("n"))


def _fingerprint(df: DataFrame) -> list:
    """128 bits of a row's values, NULLs told apart by position (the hash
    functions skip them)."""
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), F.lit("1")).otherwise(F.lit("0")) for c in df.columns])
    cols = [F.col(f"`{c}`") for c in df.columns]
    return [F.xxhash64(F.lit(seed), nulls, *cols).alias(f"__hash{seed}") for seed in (1, 2)]


def key_text(keys: list[str]) -> Column:
    """Key values as one text: joined by ``|``, which is escaped in values as
    the backslash is, and NULL as ``\\N``, which no value renders as."""
    def one(c: str) -> Column:
        text = F.replace(F.col(f"`{c}`").cast(T.StringType()), F.lit("\\"), F.lit("\\\\"))
        return F.coalesce(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\\N"))

    return F.concat_ws("|", *[one(c) for c in keys])


def duplicate_profile(df: DataFrame, table_name: str, keys: list[str] | None = None) -> DataFrame:
    """(table_name, total_rows, distinct_rows, duplicate_rows): group equal
    rows, then fold the group sizes.  Only fingerprints are shuffled, never the
    rows.  Equal rows have equal keys, so a table with ``keys`` is grouped by
    them and a 128-bit fingerprint of the row.  Without keys the groups are
    those of one 64-bit fingerprint, and a second one tells in the same
    aggregation which of them hold different rows; the rows of those alone (about
    n²/2^65 groups of n different rows, which bounds the broadcast) are read
    again and grouped by all their columns."""
    if keys:
        rows = df.select(*[F.col(f"`{k}`") for k in keys], *_fingerprint(df))
        g = _counts(rows, rows.columns).select("n")
    else:
        first, second = _fingerprint(df)
        group = df.select(first.alias("__first"), second.alias("__second")).groupBy("__first").agg(
            F.count(F.lit(1)).alias("n"), F.min("__second").alias("low"), F.max("__second").alias("high"))
        mixed = group.where("low <> high").select("__first")
        again = df.withColumn("__first", first).join(F.broadcast(mixed), "__first", "left_semi")
        g = group.where("low = high").select("n").unionByName(_counts(again, df.columns).select("n"))
    return (g.agg(F.coalesce(F.sum("n"), F.lit(0)).cast(T.LongType()).alias("total_rows"),
                  F.count(F.lit(1)).alias("distinct_rows"))
            .select(F.lit(table_name).alias("table_name"), "total_rows", "distinct_rows",
                    (F.col("total_rows") - F.col("distinct_rows")).alias("duplicate_rows")))


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count (HAVING)."""
    return _counts(df, keys).filter(F.col("n") > 1)


def duplicate_key_summary(df: DataFrame, table_name: str, keys: list[str]) -> DataFrame:
    """(table_name, key_columns, distinct_keys, duplicate_keys)."""
    g = _counts(df, keys)
    return g.agg(F.count(F.lit(1)).alias("distinct_keys"),
                 F.count_if(F.col("n") > 1).alias("duplicate_keys")).select(
        F.lit(table_name).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
        "distinct_keys", "duplicate_keys")


def top_duplicate_keys(df: DataFrame, table_name: str, keys: list[str], k: int = 5) -> DataFrame:
    """The k most repeated key values (count desc, then key asc), key values
    rendered as one text column so tables with different keys can share a
    report.  Top-k keeps a bounded heap per task (no full sort).  The keys that
    repeat are dealt once more, by another hash than the grouping's: small tables'
    groupings would else be run in the one task that unions their reports, which
    then held the hash tables of all of them."""
    v = key_violations(df, keys).repartition(F.xxhash64(*[F.col(f"`{c}`") for c in keys]))
    order = [F.col("n").desc()] + [F.col(c).asc_nulls_first() for c in keys]
    return (v.orderBy(*order).limit(k)
            .select(F.lit(table_name).alias("table_name"),
                    key_text(keys).alias("key_value"),
                    F.col("n").alias("occurrences")))


def key_report(df: DataFrame, table_name: str, keys: list[str], k: int = 5) -> tuple:
    """Key summary and the k most repeated keys from ONE aggregation.

    The top-k action consumes every group in its result stage; an
    ``observe`` on the grouped counts (before the ``n > 1`` filter) yields
    the summary from the same pass.  Result-stage metrics are counted once
    per successful task, so a retried task does not double them.
    An input that the optimizer folds to an empty plan gives no metrics; its
    summary is then a query of its own.  Returns (summary row as dict, list
    of top-k rows)."""
    from pyspark.sql import Observation

    obs = Observation(f"keys:{table_name}")
    g = _counts(df, keys).observe(obs, F.count(F.lit(1)).alias("distinct_keys"),
                                  F.count_if(F.col("n") > 1).alias("duplicate_keys"))
    order = [F.col("n").desc()] + [F.col(c).asc_nulls_first() for c in keys]
    top = (g.filter(F.col("n") > 1).orderBy(*order).limit(k)
           .select(F.lit(table_name).alias("table_name"),
                   key_text(keys).alias("key_value"),
                   F.col("n").alias("occurrences"))
           .collect())
    try:
        m = obs.get
    except Exception:  # noqa: BLE001 - a plan optimised to an empty one observes nothing
        return duplicate_key_summary(df, table_name, keys).first().asDict(), top
    summary = {"table_name": table_name, "key_columns": ",".join(keys),
               "distinct_keys": int(m["distinct_keys"]), "duplicate_keys": int(m["duplicate_keys"])}
    return summary, top


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Failing rows of a ``unique`` column test: non-null values seen more
    than once."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1)
            .withColumnRenamed(column, "unique_field"))


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """Failing rows of a ``not_null`` column test."""
    return df.filter(F.col(column).isNull())


def column_failures(df: DataFrame, column: str, with_unique: bool = True) -> DataFrame:
    """(unique_failures, not_null_failures) of one column from a single
    aggregation: group by the column once; the NULL group's size is the
    not_null failure count, non-null groups above one are unique failures.

    Without ``with_unique`` (a column with only a not_null test) there is no
    group-by at all: a global count of NULLs, one partial row per task, so
    the column's values are never shuffled."""
    if not with_unique:
        return df.agg(F.lit(None).cast(T.LongType()).alias("unique"),
                      F.count_if(F.col(column).isNull()).alias("not_null"))
    g = df.select(column).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(
        F.count_if(F.col(column).isNotNull() & (F.col("n") > 1)).alias("unique"),
        F.coalesce(F.sum(F.when(F.col(column).isNull(), F.col("n"))), F.lit(0))
        .cast(T.LongType()).alias("not_null"))


def column_test_report(tables: dict[str, DataFrame],
                       tests: dict[str, list[tuple[str, tuple[str, ...]]]]) -> DataFrame:
    """(model_name, column_name, test_name, failures) for every declared
    test; one aggregation per tested column, unioned."""
    parts = []
    for model, cols in tests.items():
        if model not in tables:
            continue
        for column, kinds in cols:
            for kind in kinds:
                if kind not in ("unique", "not_null"):
                    raise ValueError(f"unknown test {kind}")
            f = column_failures(tables[model], column, with_unique="unique" in kinds)
            rows = f.select(F.expr("stack(2, 'unique', `unique`, 'not_null', `not_null`)")
                            .alias("test_name", "failures"))
            parts.append(rows.filter(F.col("test_name").isin(*kinds)).select(
                F.lit(model).alias("model_name"), F.lit(column).alias("column_name"),
                "test_name", "failures"))
    return reduce(DataFrame.unionByName, parts)


def union_reports(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
