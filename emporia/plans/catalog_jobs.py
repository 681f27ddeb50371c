"""File and catalog round-trips (S1, S4-S6, S8-S11) as queries.

Each call writes under a fresh path of the shared scratch root (the
cluster's ``spark.checkpoint.dir``), registers or reads it back, and
returns the lazy scan.  Fresh paths and table names keep re-runs clean and
never overwrite files a running plan reads; both go when the application
ends.
"""

from __future__ import annotations

import atexit
import contextlib
import re
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.plans.ingest import load_table
from emporia.session import scratch_path
from emporia.sources import catalog
from emporia.sources.driver_tables import DriverTables
from emporia.sources.files import read_csv, scan_csv, write_csv, write_parquet
from emporia.streaming.incremental import incremental_ingest

SCRATCH_NAMESPACE = "emporia_scratch"
#: The orders as they land: text.
ORDER_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")])


def scratch_namespace(spark: SparkSession, suffix: str = "") -> str:
    """A namespace of this application, dropped with its tables at exit (their
    files are scratch paths, removed when the application ends)."""
    name = f"{SCRATCH_NAMESPACE}_{re.sub(r'[^0-9A-Za-z]', '_', spark.sparkContext.applicationId)}{suffix}"
    if not spark.catalog.databaseExists(name):
        catalog.create_namespace(spark, name, scratch_path(spark, "namespace"))
        atexit.register(_drop_namespace, spark, name)
    return name


def _drop_namespace(spark: SparkSession, name: str) -> None:
    with contextlib.suppress(Exception):  # the session may have been stopped before
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def _table_name(spark: SparkSession, stem: str) -> str:
    return f"{scratch_namespace(spark)}.{stem}_{uuid.uuid4().hex[:10]}"


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write ``part`` as CSV in the source dialect, read it back with an
    explicit schema (no inference pass)."""
    part = DriverTables(spark, sf_dir)["part"]
    path = scratch_path(spark, "part_csv")
    write_csv(part, path)
    return read_csv(spark, path, T.StructType(part.schema.fields))


def scan_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path-backed catalog table written with saveAsTable, read by name."""
    sup = DriverTables(spark, sf_dir)["supplier"]
    name = _table_name(spark, "supplier")
    catalog.save_as_table(sup, name, scratch_path(spark, "supplier_tbl"))
    return catalog.read_table(spark, name)


def register_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing Parquet files registered as a table (forced: drop, then
    create over the location; the files survive the drop)."""
    cust = DriverTables(spark, sf_dir)["customer"]
    loc = scratch_path(spark, "customer_pq")
    write_parquet(cust, loc)
    name = _table_name(spark, "customer")
    catalog.register_parquet(spark, name, loc)
    catalog.register_parquet(spark, name, loc, replace=True)
    return catalog.read_table(spark, name)


def refresh_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table over files that are overwritten later: after REFRESH the
    table shows the new files, not the cached listing."""
    orders = DriverTables(spark, sf_dir)["orders"]
    loc = scratch_path(spark, "orders_pq")
    stale = orders.withColumn("o_orderstatus", F.lower("o_orderstatus"))
    write_parquet(stale, loc)
    name = _table_name(spark, "orders")
    catalog.register_parquet(spark, name, loc)
    catalog.read_table(spark, name).count()  # the listing is now cached
    write_parquet(orders, loc)
    catalog.refresh(spark, name)
    return catalog.read_table(spark, name)


def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV with line breaks inside quotes, read by byte ranges."""
    orders = DriverTables(spark, sf_dir)["orders"].select(
        "o_orderkey", F.concat_ws("\n", "o_orderpriority", F.lit('said "so", twice'), "o_orderstatus").alias("note"), "o_totalprice")
    path = scratch_path(spark, "orders_csv")
    write_csv(orders, path)
    return scan_csv(spark, path, orders.schema, "orders", by_ranges=True).good()


def csv_set_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items some of whose quantities are no numbers: the ingest loads the
    others and sets those aside.  What was set aside, by reason and return flag."""
    items = DriverTables(spark, sf_dir)["lineitem"].select(
        "l_orderkey", "l_returnflag",
        F.when(F.col("l_linenumber") == 7, F.lit("many")).otherwise(F.col("l_quantity").cast("int").cast("string")).alias("l_quantity"))
    raw, out = scratch_path(spark, "items_csv"), scratch_path(spark, "items_bronze")
    write_csv(items, raw)
    schema = T.StructType.fromDDL("l_orderkey bigint, l_returnflag string, l_quantity int")
    scan = scan_csv(spark, raw, schema, "items")
    write_parquet(scan.good(), out)
    flag = F.split_part("record", F.lit(","), F.lit(2))
    return spark.read.parquet(out).groupBy(F.lit(None).cast("string").alias("reason"), "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")).unionByName(
        scan.bad().groupBy("reason", flag.alias("l_returnflag")).agg(
            F.count(F.lit(1)).alias("n"), F.lit(None).cast("bigint").alias("quantity")))


def csv_found_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts loaded from CSV without any declared type: types are found in the
    pass that writes, and the size is widened where it has a fraction."""
    part = DriverTables(spark, sf_dir)["part"].select(
        "p_partkey", "p_brand", "p_retailprice", (F.col("p_size") > 25).alias("large"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("p_size")).alias("since"),
        F.when(F.col("p_size") == 7, F.lit(7.5)).otherwise(F.col("p_size")).alias("p_size"))
    raw, out = scratch_path(spark, "part_csv"), scratch_path(spark, "part_bronze")
    write_csv(part, raw)
    load_table(spark, raw, "parts", f"{out}/parts", out)
    return spark.read.parquet(f"{out}/parts").withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


CATALOG_JOBS = {
    "csv_roundtrip": csv_roundtrip,
    "scan_catalog": scan_catalog,
    "register_external": register_external,
    "refresh_external": refresh_external,
    "csv_line_breaks": csv_line_breaks,
    "csv_set_aside": csv_set_aside,
    "csv_found_types": csv_found_types,
}


def _order_arrivals(spark: SparkSession, sf_dir: str) -> Iterator[str]:
    """Orders as they land, of status F first, the rest (any other status,
    NULL included) later; after each arrival the folder that the incremental
    ingest has appended its new files to."""
    orders = DriverTables(spark, sf_dir)["orders"]
    text = orders.select(
        F.col("o_orderkey").cast(T.StringType()).alias("o_orderkey"),
        F.col("o_custkey").cast(T.StringType()).alias("o_custkey"),
        "o_orderstatus", F.col("o_totalprice").cast(T.StringType()).alias("o_totalprice"),
        F.col("o_orderdate").cast(T.StringType()).alias("o_orderdate"),
        "o_orderpriority")
    landing, out, ckpt = (scratch_path(spark, n) for n in ("landing", "orders_inc", "orders_ckpt"))
    first = F.col("o_orderstatus").eqNullSafe("F")
    for k, part in enumerate((text.filter(first), text.filter(~first)), 1):
        write_csv(part, f"{landing}/arrival={k}")
        incremental_ingest(spark, landing, ORDER_TEXT, out, ckpt, "o_orderdate")
        yield out


def _typed_orders(res: DataFrame) -> DataFrame:
    return res.select(
        F.col("o_orderkey").cast(T.LongType()).alias("o_orderkey"),
        F.col("o_custkey").cast(T.LongType()).alias("o_custkey"),
        "o_orderstatus", F.col("o_totalprice").cast(T.DoubleType()).alias("o_totalprice"),
        F.col("o_orderdate").try_cast(T.TimestampNTZType()).alias("o_orderdate"),
        "o_orderpriority", "year", "month")


def incremental_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental ingest in two arrivals; the second run appends only the new
    files.  The result is the whole orders table with its year / month partitions."""
    *_, out = _order_arrivals(spark, sf_dir)
    return _typed_orders(spark.read.parquet(out))


def partitioned_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folder of the incremental ingest registered as a partitioned table
    after the first arrival; after the second its partitions are refreshed, and
    the table shows the new months and the new files of the old ones."""
    name, by = _table_name(spark, "orders_by_month"), ["year", "month"]
    schema = T.StructType([*ORDER_TEXT.fields, *(T.StructField(c, T.IntegerType()) for c in by)])
    for k, out in enumerate(_order_arrivals(spark, sf_dir)):
        if not k:
            catalog.register_partitioned(spark, name, out, schema, by)
            catalog.read_table(spark, name).count()  # the listing is now cached
    catalog.refresh_partitions(spark, name, out, by)
    return _typed_orders(catalog.read_table(spark, name))


CATALOG_JOBS |= {"incremental_orders": incremental_orders, "partitioned_external": partitioned_external}
