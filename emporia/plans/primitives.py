"""Operator-level queries over the driver tables (scans, projections,
filters, joins, aggregates, date functions, casts).  Each exercises one
operator of the layers on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.functions.dates import date_key, date_parts, date_series, elapsed_days, parse_timestamp
from emporia.functions.money import exact_sum
from emporia.operators.relational import (
    bounds_with_default, dedup_rows, distinct_project, enrich_join, lookup_join, not_null, positive,
    project,
)
from emporia.plans.gold import DEFAULT_FIRST_DAY, DEFAULT_LAST_DAY
from emporia.plans.layers import Layers
from emporia.sources.driver_tables import DriverTables

def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DriverTables(spark, sf_dir)["orders"]


def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(DriverTables(spark, sf_dir)["customer"], ["c_custkey", "c_name", "c_mktsegment"])


def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose delivered date (left-joined last ship date) is known."""
    o = DriverTables(spark, sf_dir).orders()
    return not_null(o, "order_delivered_customer_date").select(
        "order_id", "order_delivered_customer_date")


def filter_conjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    fo = Layers.from_driver(spark, sf_dir).gold["fact_orders"]
    return positive(fo, "delivery_time_days").select("order_id", "delivery_time_days")


def left_join_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = DriverTables(spark, sf_dir)
    return lookup_join(t.products(), t.product_category_name_translation(),
                       "product_category_name",
                       [F.col("l.product_id"), F.col("l.product_category_name"),
                        F.col("r.product_category_name_english")])


def inner_join_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = DriverTables(spark, sf_dir)
    lookup = t["orders"].select(F.col("o_orderkey").alias("order_id"), "o_custkey", "o_orderdate")
    items = t["lineitem"].select(F.col("l_orderkey").alias("order_id"), "l_linenumber")
    return enrich_join(items, lookup, "order_id",
                       [F.col("f.order_id"), F.col("f.l_linenumber"), F.col("r.o_custkey"),
                        F.col("r.o_orderdate")])


def agg_sum_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = DriverTables(spark, sf_dir)["lineitem"]
    return li.groupBy("l_returnflag").agg(exact_sum("l_extendedprice").alias("sum_price"))


def agg_sum_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SUM of amounts with more than two decimals, rounded once at the end."""
    li = DriverTables(spark, sf_dir)["lineitem"]
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.groupBy("l_returnflag").agg(exact_sum(net).alias("net_price"))


def agg_avg_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = DriverTables(spark, sf_dir)["orders"]
    return o.groupBy("o_orderstatus").agg(F.round(F.avg("o_totalprice"), 2).alias("avg_price"))


def agg_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fo = Layers.from_driver(spark, sf_dir).gold["fact_orders"]
    return fo.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count("delivery_time_days").alias("n_delivered"))


def agg_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = DriverTables(spark, sf_dir)["orders"]
    return bounds_with_default(o, F.to_date("o_orderdate"), F.lit(DEFAULT_FIRST_DAY),
                               F.lit(DEFAULT_LAST_DAY), "first_day", "last_day")


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_project(DriverTables(spark, sf_dir)["customer"], ["c_nationkey", "c_mktsegment"])


def dedup_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows that repeat: line items without their keys and prices."""
    return dedup_rows(DriverTables(spark, sf_dir)["lineitem"].select(
        "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"))


def raw_purchase_text(orders: DataFrame) -> DataFrame:
    """Orders' purchase time as source-like text in three shapes: full
    date-time (status F), date only (status O) and an unparsable word
    (status P)."""
    # CAST of TIMESTAMP_NTZ / DATE to text does not pass through the
    # session time zone (date_format would).
    raw = (F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate").cast(T.StringType()))
           .when(F.col("o_orderstatus") == "O", F.to_date("o_orderdate").cast(T.StringType()))
           .otherwise(F.col("o_orderpriority")))
    return orders.select(F.col("o_orderkey").alias("order_id"), raw.alias("raw_purchase_timestamp"))


def cast_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = raw_purchase_text(DriverTables(spark, sf_dir)["orders"])
    return r.withColumn("order_purchase_timestamp",
                        parse_timestamp("raw_purchase_timestamp", T.StringType()))


def date_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = DriverTables(spark, sf_dir)["orders"]
    return o.select("o_orderkey", date_key("o_orderdate").alias("date_key"))


def date_parts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = DriverTables(spark, sf_dir)["orders"].select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return o.select("o_orderkey", *[c.alias(n) for n, c in date_parts("d").items()])


def date_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = DriverTables(spark, sf_dir)["orders"]
    b = bounds_with_default(o, F.to_date("o_orderdate"), F.lit(DEFAULT_FIRST_DAY),
                            F.lit(DEFAULT_LAST_DAY), "first_day", "last_day")
    return b.select(F.explode(date_series("first_day", "last_day")).alias("date"))


def coalesce_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Layers.from_driver(spark, sf_dir).silver["silver_products"].select(
        "product_id", "product_category_name_english")


def elapsed_days_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = DriverTables(spark, sf_dir)
    w = t.shipping_window()
    o = t["orders"]
    j = o.join(w, o.o_orderkey == w.l_orderkey, "inner")
    return j.select("o_orderkey", elapsed_days("o_orderdate", "last_ship").alias("days_to_last_ship"))


PRIMITIVES = {
    "scan_parquet": scan_parquet,
    "project_columns": project_columns,
    "filter_not_null": filter_not_null,
    "filter_conjunction": filter_conjunction,
    "left_join_lookup": left_join_lookup,
    "inner_join_enrich": inner_join_enrich,
    "agg_sum_round": agg_sum_round,
    "agg_sum_expression": agg_sum_expression,
    "agg_avg_round": agg_avg_round,
    "agg_counts": agg_counts,
    "agg_min_max": agg_min_max,
    "distinct_rows": distinct_rows,
    "dedup_rows": dedup_rows_query,
    "cast_timestamps": cast_timestamps,
    "date_key": date_key_query,
    "date_parts": date_parts_query,
    "date_sequence": date_sequence,
    "coalesce_default": coalesce_default,
    "elapsed_days": elapsed_days_query,
}
