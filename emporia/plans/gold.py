"""Gold layer (G1-G8): a star schema of four dimensions and four facts.

Input is the dict of Silver frames.  The order lookup (order_id,
customer_id, purchase date key) is defined once and pruned to those
columns; fact enrichment is an inner join on order_id, a shuffle join at
scale whose skewed partitions AQE splits.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions.dates import date_key, date_parts, date_series, elapsed_days
from emporia.operators.relational import bounds_with_default, distinct_project, enrich_join
from emporia.sources.schemas import GOLD_COLUMNS

Silver = dict[str, DataFrame]

# Calendar used when there are no orders at all.
DEFAULT_FIRST_DAY = _dt.date(2016, 1, 1)
DEFAULT_LAST_DAY = _dt.date(2018, 12, 31)


def dim_customers(s: Silver) -> DataFrame:
    return distinct_project(s["silver_customers"], GOLD_COLUMNS["dim_customers"])


def dim_products(s: Silver) -> DataFrame:
    p = s["silver_products"]
    return p.select("product_id", "product_category_name",
                    F.coalesce("product_category_name_english", "product_category_name")
                    .alias("product_category_name_english")).distinct()


def dim_sellers(s: Silver) -> DataFrame:
    return distinct_project(s["silver_sellers"], GOLD_COLUMNS["dim_sellers"])


def dim_date(s: Silver, first_default: _dt.date = DEFAULT_FIRST_DAY,
             last_default: _dt.date = DEFAULT_LAST_DAY) -> DataFrame:
    """One row per calendar day between the first and last purchase day.
    The bounds are one global aggregate; the exploded calendar is bounded
    by the number of days in the range, not by the data volume."""
    bounds = bounds_with_default(
        s["silver_orders"], F.to_date("order_purchase_timestamp"),
        F.lit(first_default), F.lit(last_default), "min_date", "max_date")
    days = bounds.select(F.explode(date_series("min_date", "max_date")).alias("date"))
    return days.withColumns(date_parts("date")).select(*GOLD_COLUMNS["dim_date"])


def orders_lookup(s: Silver, with_customer: bool = True) -> DataFrame:
    o = s["silver_orders"]
    cols = [F.col("order_id")]
    if with_customer:
        cols.append(F.col("customer_id"))
    cols.append(date_key("order_purchase_timestamp").alias("order_purchase_date_key"))
    return o.select(*cols)


def fact_orders(s: Silver) -> DataFrame:
    o = s["silver_orders"]
    return o.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        date_key("order_purchase_timestamp").alias("order_purchase_date_key"),
        "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date",
        elapsed_days("order_purchase_timestamp", "order_delivered_customer_date")
        .alias("delivery_time_days"))


def fact_order_items(s: Silver) -> DataFrame:
    return enrich_join(
        s["silver_order_items"], orders_lookup(s, True), "order_id",
        [F.col("f.order_id"), F.col("f.order_item_id"), F.col("f.product_id"),
         F.col("f.seller_id"), F.col("r.customer_id"), F.col("r.order_purchase_date_key"),
         F.col("f.price"), F.col("f.freight_value")])


def fact_order_payments(s: Silver) -> DataFrame:
    return enrich_join(
        s["silver_order_payments"], orders_lookup(s, False), "order_id",
        [F.col("f.order_id"), F.col("f.payment_sequential"), F.col("r.order_purchase_date_key"),
         F.col("f.payment_type"), F.col("f.payment_installments"), F.col("f.payment_value")])


def fact_order_reviews(s: Silver) -> DataFrame:
    return s["silver_order_reviews"].select(*GOLD_COLUMNS["fact_order_reviews"])


GOLD_BUILDERS = {
    "dim_customers": dim_customers,
    "dim_products": dim_products,
    "dim_sellers": dim_sellers,
    "dim_date": dim_date,
    "fact_orders": fact_orders,
    "fact_order_items": fact_order_items,
    "fact_order_payments": fact_order_payments,
    "fact_order_reviews": fact_order_reviews,
}


def build_gold(s: Silver) -> dict[str, DataFrame]:
    return {name: fn(s) for name, fn in GOLD_BUILDERS.items()}
