"""Silver layer (V1-V9): typed, cleaned source tables.

Input is a dict of Bronze frames keyed by source table name (CSV scans or
the driver-table adapter).  Each function is a lazy projection; Catalyst
prunes columns a consumer does not use and pushes filters to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions.dates import parse_timestamps
from emporia.operators.relational import dedup_rows, lookup_join
from emporia.sources.schemas import SOURCE_SCHEMAS, TIMESTAMP_COLUMNS

Bronze = dict[str, DataFrame]


def _source(b: Bronze, table: str) -> DataFrame:
    """A source table's declared columns, in their order."""
    return b[table].select(*SOURCE_SCHEMAS[table].fieldNames())


def silver_customers(b: Bronze) -> DataFrame:
    return _source(b, "customers")


def silver_geolocation(b: Bronze) -> DataFrame:
    """Exact row-level duplicates removed."""
    return dedup_rows(_source(b, "geolocation"))


def silver_order_items(b: Bronze) -> DataFrame:
    return parse_timestamps(_source(b, "order_items"),
                            TIMESTAMP_COLUMNS["order_items"])


def silver_order_payments(b: Bronze) -> DataFrame:
    return _source(b, "order_payments")


def silver_order_reviews(b: Bronze) -> DataFrame:
    return parse_timestamps(_source(b, "order_reviews"),
                            TIMESTAMP_COLUMNS["order_reviews"])


def silver_orders(b: Bronze) -> DataFrame:
    """Five date-times parsed (malformed -> NULL); rows without a purchase
    time are rejected after the parse."""
    parsed = parse_timestamps(_source(b, "orders"), TIMESTAMP_COLUMNS["orders"])
    return parsed.filter(F.col("order_purchase_timestamp").isNotNull())


def silver_products(b: Bronze) -> DataFrame:
    """Left join of the category translation; untranslated categories keep
    their original name."""
    return lookup_join(
        b["products"], b["product_category_name_translation"], "product_category_name",
        [F.col("l.product_id"), F.col("l.product_category_name"),
         F.coalesce(F.col("r.product_category_name_english"),
                    F.col("l.product_category_name")).alias("product_category_name_english")]
        + [F.col(f"l.{c}") for c in SOURCE_SCHEMAS["products"].fieldNames()[2:]])


def silver_sellers(b: Bronze) -> DataFrame:
    return _source(b, "sellers")


def silver_translation(b: Bronze) -> DataFrame:
    return _source(b, "product_category_name_translation")


SILVER_BUILDERS = {
    "silver_customers": silver_customers,
    "silver_geolocation": silver_geolocation,
    "silver_order_items": silver_order_items,
    "silver_order_payments": silver_order_payments,
    "silver_order_reviews": silver_order_reviews,
    "silver_orders": silver_orders,
    "silver_products": silver_products,
    "silver_sellers": silver_sellers,
    "product_category_name_translation": silver_translation,
}

# Silver table -> its Bronze input (for load reports).
SILVER_INPUT = {
    "silver_customers": "customers",
    "silver_geolocation": "geolocation",
    "silver_order_items": "order_items",
    "silver_order_payments": "order_payments",
    "silver_order_reviews": "order_reviews",
    "silver_orders": "orders",
    "silver_products": "products",
    "silver_sellers": "sellers",
    "product_category_name_translation": "product_category_name_translation",
}


def build_silver(b: Bronze) -> dict[str, DataFrame]:
    return {name: fn(b) for name, fn in SILVER_BUILDERS.items()}
