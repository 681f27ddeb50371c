"""Explicit schemas of the nine raw source tables (no inference pass).

Identifiers and zip prefixes are STRING (a leading zero must survive),
date-times stay STRING in Bronze and are parsed in Silver.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()


def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Source table names and their column layouts.
SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "customers": _st(("customer_id", S), ("customer_unique_id", S),
                     ("customer_zip_code_prefix", S), ("customer_city", S),
                     ("customer_state", S)),
    "geolocation": _st(("geolocation_zip_code_prefix", S), ("geolocation_lat", D),
                       ("geolocation_lng", D), ("geolocation_city", S),
                       ("geolocation_state", S)),
    "order_items": _st(("order_id", S), ("order_item_id", I), ("product_id", S),
                       ("seller_id", S), ("shipping_limit_date", S), ("price", D),
                       ("freight_value", D)),
    "order_payments": _st(("order_id", S), ("payment_sequential", I), ("payment_type", S),
                          ("payment_installments", I), ("payment_value", D)),
    "order_reviews": _st(("review_id", S), ("order_id", S), ("review_score", I),
                         ("review_comment_title", S), ("review_comment_message", S),
                         ("review_creation_date", S), ("review_answer_timestamp", S)),
    "orders": _st(("order_id", S), ("customer_id", S), ("order_status", S),
                  ("order_purchase_timestamp", S), ("order_approved_at", S),
                  ("order_delivered_carrier_date", S),
                  ("order_delivered_customer_date", S),
                  ("order_estimated_delivery_date", S)),
    "products": _st(("product_id", S), ("product_category_name", S),
                    ("product_name_lenght", I), ("product_description_lenght", I),
                    ("product_photos_qty", I), ("product_weight_g", I),
                    ("product_length_cm", I), ("product_height_cm", I),
                    ("product_width_cm", I)),
    "sellers": _st(("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S),
                   ("seller_state", S)),
    "product_category_name_translation": _st(("product_category_name", S),
                                             ("product_category_name_english", S)),
}

SOURCE_TABLES: tuple[str, ...] = tuple(SOURCE_SCHEMAS)

# Declared keys per Silver table (None = no key, whole-row
# duplicates only).  The review key is declared but known to be violated.
SILVER_KEYS: dict[str, list[str] | None] = {
    "silver_customers": ["customer_id"],
    "silver_geolocation": None,
    "silver_order_items": ["order_id", "order_item_id"],
    "silver_order_payments": ["order_id", "payment_sequential"],
    "silver_order_reviews": ["review_id"],
    "silver_orders": ["order_id"],
    "silver_products": ["product_id"],
    "silver_sellers": ["seller_id"],
    "product_category_name_translation": ["product_category_name"],
}

# Declared column tests (unique / not_null) per model.
COLUMN_TESTS: dict[str, list[tuple[str, tuple[str, ...]]]] = {
    "silver_customers": [("customer_id", ("unique", "not_null"))],
    "silver_orders": [("order_id", ("unique", "not_null"))],
    "silver_products": [("product_id", ("unique", "not_null"))],
    "silver_sellers": [("seller_id", ("unique", "not_null"))],
    "dim_customers": [("customer_id", ("unique", "not_null"))],
    "dim_products": [("product_id", ("unique", "not_null"))],
    "dim_sellers": [("seller_id", ("unique", "not_null"))],
    "dim_date": [("date_key", ("unique", "not_null"))],
    "fact_orders": [("order_id", ("unique", "not_null"))],
    "fact_order_reviews": [("review_id", ("not_null",))],
}

# Date-time columns parsed in Silver, per source table.
TIMESTAMP_COLUMNS: dict[str, tuple[str, ...]] = {
    "orders": ("order_purchase_timestamp", "order_approved_at",
               "order_delivered_carrier_date", "order_delivered_customer_date",
               "order_estimated_delivery_date"),
    "order_items": ("shipping_limit_date",),
    "order_reviews": ("review_creation_date", "review_answer_timestamp"),
}

# Columns of the Gold dimensions.
GOLD_COLUMNS: dict[str, list[str]] = {
    "dim_customers": SOURCE_SCHEMAS["customers"].fieldNames(),
    "dim_sellers": SOURCE_SCHEMAS["sellers"].fieldNames(),
    "dim_date": ["date", "date_key", "year", "month", "month_name", "quarter", "day_of_week", "day_of_month"],
    "fact_order_reviews": ["review_id", "order_id", "review_score", "review_creation_date"],
}
