"""Adapter: the driver's TPC-H-shaped tables seen as the nine raw source
tables (same column names as the CSV sources).

Keys keep their native BIGINT type (cheaper joins than strings) and
date-times stay typed (TIMESTAMP_NTZ); the Silver parse step is a no-op
cast for typed input.  Every frame is a lazy projection / join over the
driver tables, so its size grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# The category translation rows of the adapter.  Four of the
# six part types are translated; LARGE and STANDARD have no row, so they
# take the fallback (untranslated) path.
TRANSLATION_ROWS: list[tuple[str, str]] = [
    ("PROMO", "promo_en"),
    ("ECONOMY", "economy_en"),
    ("MEDIUM", "medium_en"),
    ("SMALL", "small_en"),
]

ESTIMATED_DELIVERY = "INTERVAL 30 DAYS"
REVIEW_ANSWER_DELAY = "INTERVAL 1 DAY"


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class DriverTables:
    """Lazy handles on the driver tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        return read_driver_table(self.spark, self.sf_dir, name)

    # -- source-shaped frames ------------------------------------------------
    def customers(self) -> DataFrame:
        c, n = self["customer"], self["nation"]
        return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
                .select(F.col("c_custkey").alias("customer_id"),
                        F.col("c_name").alias("customer_unique_id"),
                        F.col("c_nationkey").cast(T.StringType()).alias("customer_zip_code_prefix"),
                        F.col("c_mktsegment").alias("customer_city"),
                        F.col("n_name").alias("customer_state")))

    def geolocation(self) -> DataFrame:
        c, n = self["customer"], self["nation"]
        return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
                .select(F.col("c_nationkey").cast(T.StringType()).alias("geolocation_zip_code_prefix"),
                        F.col("c_nationkey").cast(T.DoubleType()).alias("geolocation_lat"),
                        (-F.col("c_nationkey")).cast(T.DoubleType()).alias("geolocation_lng"),
                        F.col("c_mktsegment").alias("geolocation_city"),
                        F.col("n_name").alias("geolocation_state")))

    def sellers(self) -> DataFrame:
        s, n = self["supplier"], self["nation"]
        return (s.join(n, s.s_nationkey == n.n_nationkey, "left")
                .select(F.col("s_suppkey").alias("seller_id"),
                        F.col("s_nationkey").cast(T.StringType()).alias("seller_zip_code_prefix"),
                        F.col("s_name").alias("seller_city"),
                        F.col("n_name").alias("seller_state")))

    def products(self) -> DataFrame:
        p = self["part"]
        return p.select(F.col("p_partkey").alias("product_id"),
                        F.col("p_type").alias("product_category_name"),
                        F.length("p_name").alias("product_name_lenght"),
                        F.length("p_brand").alias("product_description_lenght"),
                        F.col("p_size").alias("product_photos_qty"),
                        F.col("p_size").alias("product_weight_g"),
                        F.col("p_size").alias("product_length_cm"),
                        F.col("p_size").alias("product_height_cm"),
                        F.col("p_size").alias("product_width_cm"))

    def product_category_name_translation(self) -> DataFrame:
        """A local relation (VALUES): its size is known to the planner, so
        the lookup join broadcasts it instead of shuffling the products on
        a low-cardinality category key."""
        rows = ", ".join(f"('{a}', '{b}')" for a, b in TRANSLATION_ROWS)
        return self.spark.sql(
            f"SELECT * FROM VALUES {rows} AS t(product_category_name, product_category_name_english)")

    def shipping_window(self) -> DataFrame:
        """First / last ship date per order: partial aggregation map-side,
        so a hot order collapses before the shuffle."""
        return (self["lineitem"].groupBy("l_orderkey")
                .agg(F.min("l_shipdate").alias("first_ship"),
                     F.max("l_shipdate").alias("last_ship")))

    def orders(self) -> DataFrame:
        o, w = self["orders"], self.shipping_window()
        return (o.join(w, o.o_orderkey == w.l_orderkey, "left")
                .select(F.col("o_orderkey").alias("order_id"),
                        F.col("o_custkey").alias("customer_id"),
                        F.col("o_orderstatus").alias("order_status"),
                        F.col("o_orderdate").alias("order_purchase_timestamp"),
                        F.col("o_orderdate").alias("order_approved_at"),
                        F.col("first_ship").alias("order_delivered_carrier_date"),
                        F.col("last_ship").alias("order_delivered_customer_date"),
                        (F.col("o_orderdate") + F.expr(ESTIMATED_DELIVERY))
                        .alias("order_estimated_delivery_date")))

    def order_items(self) -> DataFrame:
        return self["lineitem"].select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_tax").alias("freight_value"))

    def order_payments(self) -> DataFrame:
        return self["lineitem"].select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            F.col("l_returnflag").alias("payment_type"),
            F.col("l_quantity").cast(T.IntegerType()).alias("payment_installments"),
            F.col("l_extendedprice").alias("payment_value"))

    def order_reviews(self) -> DataFrame:
        return self["orders"].select(
            F.col("o_custkey").alias("review_id"),
            F.col("o_orderkey").alias("order_id"),
            F.substring("o_orderpriority", 1, 1).cast(T.IntegerType()).alias("review_score"),
            F.col("o_orderstatus").alias("review_comment_title"),
            F.col("o_orderpriority").alias("review_comment_message"),
            F.col("o_orderdate").alias("review_creation_date"),
            (F.col("o_orderdate") + F.expr(REVIEW_ANSWER_DELAY)).alias("review_answer_timestamp"))

    def bronze(self) -> dict[str, DataFrame]:
        """All nine source-shaped frames, keyed like the CSV sources."""
        return {
            "customers": self.customers(),
            "geolocation": self.geolocation(),
            "order_items": self.order_items(),
            "order_payments": self.order_payments(),
            "order_reviews": self.order_reviews(),
            "orders": self.orders(),
            "products": self.products(),
            "sellers": self.sellers(),
            "product_category_name_translation": self.product_category_name_translation(),
        }
