"""Business questions Q1-Q7 over the Gold star schema.

Plan shape (eager aggregation): every question first aggregates the fact
on its foreign key (partial aggregation map-side, then one shuffle of at
most one row per key and task), joins that much smaller result to the
dimension, and aggregates again on the dimension attributes.  This is
exact for SUM / COUNT / AVG (AVG is carried as sum and count) and keeps
the answer equal to "join, then group" even when a dimension key repeats:
each matching dimension row receives the key's whole partial.  A hot
foreign key (one seller with a third of all items) becomes one row per
task before any shuffle, so neither the join nor the final aggregation
sees the skew.

Money is summed without rounding any row and independently of the order of
additions (see ``functions.money``); delivery days are averaged from whole
seconds (BIGINT).  Top-k reports break ties on the group key so the
k rows are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.functions.dates import SECONDS_PER_DAY
from emporia.functions.money import amount, sum_parts, sum_partials

Gold = dict[str, DataFrame]

#: Orders that ``heavy_orders`` can name, and the items an order must have.
HEAVY_LIMIT, HEAVY_ITEMS = 1024, 10_000


def _avg(total: str, count: str) -> F.Column:
    """sum / count as DOUBLE; NULL when nothing was counted (like AVG)."""
    return F.when(F.col(count) > 0, F.col(total).cast(T.DoubleType()) / F.col(count).cast(T.DoubleType()))


def q1_monthly_revenue(g: Gold, limit: int | None = None, with_month: bool = True) -> DataFrame:
    """Revenue per calendar month.  ``limit`` keeps the first months;
    ``with_month=False`` drops the month number from the output (it still
    orders the rows)."""
    per_day = (g["fact_order_payments"].groupBy("order_purchase_date_key")
               .agg(sum_parts("payment_value").alias("v")))
    d = g["dim_date"].select("date_key", "year", "month", "month_name")
    j = per_day.join(d, per_day.order_purchase_date_key == d.date_key, "inner")
    res = (j.groupBy("year", "month", "month_name")
           .agg(amount(sum_partials("v")).alias("monthly_revenue"))
           .orderBy(F.col("year").asc_nulls_first(), F.col("month").asc_nulls_first(),
                    F.col("month_name").asc_nulls_first()))
    if limit is not None:
        res = res.limit(limit)
    return res if with_month else res.select("year", "month_name", "monthly_revenue")


def q2_category_revenue(g: Gold, limit: int | None = 10,
                        revenue_name: str = "category_revenue") -> DataFrame:
    per_product = (g["fact_order_items"].groupBy("product_id")
                   .agg(sum_parts("price").alias("v")))
    p = g["dim_products"].select("product_id", "product_category_name_english")
    j = per_product.join(p, "product_id", "inner")
    res = (j.groupBy("product_category_name_english")
           .agg(amount(sum_partials("v")).alias(revenue_name))
           .orderBy(F.col(revenue_name).desc_nulls_last(),
                    F.col("product_category_name_english").asc_nulls_first()))
    return res.limit(limit) if limit is not None else res


def q3_top_sellers(g: Gold, limit: int | None = 5) -> DataFrame:
    per_seller = (g["fact_order_items"].groupBy("seller_id")
                  .agg(sum_parts("price").alias("v")))
    s = g["dim_sellers"].select("seller_id", "seller_city", "seller_state")
    j = per_seller.join(s, "seller_id", "inner")
    res = (j.groupBy("seller_id", "seller_city", "seller_state")
           .agg(amount(sum_partials("v")).alias("total_sales"))
           .orderBy(F.col("total_sales").desc_nulls_last(), F.col("seller_id").asc_nulls_first(),
                    F.col("seller_city").asc_nulls_first(), F.col("seller_state").asc_nulls_first()))
    return res.limit(limit) if limit is not None else res


def q4_sales_by_state(g: Gold, limit: int | None = 10) -> DataFrame:
    per_customer = (g["fact_order_items"].groupBy("customer_id")
                    .agg(sum_parts("price").alias("v")))
    c = g["dim_customers"].select("customer_id", "customer_state")
    j = per_customer.join(c, "customer_id", "inner")
    res = (j.groupBy("customer_state")
           .agg(amount(sum_partials("v")).alias("total_sales"))
           .orderBy(F.col("total_sales").desc_nulls_last(), F.col("customer_state").asc_nulls_first()))
    return res.limit(limit) if limit is not None else res


def q5_delivery_by_state(g: Gold, limit: int | None = 10, positive_only: bool = True) -> DataFrame:
    o = g["fact_orders"].filter(F.col("delivery_time_days").isNotNull())
    if positive_only:
        o = o.filter(F.col("delivery_time_days") > 0)
    seconds = F.rint(F.col("delivery_time_days") * SECONDS_PER_DAY).cast(T.LongType())
    per_customer = (o.groupBy("customer_id")
                    .agg(F.sum(seconds).alias("s"), F.count("delivery_time_days").alias("n")))
    c = g["dim_customers"].select("customer_id", "customer_state")
    j = per_customer.join(c, "customer_id", "inner")
    res = (j.groupBy("customer_state")
           .agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
           .select("customer_state",
                   F.round(_avg("s", "n") / SECONDS_PER_DAY, 2).alias("avg_delivery_time_days"))
           .orderBy(F.col("avg_delivery_time_days").asc_nulls_first(),
                    F.col("customer_state").asc_nulls_first()))
    return res.limit(limit) if limit is not None else res


def q6_payment_trends(g: Gold, limit: int | None = None, count_name: str = "payment_count",
                      value_name: str = "total_payment_value") -> DataFrame:
    per_day_type = (g["fact_order_payments"]
                    .groupBy("order_purchase_date_key", "payment_type")
                    .agg(F.count(F.lit(1)).alias("n"), sum_parts("payment_value").alias("v")))
    d = g["dim_date"].select("date_key", "year", "month", "month_name")
    j = per_day_type.join(d, per_day_type.order_purchase_date_key == d.date_key, "inner")
    res = (j.groupBy("year", "month", "month_name", "payment_type")
           .agg(F.sum("n").alias(count_name), amount(sum_partials("v")).alias(value_name))
           .orderBy(F.col("year").asc_nulls_first(), F.col("month").asc_nulls_first(),
                    F.col(value_name).desc_nulls_last(),
                    F.col("month_name").asc_nulls_first(), F.col("payment_type").asc_nulls_first()))
    return res.limit(limit) if limit is not None else res


def heavy_orders(items: DataFrame, least: int | None = None) -> list:
    """Orders with more items than two shuffle partitions' fair share (and
    ``HEAVY_ITEMS``), at most ``HEAVY_LIMIT``: measured by a mergeable sketch of
    the most frequent values in one pass over ``order_id``, one partial row a
    task, when called.  The sketch may overstate a count, never miss an order
    with a ``HEAVY_LIMIT``-th of the items."""
    partitions = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    told = items.where(F.col("order_id").isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(order_id, {HEAVY_LIMIT}, {8 * HEAVY_LIMIT})").alias("top")).first()
    limit = max(2 * told["n"] / partitions, HEAVY_ITEMS if least is None else least)
    return [x["item"] for x in told["top"] or [] if x["count"] > limit]


def _scores_per_product(items: DataFrame, per_order: DataFrame) -> DataFrame:
    return items.join(per_order, "order_id", "inner").select("product_id", "s", "n", "r")


def q7_review_by_category(g: Gold, limit: int | None = None, count_rows: bool = False,
                          count_name: str = "review_count", heavy: list | None = None) -> DataFrame:
    """Reviews x items by order, then product: a review counts once per
    item of its order (fan-out kept on purpose), duplicated review ids are
    not removed.  Carried as per-order (sum, count) of scores; the item
    join then multiplies them by the order's items, so the review x item
    pairs are never materialised.  The count is COUNT(review_score), or
    with ``count_rows`` COUNT(*) of the joined rows.

    Items meet their order's sums by a shuffle on the order.  ``heavy`` orders
    (measured when called, unless given) are kept out of it: their sums, one row
    an order and so at most ``HEAVY_LIMIT``, are broadcast, and their items are
    joined where they are read, whatever share of all items they are."""
    items = g["fact_order_items"].select("order_id", "product_id")
    if heavy is None:
        heavy = heavy_orders(items)
    reviews = g["fact_order_reviews"].where(F.col("order_id").isNotNull())
    is_heavy = F.col("order_id").isin(heavy) if heavy else F.lit(False)

    def per_order(part: DataFrame) -> DataFrame:
        return part.groupBy("order_id").agg(F.sum("review_score").alias("s"), F.count("review_score").alias("n"),
                                            F.count(F.lit(1)).alias("r"))

    if heavy:
        fanned = _scores_per_product(items.where(~is_heavy), per_order(reviews.where(~is_heavy))).unionByName(
            _scores_per_product(items.where(is_heavy), F.broadcast(per_order(reviews.where(is_heavy)))))
    else:
        fanned = _scores_per_product(items, per_order(reviews))
    per_product = fanned.groupBy("product_id").agg(*[F.sum(c).alias(c) for c in ("s", "n", "r")])
    p = g["dim_products"].select("product_id", "product_category_name_english")
    j = per_product.join(p, "product_id", "inner")
    res = (j.groupBy("product_category_name_english")
           .agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("r").alias("r"))
           .select("product_category_name_english",
                   F.round(_avg("s", "n"), 2).alias("avg_review_score"),
                   F.col("r" if count_rows else "n").alias(count_name))
           .orderBy(F.col("avg_review_score").desc_nulls_last(),
                    F.col(count_name).desc_nulls_last(),
                    F.col("product_category_name_english").asc_nulls_first()))
    return res.limit(limit) if limit is not None else res


QUESTIONS = {
    "q1_monthly_revenue": q1_monthly_revenue,
    "q2_category_revenue": q2_category_revenue,
    "q3_top_sellers": q3_top_sellers,
    "q4_sales_by_state": q4_sales_by_state,
    "q5_delivery_by_state": q5_delivery_by_state,
    "q6_payment_trends": q6_payment_trends,
    "q7_review_by_category": q7_review_by_category,
}


# The verification report's variants of the questions (other limits and
# output names, Q5 without the positive guard, Q7 counting joined rows).
VERIFY_VARIANTS = {
    "verify_monthly_revenue": lambda g: q1_monthly_revenue(g, limit=5, with_month=False),
    "verify_category_revenue": lambda g: q2_category_revenue(g, limit=5, revenue_name="total_revenue"),
    "verify_sales_by_state": lambda g: q4_sales_by_state(g, limit=5),
    "verify_delivery_by_state": lambda g: q5_delivery_by_state(g, limit=5, positive_only=False),
    "verify_payment_trends": lambda g: q6_payment_trends(g, limit=20, count_name="tx_count",
                                                         value_name="total_value"),
    "verify_review_by_category": lambda g: q7_review_by_category(g, limit=5, count_rows=True,
                                                                 count_name="total_reviews"),
}
