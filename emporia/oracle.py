"""DuckDB twins of the registered queries, straight over the driver tables.

Each statement says in its own terms what a query must return for the tables
``customer nation supplier part orders lineitem``; none builds the layers the
query goes through.  The few expressions that several statements share (what
the adapter makes of a source column) are named below.  Null ordering is
stated explicitly (Spark's default: ASC NULLS FIRST, DESC NULLS LAST).
"""

from __future__ import annotations

# What the adapter makes of a source column.
CATEGORY = ("CASE WHEN p_type IN ('PROMO', 'ECONOMY', 'MEDIUM', 'SMALL') "
            "THEN lower(p_type) || '_en' ELSE p_type END")
TRANSLATED = "CASE WHEN p_type IN ('PROMO', 'ECONOMY', 'MEDIUM', 'SMALL') THEN lower(p_type) || '_en' END"
SCORE = "CAST(left(o_orderpriority, 1) AS INTEGER)"
DAYS = "date_diff('second', o_orderdate, arrived) / 86400.0::DOUBLE"
ARRIVED = "(SELECT l_orderkey, max(l_shipdate) AS arrived FROM lineitem GROUP BY 1)"
SHIPPED = ("(SELECT l_orderkey, min(l_shipdate) AS left_at, max(l_shipdate) AS arrived "
           "FROM lineitem GROUP BY 1)")


def day_key(stamp: str) -> str:
    return f"(year({stamp}) * 10000 + month({stamp}) * 100 + day({stamp}))::INTEGER"


def _text(column: str) -> str:
    """A key column as text with its escapes; NULL as \\N."""
    return f"coalesce(replace(replace({column}::VARCHAR, '\\', '\\\\'), '|', '\\|'), '\\N')"


def monthly_revenue(limit: str = "", month: str = "month(o_orderdate)::INTEGER AS month, ") -> str:
    return f"""
SELECT year(o_orderdate)::INTEGER AS year, {month}monthname(o_orderdate) AS month_name,
       round(sum(l_extendedprice), 2) AS monthly_revenue
FROM lineitem, orders WHERE o_orderkey = l_orderkey
GROUP BY year(o_orderdate), month(o_orderdate), monthname(o_orderdate)
ORDER BY year(o_orderdate) NULLS FIRST, month(o_orderdate) NULLS FIRST {limit}"""


def category_revenue(name: str, limit: int) -> str:
    return f"""
SELECT {CATEGORY} AS product_category_name_english, round(sum(l_extendedprice), 2) AS {name}
FROM part, lineitem, orders WHERE p_partkey = l_partkey AND l_orderkey = o_orderkey
GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 NULLS FIRST LIMIT {limit}"""


def sales_by_state(limit: int) -> str:
    return f"""
SELECT n_name AS customer_state, round(sum(l_extendedprice), 2) AS total_sales
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey
GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 NULLS FIRST LIMIT {limit}"""


def delivery_by_state(limit: int, guard: str) -> str:
    return f"""
SELECT n_name AS customer_state,
       round(sum(date_diff('second', o_orderdate, arrived)) / 86400.0::DOUBLE / count(*), 2)
         AS avg_delivery_time_days
FROM customer JOIN orders ON o_custkey = c_custkey JOIN {ARRIVED} ON l_orderkey = o_orderkey
LEFT JOIN nation ON n_nationkey = c_nationkey
WHERE arrived {guard}
GROUP BY 1 ORDER BY 2 NULLS FIRST, 1 NULLS FIRST LIMIT {limit}"""


def payment_trends(count: str, value: str, limit: str = "") -> str:
    return f"""
SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month,
       monthname(o_orderdate) AS month_name, l_returnflag AS payment_type,
       count(*) AS {count}, round(sum(l_extendedprice), 2) AS {value}
FROM lineitem, orders WHERE o_orderkey = l_orderkey GROUP BY 1, 2, 3, 4
ORDER BY 1 NULLS FIRST, 2 NULLS FIRST, 6 DESC NULLS LAST, 3 NULLS FIRST, 4 NULLS FIRST {limit}"""


def review_by_category(count: str, counted: str, limit: str = "") -> str:
    return f"""
SELECT {CATEGORY} AS product_category_name_english, round(avg({SCORE}), 2) AS avg_review_score,
       count({counted}) AS {count}
FROM orders, lineitem, part WHERE l_orderkey = o_orderkey AND l_partkey = p_partkey
GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 3 DESC NULLS LAST, 1 NULLS FIRST {limit}"""


QUESTIONS = {
    "q1_monthly_revenue": monthly_revenue(),
    "q2_category_revenue": category_revenue("category_revenue", 10),
    "q3_top_sellers": """
SELECT s_suppkey AS seller_id, s_name AS seller_city, n_name AS seller_state,
       round(sum(l_extendedprice), 2) AS total_sales
FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
JOIN lineitem ON l_suppkey = s_suppkey JOIN orders ON o_orderkey = l_orderkey
GROUP BY 1, 2, 3 ORDER BY 4 DESC NULLS LAST, 1 NULLS FIRST, 2 NULLS FIRST, 3 NULLS FIRST LIMIT 5""",
    "q4_sales_by_state": sales_by_state(10),
    "q5_delivery_by_state": delivery_by_state(10, "> o_orderdate"),
    "q6_payment_trends": payment_trends("payment_count", "total_payment_value"),
    "q7_review_by_category": review_by_category("review_count", SCORE),
}

VERIFY_VARIANTS = {
    "verify_monthly_revenue": monthly_revenue("LIMIT 5", ""),
    "verify_category_revenue": category_revenue("total_revenue", 5),
    "verify_sales_by_state": sales_by_state(5),
    "verify_delivery_by_state": delivery_by_state(5, "IS NOT NULL"),
    "verify_payment_trends": payment_trends("tx_count", "total_value", "LIMIT 20"),
    "verify_review_by_category": review_by_category("total_reviews", "*", "LIMIT 5"),
}

CUSTOMERS = """
SELECT c_custkey AS customer_id, c_name AS customer_unique_id, c_nationkey::VARCHAR AS customer_zip_code_prefix,
       c_mktsegment AS customer_city, n_name AS customer_state
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey"""
GEOLOCATION = """
SELECT c_nationkey::VARCHAR AS geolocation_zip_code_prefix, c_nationkey::DOUBLE AS geolocation_lat,
       (-c_nationkey)::DOUBLE AS geolocation_lng, c_mktsegment AS geolocation_city, n_name AS geolocation_state
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey"""
SELLERS = """
SELECT s_suppkey AS seller_id, s_nationkey::VARCHAR AS seller_zip_code_prefix, s_name AS seller_city,
       n_name AS seller_state
FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey"""
ITEMS = """
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
       l_shipdate AS shipping_limit_date, l_extendedprice AS price, l_tax AS freight_value
FROM lineitem"""
PAYMENTS = """
SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential, l_returnflag AS payment_type,
       l_quantity::INTEGER AS payment_installments, l_extendedprice AS payment_value
FROM lineitem"""
REVIEWS = f"""
SELECT o_custkey AS review_id, o_orderkey AS order_id, {SCORE} AS review_score,
       o_orderstatus AS review_comment_title, o_orderpriority AS review_comment_message,
       o_orderdate AS review_creation_date, o_orderdate + INTERVAL 1 DAY AS review_answer_timestamp
FROM orders"""
ORDERS = f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
       o_orderdate AS order_purchase_timestamp, o_orderdate AS order_approved_at,
       left_at AS order_delivered_carrier_date, arrived AS order_delivered_customer_date,
       o_orderdate + INTERVAL 30 DAY AS order_estimated_delivery_date
FROM orders LEFT JOIN {SHIPPED} ON l_orderkey = o_orderkey"""
PRODUCTS = f"""
SELECT p_partkey AS product_id, p_type AS product_category_name, {CATEGORY} AS product_category_name_english,
       length(p_name)::INTEGER AS product_name_lenght, length(p_brand)::INTEGER AS product_description_lenght,
       p_size AS product_photos_qty, p_size AS product_weight_g, p_size AS product_length_cm,
       p_size AS product_height_cm, p_size AS product_width_cm
FROM part"""
TRANSLATION = """
SELECT DISTINCT t AS product_category_name, lower(t) || '_en' AS product_category_name_english
FROM (SELECT unnest(['PROMO', 'ECONOMY', 'MEDIUM', 'SMALL']) AS t)"""
CALENDAR = f"""
SELECT date, {day_key("date")} AS date_key, year(date)::INTEGER AS year, month(date)::INTEGER AS month,
       monthname(date) AS month_name, quarter(date)::INTEGER AS quarter,
       (isodow(date) % 7 + 1)::INTEGER AS day_of_week, day(date)::INTEGER AS day_of_month
FROM (SELECT unnest(range(min(o_orderdate)::DATE, max(o_orderdate)::DATE + 1, INTERVAL 1 DAY))::DATE AS date
      FROM orders)"""
FACT_ORDERS = f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
       o_orderdate AS order_purchase_timestamp, {day_key("o_orderdate")} AS order_purchase_date_key,
       o_orderdate AS order_approved_at, left_at AS order_delivered_carrier_date,
       arrived AS order_delivered_customer_date, o_orderdate + INTERVAL 30 DAY AS order_estimated_delivery_date,
       {DAYS} AS delivery_time_days
FROM orders LEFT JOIN {SHIPPED} ON l_orderkey = o_orderkey"""

DATASETS = {
    "silver_customers": CUSTOMERS,
    "silver_geolocation": GEOLOCATION.replace("SELECT", "SELECT DISTINCT", 1),
    "silver_order_items": ITEMS,
    "silver_order_payments": PAYMENTS,
    "silver_order_reviews": REVIEWS,
    "silver_orders": ORDERS,
    "silver_products": PRODUCTS,
    "silver_sellers": SELLERS,
    "dim_customers": CUSTOMERS.replace("SELECT", "SELECT DISTINCT", 1),
    "dim_products": f"""
SELECT DISTINCT p_partkey AS product_id, p_type AS product_category_name,
       {CATEGORY} AS product_category_name_english FROM part""",
    "dim_sellers": SELLERS.replace("SELECT", "SELECT DISTINCT", 1),
    "dim_date": CALENDAR,
    "fact_orders": FACT_ORDERS,
    "fact_order_items": f"""
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
       o_custkey AS customer_id, {day_key("o_orderdate")} AS order_purchase_date_key,
       l_extendedprice AS price, l_tax AS freight_value
FROM lineitem, orders WHERE o_orderkey = l_orderkey""",
    "fact_order_payments": f"""
SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential, {day_key("o_orderdate")} AS order_purchase_date_key,
       l_returnflag AS payment_type, l_quantity::INTEGER AS payment_installments, l_extendedprice AS payment_value
FROM lineitem, orders WHERE o_orderkey = l_orderkey""",
    "fact_order_reviews": f"""
SELECT o_custkey AS review_id, o_orderkey AS order_id, {SCORE} AS review_score, o_orderdate AS review_creation_date
FROM orders""",
}

# Silver table -> (its rows before and after the Silver rules, its key).
PROFILED = {
    "silver_customers": (CUSTOMERS, CUSTOMERS, ["customer_id"]),
    "silver_geolocation": (GEOLOCATION, DATASETS["silver_geolocation"], None),
    "silver_order_items": (ITEMS, ITEMS, ["order_id", "order_item_id"]),
    "silver_order_payments": (PAYMENTS, PAYMENTS, ["order_id", "payment_sequential"]),
    "silver_order_reviews": (REVIEWS, REVIEWS, ["review_id"]),
    "silver_orders": (ORDERS, ORDERS, ["order_id"]),
    "silver_products": (PRODUCTS, PRODUCTS, ["product_id"]),
    "silver_sellers": (SELLERS, SELLERS, ["seller_id"]),
    "product_category_name_translation": (TRANSLATION, TRANSLATION, ["product_category_name"]),
}

# (model, column): the tests declared for it, and the column's values.
COLUMN_TESTS = {
    ("silver_customers", "customer_id"): ("unique not_null", "SELECT c_custkey AS v FROM customer"),
    ("silver_orders", "order_id"): ("unique not_null", "SELECT o_orderkey AS v FROM orders"),
    ("silver_products", "product_id"): ("unique not_null", "SELECT p_partkey AS v FROM part"),
    ("silver_sellers", "seller_id"): ("unique not_null", "SELECT s_suppkey AS v FROM supplier"),
    ("dim_customers", "customer_id"): ("unique not_null", "SELECT c_custkey AS v FROM customer"),
    ("dim_products", "product_id"): ("unique not_null", "SELECT p_partkey AS v FROM part"),
    ("dim_sellers", "seller_id"): ("unique not_null", "SELECT s_suppkey AS v FROM supplier"),
    ("dim_date", "date_key"): ("unique not_null", f"SELECT date_key AS v FROM ({CALENDAR})"),
    ("fact_orders", "order_id"): ("unique not_null", "SELECT o_orderkey AS v FROM orders"),
    ("fact_order_reviews", "review_id"): ("not_null", "SELECT o_custkey AS v FROM orders"),
}
FAILING = {
    "unique": "SELECT count(*) FROM (SELECT v FROM ({0}) WHERE v IS NOT NULL GROUP BY v HAVING count(*) > 1)",
    "not_null": "SELECT count(*) FROM ({0}) WHERE v IS NULL",
}


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


ROW_COUNTS = _union([
    f"SELECT '{t}' AS table_name, b AS rows_before, a AS rows_after, b - a AS rows_removed "
    f"FROM (SELECT (SELECT count(*) FROM ({before})) AS b, (SELECT count(*) FROM ({after})) AS a)"
    for t, (before, after, _) in PROFILED.items()])
TESTS = _union([
    f"SELECT '{model}' AS model_name, '{column}' AS column_name, '{kind}' AS test_name, "
    f"({FAILING[kind].format(values)}) AS failures"
    for (model, column), (kinds, values) in COLUMN_TESTS.items() for kind in kinds.split()])

CHECKS = {
    "layer_row_counts": ROW_COUNTS,
    "duplicate_profile": _union([
        f"SELECT '{t}' AS table_name, n AS total_rows, d AS distinct_rows, n - d AS duplicate_rows "
        f"FROM (SELECT (SELECT count(*) FROM ({rows})) AS n, "
        f"(SELECT count(*) FROM (SELECT DISTINCT * FROM ({rows}))) AS d)"
        for t, (_, rows, _) in PROFILED.items()]),
    "duplicate_keys": _union([
        f"SELECT '{t}' AS table_name, '{','.join(keys)}' AS key_columns, count(*) AS distinct_keys, "
        f"count(*) FILTER (n > 1) AS duplicate_keys "
        f"FROM (SELECT count(*) AS n FROM ({rows}) GROUP BY {', '.join(keys)})"
        for t, (_, rows, keys) in PROFILED.items() if keys]),
    "duplicate_keys_top5": _union([
        f"(SELECT '{t}' AS table_name, {" || '|' || ".join(map(_text, keys))} AS key_value, count(*) AS occurrences "
        f"FROM ({rows}) GROUP BY {', '.join(keys)} HAVING count(*) > 1 "
        f"ORDER BY count(*) DESC, {', '.join(f'{k} NULLS FIRST' for k in keys)} LIMIT 5)"
        for t, (_, rows, keys) in PROFILED.items() if keys]),
    "check_unique": "SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders "
                    "WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "check_not_null": FACT_ORDERS + " WHERE arrived IS NULL OR o_orderdate IS NULL",
    "column_tests": TESTS,
}

BY_MONTH = "SELECT *, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month FROM orders"


PRIMITIVES = {
    "scan_parquet": "SELECT * FROM orders",
    "project_columns": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "filter_not_null": "SELECT l_orderkey AS order_id, max(l_shipdate) AS order_delivered_customer_date "
                       "FROM lineitem SEMI JOIN orders ON o_orderkey = l_orderkey GROUP BY 1 "
                       "HAVING max(l_shipdate) IS NOT NULL",
    "filter_conjunction": f"SELECT o_orderkey AS order_id, {DAYS} AS delivery_time_days "
                          f"FROM orders JOIN {ARRIVED} ON l_orderkey = o_orderkey WHERE arrived > o_orderdate",
    "left_join_lookup": f"SELECT p_partkey AS product_id, p_type AS product_category_name, "
                        f"{TRANSLATED} AS product_category_name_english FROM part",
    "inner_join_enrich": "SELECT o_orderkey AS order_id, l_linenumber, o_custkey, o_orderdate "
                         "FROM orders, lineitem WHERE l_orderkey = o_orderkey",
    "agg_sum_round": "SELECT l_returnflag, round(sum(l_extendedprice), 2) AS sum_price FROM lineitem GROUP BY 1",
    "agg_sum_expression": "SELECT l_returnflag, ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS net_price "
                          "FROM lineitem GROUP BY l_returnflag",
    "agg_avg_round": "SELECT o_orderstatus, round(avg(o_totalprice), 2) AS avg_price FROM orders GROUP BY 1",
    "agg_counts": f"SELECT o_orderstatus AS order_status, count(*) AS n_orders, count(arrived) AS n_delivered "
                  f"FROM orders LEFT JOIN {ARRIVED} ON l_orderkey = o_orderkey GROUP BY 1",
    "agg_min_max": "SELECT coalesce(min(o_orderdate)::DATE, DATE '2016-01-01') AS first_day, "
                   "coalesce(max(o_orderdate)::DATE, DATE '2018-12-31') AS last_day FROM orders",
    "distinct_rows": "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer",
    "dedup_rows": "SELECT DISTINCT l_suppkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus "
                  "FROM lineitem",
    "cast_timestamps": """
SELECT order_id, raw_purchase_timestamp, try_cast(raw_purchase_timestamp AS TIMESTAMP) AS order_purchase_timestamp
FROM (SELECT o_orderkey AS order_id,
             CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                                WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
                                ELSE o_orderpriority END AS raw_purchase_timestamp
      FROM orders)""",
    "date_key": f"SELECT o_orderkey, {day_key('o_orderdate')} AS date_key FROM orders",
    "date_parts": f"""
SELECT o_orderkey, {day_key("o_orderdate")} AS date_key, year(o_orderdate)::INTEGER AS year,
       month(o_orderdate)::INTEGER AS month, monthname(o_orderdate) AS month_name,
       quarter(o_orderdate)::INTEGER AS quarter, (isodow(o_orderdate) % 7 + 1)::INTEGER AS day_of_week,
       day(o_orderdate)::INTEGER AS day_of_month
FROM orders""",
    "date_sequence": f"SELECT date FROM ({CALENDAR})",
    "coalesce_default": f"SELECT p_partkey AS product_id, {CATEGORY} AS product_category_name_english FROM part",
    "elapsed_days": f"SELECT o_orderkey, {DAYS} AS days_to_last_ship "
                    f"FROM orders JOIN {ARRIVED} ON l_orderkey = o_orderkey",
    "csv_roundtrip": "SELECT * FROM part",
    "scan_catalog": "SELECT * FROM supplier",
    "register_external": "SELECT * FROM customer",
    "refresh_external": "SELECT * FROM orders",
    "csv_line_breaks": """SELECT o_orderkey,
        o_orderpriority || chr(10) || 'said "so", twice' || chr(10) || o_orderstatus AS note, o_totalprice FROM orders""",
    "csv_set_aside": """SELECT CASE WHEN l_linenumber = 7 THEN 'items.l_quantity: not int: many' END AS reason, l_returnflag,
        count(*) AS n, CASE WHEN l_linenumber <> 7 THEN sum(l_quantity::INTEGER)::BIGINT END AS quantity
        FROM (SELECT * REPLACE (CASE WHEN l_linenumber = 7 THEN 7 ELSE 0 END AS l_linenumber) FROM lineitem)
        GROUP BY l_linenumber, l_returnflag""",
    "csv_found_types": """SELECT p_partkey, p_brand, p_retailprice, p_size > 25 AS large,
        (DATE '2020-01-01' + p_size)::DATE AS since, CASE WHEN p_size = 7 THEN 7.5 ELSE p_size END::DOUBLE AS p_size FROM part""",
    "incremental_orders": BY_MONTH,
    "partitioned_external": BY_MONTH,
}

# The path CSV -> Bronze -> Silver -> Gold -> answer: identifiers come back as text.
PIPELINE = {f"pipeline_{q.split('_')[0]}": sql for q, sql in QUESTIONS.items()} | {
    "pipeline_q3": f"SELECT * REPLACE (seller_id::VARCHAR AS seller_id) FROM ("
                   f"{QUESTIONS['q3_top_sellers'].replace('4 DESC NULLS LAST, 1 NULLS FIRST', '4 DESC NULLS LAST, 1::VARCHAR NULLS FIRST')})",
    "pipeline_load_report": ROW_COUNTS,
    "pipeline_column_tests": TESTS,
    "silver_view": PRODUCTS,
    "temp_view_sql": sales_by_state(10),
}


def all_oracles() -> dict[str, str]:
    return QUESTIONS | VERIFY_VARIANTS | DATASETS | CHECKS | PRIMITIVES | PIPELINE
