"""Hand-made source-shaped tables covering the edge cases of FIXTURES.md §5."""

from __future__ import annotations

from emporia.sources.schemas import SOURCE_SCHEMAS

CUSTOMERS = [
    ("c1", "u1", "01310", "sao paulo", "SP"),
    ("c2", "u2", "20000", "rio de janeiro", "RJ"),
    ("c3", "u3", "30000", "belo horizonte", "MG"),
]
GEOLOCATION = [
    ("01310", -23.5, -46.6, "sao paulo", "SP"),
    ("01310", -23.5, -46.6, "sao paulo", "SP"),
    ("01310", -23.5, -46.6, "sao paulo", "SP"),
    ("20000", -22.9, -43.2, "rio de janeiro", "RJ"),
]
ORDERS = [
    # id, customer, status, purchase, approved, carrier, delivered, estimated
    ("o1", "c1", "delivered", "2017-01-01 00:00:00", None, None, "2017-01-01 18:00:00", None),
    ("o2", "c2", "shipped", "2017-01-02 10:00:00", None, None, None, None),
    ("o3", "c2", "delivered", "bad", None, None, "2017-01-09 00:00:00", None),
    ("o4", "c3", "delivered", None, None, None, "2017-01-09 00:00:00", None),
    ("o5", "c3", "delivered", "2017-01-05 00:00:00", None, None, "2017-01-04 00:00:00", None),
    ("o6", "c1", "delivered", "2017-02-10 08:00:00", None, None, "2017-02-12 08:00:00", None),
    ("o7", "c3", "delivered", "2017-01-03", None, None, "2017-01-03", None),
]
ORDER_ITEMS = [
    ("o1", 1, "p1", "s1", "2017-01-03 00:00:00", 10.00, 1.0),
    ("o1", 2, "p2", "s1", "2017-01-03 00:00:00", 20.00, 1.0),
    ("o1", 3, "p3", "s2", "2017-01-03 00:00:00", 30.00, 1.0),
    ("o6", 1, "p4", "s2", "not a date", 5.50, 1.0),
    ("o99", 1, "p1", "s1", "2017-01-03 00:00:00", 100.00, 1.0),
    ("o2", 1, "p1", "s2", "2017-01-04 00:00:00", 40.00, 2.0),
]
ORDER_PAYMENTS = [
    ("o1", 1, "credit_card", 3, 60.0),
    ("o6", 1, "boleto", 1, 5.5),
    ("o99", 1, "voucher", 1, 999.0),
    ("o2", 1, "credit_card", 2, 40.0),
]
ORDER_REVIEWS = [
    ("r1", "o1", 4, None, "ok", "2017-01-05 00:00:00", "2017-01-06 10:00:00"),
    ("r1", "o6", 2, None, 'said "meh"\nthen left', "2017-02-15 00:00:00", None),
    ("r2", "o2", 5, "great", None, "2017-01-10", "garbage"),
]
PRODUCTS = [
    ("p1", "beleza_saude", 10, 100, 1, 200, 10, 10, 10),
    ("p2", "esporte_lazer", 10, 100, 1, 200, 10, 10, 10),
    ("p3", "beleza_saude", 10, 100, 1, 200, 10, 10, 10),
    ("p4", None, 10, 100, 1, 200, 10, 10, 10),
]
SELLERS = [
    ("s1", "01310", "sao paulo", "SP"),
    ("s2", "20000", "rio de janeiro", "RJ"),
]
TRANSLATION = [
    ("beleza_saude", "health_beauty"),
    ("informatica", "computers"),
]

ROWS = {
    "customers": CUSTOMERS,
    "geolocation": GEOLOCATION,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "order_payments": ORDER_PAYMENTS,
    "order_reviews": ORDER_REVIEWS,
    "products": PRODUCTS,
    "sellers": SELLERS,
    "product_category_name_translation": TRANSLATION,
}


def bronze(spark, overrides: dict | None = None):
    rows = {**ROWS, **(overrides or {})}
    return {t: spark.createDataFrame(rows[t], SOURCE_SCHEMAS[t]) for t in SOURCE_SCHEMAS}
