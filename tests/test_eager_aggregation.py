"""The question plans aggregate facts on the foreign key before the
dimension join.  Brute-force check against join, group and order in plain Python on
random Gold tables with duplicated dimension keys (fan-out), a hot key
holding a third of the rows, NULL keys and NULL scores."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest

from emporia.plans.questions import QUESTIONS, VERIFY_VARIANTS

GOLD_SCHEMAS = {
    "dim_customers": "customer_id bigint, customer_unique_id string, customer_zip_code_prefix string, "
                     "customer_city string, customer_state string",
    "dim_products": "product_id bigint, product_category_name string, product_category_name_english string",
    "dim_sellers": "seller_id bigint, seller_zip_code_prefix string, seller_city string, seller_state string",
    "dim_date": "date date, date_key int, year int, month int, month_name string, quarter int, "
                "day_of_week int, day_of_month int",
    "fact_orders": "order_id bigint, customer_id bigint, order_status string, delivery_time_days double",
    "fact_order_items": "order_id bigint, order_item_id int, product_id bigint, seller_id bigint, "
                        "customer_id bigint, order_purchase_date_key int, price double, freight_value double",
    "fact_order_payments": "order_id bigint, payment_sequential int, order_purchase_date_key int, "
                           "payment_type string, payment_installments int, payment_value double",
    "fact_order_reviews": "review_id bigint, order_id bigint, review_score int",
}


def random_gold(seed: int):
    rnd = random.Random(seed)
    cats = ["a", "b", "c", None]
    states = ["SP", "RJ", None]
    n_prod, n_cust, n_sell, n_orders = 30, 20, 8, 60
    prods = [(p, f"pt{p % 5}", rnd.choice(cats)) for p in range(n_prod)]
    prods += [(p, "dup", rnd.choice(cats)) for p in rnd.sample(range(n_prod), 5)]  # fan-out
    custs = [(c, f"u{c}", "0", "city", rnd.choice(states)) for c in range(n_cust)]
    custs += [(c, f"u{c}", "1", "city2", rnd.choice(states)) for c in rnd.sample(range(n_cust), 3)]
    sells = [(s, "0", rnd.choice(["x", "y"]), rnd.choice(states)) for s in range(n_sell)]
    sells += [(3, "9", "z", "SP")]
    import datetime as dt
    days = [dt.date(2017, 1, 1) + dt.timedelta(days=i) for i in range(70)]
    dim_date = [(d, int(d.strftime("%Y%m%d")), d.year, d.month, d.strftime("%B"),
                 (d.month - 1) // 3 + 1, d.isoweekday() % 7 + 1, d.day) for d in days]
    keys = [r[1] for r in dim_date]
    orders = []
    for o in range(n_orders):
        dtd = rnd.choice([None, rnd.randrange(-2 * 86400, 20 * 86400) / 86400, 0.0])
        orders.append((o, rnd.choice(range(n_cust + 2)), "s", dtd))
    items, pays, revs = [], [], []
    for i in range(400):
        hot = i % 3 == 0  # a third of all rows on one product / seller / order
        o = 7 if hot else rnd.randrange(n_orders + 3)
        items.append((o, i, 11 if hot else rnd.choice(list(range(n_prod + 2)) + [None]),
                      3 if hot else rnd.randrange(n_sell + 1), rnd.randrange(n_cust + 1),
                      rnd.choice(keys + [None]), round(rnd.uniform(0, 500), 2), 0.0))
    for i in range(300):
        pays.append((rnd.randrange(n_orders), i, rnd.choice(keys + [99999999]),
                     rnd.choice(["card", "boleto", None]), 1, round(rnd.uniform(0, 300), 2)))
    for i in range(120):
        revs.append((rnd.randrange(40), 7 if i % 3 == 0 else rnd.randrange(n_orders + 2),
                     rnd.choice([1, 2, 3, 4, 5, None])))
    return {"dim_products": prods, "dim_customers": custs, "dim_sellers": sells,
            "dim_date": dim_date, "fact_orders": orders, "fact_order_items": items,
            "fact_order_payments": pays, "fact_order_reviews": revs}


def rows_of(data, name):
    names = [c.strip().split(" ")[0] for c in GOLD_SCHEMAS[name].split(",")]
    return [dict(zip(names, r)) for r in data[name]]


def joined(left, right, on):
    """All pairs of rows that agree in a key that isn't NULL."""
    lk, rk = on
    return [x | y for x in left for y in right if x[lk] is not None and x[lk] == y[rk]]


def grouped(rows, keys):
    out = {}
    for r in rows:
        out.setdefault(tuple(r[k] for k in keys), []).append(r)
    return out


def total(rows, col):
    values = [r[col] for r in rows if r[col] is not None]
    return float(sum(Decimal(repr(v)) for v in values).quantize(Decimal("0.01"), ROUND_HALF_UP)) if values else None


def mean(values):
    if not values:
        return None
    exact = sum(map(Fraction, values)) / len(values)
    return float((Decimal(exact.numerator) / Decimal(exact.denominator)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def first(v):  # ascending, NULLs first
    return (v is not None, v if v is not None else 0)


def down(v):  # descending, NULLs last
    return (v is None, -v if v is not None else 0)


def word(v):
    return (v is not None, v or "")


def brute(data):
    """Each question as join, group, order over lists: the whole ranking."""
    t = {name: rows_of(data, name) for name in GOLD_SCHEMAS}
    day = ("order_purchase_date_key", "date_key")
    out = {}
    pays = joined(t["fact_order_payments"], t["dim_date"], day)
    out["q1"] = sorted([(*k, total(r, "payment_value")) for k, r in grouped(pays, ["year", "month", "month_name"]).items()],
                       key=lambda r: (first(r[0]), first(r[1]), word(r[2])))
    sold = joined(t["fact_order_items"], t["dim_products"], ("product_id", "product_id"))
    out["q2"] = sorted([(*k, total(r, "price")) for k, r in grouped(sold, ["product_category_name_english"]).items()],
                       key=lambda r: (down(r[1]), word(r[0])))
    by = joined(t["fact_order_items"], t["dim_sellers"], ("seller_id", "seller_id"))
    out["q3"] = sorted([(*k, total(r, "price")) for k, r in grouped(by, ["seller_id", "seller_city", "seller_state"]).items()],
                       key=lambda r: (down(r[3]), first(r[0]), word(r[1]), word(r[2])))
    to = joined(t["fact_order_items"], t["dim_customers"], ("customer_id", "customer_id"))
    out["q4"] = sorted([(*k, total(r, "price")) for k, r in grouped(to, ["customer_state"]).items()],
                       key=lambda r: (down(r[1]), word(r[0])))
    for name, keep in (("q5", lambda d: d > 0), ("q5_all", lambda d: True)):
        late = [r for r in t["fact_orders"] if r["delivery_time_days"] is not None and keep(r["delivery_time_days"])]
        to = joined(late, t["dim_customers"], ("customer_id", "customer_id"))
        out[name] = sorted([(*k, mean([Fraction(round(x["delivery_time_days"] * 86400), 86400) for x in r]))
                            for k, r in grouped(to, ["customer_state"]).items()],
                           key=lambda r: (first(r[1]), word(r[0])))
    out["q6"] = sorted([(*k, len(r), total(r, "payment_value"))
                        for k, r in grouped(pays, ["year", "month", "month_name", "payment_type"]).items()],
                       key=lambda r: (first(r[0]), first(r[1]), down(r[5]), word(r[2]), word(r[3])))
    said = joined(joined(t["fact_order_reviews"], t["fact_order_items"], ("order_id", "order_id")), t["dim_products"],
                  ("product_id", "product_id"))
    for name, count in (("q7", lambda r: len([x for x in r if x["review_score"] is not None])), ("q7_all", len)):
        out[name] = sorted([(*k, mean([x["review_score"] for x in r if x["review_score"] is not None]), count(r))
                            for k, r in grouped(said, ["product_category_name_english"]).items()],
                           key=lambda r: (down(r[1]), down(r[2]), word(r[0])))
    return out


def gold_frames(spark, data):
    return {name: spark.createDataFrame(rows, GOLD_SCHEMAS[name]) for name, rows in data.items()}


def ordered(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_questions_equal_join_then_group_in_order(spark, seed):
    data = random_gold(seed)
    gold, want = gold_frames(spark, data), brute(data)
    for key, fn in QUESTIONS.items():
        assert ordered(fn(gold, limit=None)) == want[key[:2]], key
        assert ordered(fn(gold, limit=3)) == want[key[:2]][:3], key


@pytest.mark.parametrize("seed", [4, 5])
def test_verify_variants_equal_join_then_group_in_order(spark, seed):
    data = random_gold(seed)
    gold, want = gold_frames(spark, data), brute(data)
    expected = {
        "verify_monthly_revenue": [(y, name, v) for y, _, name, v in want["q1"]][:5],
        "verify_category_revenue": want["q2"][:5],
        "verify_sales_by_state": want["q4"][:5],
        "verify_delivery_by_state": want["q5_all"][:5],
        "verify_payment_trends": want["q6"][:20],
        "verify_review_by_category": want["q7_all"][:5],
    }
    assert set(expected) == set(VERIFY_VARIANTS)
    for key, fn in VERIFY_VARIANTS.items():
        assert ordered(fn(gold)) == expected[key], key
