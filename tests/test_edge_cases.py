"""Edge cases on hand-made source tables (FIXTURES.md §5)."""

from __future__ import annotations

import datetime as dt

import pytest

from emporia.operators import quality
from emporia.plans.layers import Layers
from emporia.plans.questions import QUESTIONS
from emporia.sources.files import read_source_csv
from tests.fixtures import bronze


@pytest.fixture(scope="module")
def lay(spark):
    return Layers(bronze(spark))


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_bad_and_null_purchase_time_rejected(lay):
    ids = sorted(r.order_id for r in lay.silver["silver_orders"].collect())
    assert ids == ["o1", "o2", "o5", "o6", "o7"]


def test_timestamps_parsed_tolerantly(lay):
    o = {r.order_id: r for r in lay.silver["silver_orders"].collect()}
    assert o["o1"].order_purchase_timestamp == dt.datetime(2017, 1, 1, 0, 0)
    assert o["o7"].order_purchase_timestamp == dt.datetime(2017, 1, 3, 0, 0)  # date only
    items = {(r.order_id, r.order_item_id): r for r in lay.silver["silver_order_items"].collect()}
    assert items[("o6", 1)].shipping_limit_date is None
    rev = {r.order_id: r for r in lay.silver["silver_order_reviews"].collect()}
    assert rev["o2"].review_answer_timestamp is None
    assert rev["o2"].review_creation_date == dt.datetime(2017, 1, 10)


def test_delivery_time_days(lay):
    f = {r.order_id: r.delivery_time_days for r in lay.gold["fact_orders"].collect()}
    assert f["o1"] == pytest.approx(0.75)
    assert f["o2"] is None
    assert f["o5"] == pytest.approx(-1.0)
    assert f["o6"] == pytest.approx(2.0)
    assert f["o7"] == 0.0


def test_translation_fallback_and_null_category(lay):
    p = {r.product_id: r.product_category_name_english for r in lay.gold["dim_products"].collect()}
    assert p == {"p1": "health_beauty", "p2": "esporte_lazer", "p3": "health_beauty", "p4": None}


def test_orphans_dropped_from_facts(lay):
    assert "o99" not in {r.order_id for r in lay.gold["fact_order_items"].collect()}
    assert "o99" not in {r.order_id for r in lay.gold["fact_order_payments"].collect()}
    assert lay.gold["fact_order_items"].count() == 5


def test_geolocation_exact_duplicates_removed(lay):
    assert lay.silver["silver_geolocation"].count() == 2


def test_dim_date_spans_purchase_days(lay):
    d = lay.gold["dim_date"].orderBy("date").collect()
    assert len(d) == 41
    assert d[0].date == dt.date(2017, 1, 1) and d[-1].date == dt.date(2017, 2, 10)
    first = d[0]
    assert (first.date_key, first.year, first.month, first.month_name, first.quarter,
            first.day_of_week, first.day_of_month) == (20170101, 2017, 1, "January", 1, 1, 1)


def test_dim_date_defaults_when_no_orders(spark):
    lay = Layers(bronze(spark, {"orders": []}))
    d = lay.gold["dim_date"]
    assert d.count() == 1096
    agg = d.agg({"date": "min"}).collect()[0][0], d.agg({"date": "max"}).collect()[0][0]
    assert agg == (dt.date(2016, 1, 1), dt.date(2018, 12, 31))


def test_q1_monthly_revenue(lay):
    assert rows(QUESTIONS["q1_monthly_revenue"](lay.gold)) == [
        (2017, 1, "January", 100.0), (2017, 2, "February", 5.5)]


def test_q2_category_revenue_with_null_group(lay):
    assert rows(QUESTIONS["q2_category_revenue"](lay.gold)) == [
        ("health_beauty", 80.0), ("esporte_lazer", 20.0), (None, 5.5)]


def test_q3_top_sellers(lay):
    assert rows(QUESTIONS["q3_top_sellers"](lay.gold)) == [
        ("s2", "rio de janeiro", "RJ", 75.5), ("s1", "sao paulo", "SP", 30.0)]


def test_q4_sales_by_state(lay):
    assert rows(QUESTIONS["q4_sales_by_state"](lay.gold)) == [("SP", 65.5), ("RJ", 40.0)]


def test_q5_only_positive_delivered(lay):
    assert rows(QUESTIONS["q5_delivery_by_state"](lay.gold)) == [("SP", 1.38)]
    # without the guard the negative and zero deliveries count
    res = rows(QUESTIONS["q5_delivery_by_state"](lay.gold, positive_only=False))
    assert res == [("MG", -0.5), ("SP", 1.38)]


def test_q6_payment_trends(lay):
    assert rows(QUESTIONS["q6_payment_trends"](lay.gold)) == [
        (2017, 1, "January", "credit_card", 2, 100.0),
        (2017, 2, "February", "boleto", 1, 5.5)]


def test_q7_review_fan_out(lay):
    # o1 has three items and one review: the review counts once per item
    assert rows(QUESTIONS["q7_review_by_category"](lay.gold)) == [
        ("health_beauty", 4.33, 3), ("esporte_lazer", 4.0, 1), (None, 2.0, 1)]


def test_duplicate_review_kept_and_reported(lay):
    rev = lay.gold["fact_order_reviews"]
    assert rev.count() == 3
    assert rows(quality.unique_failures(rev, "review_id")) == [("r1", 2)]


def test_tie_at_limit_smaller_key_wins(spark):
    items = [("o1", 1, "p1", "sB", "2017-01-01", 10.0, 0.0),
             ("o1", 2, "p1", "sA", "2017-01-01", 10.0, 0.0)]
    sellers = [("sB", "1", "b", "B"), ("sA", "1", "a", "A")]
    lay = Layers(bronze(spark, {"order_items": items, "sellers": sellers}))
    assert rows(QUESTIONS["q3_top_sellers"](lay.gold, limit=1)) == [("sA", "a", "A", 10.0)]


def test_csv_quoting_and_leading_zero(spark, tmp_path):
    d = tmp_path / "raw"
    (d / "order_reviews.csv").mkdir(parents=True)
    (d / "order_reviews.csv" / "part-0.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,,"line one\nsaid ""hi""",2017-01-01 00:00:00,\n'
        "r2,o2,3,t,plain,2017-01-02 00:00:00,2017-01-03 00:00:00\n")
    (d / "customers.csv").mkdir()
    (d / "customers.csv" / "part-0.csv").write_text(
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,u1,01310,sao paulo,SP\n")
    r = read_source_csv(spark, str(d), "order_reviews").orderBy("review_id").collect()
    assert len(r) == 2
    assert r[0].review_comment_message == 'line one\nsaid "hi"'
    c = read_source_csv(spark, str(d), "customers").collect()
    assert c[0].customer_zip_code_prefix == "01310"
