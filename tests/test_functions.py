"""Scalar functions: tolerant parse, date keys, elapsed days (zone-free),
order-independent money sums."""

from __future__ import annotations

import datetime as dt
import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.functions.dates import date_key, date_parts, elapsed_days, parse_timestamp
from emporia.functions.money import amount, exact_sum, sum_partials, sum_parts


def test_parse_timestamp_tolerant(spark):
    df = spark.createDataFrame([("2017-01-02 03:04:05",), ("2017-01-02",), ("bad",), (None,)], "s string")
    got = [r.t for r in df.select(parse_timestamp("s", T.StringType()).alias("t")).collect()]
    assert got == [dt.datetime(2017, 1, 2, 3, 4, 5), dt.datetime(2017, 1, 2), None, None]


def test_date_key_and_parts(spark):
    df = spark.createDataFrame([(dt.date(2018, 12, 31),)], "d date")
    r = df.select(date_key("d").alias("k"), *[c.alias(n) for n, c in date_parts("d").items()]).first()
    assert r.k == 20181231 and r.date_key == 20181231
    assert (r.year, r.month, r.month_name, r.quarter, r.day_of_week, r.day_of_month) == \
        (2018, 12, "December", 4, 2, 31)


def test_elapsed_days_ignores_session_zone(spark):
    # 2017-10-15 is a daylight-saving start day in America/Sao_Paulo
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = spark.createDataFrame(
            [(dt.datetime(2017, 10, 14, 12, 0), dt.datetime(2017, 10, 16, 0, 0)),
             (dt.datetime(2017, 1, 1, 0, 0), dt.datetime(2017, 1, 1, 18, 0)),
             (dt.datetime(2017, 1, 2, 0, 0), None)],
            "a timestamp_ntz, b timestamp_ntz")
        got = [r.d for r in df.select(elapsed_days("a", "b").alias("d")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [1.5, 0.75, None]


def _rounded(values):
    """ROUND(SUM, 2) half up of the exact sum of the doubles' shortest decimals."""
    total = sum(Decimal(repr(v)) for v in values)
    return float(total.quantize(Decimal("0.01"), ROUND_HALF_UP))


@pytest.mark.parametrize("values", [
    [0.004] * 1000, [0.005] * 3, [-0.004] * 1000 + [1e9], [0.1, 0.2, 0.3, 68423.46, 1e-2, 12345678901.23] * 500,
    [1e12 + 0.01] * 2000, [8e12, 8e12, 0.01, -8e12], [5e-324, 1e-9, 1e-9], [123456.789] * 777, [-7.125, 0.0, -0.0]])
def test_sum_rounds_once(spark, values):
    df = spark.createDataFrame([(i % 7, v) for i, v in enumerate(values)] + [(0, None)], "k int, x double").repartition(5)
    want = _rounded(values)
    assert df.agg(exact_sum("x").alias("s")).first().s == want
    two = df.groupBy("k").agg(sum_parts("x").alias("p")).agg(amount(sum_partials("p")).alias("s"))
    assert two.first().s == want


def test_sum_of_nan_infinities_and_nothing(spark):
    rows = [("nan", float("nan")), ("nan", 1.0), ("inf", float("inf")), ("inf", 2.0), ("both", float("inf")),
            ("both", float("-inf")), ("null", None), ("huge", 1e300), ("huge", 1.0), ("mixed", 1e13), ("mixed", 0.25)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r.k: r.s for r in df.groupBy("k").agg(exact_sum("x").alias("s")).collect()}
    assert math.isnan(got["nan"]) and got["inf"] == math.inf and math.isnan(got["both"])
    assert got["null"] is None and got["huge"] == 1e300 and got["mixed"] == 1e13 + 0.25
    assert df.limit(0).agg(exact_sum("x").alias("s")).first().s is None


def test_sum_does_not_depend_on_partitioning(spark):
    rnd = random.Random(3)
    rows = [(rnd.uniform(-1e6, 1e9),) for _ in range(5000)]
    sums = {spark.createDataFrame(rnd.sample(rows, len(rows)), "x double").repartition(n)
            .agg(exact_sum("x").alias("s")).first().s for n in (1, 3, 16)}
    assert sums == {_rounded([r[0] for r in rows])}


def test_date_key_and_elapsed_days_match_python(spark):
    """Random wall-clock timestamps (1900-2100) in one Spark job: the key
    equals strftime('%Y%m%d') and elapsed days equal whole-second
    differences / 86400, whatever the session zone."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    stamps = st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2100, 12, 31))
    cases: list[tuple[dt.datetime, dt.datetime]] = []

    @settings(max_examples=300, derandomize=True, deadline=None)
    @given(stamps, stamps)
    def collect(a, b):
        cases.append((a.replace(microsecond=0), b.replace(microsecond=0)))

    collect()
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(cases, "a timestamp_ntz, b timestamp_ntz")
        got = df.select("a", "b", date_key("a").alias("k"),
                        elapsed_days("a", "b").alias("d")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    for r in got:
        assert r.k == int(r.a.strftime("%Y%m%d"))
        assert r.d == (r.b - r.a).total_seconds() / 86400.0
