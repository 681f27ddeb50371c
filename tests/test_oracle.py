"""Every registered query equals its DuckDB twin on the sf0.001 tables
(row count, column names and types, order-insensitive values)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from emporia.oracle import all_oracles
from emporia.registry import all_queries

TABLES = "region nation customer supplier part orders lineitem".split()
KEYS = sorted(all_queries())
DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        r = round(v, 9)
        return ("zero", math.copysign(1.0, v)) if r == 0 else r
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _sorted(rows):
    return sorted((tuple(_norm(v) for v in r) for r in rows),
                  key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(KEYS) == set(all_oracles())
    assert set(KEYS) <= set(E.queries()) and set(KEYS) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert [f.name for f in df.schema] == ["product_category_name_english", "category_revenue"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, sf_small, key):
    df = E.queries()[key](spark, sf_small)
    got = df.collect()
    cur = duck.execute(E.oracle_sql()[key])
    names = [c[0] for c in cur.description]
    want = cur.fetchall()
    assert df.columns == names
    spark_types = [DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields]
    assert spark_types == [str(c[1]) for c in cur.description]
    assert len(got) == len(want)
    assert _sorted(got) == _sorted(want)
