"""Ingest: records set aside, types widened and found in the pass that writes."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from emporia.plans.ingest import TooManyBadRecords, ingest_report, set_aside
from emporia.plans.pipeline import export_sources_csv, read_layer, run_pipeline
from emporia.session import scratch_path
from emporia.sources import publish, value_types
from tests import fixtures


def raw_folder(spark, tmp_path, **files):
    """The fixture tables as one CSV file each, with some of them replaced."""
    raw = tmp_path / "raw"
    raw.mkdir()
    for table, df in fixtures.bronze(spark).items():
        if table not in files:
            export = df.toPandas()
            export.to_csv(raw / f"{table}.csv", index=False)
    for table, text in files.items():
        (raw / f"{table}.csv").write_text(text)
    return str(raw)


SELLERS = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
PRODUCTS = ",".join(f.name for f in fixtures.SOURCE_SCHEMAS["products"].fields) + "\n"


def test_bad_records_are_set_aside_up_to_the_limit(spark, tmp_path):
    good = "".join(f's{k},0{k},"city\n{k}",SP\n' for k in range(8))
    raw = raw_folder(spark, tmp_path, sellers=SELLERS + good + "s8,1\ns9,1,c,SP,more\n",
                     products=PRODUCTS + "p1,cat,1,1,1,many,1,1,1\np2,cat,1,1,1,,1,1,1\n")
    base = scratch_path(spark, "bronze")
    with pytest.raises(TooManyBadRecords, match="products: 1 of 2"):
        ingest_report(spark, raw, base, bad_share=0.3)
    assert publish.current(spark, base) == {}
    fs, where = publish.file_system(spark, f"{base}/{publish.VERSIONS}")
    assert len(fs.listStatus(where)) == 0
    loads = ingest_report(spark, raw, base, bad_share=0.5)
    assert (loads["sellers"].rows, loads["sellers"].bad) == (8, 2) and loads["customers"].bad == 0
    aside = sorted((r["table_name"], r["file"].rsplit("/", 1)[1], r["record"], r["reason"]) for r in set_aside(spark, base).collect())
    assert aside == [
        ("products", "products.csv", "p1,cat,1,1,1,many,1,1,1", "products.product_weight_g: not int: many"),
        ("sellers", "sellers.csv", "s8,1", "sellers: the record doesn't have 4 fields"),
        ("sellers", "sellers.csv", "s9,1,c,SP,more", "sellers: the record doesn't have 4 fields")]
    layer = read_layer(spark, base, ["sellers", "products"])
    assert layer["sellers"].where("seller_city like 'city\\n%'").count() == 8
    assert [r["product_id"] for r in layer["products"].collect()] == ["p2"]


def test_integer_columns_are_widened(spark, tmp_path):
    raw = raw_folder(spark, tmp_path, products=PRODUCTS + (
        "p1,cat,1,1,1,16.5,3000000000,1,1\np2,cat,1,1,1,225.0,7,1,\np3,cat,1,1,1,,,1e20,\"\"\n"))
    base = scratch_path(spark, "bronze")
    load = ingest_report(spark, raw, base)["products"]
    assert (load.rows, load.bad) == (3, 0)
    assert {c: t.simpleString() for c, t in load.widened.items()} == {
        "product_weight_g": "double", "product_length_cm": "bigint", "product_height_cm": "double"}
    rows = read_layer(spark, base, ["products"])["products"].orderBy("product_id").collect()
    assert [tuple(r)[5:] for r in rows] == [(16.5, 3000000000, 1.0, 1), (225.0, 7, 1.0, None), (None, None, 1e20, None)]


def test_undeclared_columns_and_tables_get_types(spark, tmp_path):
    raw = raw_folder(spark, tmp_path, sellers=SELLERS.strip() + ",rating,since\n" + "s1,0,c,SP,4.5,2017-01-01\ns2,0,c,SP,,2017-02-01\n",
                     other='x,y,z,"w w"\n1,a,true,2017-01-01 10:00:00\n,"",FALSE,2017-01-02\n-7,b,,\n')
    base = scratch_path(spark, "bronze")
    loads = ingest_report(spark, raw, base)
    assert loads["other"].rows == 3
    layer = read_layer(spark, base, ["sellers", "other"])
    assert layer["sellers"].dtypes[-2:] == [("rating", "double"), ("since", "date")]
    assert layer["other"].dtypes == [("x", "int"), ("y", "string"), ("z", "boolean"), ("w w", "timestamp")]
    assert sorted((r["x"], r["y"], r["z"]) for r in layer["other"].where("x is not null").collect()) == [
        (-7, "b", None), (1, "a", True)]


VALUES = ["5", "+5", "-3", "007", "3000000000", "99999999999999999999", "12345678901234567890123456789", "1.5", ".5",
          "1e5", "NaN", "Inf", "nan", "2017", "2017-01-01", "2017-02-30", "2017-1-1", "2017-01-01 10:00:00",
          "2017-01-01T10:00:00", "true", "FALSE", "True ", "yes", "1,5", " 5", "1.5f", "9" * 41, "x", None, ""]
NUMBERS = [v for v in VALUES if v and v[0] in "+-.0123456789" and "-0" not in v and "-1-" not in v and "," not in v]
MIXES = [[v] for v in VALUES] + [NUMBERS[:4], NUMBERS[:5], NUMBERS[:6], NUMBERS, ["2017-01-01", "2017-01-01 10:00:00"],
                                 ["true", "FALSE", None], ["true", "1"], ["2017-01-01", "x"], ["1.5", "2017-01-01"],
                                 ["2017-01-01 10:00:00", "true"], [None, "", "7"], ["3000000000", "5", "1.5"]]


@pytest.mark.parametrize("k", range(len(MIXES)))
def test_types_equal_spark_inference(spark, tmp_path, k):
    values = MIXES[k]
    path = tmp_path / "v.csv"
    path.write_text("a,b\n" + "".join(('"' + v + '"' if v is not None else "") + ",x\n" for v in values))
    want = spark.read.options(header="true", inferSchema="true", multiLine="true", escape='"').csv(str(path)).dtypes[0][1]
    df = spark.createDataFrame([(v,) for v in values], "a string")
    told = df.agg(*value_types.counts("a", "")).first().asDict()
    assert value_types.type_of(told).simpleString() == want
    # the same from any two parts
    cut = random.Random(k).randrange(len(values) + 1)
    parts = [spark.createDataFrame([(v,) for v in p], "a string").agg(*value_types.counts("a", "")).first().asDict()
             for p in (values[:cut], values[cut:])]
    assert value_types.joined(*parts) == told
    cast = df.select(value_types.cast("a", value_types.type_of(told)).alias("a"))
    assert cast.where(F.col("a").isNull()).count() == sum(not v for v in values) or want == "string"


def test_pipeline_with_line_breaks_in_customers(spark, tmp_path):
    bronze = fixtures.bronze(spark, {"customers": [(a, b, c, d + "\n" + d, e) for a, b, c, d, e in fixtures.CUSTOMERS]})
    raw = scratch_path(spark, "raw")
    export_sources_csv(bronze, raw)
    broken = run_pipeline(spark, raw, scratch_path(spark, "work"), None, None)
    export_sources_csv(fixtures.bronze(spark), raw)
    plain = run_pipeline(spark, raw, scratch_path(spark, "work"), None, None)
    assert broken["report"]["bronze"] == plain["report"]["bronze"] and not broken["report"]["set_aside"]
    for q, df in plain["answers"].items():
        assert broken["answers"][q].collect() == df.collect(), q
