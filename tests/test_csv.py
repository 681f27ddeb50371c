"""CSV ingest: names bind the columns, nothing is dropped silently, and what
the writer writes is read back value for value."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from emporia.sources.files import discover_sources, list_csv, read_csv, read_source_csv, write_csv
from emporia.sources.schemas import SOURCE_SCHEMAS

SELLERS = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
PRODUCTS = ",".join(f.name for f in SOURCE_SCHEMAS["products"].fields) + "\n"
FAILURES = (ValueError, Exception)


def put(folder, name, text):
    (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_columns_are_bound_by_name(spark, tmp_path):
    raw = put(tmp_path, "sellers", "Seller_State,seller_id,extra,seller_city,seller_zip_code_prefix\nSP,s1,x,city,01310\n")
    df = read_source_csv(spark, raw, "sellers")
    assert df.columns == ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state", "extra"]
    assert [tuple(r) for r in df.collect()] == [("s1", "01310", "city", "SP", "x")]


def test_missing_column_fails(spark, tmp_path):
    with pytest.raises(ValueError, match="seller_state"):
        read_source_csv(spark, put(tmp_path, "sellers", "seller_id,seller_zip_code_prefix,seller_city\ns,0,c\n"), "sellers")


def test_part_files_with_other_headers_fail(spark, tmp_path):
    folder = tmp_path / "sellers.csv"
    folder.mkdir()
    (folder / "a.csv").write_text(SELLERS + "s1,0,c,SP\n")
    (folder / "b.csv").write_text("seller_zip_code_prefix,seller_id,seller_city,seller_state\n0,s2,c,SP\n")
    with pytest.raises(Exception):
        read_source_csv(spark, str(tmp_path), "sellers").collect()


def test_whole_decimals_are_integers_and_others_fail(spark, tmp_path):
    raw = put(tmp_path, "products", PRODUCTS + "p1,cat,10.0,+5,,225.0,16,1e2,-3\n")
    row = read_source_csv(spark, raw, "products").first()
    assert tuple(row)[2:] == (10, 5, None, 225, 16, 100, -3)
    for bad in ("16.5", "many", "99999999999"):
        raw = put(tmp_path, "products", PRODUCTS + f"p1,cat,1,1,1,{bad},1,1,1\n")
        with pytest.raises(Exception, match="product_weight_g"):
            read_source_csv(spark, raw, "products").collect()


def test_bad_double_fails(spark, tmp_path):
    header = ",".join(f.name for f in SOURCE_SCHEMAS["order_payments"].fields) + "\n"
    raw = put(tmp_path, "order_payments", header + "o,1,card,1,1.5\no,2,card,1,twelve\n")
    with pytest.raises(Exception, match="payment_value"):
        read_source_csv(spark, raw, "order_payments").collect()


@pytest.mark.parametrize("record", ["s1,0\n", "s1,0,c,SP,more\n", 's1,0,"c"\nd,SP\n'])
def test_broken_records_are_refused(spark, tmp_path, record):
    with pytest.raises(Exception):
        read_source_csv(spark, put(tmp_path, "sellers", SELLERS + record + "s2,0,c,SP\n"), "sellers").collect()


def test_quoted_line_breaks_in_every_table(spark, tmp_path):
    raw = put(tmp_path, "sellers", SELLERS + 's1,0,"two\nlines",SP\ns2,0,c,"S\r\nP"\n')
    df = discover_sources(spark, raw, ["sellers"])["sellers"]
    assert [(r.seller_id, r.seller_city, r.seller_state) for r in df.collect()] == [
        ("s1", "two\nlines", "SP"), ("s2", "c", "S\r\nP")]


def test_writer_loses_nothing(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType()),
                           T.StructField("n", T.IntegerType())])
    rows = [("", None, 1), (None, "", None), ("  left", "right  ", 0), (" ", "\t", 2), ('say "x"', "a,b", -1),
            ("NULL", "null", 3), ("back\\slash", '"', 4), ("é中😀", "#c", 5), ('""', "''", 6)]
    write_csv(spark.createDataFrame(rows, schema), str(tmp_path / "t"))
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "t"), schema).collect()), key=str) == sorted(rows, key=str)
    rows += [("line\nbreak", "x\r\ny", 7)]
    write_csv(spark.createDataFrame(rows, schema), str(tmp_path / "u"))
    back = read_csv(spark, str(tmp_path / "u"), schema).collect()
    assert {(r.a or "").replace("\r\n", "\n") for r in back} >= {"line\nbreak", "  left", ""}
    assert len(back) == len(rows)


def test_every_file_is_found_and_stems_are_mapped(spark, tmp_path):
    put(tmp_path, "the_sellers_file", SELLERS + "s1,0,c,SP\n")
    put(tmp_path, "other", "x,y\n1,2.5\n3,4.5\n")
    (tmp_path / "notes.txt").write_text("no table")
    assert sorted(list_csv(spark, str(tmp_path))) == ["other", "the_sellers_file"]
    found = discover_sources(spark, str(tmp_path), ["sellers"], {"the_sellers_file": "sellers"})
    assert found["sellers"].count() == 1
    assert found["other"].dtypes == [("x", "int"), ("y", "double")]
    with pytest.raises(ValueError, match="sellers"):
        discover_sources(spark, str(tmp_path), ["sellers"])
    with pytest.raises(ValueError, match="both"):
        discover_sources(spark, str(tmp_path), ["sellers"], {"the_sellers_file": "sellers", "other": "sellers"})
