"""End-to-end pipeline: source CSVs (exported from the adapter) -> ingest
-> Silver / Gold catalog tables -> column tests -> questions; the answers
equal the lazily composed registered queries."""

from __future__ import annotations

import pytest

from emporia.operators import quality
from emporia.plans.layers import Layers
from emporia.plans.pipeline import export_sources_csv, read_layer, run_pipeline, write_tables
from emporia.plans.questions import QUESTIONS
from emporia.session import scratch_path
from emporia.sources import publish
from tests import fixtures


def _rows(df):
    """Ids are STRING in the CSV source schema and BIGINT in the adapter:
    compare them as text."""
    return sorted(tuple(str(v) if isinstance(v, int) and f.dataType.simpleString() in
                        ("bigint", "string") else v for v, f in zip(r, df.schema.fields))
                  for r in df.collect())


@pytest.fixture(scope="module")
def result(spark, sf_small):
    lay = Layers.from_driver(spark, sf_small)
    raw = scratch_path(spark, "raw")
    export_sources_csv(lay.bronze, raw)
    return run_pipeline(spark, raw, scratch_path(spark, "work"), "t_silver", "t_gold"), lay


def test_load_report(result, spark):
    out, lay = result
    rep = out["report"]
    assert rep["bronze"]["orders"] == lay.bronze["orders"].count()
    assert rep["silver"]["silver_geolocation"] == lay.silver["silver_geolocation"].count()
    assert rep["gold"]["fact_order_items"] == lay.gold["fact_order_items"].count()
    assert spark.catalog.tableExists("t_gold.fact_order_items")
    assert rep["bronze_schema"]["customers"].startswith("struct<customer_id:string,")


def test_rows_removed_by_silver_rules(result, spark):
    out, lay = result
    removed = out["report"]["silver_removed"]
    geo = lay.bronze["geolocation"]
    assert removed["silver_geolocation"] == geo.count() - geo.distinct().count()
    assert removed["silver_orders"] == 0  # every driver order has a purchase time
    assert removed["silver_order_items"] == 0


def test_missing_source_fails(spark, tmp_path):
    from emporia.sources.files import discover_sources
    with pytest.raises(ValueError, match="orders"):
        discover_sources(spark, str(tmp_path), ["orders"])
    with pytest.raises(ValueError):
        discover_sources(spark, str(tmp_path), [])


def test_column_tests(result):
    tests = result[0]["report"]["tests"]
    assert len(tests) == 19
    assert tests[("fact_order_reviews", "review_id", "not_null")] == 0
    assert tests[("dim_date", "date_key", "unique")] == 0
    assert tests[("silver_orders", "order_id", "not_null")] == 0


@pytest.mark.parametrize("q", sorted(QUESTIONS))
def test_answers_equal_lazy_queries(result, q):
    out, lay = result
    assert _rows(out["answers"][q]) == _rows(QUESTIONS[q](lay.gold))


def test_sql_over_gold_views_equals_dataframe_answers(result, spark):
    """Gold registered as temp views, asked in SQL written for this test."""
    from emporia.plans.pipeline import register_layer_views

    lay = result[1]
    assert register_layer_views({"dim_sellers": lay.gold["dim_sellers"], "fact_order_items": lay.gold["fact_order_items"]},
                                prefix="v_") == ["v_dim_sellers", "v_fact_order_items"]
    got = spark.sql("""SELECT seller_id, seller_city, seller_state, total_sales FROM (
        SELECT seller_id, ROUND(SUM(price), 2) AS total_sales FROM v_fact_order_items GROUP BY 1)
        JOIN v_dim_sellers USING (seller_id) ORDER BY total_sales DESC, seller_id LIMIT 5""")
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in QUESTIONS["q3_top_sellers"](lay.gold).collect()]


def test_failed_build_publishes_nothing(spark):
    """The first of seven tables fails: what was there before stays, and
    nothing of the new build is seen."""
    from pyspark.sql import functions as F

    base = scratch_path(spark, "layer")
    good = {f"t{i}": spark.range(3 + i) for i in range(7)}
    assert write_tables(spark, good, base) == {f"t{i}": 3 + i for i in range(7)}
    bad = {n: df.union(spark.range(100)) for n, df in good.items()}
    bad["t0"] = spark.range(2).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        write_tables(spark, bad, base)
    assert {n: df.count() for n, df in read_layer(spark, base, good).items()} == {f"t{i}": 3 + i for i in range(7)}
    fs, where = publish.file_system(spark, f"{base}/{publish.VERSIONS}")
    assert len(fs.listStatus(where)) == 1  # nothing of the failed build is left
    assert write_tables(spark, {n: spark.range(1) for n in good}, base) == {n: 1 for n in good}


def test_silver_views_equal_silver_frames_and_last(spark):
    from emporia.plans.pipeline import create_silver_views, register_layer_tables
    from emporia.plans.silver import build_silver

    bronze = fixtures.bronze(spark)
    base = scratch_path(spark, "view_bronze")
    write_tables(spark, bronze, base)
    register_layer_tables(spark, "t_view_bronze", base, list(bronze))
    create_silver_views(spark, "t_views", "t_view_bronze", scratch_path(spark, "t_views_db"))
    other = spark.newSession()  # views of the catalog, not of the session
    for name, df in build_silver(bronze).items():
        view = other.read.table(f"t_views.{name}")
        assert view.columns == df.columns, name
        assert sorted(map(str, view.collect())) == sorted(map(str, df.collect())), name
    write_tables(spark, bronze | {"sellers": bronze["sellers"].limit(1)}, base)
    register_layer_tables(spark, "t_view_bronze", base, list(bronze))
    assert spark.read.table("t_views.silver_sellers").count() == 1


def test_key_text_is_unambiguous(spark):
    rows = [("a", None), (None, "a"), ("a|b", "c"), ("a", "b|c"), ("\\N", None), (None, "\\N"), ("", None), (None, ""),
            ("a\\", "b"), ("a", "\\b"), ("\\", "|"), ("\\|", "")]
    df = spark.createDataFrame(rows, "x string, y string")
    texts = [r.t for r in df.select(quality.key_text(["x", "y"]).alias("t")).collect()]
    assert len(set(texts)) == len(rows)


def test_profile_by_key_and_fingerprint_equals_whole_rows(spark):
    rows = [(1, "a", None), (1, None, "a"), (1, "a", None), (2, None, None), (2, None, None), (None, "x", "y"),
            (None, "x", "y"), (None, "y", "x"), (3, "", None), (3, None, "")]
    df = spark.createDataFrame(rows, "k int, x string, y string")
    assert quality.duplicate_profile(df, "t", ["k"]).collect() == quality.duplicate_profile(df, "t").collect()
    assert tuple(quality.duplicate_profile(df, "t", ["k"]).first()) == ("t", 10, 7, 3)


def test_silver_as_views(spark, sf_small):
    lay = Layers.from_driver(spark, sf_small)
    raw = scratch_path(spark, "raw_v")
    export_sources_csv(lay.bronze, raw)
    out = run_pipeline(spark, raw, scratch_path(spark, "work_v"), None, "t_gold_v", silver_as_views=True)
    assert spark.catalog.tableExists("silver_orders")
    assert "silver" not in out["report"]
    assert _rows(out["answers"]["q4_sales_by_state"]) == _rows(QUESTIONS["q4_sales_by_state"](lay.gold))


def test_single_pass_key_analysis_equals_reports(spark, sf_small):
    """analysis_report (one job per keyed table, summary by observe) gives
    the same rows as the separate lazy reports."""
    from emporia.plans import checks

    lay = Layers.from_driver(spark, sf_small)
    rep = checks.analysis_report(lay.silver)
    as_set = lambda rows: sorted(tuple(sorted(r.items())) for r in rows)
    assert as_set(rep["duplicate_keys"]) == as_set(
        [r.asDict() for r in checks.duplicate_keys(lay.silver).collect()])
    assert as_set(rep["duplicate_keys_top5"]) == as_set(
        [r.asDict() for r in checks.duplicate_keys_top5(lay.silver).collect()])
    assert as_set(rep["duplicate_profile"]) == as_set(
        [r.asDict() for r in checks.duplicate_profile(lay.silver).collect()])


def test_exported_and_written_files_are_compressed(spark, tmp_path):
    """Raw CSVs are gzipped and read back value for value; layers are Parquet in zstd."""
    import glob

    import pyarrow.parquet as pq

    raw, work = str(tmp_path / "raw"), str(tmp_path / "work")
    rows = fixtures.bronze(spark)
    export_sources_csv(rows, raw)
    parts = glob.glob(f"{raw}/*.csv/part-*")
    assert parts and all(p.endswith(".csv.gz") for p in parts)
    out = run_pipeline(spark, raw, work, None, None)
    bronze = read_layer(spark, f"{work}/bronze", list(rows))
    for t, df in rows.items():
        assert sorted(map(str, bronze[t].collect())) == sorted(map(str, df.collect())), t
    files = glob.glob(f"{work}/*/_versions/*/*/part-*.parquet")
    codecs = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files
              if pq.ParquetFile(f).metadata.num_row_groups}
    assert codecs == {"ZSTD"} and out["report"]["bronze"]["orders"] == len(fixtures.ORDERS)
