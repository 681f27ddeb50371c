"""Incremental ingest: a run appends only files it has not seen; an idle
run appends nothing; output is partitioned by year / month."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import types as T

from emporia.session import scratch_path
from emporia.sources.schemas import SOURCE_SCHEMAS
from emporia.streaming import incremental_ingest

HEADER = ("order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
          "order_delivered_carrier_date,order_delivered_customer_date,"
          "order_estimated_delivery_date\n")


def _rows(run):
    return run.rows


def test_only_new_files_are_ingested(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text(HEADER + "o1,c1,ok,2017-01-05 10:00:00,,,,\n"
                                            "o2,c1,ok,2017-02-05 10:00:00,,,,\n")
    out, ckpt = scratch_path(spark, "inc_out"), scratch_path(spark, "inc_ckpt")
    schema = SOURCE_SCHEMAS["orders"]
    q1 = incremental_ingest(spark, str(landing), schema, out, ckpt, "order_purchase_timestamp")
    assert _rows(q1) == 2
    q2 = incremental_ingest(spark, str(landing), schema, out, ckpt, "order_purchase_timestamp")
    assert _rows(q2) == 0
    (landing / "b.csv").write_text(HEADER + "o3,c2,ok,2018-03-01 00:00:00,,,,\nbad,c2,ok,nope,,,,\n")
    q3 = incremental_ingest(spark, str(landing), schema, out, ckpt, "order_purchase_timestamp")
    assert _rows(q3) == 2
    res = spark.read.parquet(out)
    assert res.count() == 4
    parts = {(r.year, r.month) for r in res.select("year", "month").collect()}
    assert parts == {(2017, 1), (2017, 2), (2018, 3), (None, None)}
    assert isinstance(res.schema["order_purchase_timestamp"].dataType, T.StringType)


def test_files_are_few_and_all_batches_counted(spark, tmp_path):
    """12 files landing in many batches: a bounded number of files per month."""
    landing = tmp_path / "landing"
    landing.mkdir()
    for k in range(12):
        lines = [f"o{k}x{i},c1,ok,2017-{i % 6 + 1:02}-05 10:00:00,,,,\n" for i in range(300)]
        (landing / f"{k}.csv").write_text(HEADER + "".join(lines))
    out, ckpt = scratch_path(spark, "inc_many"), scratch_path(spark, "inc_many_ckpt")
    schema = SOURCE_SCHEMAS["orders"]
    run = incremental_ingest(spark, str(landing), schema, out, ckpt, "order_purchase_timestamp", files_per_month=2)
    assert run.rows == 3600 == spark.read.parquet(out).count()
    assert len(spark.read.parquet(out).inputFiles()) <= 2 * 6
    out, ckpt = scratch_path(spark, "inc_batches"), scratch_path(spark, "inc_batches_ckpt")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        run = incremental_ingest(spark, str(landing), schema, out, ckpt, "order_purchase_timestamp",
                                 max_files_per_trigger=2)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert run.rows == 3600


def test_other_header_fails(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text(HEADER.replace("order_id,customer_id", "customer_id,order_id") + "c1,o1,ok,,,,,\n")
    with pytest.raises(StreamingQueryException):
        incremental_ingest(spark, str(landing), SOURCE_SCHEMAS["orders"], scratch_path(spark, "o"),
                           scratch_path(spark, "c"), "order_purchase_timestamp")
