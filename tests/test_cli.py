"""The command-line jobs run the pipeline steps over paths."""

from __future__ import annotations

import json

import pytest

from emporia import cli
from emporia.plans.layers import Layers
from emporia.plans.pipeline import export_sources_csv, read_layer
from emporia.session import SCALE_CONF, scratch_path
from emporia.sources import publish
from tests import fixtures


def test_cli_jobs(spark, sf_small, capsys):
    # the jobs fill unset cluster settings in the (shared) session: restore after
    saved = {k: spark.conf.get(k, None) for k in SCALE_CONF}
    try:
        _run_jobs(spark, sf_small, capsys)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == \
            SCALE_CONF["spark.sql.files.maxPartitionBytes"]
        assert spark.conf.get("spark.sql.shuffle.partitions") == saved["spark.sql.shuffle.partitions"]
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _run_jobs(spark, sf_small, capsys):
    raw, w = scratch_path(spark, "cli_raw"), scratch_path(spark, "cli_work")
    export_sources_csv(Layers.from_driver(spark, sf_small).bronze, raw)
    assert cli.main(["ingest", raw, f"{w}/bronze"]) == 0
    assert cli.main(["silver", f"{w}/bronze", f"{w}/silver", "--namespace", "cli_silver"]) == 0
    assert cli.main(["gold", f"{w}/silver", f"{w}/gold", "--namespace", "cli_gold"]) == 0
    assert cli.main(["test", f"{w}/silver", f"{w}/gold"]) == 0
    assert cli.main(["questions", f"{w}/gold"]) == 0
    assert cli.main(["analysis", f"{w}/silver"]) == 0
    assert cli.main(["register", f"{w}/gold", "cli_gold_ext", "gold"]) == 0
    assert cli.main(["register", f"{w}/gold", "cli_gold_ext", "gold"]) == 0  # idempotent
    assert spark.table("cli_gold_ext.fact_order_items").count() == \
        spark.read.parquet(publish.table_path(spark, f"{w}/gold", "fact_order_items")).count()
    out = capsys.readouterr().out
    assert "PASS unique(dim_date.date_key)" in out and "== q7_review_by_category" in out
    # every row of an answer is printed, one line each
    q6 = out.split("== q6_payment_trends")[1].split("== q7")[0]
    assert len([x for x in q6.splitlines() if x.startswith("{")]) == q6_rows(spark, f"{w}/gold") > 50


def q6_rows(spark, gold):
    layer = read_layer(spark, gold, ["fact_order_payments", "dim_date"])
    facts, days = layer["fact_order_payments"], layer["dim_date"]
    return (facts.join(days, facts.order_purchase_date_key == days.date_key)
            .select("year", "month", "payment_type").distinct().count())


def raw_files(spark, folder, **overrides):
    raw = scratch_path(spark, folder)
    export_sources_csv(fixtures.bronze(spark, overrides), raw)
    return raw


def test_pipeline_fails_on_a_failing_test_and_writes_all_answers(spark, capsys):
    w = scratch_path(spark, "cli_pipeline")
    assert cli.main(["pipeline", raw_files(spark, "cli_good"), w]) == 0
    questions = [x for x in capsys.readouterr().out.splitlines() if x.startswith("== q")]
    assert len(questions) == 7
    answers = spark.read.options(header=True).csv(f"{w}/answers/q6_payment_trends")
    assert answers.count() == 2 and "payment_count" in answers.columns
    twice = fixtures.ORDERS + [fixtures.ORDERS[0]]
    assert cli.main(["pipeline", raw_files(spark, "cli_bad", orders=twice), scratch_path(spark, "cli_bad_work")]) == 1
    assert "silver_orders.order_id.unique" in capsys.readouterr().err


def test_analysis_goes_on_after_a_bad_table(spark, capsys):
    w = scratch_path(spark, "cli_analysis")
    assert cli.main(["ingest", raw_files(spark, "cli_raw2"), f"{w}/bronze"]) == 0
    assert cli.main(["silver", f"{w}/bronze", f"{w}/silver", "--namespace", "cli_silver2"]) == 0
    publish.remove(spark, publish.table_path(spark, f"{w}/silver", "silver_orders"))
    capsys.readouterr()
    assert cli.main(["analysis", f"{w}/silver"]) == 1
    out = capsys.readouterr().out
    profiles = [json.loads(x)["table_name"] for x in out.split("== duplicate_keys")[0].splitlines() if x.startswith("{")]
    assert len(profiles) == 8 and "silver_orders" not in profiles
    assert "product_category_name_translation" in profiles
    assert [json.loads(x)["table_name"] for x in out.split("== errors")[1].splitlines() if x.startswith("{")] == ["silver_orders"]


def test_ingest_with_stems(spark, tmp_path, capsys):
    raw = raw_files(spark, "cli_stems")
    fs, orders = publish.file_system(spark, f"{raw}/orders.csv")
    assert fs.rename(orders, publish.file_system(spark, f"{raw}/the_orders_of_all_shops.csv")[1])
    with pytest.raises(ValueError, match="orders"):
        cli.main(["ingest", raw, scratch_path(spark, "cli_nostem")])
    assert cli.main(["ingest", raw, scratch_path(spark, "cli_stem"), "--stem", "the_orders_of_all_shops=orders"]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["orders"]["rows"] == len(fixtures.ORDERS)
