"""The path the layers are made for, as queries: the adapter's frames are
exported as source CSVs, ingested, built into Silver and Gold, tested and
asked the questions, identifiers and date-times being text on the way in.

One run per session and input serves all of these queries; its tables live in
the shared scratch folder until the application ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from emporia.plans.catalog_jobs import scratch_namespace
from emporia.plans.layers import Layers
from emporia.plans.pipeline import (
    create_silver_views, export_sources_csv, register_layer_tables, register_layer_views, run_pipeline, write_tables,
)
from emporia.plans.questions import QUESTIONS
from emporia.plans.silver import SILVER_INPUT
from emporia.session import scratch_path
from emporia.sources.publish import file_stamps
from emporia.sources.schemas import SOURCE_TABLES

_RUNS: dict[tuple, dict] = {}


def pipeline_run(spark: SparkSession, sf_dir: str) -> dict:
    """The run over the tables that ``sf_dir`` holds now (files, sizes, times)."""
    key = (spark.sparkContext.applicationId, sf_dir, tuple(file_stamps(spark, sf_dir)))
    if key not in _RUNS:
        raw = scratch_path(spark, "pipeline-raw")
        export_sources_csv(Layers.from_driver(spark, sf_dir).bronze, raw)
        _RUNS[key] = run_pipeline(spark, raw, scratch_path(spark, "pipeline-work"), None, None)
    return _RUNS[key]


def _answer(question: str):
    return lambda spark, sf_dir: pipeline_run(spark, sf_dir)["answers"][question]


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before and after the Silver rules, as counted during the writes."""
    report = pipeline_run(spark, sf_dir)["report"]
    rows = [(s, report["bronze"][b], report["silver"][s], report["silver_removed"][s])
            for s, b in SILVER_INPUT.items()]
    return spark.createDataFrame(rows, "table_name string, rows_before long, rows_after long, rows_removed long")


def column_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(*k, n) for k, n in pipeline_run(spark, sf_dir)["report"]["tests"].items()]
    return spark.createDataFrame(rows, "model_name string, column_name string, test_name string, failures long")


def silver_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver products read through catalog views over Bronze tables."""
    suffix = f"_{uuid.uuid4().hex[:10]}"
    name = scratch_namespace(spark, suffix)
    base = scratch_path(spark, "bronze-tables")
    bronze = Layers.from_driver(spark, sf_dir).bronze
    write_tables(spark, {t: bronze[t] for t in SOURCE_TABLES}, base)
    tables = scratch_namespace(spark, f"{suffix}_bronze")
    register_layer_tables(spark, tables, base, SOURCE_TABLES)
    create_silver_views(spark, name, tables)
    return spark.read.table(f"{name}.silver_products")


def temp_view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over a layer's frames registered as views of the session."""
    register_layer_views(Layers.from_driver(spark, sf_dir).gold, prefix="gold_")
    return spark.sql("""
        WITH per_customer AS (SELECT customer_id, SUM(price) AS spent FROM gold_fact_order_items GROUP BY customer_id)
        SELECT c.customer_state, ROUND(SUM(p.spent), 2) AS total_sales
        FROM gold_dim_customers AS c, per_customer AS p WHERE c.customer_id = p.customer_id
        GROUP BY c.customer_state ORDER BY total_sales DESC, customer_state LIMIT 10""")


PIPELINE_JOBS = {f"pipeline_{q.split('_')[0]}": _answer(q) for q in QUESTIONS} | {
    "pipeline_load_report": load_report,
    "pipeline_column_tests": column_tests,
    "silver_view": silver_view,
    "temp_view_sql": temp_view_sql,
}
