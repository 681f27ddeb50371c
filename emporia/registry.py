"""Query registry: key -> callable(spark, sf_dir) -> DataFrame.

Dataset keys return a whole Silver or Gold table, question keys the answer
of Q1-Q7, check keys a quality report, and operator keys one operator over
the driver tables.  All are lazy except the catalog round-trips, which
must write before they can read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from emporia.operators import quality
from emporia.plans import checks
from emporia.plans.catalog_jobs import CATALOG_JOBS
from emporia.plans.gold import GOLD_BUILDERS
from emporia.plans.layers import Layers
from emporia.plans.pipeline_jobs import PIPELINE_JOBS
from emporia.plans.primitives import PRIMITIVES
from emporia.plans.questions import QUESTIONS, VERIFY_VARIANTS
from emporia.plans.silver import SILVER_BUILDERS, SILVER_INPUT
from emporia.sources.observe import rows_before_after

Query = Callable[[SparkSession, str], DataFrame]


def _silver(name: str) -> Query:
    return lambda spark, sf: Layers.from_driver(spark, sf).silver[name]


def _gold(name: str) -> Query:
    return lambda spark, sf: Layers.from_driver(spark, sf).gold[name]


def _question(name: str) -> Query:
    fn = QUESTIONS.get(name) or VERIFY_VARIANTS[name]
    return lambda spark, sf: fn(Layers.from_driver(spark, sf).gold)


def layer_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    lay = Layers.from_driver(spark, sf)
    return rows_before_after({t: (lay.bronze[SILVER_INPUT[t]], lay.silver[t]) for t in checks.PROFILED})


def duplicate_profile(spark: SparkSession, sf: str) -> DataFrame:
    return checks.duplicate_profile(Layers.from_driver(spark, sf).silver)


def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return checks.duplicate_keys(Layers.from_driver(spark, sf).silver)


def duplicate_keys_top5(spark: SparkSession, sf: str) -> DataFrame:
    return checks.duplicate_keys_top5(Layers.from_driver(spark, sf).silver)


def check_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.unique_failures(Layers.from_driver(spark, sf).gold["fact_order_reviews"], "review_id")


def check_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return quality.not_null_failures(Layers.from_driver(spark, sf).gold["fact_orders"],
                                     "delivery_time_days")


def column_tests(spark: SparkSession, sf: str) -> DataFrame:
    lay = Layers.from_driver(spark, sf)
    return checks.column_tests(lay.silver, lay.gold)


def all_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for name in list(QUESTIONS) + list(VERIFY_VARIANTS):
        q[name] = _question(name)
    for name in SILVER_BUILDERS:
        if name.startswith("silver_"):  # the translation copy reads no given table
            q[name] = _silver(name)
    for name in GOLD_BUILDERS:
        q[name] = _gold(name)
    q.update({
        "layer_row_counts": layer_row_counts,
        "duplicate_profile": duplicate_profile,
        "duplicate_keys": duplicate_keys,
        "duplicate_keys_top5": duplicate_keys_top5,
        "check_unique": check_unique,
        "check_not_null": check_not_null,
        "column_tests": column_tests,
    })
    q.update(PRIMITIVES)
    q.update(CATALOG_JOBS)
    q.update(PIPELINE_JOBS)
    return q
