"""Data-quality reports over the layers (C1-C5)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from emporia.operators import quality
from emporia.sources.schemas import COLUMN_TESTS, SILVER_KEYS

# Tables profiled by the duplicate analysis: all nine.
PROFILED = list(SILVER_KEYS)


def duplicate_profile(silver: Mapping) -> DataFrame:
    return quality.union_reports([quality.duplicate_profile(silver[t], t, SILVER_KEYS[t]) for t in PROFILED])


def duplicate_keys(silver: Mapping) -> DataFrame:
    return quality.union_reports([quality.duplicate_key_summary(silver[t], t, keys)
                                  for t in PROFILED if (keys := SILVER_KEYS[t])])


def duplicate_keys_top5(silver: Mapping, k: int = 5) -> DataFrame:
    return quality.union_reports([quality.top_duplicate_keys(silver[t], t, keys, k)
                                  for t in PROFILED if (keys := SILVER_KEYS[t])])


def column_tests(silver: Mapping, gold: Mapping) -> DataFrame:
    tables = {**{k: silver[k] for k in silver if k in COLUMN_TESTS},
              **{k: gold[k] for k in gold if k in COLUMN_TESTS}}
    return quality.column_test_report(tables, COLUMN_TESTS)


def analysis_report(silver: Mapping, parallelism: int = 4) -> dict[str, list]:
    """The duplicate analysis, collected (small: one row per table, or k
    per table).  Each table gets a job for its whole-row profile and, if
    keyed, one that yields both its key summary and its most repeated keys;
    jobs are submitted concurrently so their small stages overlap.  A table
    that can't be read or analysed is reported under ``errors`` and the
    others go on."""
    from concurrent.futures import ThreadPoolExecutor

    def analyse(table: str):
        keys = SILVER_KEYS[table]
        try:
            df = silver[table]
            profile = quality.duplicate_profile(df, table, keys).first().asDict()
            return profile, quality.key_report(df, table, keys) if keys else None, None
        except Exception as e:  # noqa: BLE001 - whatever is wrong with one table
            return None, None, {"table_name": table, "error": str(e).splitlines()[0][:500]}

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        results = list(pool.map(analyse, PROFILED))
    keyed = [k for _, k, _ in results if k]
    return {"duplicate_profile": [p for p, _, _ in results if p],
            "duplicate_keys": [summary for summary, _ in keyed],
            "duplicate_keys_top5": [r.asDict() for _, top in keyed for r in top],
            "errors": [e for _, _, e in results if e]}
