"""Benchmark: the pipeline steps of the reference and the business
questions at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3, best run kept).  Prints one JSON line.

Setup (not timed): the driver tables are exported through the adapter as
the nine source CSVs, the input format of the reference's ingest step.

Phases, each timed end to end (a fresh output folder per run):
  ingest       9 source CSVs -> Bronze Parquet, with row counts      (L1)
  silver       Bronze -> 8 Silver tables + translation, written        (L2)
  gold         Silver -> 4 dimensions + 4 facts, written              (L3)
  tests        the 19 declared column tests over Silver + Gold         (C4, C5)
  analysis     duplicate profile + key violations + top-5 over Silver  (C1-C3)
  q1..q7       the questions over the written Gold tables
  e2e_q1..q7   the registered queries: questions composed lazily from the
               raw driver tables (no materialised layer)
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from emporia.plans import checks  # noqa: E402
from emporia.plans.gold import GOLD_BUILDERS  # noqa: E402
from emporia.plans.layers import Layers  # noqa: E402
from emporia.plans.pipeline import (  # noqa: E402
    build_gold_tables, build_silver_tables, export_sources_csv, ingest, read_layer,
)
from emporia.plans.questions import QUESTIONS  # noqa: E402
from emporia.plans.silver import SILVER_BUILDERS  # noqa: E402
from emporia.session import local_session, scratch_path  # noqa: E402
from emporia.sources.schemas import SOURCE_TABLES  # noqa: E402


def timed(fn, repeat: int):
    best, out = float("inf"), None
    for _ in range(repeat):
        t0 = time.perf_counter()
        out = fn()
        best = min(best, time.perf_counter() - t0)
    return round(best, 3), out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus, app="emporia-bench", shuffle_partitions=max(cpus, 8))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    lay = Layers.from_driver(spark, sf_dir)
    raw = scratch_path(spark, "bench_raw")
    export_sources_csv(lay.bronze, raw)
    # warm-up: JVM class loading and parquet footers, not measured
    QUESTIONS["q2_category_revenue"](lay.gold).collect()

    times: dict[str, float] = {}

    def run_ingest():
        d = scratch_path(spark, "bench_bronze")
        ingest(spark, raw, d)
        return d

    times["ingest"], bronze_dir = timed(run_ingest, repeat)
    bronze = read_layer(spark, bronze_dir, SOURCE_TABLES)

    def run_silver():
        d = scratch_path(spark, "bench_silver")
        build_silver_tables(spark, bronze, d, None)
        return d

    times["silver"], silver_dir = timed(run_silver, repeat)
    silver = read_layer(spark, silver_dir, SILVER_BUILDERS)

    def run_gold():
        d = scratch_path(spark, "bench_gold")
        build_gold_tables(spark, silver, d, None)
        return d

    times["gold"], gold_dir = timed(run_gold, repeat)
    gold = read_layer(spark, gold_dir, GOLD_BUILDERS)

    times["tests"], _ = timed(lambda: checks.column_tests(silver, gold).collect(), repeat)
    times["analysis"], _ = timed(lambda: checks.analysis_report(silver), repeat)
    for name, fn in QUESTIONS.items():
        times[name.split("_")[0]], _ = timed(lambda fn=fn: fn(gold).collect(), repeat)
    for name, fn in QUESTIONS.items():
        times["e2e_" + name.split("_")[0]], _ = timed(
            lambda fn=fn: fn(Layers.from_driver(spark, sf_dir).gold).collect(), repeat)

    total = round(sum(times.values()), 3)
    pipeline = round(times["ingest"] + times["silver"] + times["gold"] + times["tests"], 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times,
                      "pipeline_sec": pipeline, "sf": sf, "cpus": cpus, "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
