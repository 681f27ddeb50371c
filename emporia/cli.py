"""Command-line jobs, one per pipeline step (run under spark-submit or
``python -m emporia``; the session comes from the launcher's settings).

    ingest      RAW_DIR BRONZE_DIR [--stem FILE_STEM=TABLE ...] [--bad-share SHARE]
    silver      BRONZE_DIR SILVER_DIR [--namespace NS]
    gold        SILVER_DIR GOLD_DIR   [--namespace NS]
    test        SILVER_DIR GOLD_DIR        exit 1 when a declared test fails
    analysis    SILVER_DIR                 duplicate profile / key report; exit 1 on a bad table
    questions   GOLD_DIR                   Q1-Q7, every row
    pipeline    RAW_DIR WORK_DIR [--silver-views] [--stem ...] [--bad-share SHARE]
                                           all of the above; answers also in WORK_DIR/answers,
                                           exit 1 when a declared test fails
    incremental SOURCE_DIR TABLE OUT_DIR CHECKPOINT_DIR DATE_COLUMN
    register    LAYER_DIR NAMESPACE {bronze,silver,gold}   re-register a layer's tables
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from emporia.plans import checks
from emporia.plans.gold import GOLD_BUILDERS
from emporia.plans.pipeline import (
    LazyLayer, build_gold_tables, build_silver_tables, ingest_report, layer_schemas, read_layer,
    register_layer_tables, run_pipeline,
)
from emporia.plans.questions import QUESTIONS
from emporia.plans.silver import SILVER_BUILDERS
from emporia.session import apply_scale_defaults, ensure_checkpoint_dir
from emporia.sources.files import write_csv
from emporia.sources.schemas import SOURCE_SCHEMAS, SOURCE_TABLES


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("emporia").getOrCreate()
    apply_scale_defaults(spark)
    ensure_checkpoint_dir(spark)
    return spark


def _print(title: str, df) -> None:
    """Every row of an answer, one JSON line each."""
    print(f"== {title}")
    for row in df.toLocalIterator():
        print(json.dumps(row.asDict(), default=str))


def _stems(pairs: list[str]) -> dict[str, str]:
    return dict(p.split("=", 1) for p in pairs)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="emporia")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("ingest"); a.add_argument("raw"); a.add_argument("bronze")
    a.add_argument("--stem", action="append", default=[])
    a.add_argument("--bad-share", type=float, default=0.01)
    a = sub.add_parser("silver"); a.add_argument("bronze"); a.add_argument("silver")
    a.add_argument("--namespace", default="default_silver")
    a = sub.add_parser("gold"); a.add_argument("silver"); a.add_argument("gold")
    a.add_argument("--namespace", default="default_gold")
    a = sub.add_parser("test"); a.add_argument("silver"); a.add_argument("gold")
    a = sub.add_parser("analysis"); a.add_argument("silver")
    a = sub.add_parser("questions"); a.add_argument("gold")
    a = sub.add_parser("pipeline"); a.add_argument("raw"); a.add_argument("work")
    a.add_argument("--silver-views", action="store_true")
    a.add_argument("--stem", action="append", default=[])
    a.add_argument("--bad-share", type=float, default=0.01)
    a = sub.add_parser("register"); a.add_argument("base"); a.add_argument("namespace")
    a.add_argument("layer", choices=["bronze", "silver", "gold"])
    a = sub.add_parser("incremental")
    for n in ("source", "table", "out", "checkpoint", "date_column"):
        a.add_argument(n)
    args = p.parse_args(argv)
    spark = _session()

    if args.job == "ingest":
        loads = ingest_report(spark, args.raw, args.bronze, _stems(args.stem), args.bad_share)
        schemas = layer_schemas(read_layer(spark, args.bronze, list(loads)))
        print(json.dumps({t: {"rows": x.rows, "set_aside": x.bad, "schema": schemas[t]} for t, x in loads.items()}))
    elif args.job == "silver":
        bronze = read_layer(spark, args.bronze, SOURCE_TABLES)
        print(json.dumps(build_silver_tables(spark, bronze, args.silver, args.namespace)))
    elif args.job == "gold":
        silver = read_layer(spark, args.silver, SILVER_BUILDERS)
        print(json.dumps(build_gold_tables(spark, silver, args.gold, args.namespace)))
    elif args.job == "test":
        silver = read_layer(spark, args.silver, SILVER_BUILDERS)
        gold = read_layer(spark, args.gold, GOLD_BUILDERS)
        rep = checks.column_tests(silver, gold).collect()
        failed = [r for r in rep if r.failures]
        for r in rep:
            print(f"{'FAIL' if r.failures else 'PASS'} {r.test_name}({r.model_name}.{r.column_name})"
                  f" failures={r.failures}")
        return 1 if failed else 0
    elif args.job == "analysis":
        found = checks.analysis_report(LazyLayer(spark, args.silver, checks.PROFILED))
        for title, rows in found.items():
            print(f"== {title}")
            for r in rows:
                print(json.dumps(r, default=str))
        return 1 if found["errors"] else 0
    elif args.job == "questions":
        gold = read_layer(spark, args.gold, GOLD_BUILDERS)
        for name, fn in QUESTIONS.items():
            _print(name, fn(gold))
    elif args.job == "pipeline":
        out = run_pipeline(spark, args.raw, args.work, silver_as_views=args.silver_views,
                           stems=_stems(args.stem), bad_share=args.bad_share)
        rep = out["report"]
        rep["tests"] = {".".join(k): v for k, v in rep["tests"].items()}
        print(json.dumps(rep))
        for name, df in out["answers"].items():
            write_csv(df, f"{args.work.rstrip('/')}/answers/{name}")
            _print(name, df)
        for k in out["failed_tests"]:
            print(f"FAIL {'.'.join(k)}", file=sys.stderr)
        return 1 if out["failed_tests"] else 0
    elif args.job == "register":
        names = {"bronze": SOURCE_TABLES, "silver": list(SILVER_BUILDERS),
                 "gold": list(GOLD_BUILDERS)}[args.layer]
        print(json.dumps(register_layer_tables(spark, args.namespace, args.base, names)))
    elif args.job == "incremental":
        from emporia.streaming.incremental import incremental_ingest
        run = incremental_ingest(spark, args.source, SOURCE_SCHEMAS[args.table], args.out,
                                 args.checkpoint, args.date_column)
        print(json.dumps({"rows": run.rows}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
