"""Hot-key evidence from Spark's event log (no UI).

1. Hot product: derives a skewed Gold fact from the driver tables (a third
   of all line items, chosen by hash, re-pointed to one product), then runs
   Q2 twice with broadcasts disabled: the library's plan (fact aggregated
   per product before the dimension join) and a plain join-then-group plan.
2. Hot order: re-points a third of all Silver line items to one existing
   order and builds the Gold enrichment join (``fact_order_items``) with
   broadcasts disabled, once with AQE's skew-join split and once without
   (skew thresholds scaled down to the test size); both must give the same
   rows.  AQE splits a skewed partition at map-task boundaries; every test
   input is a single row group (one map task), so the derived items are
   first spread over 16 tasks, as a multi-file input would be.

For each run it prints, per stage, the task count and the max / median
shuffle records read per task, read from the event log in a scratch
folder.

    python tools/skew_report.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from emporia.functions.money import exact_sum  # noqa: E402
from emporia.plans.gold import fact_order_items  # noqa: E402
from emporia.plans.layers import Layers  # noqa: E402
from emporia.plans.questions import q2_category_revenue, q7_review_by_category  # noqa: E402
from emporia.session import local_session  # noqa: E402


def stage_stats(log_dir: str, job_group: str) -> list[tuple]:
    files = [f for f in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(f)]
    jobs_of_group, stages_of_job, tasks = set(), {}, {}
    for f in files:
        with open(f) as fh:
            for line in fh:
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart":
                    props = e.get("Properties", {})
                    if props.get("spark.jobGroup.id") == job_group:
                        jobs_of_group.add(e["Job ID"])
                        stages_of_job[e["Job ID"]] = e["Stage IDs"]
                elif ev == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    sr = m.get("Shuffle Read Metrics", {})
                    recs = sr.get("Total Records Read", 0)
                    tasks.setdefault(e["Stage ID"], []).append(recs)
    out = []
    wanted = sorted({s for j in jobs_of_group for s in stages_of_job[j]})
    for s in wanted:
        t = tasks.get(s)
        if t and max(t) > 0:
            out.append((s, len(t), max(t), statistics.median(t), sum(t)))
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = local_session(8, shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    lay = Layers.from_driver(spark, sf)
    items = lay.gold["fact_order_items"]
    third = F.pmod(F.xxhash64("order_id", "order_item_id"), F.lit(3)) == 0
    hot = items.withColumn("product_id", F.when(third, F.lit(0)).otherwise(F.col("product_id")))
    gold = {"fact_order_items": hot, "dim_products": lay.gold["dim_products"]}
    share = hot.filter("product_id = 0").count() / hot.count()
    print(f"hot product share of items: {share:.2%}")

    sc = spark.sparkContext
    sc.setJobGroup("eager", "eager")
    a = q2_category_revenue(gold, limit=None).collect()
    sc.setJobGroup("naive", "naive")
    j = hot.join(lay.gold["dim_products"], "product_id")
    b = (j.groupBy("product_category_name_english")
         .agg(F.round(F.sum("price"), 2).alias("category_revenue")).collect())
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))

    # -- hot order: the fact enrichment join --------------------------------
    orders = lay.silver["silver_orders"]
    hot_id = orders.agg(F.min("order_id")).first()[0]
    hot_items = lay.silver["silver_order_items"].withColumn(
        "order_id", F.when(third, F.lit(hot_id)).otherwise(F.col("order_id"))).repartition(16)
    fact = fact_order_items({"silver_order_items": hot_items, "silver_orders": orders})
    summary = fact.agg(F.count(F.lit(1)).alias("rows"), exact_sum("price").alias("total"),
                       F.count_if(F.col("order_id") == hot_id).alias("hot_rows"))
    for k, v in {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
                 "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
                 "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}.items():
        spark.conf.set(k, v)
    results = {}
    for group, split in (("hot_order_split", "true"), ("hot_order_nosplit", "false")):
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", split)
        sc.setJobGroup(group, group)
        run = summary.select("*")  # a fresh plan per setting
        results[group] = run.collect()[0]
        plan = run._jdf.queryExecution().executedPlan().toString()
        print(f"{group}: {results[group].asDict()}, skew split in plan: {'skew=true' in plan}")
    assert results["hot_order_split"] == results["hot_order_nosplit"]

    # -- hot order: Q7's review join, without any help from AQE ---------------
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    hot_fact = items.withColumn("order_id", F.when(third, F.lit(hot_id)).otherwise(F.col("order_id"))).repartition(16)
    reviews = lay.gold["fact_order_reviews"]
    sc.setJobGroup("q7_heavy_apart", "q7_heavy_apart")
    a = q7_review_by_category({"fact_order_items": hot_fact, "fact_order_reviews": reviews,
                               "dim_products": lay.gold["dim_products"]}).collect()
    sc.setJobGroup("q7_plain", "q7_plain")
    b = (reviews.join(hot_fact, "order_id").join(lay.gold["dim_products"], "product_id")
         .groupBy("product_category_name_english").agg(F.count("review_score").alias("n")).collect())
    assert sorted((r[0], r[2]) for r in a) == sorted(map(tuple, b))
    spark.stop()
    for group in ("eager", "naive", "hot_order_split", "hot_order_nosplit", "q7_heavy_apart", "q7_plain"):
        print(f"== {group}: stage, tasks, max records/task, median, total shuffle records")
        for row in stage_stats(log_dir, group):
            print("  ", row)


if __name__ == "__main__":
    main()
