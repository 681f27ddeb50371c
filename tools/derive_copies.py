"""Derive an N-fold copy of the driver tables for scale runs of bench.py.

Every row of the seven tables the adapter reads is repeated N times; copy i
offsets each key domain (orders, customers, parts, suppliers) by
i * (largest key + 1), so keys stay unique per copy and every join keeps
its fan-out.  nation and region are copied once.  Rows are repeated with a
generator (explode of a sequence), not a join, and each copy is written as
its own file, as a large table lands in many files (the driver's tables are
one file and one row group each, which would make every scan one task).

    python tools/derive_copies.py SF_DIR OUT_DIR N
    BENCH_SF_DIR=OUT_DIR python bench.py
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from emporia.session import local_session  # noqa: E402

# table -> {column: key domain}
KEYS = {
    "customer": {"c_custkey": "cust"},
    "supplier": {"s_suppkey": "supp"},
    "part": {"p_partkey": "part"},
    "orders": {"o_orderkey": "order", "o_custkey": "cust"},
    "lineitem": {"l_orderkey": "order", "l_partkey": "part", "l_suppkey": "supp"},
}
DOMAIN_OF = {"order": ("orders", "o_orderkey"), "cust": ("customer", "c_custkey"),
             "part": ("part", "p_partkey"), "supp": ("supplier", "s_suppkey")}


def main() -> None:
    src, dst, n = sys.argv[1].rstrip("/"), sys.argv[2].rstrip("/"), int(sys.argv[3])
    spark = local_session(8)

    def read(t):
        return spark.read.parquet(f"{src}/{t}.parquet")

    # one global aggregate per domain (a single row each)
    span = {d: read(t).agg(F.max(c)).first()[0] + 1 for d, (t, c) in DOMAIN_OF.items()}
    for t in ("nation", "region"):
        read(t).write.mode("overwrite").parquet(f"{dst}/{t}.parquet")
    for t, cols in KEYS.items():
        df = read(t).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        df = df.withColumns({c: F.col(c) + F.col("_copy") * F.lit(span[d]).cast("bigint")
                             for c, d in cols.items()})
        (df.repartitionByRange(n, "_copy").drop("_copy")
         .write.mode("overwrite").parquet(f"{dst}/{t}.parquet"))
        print(t, spark.read.parquet(f"{dst}/{t}.parquet").count())
    spark.stop()


if __name__ == "__main__":
    main()
