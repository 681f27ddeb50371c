"""Connected components of an edge table by randomised contraction.

Each round every node joins the neighbour (or itself) with the smallest
fresh hash, and edges between nodes that joined the same one disappear.
The expected number of nodes falls by a constant factor a round, for chains
as for stars, so a few rounds do; the smallest identifier of each component
is found at the end by an aggregation.  Every round's tables are written to
the shared folder: a lost executor costs a re-read.  Nothing but the test
whether edges remain reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of ``edges``: component is the smallest
    node reachable.  Self-loops and edges with a null end count for nothing;
    repeated and reversed edges count once."""
    rest = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
                   .where("a <> b").distinct(), "cc-edges")
    maps: list[DataFrame] = []
    while not rest.isEmpty():
        def ranked(col: str, salt: int = len(maps)):
            return F.struct(F.xxhash64(F.lit(salt), col).alias("h"), F.col(col).alias("v"))

        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        joined = written(
            both.groupBy("a").agg(F.min(ranked("b")).alias("near")).select(
                F.col("a").alias("u"), F.least(ranked("a"), "near")["v"].alias("m")), "cc-map")
        maps.append(joined)
        rest = written(
            rest.join(joined.select(F.col("u").alias("a"), F.col("m").alias("ma")), "a")
            .join(joined.select(F.col("u").alias("b"), F.col("m").alias("mb")), "b")
            .where("ma <> mb")
            .select(F.least("ma", "mb").alias("a"), F.greatest("ma", "mb").alias("b")).distinct(),
            "cc-edges")
    if not maps:
        return rest.select(F.col("a").alias("node"), F.col("a").alias("component"))
    label = maps[0].select(F.col("u").alias("node"), "m")
    for step in maps[1:]:
        up = step.select(F.col("u").alias("m"), F.col("m").alias("m2"))
        label = label.join(up, "m", "left").select("node", F.coalesce("m2", "m").alias("m"))
    label = written(label, "cc-labels")
    smallest = label.groupBy("m").agg(F.min("node").alias("component"))
    return written(label.join(smallest, "m").select("node", "component"), "cc-nodes")
