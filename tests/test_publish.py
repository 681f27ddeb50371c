"""A layer is switched in one step: a build killed anywhere leaves the old one whole."""

from __future__ import annotations

import os
import signal
import subprocess
import sys

import pytest

from emporia.plans.gold import GOLD_BUILDERS
from emporia.plans.layers import Layers
from emporia.plans.pipeline import build_layers, read_layer, references, register_layer_tables, write_tables
from emporia.plans.silver import SILVER_BUILDERS, build_silver
from emporia.session import scratch_path
from emporia.sources import publish
from tests import fixtures

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import os, signal, sys
sys.path.insert(0, {repo!r})
from emporia.session import local_session
from emporia.plans import pipeline
from emporia.sources import publish
spark = local_session(2, shuffle_partitions=2)
base, moment = sys.argv[1:]
die = lambda: os.kill(os.getpid(), signal.SIGKILL)
tables = lambda n: {{f"t{{i}}": spark.range(n) for i in range(4)}}
pipeline.write_tables(spark, tables(3), base)
print("first", flush=True)
if moment.isdigit():
    write, done = pipeline._write_counted, []
    def counted(df, name, path):
        if len(done) == int(moment):
            die()
        done.append(name)
        return write(df, name, path)
    pipeline._write_counted = counted
elif moment == "before the manifest":
    publish.publish = lambda *a: die()
else:  # half a manifest
    def cut(spark, base, build, tables):
        fs, at = publish.file_system(spark, base + "/" + publish.PUBLISHED + "/0000000002")
        out = fs.create(at, False)
        out.write(bytearray(b'{{"t0": "_versions/x'))
        out.close()
        die()
    publish.publish = cut
pipeline.write_tables(spark, tables(100), base, parallelism=1)
"""


@pytest.mark.parametrize("moment", ["1", "3", "before the manifest", "in the manifest"])
def test_killed_builds_leave_the_old_layer_whole(spark, tmp_path, moment):
    base = str(tmp_path / "layer")
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO), base, moment], capture_output=True, text=True, timeout=300)
    assert "first" in run.stdout and run.returncode == -signal.SIGKILL, run.stderr[-2000:]
    names = [f"t{i}" for i in range(4)]
    assert {n: df.count() for n, df in read_layer(spark, base, names).items()} == dict.fromkeys(names, 3)
    write_tables(spark, {n: spark.range(7) for n in names}, base)
    assert {n: df.count() for n, df in read_layer(spark, base, names).items()} == dict.fromkeys(names, 7)


def test_readers_keep_their_files_and_old_ones_go(spark):
    base = scratch_path(spark, "layer")
    write_tables(spark, {"a": spark.range(1), "b": spark.range(1)}, base)
    old = read_layer(spark, base, ["a", "b"])
    write_tables(spark, {"a": spark.range(2)}, base)
    assert old["a"].count() == 1  # it began before
    assert {n: df.count() for n, df in read_layer(spark, base, ["a", "b"]).items()} == {"a": 2, "b": 1}
    for n in (3, 4, 5):
        write_tables(spark, {"a": spark.range(n)}, base)
    assert [m for m, _ in publish.manifests(spark, base)] == ["0000000004", "0000000005"]
    fs, where = publish.file_system(spark, f"{base}/{publish.VERSIONS}")
    assert len(fs.listStatus(where)) == 3  # two of a, and the one b is still in
    assert read_layer(spark, base, ["b"])["b"].count() == 1


def test_plain_folders_are_layers_too(spark):
    base = scratch_path(spark, "plain")
    spark.range(4).write.parquet(f"{base}/a")
    assert read_layer(spark, base, ["a"])["a"].count() == 4
    register_layer_tables(spark, "t_plain", base, ["a"])
    assert spark.table("t_plain.a").count() == 4
    spark.sql("DROP DATABASE t_plain CASCADE")


def test_references_of_the_gold_tables(spark):
    needs = references(GOLD_BUILDERS, Layers(fixtures.bronze(spark)).silver)
    assert needs["dim_sellers"] == {"silver_sellers"} and needs["dim_date"] == {"silver_orders"}
    assert needs["fact_order_items"] == {"silver_order_items", "silver_orders"}
    assert set().union(*needs.values()) <= set(SILVER_BUILDERS)


def test_layers_in_order_of_references_equal_layers_one_by_one(spark):
    bronze = fixtures.bronze(spark)
    s, g = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    report = build_layers(spark, bronze, s, g, "t_graph_silver", "t_graph_gold")
    silver = build_silver(bronze)
    for n, df in read_layer(spark, s, SILVER_BUILDERS).items():
        assert sorted(map(str, df.collect())) == sorted(map(str, silver[n].collect())), n
        assert report["silver"][n] == df.count()
    for n, df in read_layer(spark, g, GOLD_BUILDERS).items():
        assert sorted(map(str, df.collect())) == sorted(map(str, GOLD_BUILDERS[n](silver).collect())), n
    assert len(report["tests"]) == 19 and spark.table("t_graph_gold.dim_date").count() == report["gold"]["dim_date"]
    # a failing table publishes neither its layer nor one that needs it
    bad = bronze | {"orders": bronze["orders"].selectExpr("*").where("raise_error('broken') is null")}
    with pytest.raises(Exception, match="broken"):
        build_layers(spark, bad, s, g)
    assert {n: df.count() for n, df in read_layer(spark, g, GOLD_BUILDERS).items()} == report["gold"]
    for ns in ("t_graph_silver", "t_graph_gold"):
        spark.sql(f"DROP DATABASE {ns} CASCADE")
