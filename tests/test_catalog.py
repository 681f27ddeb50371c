"""Catalog operators: namespaces, path-backed tables, external tables,
forced re-registration and refresh after overwrite."""

from __future__ import annotations

from emporia.session import scratch_path
from emporia.sources import catalog, publish
from emporia.sources.files import write_parquet


def test_register_drop_keeps_files_and_refresh(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    loc = scratch_path(spark, "tcat")
    write_parquet(df, loc)
    catalog.create_namespace(spark, "t_cat", scratch_path(spark, "t_cat_db"))
    catalog.register_parquet(spark, "t_cat.t1", loc)
    assert catalog.read_table(spark, "t_cat.t1").count() == 10
    catalog.register_parquet(spark, "t_cat.t1", loc, replace=True)  # files survive the drop
    assert catalog.read_table(spark, "t_cat.t1").count() == 10
    write_parquet(spark.range(3).withColumnRenamed("id", "k"), loc)
    catalog.refresh(spark, "t_cat.t1")
    assert catalog.read_table(spark, "t_cat.t1").count() == 3


def test_save_as_table_path_backed(spark):
    loc = scratch_path(spark, "tsat")
    catalog.create_namespace(spark, "t_cat", scratch_path(spark, "t_cat_db"))
    catalog.save_as_table(spark.range(5), "t_cat.t2", loc)
    assert catalog.read_table(spark, "t_cat.t2").count() == 5
    assert spark.read.parquet(loc).count() == 5


def test_partitions_are_found_added_and_dropped_one_by_one(spark):
    loc = scratch_path(spark, "tpart")
    rows = spark.createDataFrame([(1, 2017, "a"), (2, 2017, "b c/d"), (3, None, "a"), (4, 2018, None)], "k int, year int, tag string")
    rows.where("k < 4").write.partitionBy("year", "tag").parquet(loc)
    catalog.create_namespace(spark, "t_cat", scratch_path(spark, "t_cat_db"))
    catalog.register_partitioned(spark, "t_cat.parts", loc, rows.schema, ["year", "tag"])
    assert sorted(map(tuple, spark.table("t_cat.parts").collect()), key=str) == sorted(
        [(1, 2017, "a"), (2, 2017, "b c/d"), (3, None, "a")], key=str)
    rows.where("k = 4").write.mode("append").partitionBy("year", "tag").parquet(loc)
    rows.where("k = 1").selectExpr("k + 10 AS k", "year", "tag").write.mode("append").partitionBy("year", "tag").parquet(loc)
    assert catalog.refresh_partitions(spark, "t_cat.parts", loc, ["year", "tag"]) == ([("2018", None)], [])
    assert sorted(r["k"] for r in spark.table("t_cat.parts").collect()) == [1, 2, 3, 4, 11]
    assert [r["k"] for r in spark.table("t_cat.parts").where("year = 2018").collect()] == [4]
    publish.remove(spark, f"{loc}/year=2018")
    assert catalog.refresh_partitions(spark, "t_cat.parts", loc, ["year", "tag"]) == ([], [("2018", None)])
    assert spark.table("t_cat.parts").count() == 4
    # a query lists the folders of its partitions alone
    files = spark.table("t_cat.parts").where("year = 2017 AND tag = 'a'").inputFiles()
    assert files and all("year=2017" in f and "tag=a" in f for f in files)
    spark.sql("DROP TABLE t_cat.parts")
    assert spark.read.parquet(loc).count() == 4  # the files outlive the table
