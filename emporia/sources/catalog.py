"""Catalog operators (S4, S6-S13): namespaces, path-backed tables, external
tables over existing Parquet, forced re-registration, refresh, views."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from emporia.sources.publish import file_system

#: The folder name of a null partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def quoted(name: str) -> str:
    """A dotted name with each part quoted."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in name.split("."))


def _text(value: str) -> str:
    """A value as a SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """CREATE DATABASE IF NOT EXISTS; with a location the namespace folder
    lives in shared storage instead of the local warehouse directory."""
    loc = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{loc}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def save_as_table(df: DataFrame, name: str, path: str, mode: str = "overwrite",
                  fmt: str = "parquet") -> None:
    """Path-backed (external) catalog table; the files outlive a DROP."""
    df.write.mode(mode).format(fmt).option("path", path).saveAsTable(name)


def register_parquet(spark: SparkSession, name: str, location: str,
                     replace: bool = False) -> None:
    """Idempotent registration of existing Parquet files as a table; with
    ``replace`` the table is dropped first (files are kept)."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(name)} USING PARQUET LOCATION {_text(location)}")
    refresh(spark, name)


def refresh(spark: SparkSession, name: str) -> None:
    """Drop the cached file listing after the files under a table change."""
    spark.catalog.refreshTable(name)


def create_view(spark: SparkSession, name: str, select: str) -> None:
    """A catalog view (it lasts beyond the session) over catalog tables."""
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS {select}")


def partition_folders(spark: SparkSession, location: str, by: list[str]) -> dict[tuple, str]:
    """Partition values (as text, None for null) -> folder, of every
    ``key=value`` folder below ``location``; one listing a level, no file is opened."""
    fs, base = file_system(spark, location)
    found: dict[tuple, str] = {(): str(base.toString())}
    for key in by:
        level = {}
        for values, folder in found.items():
            for f in fs.listStatus(file_system(spark, folder)[1]):
                name, _, value = f.getPath().getName().partition("=")
                if f.isDirectory() and name.lower() == key.lower():
                    level[(*values, None if value == NULL_FOLDER else unquote(value))] = str(f.getPath().toString())
        found = level
    return found


def _spec(by: list[str], values: tuple) -> str:
    """A partition's values; Spark casts the texts to the columns' types."""
    return ", ".join(f"{quoted(k)} = {'NULL' if v is None else _text(v)}" for k, v in zip(by, values))


def register_partitioned(spark: SparkSession, name: str, location: str, schema: StructType,
                         by: list[str]) -> None:
    """Register Parquet files in ``key=value`` folders as an external table
    whose partitions the catalog knows: a query lists only the folders it reads.
    ``schema`` holds the partition columns too; nothing is inferred.  A folder
    that a stream writes has a log, which Spark would read instead of partitions,
    so the table's own location is then an empty folder beside the log."""
    fs, log = file_system(spark, f"{location.rstrip('/')}/_spark_metadata")
    root = f"{location.rstrip('/')}/_table" if fs.exists(log) else location
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}"
                        for f in [*(f for f in schema.fields if f.name not in by), *(schema[k] for k in by)])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({columns}) USING PARQUET "
              f"PARTITIONED BY ({', '.join(map(quoted, by))}) LOCATION {_text(root)}")
    refresh_partitions(spark, name, location, by)


def known_partitions(spark: SparkSession, name: str) -> set[tuple]:
    """Partition values (as text) that the catalog knows."""
    def value(part: str) -> str | None:
        text = unquote(part.partition("=")[2])
        return None if text in (NULL_FOLDER, "null") else text

    return {tuple(value(p) for p in r["partition"].split("/")) for r in spark.sql(f"SHOW PARTITIONS {quoted(name)}").collect()}


def refresh_partitions(spark: SparkSession, name: str, location: str, by: list[str]) -> tuple[list[tuple], list[tuple]]:
    """Add the partitions whose folders are new and drop those whose folders
    are gone (files are never touched), then forget the files listed before.
    Returns the values added and dropped."""
    folders, known = partition_folders(spark, location, by), known_partitions(spark, name)
    added = sorted(folders.keys() - known, key=str)
    dropped = sorted(known - folders.keys(), key=str)
    for k in range(0, len(added), 500):
        parts = " ".join(f"PARTITION ({_spec(by, v)}) LOCATION {_text(folders[v])}" for v in added[k:k + 500])
        spark.sql(f"ALTER TABLE {quoted(name)} ADD IF NOT EXISTS {parts}")
    for v in dropped:
        spark.sql(f"ALTER TABLE {quoted(name)} DROP IF EXISTS PARTITION ({_spec(by, v)})")
    refresh(spark, name)
    return added, dropped
