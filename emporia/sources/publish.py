"""Layers published in one step.

The tables of a build are written to a folder of their own, ``_versions/<id>``,
and nothing that is there is touched.  The build becomes the layer when a
numbered manifest (table -> folder) is created in ``_published``; readers take
the manifest with the highest number.  A process killed at any moment therefore
leaves the old layer whole, and a reader that began before goes on with the old
files: the manifests before the newest, ``keep`` in all, keep their folders.

A manifest names all tables of the layer, those that the build didn't write with
the folder they were in.  A number is taken by creating its file, which fails if
it exists; a manifest cut off while it was written isn't valid JSON and counts for nothing.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession

VERSIONS, PUBLISHED = "_versions", "_published"
#: Age from which the folder of a build that was never published is litter.
STALE_SECONDS = 7 * 24 * 3600
#: How long a manifest that another build is writing is waited for.
WAIT_SECONDS = 5.0


def file_system(spark: SparkSession, path: str):
    """(file system, path) on whatever storage the path names."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def file_stamps(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """(name, bytes, time) of all files below a folder."""
    fs, where = file_system(spark, folder)
    found, files = [], fs.listFiles(where, True)
    while files.hasNext():
        f = files.next()
        found.append((str(f.getPath().toString()), f.getLen(), f.getModificationTime()))
    return sorted(found)


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, where = file_system(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def _manifest(spark: SparkSession, base: str, number: str) -> dict[str, str] | None:
    fs, where = file_system(spark, f"{base}/{PUBLISHED}/{number}")
    jvm = spark.sparkContext._jvm
    stream = fs.open(where)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def manifests(spark: SparkSession, base: str) -> list[tuple[str, dict[str, str]]]:
    """(number, table -> folder under ``base``) of every valid manifest, oldest first."""
    base = base.rstrip("/")
    found = ((n, _manifest(spark, base, n)) for n in _names(spark, f"{base}/{PUBLISHED}") if n.isdigit())
    return [(n, m) for n, m in found if m is not None]


def current(spark: SparkSession, base: str) -> dict[str, str]:
    """Table -> folder of the layer under ``base``."""
    base = base.rstrip("/")
    for number in reversed(_names(spark, f"{base}/{PUBLISHED}")):
        if number.isdigit():
            found = _manifest(spark, base, number)
            if found is not None:
                return {t: f"{base}/{folder}" for t, folder in found.items()}
    return {}


def table_path(spark: SparkSession, base: str, table: str) -> str:
    """Where a table of the layer lies; without a published one, the folder of its name."""
    return current(spark, base).get(table, f"{base.rstrip('/')}/{table}")


def new_build(base: str) -> str:
    """The folder, under ``base``, of a new build."""
    return f"{VERSIONS}/{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, base: str, build: str, tables: list[str], without: tuple[str, ...] = (),
            keep: int = 2) -> str:
    """Make the build's tables the layer's, in one step, which then has none of
    those ``without``; returns the number."""
    base = base.rstrip("/")
    fs, folder = file_system(spark, f"{base}/{PUBLISHED}")
    fs.mkdirs(folder)
    java = spark.sparkContext._jvm.java.io
    deadline = time.monotonic() + WAIT_SECONDS
    while True:
        taken = [n for n in _names(spark, f"{base}/{PUBLISHED}") if n.isdigit()]
        held = manifests(spark, base)
        if taken and (not held or held[-1][0] < taken[-1]) and time.monotonic() < deadline:
            time.sleep(0.1)  # the newest is being written, or was cut off
            continue
        before = {t: f for t, f in (held[-1][1] if held else {}).items() if t not in without}
        tables_now = before | {t: f"{build}/{t}" for t in tables}
        number = f"{int(taken[-1]) + 1 if taken else 1:010d}"
        try:
            stream = fs.create(file_system(spark, f"{base}/{PUBLISHED}/{number}")[1], False)
        except Exception as e:  # another build took the number
            if "FileAlreadyExists" not in str(e):
                raise
            continue
        writer = java.OutputStreamWriter(stream, "UTF-8")
        writer.write(json.dumps(tables_now))
        writer.close()
        _sweep(spark, base, keep)
        return number


def remove(spark: SparkSession, path: str) -> None:
    fs, where = file_system(spark, path)
    fs.delete(where, True)


def discard(spark: SparkSession, base: str, build: str) -> None:
    """Remove the folder of a build that won't be published."""
    remove(spark, f"{base.rstrip('/')}/{build}")


def _sweep(spark: SparkSession, base: str, keep: int) -> None:
    """Drop manifests but the last ``keep``, and folders none of those names."""
    held = manifests(spark, base)
    used = {folder.split("/")[1] for _, m in held[-keep:] for folder in m.values()}
    for number, _ in held[:-keep]:
        remove(spark, f"{base}/{PUBLISHED}/{number}")
    once = {folder.split("/")[1] for _, m in held[:-keep] for folder in m.values()}
    for name in _names(spark, f"{base}/{VERSIONS}"):
        fs, where = file_system(spark, f"{base}/{VERSIONS}/{name}")
        age = time.time() - fs.getFileStatus(where).getModificationTime() / 1000
        if name not in used and (name in once or age > STALE_SECONDS):
            fs.delete(where, True)
