"""Session helpers: a local session for tests / bench and the shared scratch
folder used for written tables.

On a cluster the scratch root is the shared folder named by
``spark.checkpoint.dir``; it is only set here when the session has none
(local tests), never overridden.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "emporia", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.fileCompressionFactor", "4")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for a remote (Spark Connect) session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written tables: ``spark.checkpoint.dir`` (or
    the context's checkpoint folder).  Only a local-mode session that names
    none (tests, local runs) gets a private ``/tmp/run-*`` folder, set as
    the context's checkpoint folder; a cluster session without a shared
    folder is an error.  A core config is never modified."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = _context(spark)
    if sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        if configured:
            return configured
        current = sc.getCheckpointDir()
        if current:
            return current
    if sc is None or not sc.master.startswith("local"):
        # a folder on the driver's disk is not visible to executors
        raise RuntimeError("no shared scratch folder: set spark.checkpoint.dir "
                           "to a folder every executor can reach")
    local = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sc.setCheckpointDir(local)
    return local


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint`` has a folder (the configured
    shared one, or a private one when none is configured); returns the
    scratch root."""
    root = scratch_root(spark)
    sc = _context(spark)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared scratch root for one written
    table.  Unique per call so a re-run never overwrites a path that a
    running plan still reads.  All paths of an application lie in one folder
    that the file system drops when the application ends."""
    return f"{_application_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_FOLDERS: dict[str, str] = {}


def _application_folder(spark: SparkSession) -> str:
    root = scratch_root(spark).rstrip("/")
    sc = _context(spark)
    if sc is None:  # a Connect session has no handle on the file system
        return f"{root}/emporia/connect"
    if sc.applicationId not in _FOLDERS:
        folder = f"{root}/emporia/{sc.applicationId}-{uuid.uuid4().hex[:6]}"
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)  # takes only paths that exist
        _FOLDERS[sc.applicationId] = folder
    return _FOLDERS[sc.applicationId]


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per application.
    Functions that run there import it, wherever the driver found it."""
    sc = _context(spark)
    if sc is None or sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="emporia-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "emporia.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(base, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


__all__ = ["local_session", "ensure_checkpoint_dir", "scratch_root", "scratch_path", "ship_package", "SCALE_CONF",
           "apply_scale_defaults"]


# Suggested settings for a large cluster (documentation and a starting
# point; the session owner decides).  Shuffle partitions should be about
# the largest stage's shuffle bytes / advisory size; AQE coalesces down.
SCALE_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # split a hot join partition even when that costs an extra shuffle
    # (chains of joins on one key, e.g. order enrichment then reviews)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Parquet size estimates are compressed bytes; scale them so a side
    # is broadcast only when its decoded size fits the threshold.
    "spark.sql.sources.fileCompressionFactor": "4",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.session.timeZone": "UTC",
}

# Settings the session owner sizes for the cluster and data at hand; the
# helper below never sets them.
OWNER_KEYS = frozenset({"spark.sql.shuffle.partitions", "spark.sql.session.timeZone"})


def apply_scale_defaults(spark: SparkSession, conf: dict[str, str] | None = None) -> dict[str, str]:
    """Set each runtime SQL setting of ``SCALE_CONF`` that the session has
    not set explicitly (launcher, ``--conf`` and spark-defaults win); shuffle
    partitions and the time zone stay with the session owner.  Returns the
    settings applied."""
    applied = {}
    for key, value in (SCALE_CONF if conf is None else conf).items():
        if key in OWNER_KEYS or spark.conf.get(key, None) is not None:
            continue
        spark.conf.set(key, value)
        applied[key] = value
    return applied
