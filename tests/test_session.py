"""The driver contract works in a session that names no checkpoint
folder (no core config is modified; a private scratch folder is used)."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
import __spark_entry__ as E
assert E.entry(spark).count() > 0
for k in ("csv_roundtrip", "scan_catalog", "q1_monthly_revenue"):
    assert E.queries()[k](spark, "/root/testdata/sf0.001").count() > 0, k
print("OK", spark.sparkContext.getCheckpointDir())
"""


def test_contract_without_checkpoint_config():
    conf_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    with open(os.path.join(conf_dir, "spark-defaults.conf"), "w") as f:
        f.write("spark.ui.enabled false\\n")
    env = {**os.environ, "SPARK_CONF_DIR": conf_dir}
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "OK" in out.stdout and "/tmp/run-" in out.stdout


def test_cluster_session_without_shared_folder_is_refused():
    """On a cluster a driver-local /tmp folder would be invisible to the
    executors: with no spark.checkpoint.dir the scratch root is an error."""
    import pytest

    from emporia.session import scratch_root

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Context:
        master = "spark://cluster:7077"

        def getConf(self):
            return _Conf()

        def getCheckpointDir(self):
            return None

        def setCheckpointDir(self, path):  # must not be reached
            raise AssertionError(path)

    class _Session:
        conf = _Conf()
        sparkContext = _Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(_Session())


def test_scale_defaults_fill_only_unset_settings():
    """The cluster settings are applied where the launcher set nothing; an
    explicit setting and the owner's keys are left alone."""
    from emporia.session import SCALE_CONF, apply_scale_defaults

    class _Conf:
        def __init__(self, values):
            self.values = dict(values)

        def get(self, key, default=None):
            return self.values.get(key, default)

        def set(self, key, value):
            self.values[key] = value

    class _Session:
        conf = _Conf({"spark.sql.adaptive.skewJoin.skewedPartitionFactor": "9"})

    s = _Session()
    applied = apply_scale_defaults(s)
    assert s.conf.values["spark.sql.adaptive.skewJoin.skewedPartitionFactor"] == "9"
    assert "spark.sql.shuffle.partitions" not in s.conf.values
    assert "spark.sql.session.timeZone" not in s.conf.values
    assert s.conf.values["spark.sql.files.maxPartitionBytes"] == SCALE_CONF[
        "spark.sql.files.maxPartitionBytes"]
    assert set(applied) == set(SCALE_CONF) - {
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.shuffle.partitions",
        "spark.sql.session.timeZone"}
    assert apply_scale_defaults(s) == {}  # idempotent
