"""Session construction and shared scratch storage.

Every file a job writes on its own behalf (checkpoints, CSV/Parquet round
trips, saved models, streaming state) goes under the folder the cluster names
in ``spark.checkpoint.dir``.  Only a session whose master is ``local`` may do
without: it gets a temporary folder that is removed when the process ends.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Fixed session defaults: UTC wall clock, ANSI arithmetic, adaptive execution.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "hourcast", extra: dict | None = None) -> SparkSession:
    """A session with the defaults above.

    The master and the number of shuffle partitions are only set when they are
    passed: a cluster's own settings, or those of a session that exists, stay.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only for a local master without the setting."""
    global _LOCAL_FALLBACK
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder when the master is {sc.master}")
        if _LOCAL_FALLBACK is None:
            _LOCAL_FALLBACK = tempfile.TemporaryDirectory(prefix="hourcast-ckpt-")
        configured = _LOCAL_FALLBACK.name
    sc.setCheckpointDir(configured)
    # Spark appends a random sub folder; keep our own files beside its files.
    return sc.getCheckpointDir().rstrip("/")


_LOCAL_FALLBACK: tempfile.TemporaryDirectory | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def is_directory(spark: SparkSession, path: str) -> bool:
    """True when ``path`` is a directory, on any Hadoop-compatible file system; a failed
    look-up is an error, not an answer."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath) and fs.getFileStatus(hpath).isDirectory())


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
