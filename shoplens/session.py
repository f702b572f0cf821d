"""Spark session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC clock, AQE re-planning (coalesce small
# shuffle partitions, split skewed join partitions), ANSI arithmetic.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "shoplens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the shared defaults.

    ``shuffle_partitions`` should be sized to the data: roughly
    total shuffle bytes / 128 MB on a cluster; AQE coalesces the rest.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for lineage cuts and intermediate tables.

    Read from ``spark.checkpoint.dir``. Only where it is unset and Spark runs
    on this machine alone (tests) a private folder is created and registered;
    on a cluster that is an error, as executors would write to their own disks.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="shoplens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared folder for a written intermediate table."""
    base = shared_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")
