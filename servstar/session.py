"""Session construction and shared storage locations.

Jobs write intermediate and materialised tables under the folder the cluster
names in ``spark.checkpoint.dir``; a local default is set only when the session
has none (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "servstar",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session for the CLI, bench and tests. Library functions take any
    SparkSession and give the same results without these settings (checked in
    a plain session with another time zone and ANSI off); they are runtime
    choices: UTC, AQE with skew-join splitting, no UI."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    storage_root(spark)
    return spark


def storage_root(spark: SparkSession) -> str:
    """Shared folder for written tables: ``spark.checkpoint.dir``.

    When unset, a private folder is created and registered as the checkpoint
    dir — in local mode only (tests, laptops); on a cluster this is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: written tables "
                               "and checkpoints must survive the loss of any one machine")
        root = tempfile.mkdtemp(prefix="servstar-")
        sc.setCheckpointDir(root)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared storage root."""
    return f"{storage_root(spark)}/servstar/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str | None:
    """Filesystem path for ``file:`` / bare paths, else None (remote store)."""
    if path.startswith("file:"):
        return path[len("file:"):]
    if "://" in path:
        return None
    return os.path.abspath(path)
