"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

_local_root: tempfile.TemporaryDirectory | None = None


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("weirgate")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if _local_root is None:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_root.name


def provide_local_root(spark: SparkSession) -> None:
    """For entry points that are handed a local session without the setting, which cannot be made once it runs.

    Such a process gets one folder, which goes when the process ends. Sessions on a cluster get none.
    """
    global _local_root
    unset = not spark.conf.get("spark.checkpoint.dir", None)
    if unset and _local_root is None and spark.conf.get("spark.master", "").startswith("local["):
        _local_root = tempfile.TemporaryDirectory(prefix="weirgate-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for one intermediate table."""
    return f"{shared_root(spark)}/weirgate/{label}-{uuid4().hex}"
