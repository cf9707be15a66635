"""Session helpers for local runs, and the shared scratch location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", **settings: str) -> SparkSession:
    """A session for tests and the bench. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hourgrid")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("HOURGRID_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    A session in one process (a local test) without that setting gets a temporary
    folder. Any other raises: executors do not see each other's disks.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="hourgrid-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, so runs never collide."""
    return f"{shared_folder(spark).rstrip('/')}/hourgrid/{name}-{uuid.uuid4().hex}"
