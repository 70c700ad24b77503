"""Session settings the firewall relies on, and its shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "sluicegate", master: str | None = None, **conf: object) -> SparkSession:
    """A session pinned to UTC with adaptive execution on.

    Shuffle partitions are left to the caller's ``conf``; adaptive execution
    coalesces them, so a large number is safe on a cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the checkpoint folder that the cluster shares.

    Only a local master may fall back to a temporary folder of this machine: on
    a cluster the executors could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="sluicegate-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
