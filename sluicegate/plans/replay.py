"""Replay of the quarantine: rejects are judged again, and those that pass are released once.

Rejects are told apart by a digest of their row; equal rows are judged once and released as
often as they occur.  A log next to the tables says of each digest how often it was tried
and whether it was released.  A run leaves out what was released, by an anti-join, and what
was tried often enough.  It writes the released events first, as a batch of its own that a
repeated run replaces, and the log last, so a run that broke off is done again whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate import schemas
from sluicegate.operators import routing
from sluicegate.plans.pipeline import Firewall
from sluicegate.sources import folders, tables

LOG = "replay_log"
WRITER = "replay"
LOG_SCHEMA = "row_hash binary, copies bigint, released boolean"
ATTEMPTS = 3


def with_hash(rejects: DataFrame) -> DataFrame:
    names = schemas.QUARANTINE_EVENTS.names
    text = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    return rejects.withColumn("row_hash", F.unhex(F.sha2(text, 256)))


def _log(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/{LOG}"
    if not folders.numbers(spark, path, tables.BATCH):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def history(spark: SparkSession, root: str) -> DataFrame:
    """(row_hash, attempts, released) of every reject that was judged again."""
    return _log(spark, root).groupBy("row_hash").agg(F.count("*").alias("attempts"), F.expr("bool_or(released) AS released"))


def replay(spark: SparkSession, root: str, firewall: Firewall, attempts: int = ATTEMPTS) -> int:
    """Judge the open rejects below ``root`` under another contract; the number of the run."""
    run = max(folders.numbers(spark, f"{root}/{LOG}", tables.BATCH), default=-1) + 1
    names = schemas.QUARANTINE_EVENTS.names
    rejects = with_hash(tables.read_table(spark, root, "quarantine_events"))
    # Combined before the shuffle: a reject that occurs very often is one row per task.
    different = rejects.groupBy("row_hash").agg(F.first(F.struct(*names)).alias("reject"), F.count("*").alias("copies"))
    done = history(spark, root).filter(F.col("released") | (F.col("attempts") >= attempts)).select("row_hash")
    pending = different.join(done, "row_hash", "left_anti").select("row_hash", "copies", "reject.*")
    raw = pending.withColumnsRenamed({"raw_event_ts": "event_ts", "quarantined_at": "received_time"}).drop("violations")
    judged = firewall.events_verdict(raw)
    passed = judged.filter("is_valid").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    clean = routing.clean_events(passed, "received_time")
    tables.write_batch(clean, root, "clean_events", run, F.col("received_time"), gather=True, writer=WRITER)
    log = judged.select("row_hash", "copies", F.col("is_valid").alias("released"))
    log.write.mode("overwrite").parquet(f"{root}/{LOG}/{tables.BATCH}={run}")
    return run


def open_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Stored rejects that no run has released."""
    released = history(spark, root).filter("released").select("row_hash")
    rejects = with_hash(tables.read_table(spark, root, "quarantine_events"))
    return rejects.join(released, "row_hash", "left_anti").drop("row_hash")
