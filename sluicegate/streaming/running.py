"""Starting, naming and reading the progress of the firewall's streaming queries."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

NAME_PREFIX = "sluicegate_"

# Stores a micro-batch: its rows, its number, and the name of the writer.
Writer = Callable[[DataFrame, int, str], None]

_ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Upload what changed in a batch instead of a full copy of the state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def query_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for the queries started inside the block.

    A query takes its settings when it starts, so the session's own are put back.
    """
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def start(
    stream: DataFrame,
    write: Writer,
    name: str,
    checkpoint: str,
    available_now: bool = False,
    every: str | None = None,
    state_partitions: int | None = None,
    suffix: str = "",
) -> StreamingQuery:
    """Start an append query that hands each micro-batch to ``write``.

    ``checkpoint`` must be on storage that survives the loss of any machine.
    ``state_partitions`` is the number of state stores, fixed for the life of the
    checkpoint; without it the session's number of shuffle partitions counts.
    ``suffix`` tells queries of the same kind in one session apart.
    """
    settings = dict(_ROCKSDB)
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    writer = (
        stream.writeStream.outputMode("append")
        .queryName(f"{NAME_PREFIX}{name}{suffix}")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda rows, batch_id: write(rows, batch_id, run_id(rows.sparkSession, checkpoint)))
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    with query_conf(stream.sparkSession, settings):
        return writer.start()


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in the checkpoint: the same after restarts, another elsewhere."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def stop_all(spark: SparkSession) -> list[str]:
    """Stop the firewall's own queries; others of the session keep running."""
    stopped = []
    for query in spark.streams.active:
        if (query.name or "").startswith(NAME_PREFIX):
            query.stop()
            stopped.append(query.name)
    return stopped


def dropped_late(query: StreamingQuery) -> int:
    """Groups of rows (source and window, per batch and task) that came too late.

    A lower bound of the number of events, over the progress that Spark still holds
    (``spark.sql.streaming.numRecentProgressUpdates``).
    """
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
