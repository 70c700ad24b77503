"""Continuous forecasts and alerts, chained behind the window metrics.

Spark refuses window functions on a stream, so the newest rates of each source are a
table beside the checkpoint, see :mod:`sluicegate.streaming.kept`; forecast, status and
time to breach are the same expressions as in a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluicegate.operators import alerts as alerting
from sluicegate.operators import metrics as measuring
from sluicegate.plans.pipeline import Firewall
from sluicegate.settings import Settings
from sluicegate.sources import tables
from sluicegate.streaming import idle, running
from sluicegate.streaming.board import LiveBoard
from sluicegate.streaming.kept import Tails
from sluicegate.streaming.metrics import timed
from sluicegate.streaming.running import Writer


def tails_of(checkpoint: str, depth: int, settings: Settings) -> Tails:
    return Tails(f"{checkpoint.rstrip('/')}-tails", depth, settings)


@contextmanager
def with_recent(closed: DataFrame, batch_id: int, tails: Tails, tasks: int | None = None) -> Iterator[DataFrame]:
    """Windows that a batch closed, with their recent rates, computed once; then the tails move on.

    They are held in ``tasks`` partitions at most, as each table written reads them all.
    """
    with tables.packed(closed, tasks) as rows:
        known = tails.known(rows, batch_id)
        known = (known.coalesce(tasks) if tasks else known).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield known
            tails.keep(known, batch_id)
        finally:
            known.unpersist()


def alert_writer(root: str, firewall: Firewall, tails: Tails) -> Writer:
    """Writes the metrics of the closed windows and both alert tables on them."""
    schema = measuring.schema(firewall.contract)

    def write(closed: DataFrame, batch_id: int, writer: str = tables.BATCH_JOB, tasks: int | None = None) -> None:
        with with_recent(closed, batch_id, tails, tasks) as rows:
            full = alerting.alerts_from_recent(rows, firewall.settings, firewall.contract)
            simple = alerting.alerts_simple_from_recent(rows, firewall.settings, firewall.contract)
            tables.write_batch(rows, root, "dq_metrics", batch_id, F.col("window_start"), schema, writer=writer)
            tables.write_batch(full, root, "dq_alerts", batch_id, F.col("ts"), writer=writer)
            tables.write_batch(simple, root, "dq_alerts_simple", batch_id, F.col("ts"), writer=writer)

    return write


def serving_writer(root: str, firewall: Firewall, tails: Tails) -> Writer:
    """Writes the serving alerts of the closed windows, and keeps the live board."""
    board = LiveBoard(root, firewall.settings)

    def write(closed: DataFrame, batch_id: int, writer: str = tables.BATCH_JOB) -> None:
        with with_recent(closed, batch_id, tails) as rows:
            served = alerting.serving_alerts_from_recent(rows, firewall.settings, firewall.contract)
            tables.write_batch(served, root, "serving_alerts", batch_id, F.col("ts"), writer=writer)
            board.update(served, batch_id, writer)

    return write


def start_alerts(
    raw: DataFrame,
    root: str,
    checkpoint: str,
    firewall: Firewall | None = None,
    idle_close: float | None = None,
    **trigger: object,
) -> StreamingQuery:
    """Metrics, alerts and simple alerts from one scan of the stream."""
    firewall = firewall or Firewall()
    metrics = firewall.dq_metrics(timed(raw, checkpoint, firewall, idle_close))
    tails = tails_of(checkpoint, firewall.settings.train_max, firewall.settings)
    query = running.start(metrics, alert_writer(root, firewall, tails), "alerts", checkpoint, **trigger)
    return idle.watch(query, checkpoint, firewall, idle_close)


def start_serving_alerts(
    raw: DataFrame,
    root: str,
    checkpoint: str,
    firewall: Firewall | None = None,
    idle_close: float | None = None,
    **trigger: object,
) -> StreamingQuery:
    """The serving variant.  Blank sources count as one, so it groups for itself."""
    firewall = firewall or Firewall()
    metrics = firewall.serving_metrics(timed(raw, checkpoint, firewall, idle_close))
    tails = tails_of(checkpoint, firewall.settings.damped_points, firewall.settings)
    query = running.start(metrics, serving_writer(root, firewall, tails), "serving_alerts", checkpoint, **trigger)
    return idle.watch(query, checkpoint, firewall, idle_close)
