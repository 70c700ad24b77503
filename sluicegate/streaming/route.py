"""Continuous contract check and routing into the clean and quarantine tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluicegate.plans.pipeline import Firewall
from sluicegate.sources import tables, wire
from sluicegate.streaming import running
from sluicegate.streaming.running import Writer

def lane_writer(root: str, firewall: Firewall | None = None) -> Writer:
    """Writes one judged micro-batch to both lanes in one pass.

    The batch's folder is replaced as a whole, so a repeated batch leaves the same rows.
    """
    contract = (firewall or Firewall()).contract

    def write(judged: DataFrame, batch_id: int, writer: str = tables.BATCH_JOB) -> None:
        tables.write_judged(judged, root, batch_id, contract, writer)

    return write


def start_undecodable(decoded: DataFrame, root: str, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Keep the messages that could not be decoded, beside the two lanes."""

    def write(messages: DataFrame, batch_id: int, writer: str = tables.BATCH_JOB) -> None:
        tables.write_batch(messages, root, "undecodable_messages", batch_id, F.col("received_time"), writer=writer)

    return running.start(wire.undecodable(decoded), write, "undecodable", checkpoint, **trigger)


def start_routing(
    raw: DataFrame, root: str, checkpoint: str, firewall: Firewall | None = None, **trigger: object
) -> StreamingQuery:
    """Route a raw event stream.  Stateless, so late events are routed like any other."""
    firewall = firewall or Firewall()
    return running.start(firewall.events_verdict(raw), lane_writer(root, firewall), "routing", checkpoint, **trigger)
