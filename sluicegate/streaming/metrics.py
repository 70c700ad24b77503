"""Continuous window metrics."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluicegate.operators import metrics as measuring
from sluicegate.plans.pipeline import Firewall
from sluicegate.sources import tables
from sluicegate.streaming import idle, running
from sluicegate.streaming.running import Writer

_BEAT = "_heartbeat"


def watermarked(raw: DataFrame, firewall: Firewall) -> DataFrame:
    return raw.withWatermark("received_time", firewall.settings.watermark)


def with_beats(raw: DataFrame, beats: str, firewall: Firewall) -> DataFrame:
    """Merge the marker rows of a folder into the stream; they count towards the watermark only.

    The filter names the event time so that Spark keeps it behind the watermark.
    """
    idle.send_beat(raw.sparkSession, beats, datetime.fromtimestamp(0, timezone.utc))
    marks = raw.sparkSession.readStream.schema(idle.BEATS).parquet(beats)
    rows = marks.select(
        *[
            F.col("beat").alias(f.name) if f.name == "received_time" else F.lit(None).cast(f.dataType).alias(f.name)
            for f in raw.schema.fields
        ],
        F.lit(True).alias(_BEAT),
    )
    merged = watermarked(raw.withColumn(_BEAT, F.lit(False)).unionByName(rows), firewall)
    return merged.filter(~F.col(_BEAT) | F.col("received_time").isNull()).drop(_BEAT)


def timed(raw: DataFrame, checkpoint: str, firewall: Firewall, idle_close: float | None) -> DataFrame:
    return watermarked(raw, firewall) if idle_close is None else with_beats(raw, idle.folder(checkpoint), firewall)


def metrics_writer(root: str, firewall: Firewall) -> Writer:
    schema = measuring.schema(firewall.contract)

    def write(closed: DataFrame, batch_id: int, writer: str = tables.BATCH_JOB) -> None:
        with tables.packed(closed) as rows:
            tables.write_batch(rows, root, "dq_metrics", batch_id, F.col("window_start"), schema, writer=writer)

    return write


def start_metrics(
    raw: DataFrame,
    root: str,
    checkpoint: str,
    firewall: Firewall | None = None,
    idle_close: float | None = None,
    **trigger: object,
) -> StreamingQuery:
    """Store every window once the watermark has passed its end.

    Not needed beside ``start_alerts``, which stores the same table.

    Events later than the watermark no longer change a stored window; see
    :func:`running.dropped_late`.  ``idle_close`` closes what is open after so many seconds
    without input, see :mod:`sluicegate.streaming.idle`.
    """
    firewall = firewall or Firewall()
    metrics = firewall.dq_metrics(timed(raw, checkpoint, firewall, idle_close))
    query = running.start(metrics, metrics_writer(root, firewall), "metrics", checkpoint, **trigger)
    return idle.watch(query, checkpoint, firewall, idle_close)
