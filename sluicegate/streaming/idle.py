"""Closing windows when no input comes any more.

A window closes when the watermark passes its end, and only data moves the watermark.
Once a query has read all there is and nothing came for a while, a beat is sent: a marker
row in a small folder beside the checkpoint, which the query reads as a second input.  It
lies just behind the newest event, so it closes what is open and nothing more.  The clock
never enters the watermark, and a backlog, which is input, is never cut short by it.

Events that come after all, older than the windows closed, are late as they would be
behind any newer event.
"""

from __future__ import annotations

import threading
import time
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from sluicegate.plans.pipeline import Firewall

BEATS = "beat timestamp"
_LOOK_SECONDS = 0.5


def folder(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-beats"


def send_beat(spark: SparkSession, beats: str, moment: datetime) -> None:
    micros = (moment - datetime.fromtimestamp(0, timezone.utc)) // timedelta(microseconds=1)
    spark.range(1).selectExpr(f"timestamp_micros({micros}L) AS beat").coalesce(1).write.mode("append").parquet(beats)


def _behind(query: StreamingQuery, firewall: Firewall) -> datetime | None:
    """A moment that closes all windows open: behind the newest event by more than a window."""
    progress = query.lastProgress
    mark = (progress or {}).get("eventTime", {}).get("watermark")
    newest = [p["eventTime"]["max"] for p in query.recentProgress if "max" in p.get("eventTime", {})]
    if not newest and (not mark or mark.startswith("1970")):
        return None
    delay = duration(firewall.settings.watermark)
    at = [datetime.fromisoformat(n) for n in newest] + [datetime.fromisoformat(mark) + delay] * bool(mark)
    return max(at) + delay + timedelta(seconds=firewall.settings.window_seconds)


def duration(text: str) -> timedelta:
    number, unit = text.split()
    return timedelta(**{unit if unit.endswith("s") else f"{unit}s": float(number)})


def watch(query: StreamingQuery, checkpoint: str, firewall: Firewall, idle_close: float | None) -> StreamingQuery:
    """Send a beat whenever the query had no input for ``idle_close`` seconds."""
    if idle_close is None:
        return query
    spark, beats = query.sparkSession if hasattr(query, "sparkSession") else SparkSession.active(), folder(checkpoint)

    def look() -> None:
        batch, since, sent = None, time.monotonic(), False
        while query.isActive:
            progress = query.lastProgress
            if progress and progress["batchId"] != batch:
                batch = progress["batchId"]
                read = [s["numInputRows"] for s in progress["sources"] if beats.rsplit("/", 1)[-1] not in s["description"]]
                if sum(read):
                    since, sent = time.monotonic(), False
            busy = query.status["isTriggerActive"] and query.status["isDataAvailable"]
            if not sent and not busy and time.monotonic() - since >= idle_close:
                if moment := _behind(query, firewall):
                    send_beat(spark, beats, moment)
                    sent = True
            time.sleep(_LOOK_SECONDS)

    threading.Thread(target=look, name=f"{query.name}-idle", daemon=True).start()
    return query


def run_to_end(start, checkpoint: str, firewall: Firewall | None = None) -> None:
    """Run a bounded stream until its last window is closed.

    ``start`` starts the query with ``available_now=True`` and an ``idle_close``; it runs
    once for the input and once more for a beat behind the newest event.
    """
    first = start()
    first.awaitTermination()
    if moment := _behind(first, firewall or Firewall()):
        send_beat(SparkSession.active(), folder(checkpoint), moment)
        start().awaitTermination()
