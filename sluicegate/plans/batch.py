"""Build and store all tables from bounded sets of raw events, one batch after another.

Raw events are read and judged once, in one write that is split by lane and day.  Metrics
come from the few columns they need of what was stored, everything else from the stored
metrics, which hold one row per source and window; stored tables also cut the lineage, so
losing an executor later does not send Spark back to the raw events.

Forecasts look back on the last rates of each block of windows, a narrow table beside the
metrics.  A later batch therefore reads nothing of the stored events and metrics, and its
alerts are those that a single batch of all events would have had.  Batches come in the order of
time: every window lies in one batch, and is newer than those of its source in earlier batches.
A batch that is stored again replaces itself; what came after it must then be stored again too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate import schemas
from sluicegate.operators import alerts as alerting
from sluicegate.operators import forecast, series
from sluicegate.operators import metrics as measuring
from sluicegate.plans.pipeline import Firewall
from sluicegate.settings import Settings
from sluicegate.sources import tables

WINDOWS = "window_metrics"
TAILS, SERVING_TAILS = "block_tails", "serving_tails"


def store_lanes(raw: DataFrame, root: str, firewall: Firewall, batch_id: int = 0) -> None:
    tables.write_judged(firewall.events_verdict(raw), root, batch_id, firewall.contract)


def _with_recent(metrics: DataFrame, root: str, table: str, batch_id: int, depth: int, settings: Settings) -> DataFrame:
    """Metrics of a batch with ``recent_points``, across earlier batches; stores the batch's own tails."""
    spark = metrics.sparkSession
    own = forecast.block_tails(metrics, depth, batch_id, settings)
    begins = F.timestamp_seconds(F.col(series.BLOCK) * F.lit(settings.block_windows * settings.window_seconds))
    tables.write_batch(own, root, table, batch_id, begins, schemas.BLOCK_TAILS, gather=True)
    known = tables.read_table(spark, root, table, schema=schemas.BLOCK_TAILS)
    return forecast.with_recent_from(metrics, series.carried(known, depth, batch_id), depth, settings)


def store_metrics_and_alerts(judged: DataFrame, root: str, firewall: Firewall, batch_id: int = 0) -> None:
    spark, settings, contract = judged.sparkSession, firewall.settings, firewall.contract
    wide = measuring.schema(contract, with_first_seen=True)
    by_window = measuring.window_metrics(judged, contract, settings, with_first_seen=True)
    tables.write_batch(by_window, root, WINDOWS, batch_id, F.col("window_start"), wide, gather=True)
    stored = tables.read_batch(spark, root, WINDOWS, batch_id, wide)
    tables.write_batch(stored, root, "dq_metrics", batch_id, F.col("window_start"), measuring.schema(contract))
    known = _with_recent(stored, root, TAILS, batch_id, settings.train_max, settings)
    merged = measuring.merge_blank_sources(stored, contract)
    serving = _with_recent(merged, root, SERVING_TAILS, batch_id, settings.damped_points, settings)
    for table, rows in (
        ("dq_alerts", alerting.alerts_from_recent(known, settings, contract)),
        ("dq_alerts_simple", alerting.alerts_simple_from_recent(known, settings, contract)),
        ("serving_alerts", alerting.serving_alerts_from_recent(serving, settings, contract)),
    ):
        tables.write_batch(rows, root, table, batch_id, F.col("ts"), gather=True)


def store_tables(raw: DataFrame, root: str, firewall: Firewall | None = None, batch_id: int = 0) -> None:
    """Store all six tables below ``root``: a batch of them, replacing an earlier run of it."""
    firewall = firewall or Firewall()
    store_lanes(raw, root, firewall, batch_id)
    own = tables.read_judged(raw.sparkSession, root, firewall.contract, (tables.BATCH_JOB, batch_id))
    store_metrics_and_alerts(own, root, firewall, batch_id)
