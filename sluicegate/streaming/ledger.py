"""Window metrics that account for every event: counted, late, or without a record time.

Spark's own watermark drops what comes too late without a trace.  Here a micro-batch marks
each event before anything is summed: an event is late if an earlier batch closed its
window.  Late events, and those without a record time, are stored in a lane of their own;
all others are summed by source and window and added to the windows still open, a small
table that goes from batch to batch.  The mark then moves to the newest event less the
delay, and windows that end by then close.

So over any number of batches events = counted + late + timeless, event by event, and a
repeated batch stores the same again.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluicegate import schemas
from sluicegate.operators import metrics as measuring
from sluicegate.plans.pipeline import Firewall
from sluicegate.sources import tables
from sluicegate.streaming import running
from sluicegate.streaming.alerts import alert_writer, tails_of
from sluicegate.streaming.idle import duration
from sluicegate.streaming.kept import Kept
from sluicegate.streaming.running import Writer

_WINDOW = ("source", "window_start", "window_end")
# Rows of windows that a task merges, forecasts and writes.
WINDOWS_PER_TASK = 20_000


class Ledger:
    """Sums of open windows, and the mark up to which windows are closed, beside a checkpoint."""

    def __init__(self, checkpoint: str, firewall: Firewall) -> None:
        base = f"{checkpoint.rstrip('/')}-ledger"
        self.settings, self.contract = firewall.settings, firewall.contract
        self.sums = measuring.sums(firewall.contract)
        columns = ", ".join(f"{name} bigint" for name in self.sums)
        self.open = Kept(f"{base}/open", f"source string, window_start timestamp, window_end timestamp, {columns}")
        self.mark = Kept(f"{base}/mark", "micros bigint")

    def closed_until(self, spark: SparkSession, batch_id: int) -> int | None:
        """The mark that earlier batches left, in microseconds; None before the first event."""
        row = self.mark.before(spark, batch_id).first()
        return row.micros if row else None

    def late(self, until: int | None) -> Column:
        """Whether the window of an event was closed already."""
        end = self._start() + self.settings.window_seconds * 1_000_000
        return F.lit(False) if until is None else F.coalesce(end <= F.lit(until), F.lit(False))

    def _start(self) -> Column:
        micros = F.unix_micros("received_time")
        return micros - F.pmod(micros, F.lit(self.settings.window_seconds * 1_000_000))

    def grouped(self, judged: DataFrame, until: int | None) -> DataFrame:
        """Sums by source, window and lateness, one shuffle; ``newest`` is the last event of each."""
        start = F.timestamp_micros(self._start())
        end = F.timestamp_micros(self._start() + self.settings.window_seconds * 1_000_000)
        keys = [F.col("source"), start.alias("window_start"), end.alias("window_end"), self.late(until).alias("late")]
        values = [F.expr(f"{value} AS {name}") for name, value in self.sums.items()]
        return judged.groupBy(*keys).agg(*values, F.expr("max(unix_micros(received_time)) AS newest"))

    def tasks(self, spark: SparkSession, groups: int, batch_id: int) -> int:
        """How many tasks the windows of a batch and those still open ask for.

        Adaptive execution leaves the partitions of rows that are held alone.  Without
        a number of their own, each of a dozen steps per batch would run as many tasks
        as the session has shuffle partitions, most of them for no row at all.
        """
        return 1 + (groups + self.open.before(spark, batch_id).count()) // WINDOWS_PER_TASK

    def merged(self, grouped: DataFrame, batch_id: int, tasks: int) -> DataFrame:
        """The windows still open and those of a batch, added up, in ``tasks`` partitions at most."""
        before = self.open.before(grouped.sparkSession, batch_id)
        counted = grouped.filter("NOT late AND window_start IS NOT NULL").select(*before.columns)
        both = before.unionByName(counted).coalesce(tasks)
        return both.groupBy(*_WINDOW).agg(*[F.sum(name).alias(name) for name in self.sums]).coalesce(tasks)

    def open_windows(self, spark: SparkSession) -> DataFrame:
        """Metrics so far of the windows that are still open."""
        return measuring.of_sums(self.open.newest(spark), self.contract)


def ledger_writer(root: str, checkpoint: str, firewall: Firewall) -> Writer:
    """Stores late events, totals, and the metrics and alerts of the windows a batch closed."""
    ledger, settings = Ledger(checkpoint, firewall), firewall.settings
    closing = alert_writer(root, firewall, tails_of(checkpoint, settings.train_max, settings))
    delay = int(duration(settings.watermark).total_seconds() * 1_000_000)

    def write(raw: DataFrame, batch_id: int, writer: str = tables.BATCH_JOB) -> None:
        spark = raw.sparkSession
        until = ledger.closed_until(spark, batch_id)
        grouped = ledger.grouped(firewall.events_verdict(raw), until).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            totals = grouped.selectExpr(
                "timestamp_micros(max(newest)) AS counted_at",
                "coalesce(sum(total_events), 0) AS events",
                "coalesce(sum(CASE WHEN NOT late AND window_start IS NOT NULL THEN total_events END), 0) AS counted",
                "coalesce(sum(CASE WHEN late THEN total_events END), 0) AS late",
                "coalesce(sum(CASE WHEN window_start IS NULL THEN total_events END), 0) AS timeless",
                "max(newest) AS newest",
                "count(*) AS groups",
            ).persist()
            said = totals.first()
            if not said.events:
                return
            if said.late or said.timeless:
                # Read again, as such events are few: the condition on the time reaches the files.
                is_late = ledger.late(until)
                lane = raw.filter(is_late | F.col("received_time").isNull()).withColumn("late", is_late)
                tables.write_batch(lane, root, "late_events", batch_id, F.col("received_time"), gather=True, writer=writer)
            now = max((n for n in (until, said.newest is not None and said.newest - delay) if n not in (None, False)), default=None)
            tasks = ledger.tasks(spark, said.groups, batch_id)
            merged = ledger.merged(grouped, batch_id, tasks).persist(StorageLevel.MEMORY_AND_DISK)
            ends_by = F.lit(False) if now is None else F.unix_micros("window_end") <= F.lit(now)
            closing(measuring.of_sums(merged.filter(ends_by), firewall.contract), batch_id, writer, tasks)
            tables.write_batch(totals, root, "event_totals", batch_id, F.col("counted_at"), writer=writer)
            ledger.open.keep(merged.filter(~ends_by), batch_id)
            if now is not None:
                ledger.mark.keep(spark.range(1).select(F.lit(now).cast("long").alias("micros")), batch_id)
            merged.unpersist()
            totals.unpersist()
        finally:
            grouped.unpersist()

    return write


def start_ledger(
    raw: DataFrame, root: str, checkpoint: str, firewall: Firewall | None = None, **trigger: object
) -> StreamingQuery:
    """Metrics and alerts as by ``start_alerts``, with every late event stored and counted.

    Windows open at the end of the input stay open; :meth:`Ledger.open_windows` shows them.
    """
    events = schemas.conform(raw, schemas.RAW_EVENTS)
    return running.start(events, ledger_writer(root, checkpoint, firewall or Firewall()), "ledger", checkpoint, **trigger)
