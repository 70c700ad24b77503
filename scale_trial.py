"""Throughput of the pipeline on many copies of the events table.

    python scale_trial.py <events folder> [copies] [cpus]

Copies follow each other in time, so the number of windows grows with the data.
They are written below spark.checkpoint.dir.
Three fifths of all events come from one source, to show what a hot source costs.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame

from sluicegate.operators import ranking
from sluicegate.plans.pipeline import Firewall
from sluicegate.session import build_session, work_folder
from sluicegate.sources import derived, ingest

STEPS = (
    "events_verdict",
    "clean_events",
    "quarantine_events",
    "dq_metrics",
    "serving_metrics",
    "dq_alerts",
    "serving_alerts",
    "source_health",
    "source_history",
    "health_board",
    "worst_source_history",
    "dlq_feed",
)


def copied(events: DataFrame, copies: int, rows: int) -> DataFrame:
    hot = "CASE WHEN event_type IN ('click', 'view') THEN 'purchase' ELSE event_type END"
    return (
        events.repartition(max(8, copies))
        .selectExpr("*", f"explode(sequence(0, {copies - 1})) AS copy")
        .selectExpr(f"event_id + copy * {rows}L AS event_id", "user_id", f"{hot} AS event_type", "value")
    )


def main() -> None:
    folder = sys.argv[1]
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 200
    cpus = sys.argv[3] if len(sys.argv) > 3 else "8"
    spark = build_session(
        "sluicegate-scale",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": 64,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = derived.read_events(spark, folder)
    rows = events.count()
    path = work_folder(spark, "scale-raw")
    derived.raw_events(copied(events, copies, rows)).write.parquet(path)
    raw = ingest.read_files(spark, path)
    millions = rows * copies / 1e6
    ranking.latest_raw(raw).write.format("noop").mode("overwrite").save()
    for step in STEPS:
        started = time.perf_counter()
        getattr(Firewall(), step)(raw).write.format("noop").mode("overwrite").save()
        taken = time.perf_counter() - started
        print(f"{step:22s} {taken:7.2f} s {millions / taken:7.2f} M events/s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
