"""Per-source quality metrics in tumbling event-time windows.

Grouped by source *and* window, so Spark combines on the map side before the one
shuffle and a source that sends a third of all rows is spread over its windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate import schemas
from sluicegate.functions.exact import points_to_pct, share_points
from sluicegate.operators.contract import FRESHNESS, ORDER_EVENTS, Contract
from sluicegate.settings import DEFAULTS, UNKNOWN_SOURCE, Settings


def first_seen(counter: str) -> str:
    return counter.replace("cnt_", "first_", 1)


def name_blank_sources(events: DataFrame) -> DataFrame:
    """Give events without a source the name the serving layer shows."""
    return events.withColumn("source", F.expr(f"coalesce(nullif(source, ''), '{UNKNOWN_SOURCE}')"))


def window_metrics(
    verdicts: DataFrame,
    contract: Contract = ORDER_EVENTS,
    settings: Settings = DEFAULTS,
    with_first_seen: bool = False,
) -> DataFrame:
    """One row per source and window.

    ``with_first_seen`` adds, per rule, when it was first broken in the window:
    the serving layer breaks ties between reasons by it.
    """
    counters = [rule.counter for rule in contract.rules]
    seen = {first_seen(rule.counter): rule.flag for rule in contract.rules} if with_first_seen else {}
    measures = {
        "total_events": "count(*)",
        "bad_events": "count_if(NOT is_valid)",
        **{rule.counter: f"count_if({rule.flag})" for rule in contract.rules},
        "avg_freshness": f"avg(CAST({FRESHNESS} AS DOUBLE))",
        **{name: f"min(CASE WHEN {flag} THEN received_time END)" for name, flag in seen.items()},
    }
    grouped = verdicts.groupBy("source", F.window("received_time", settings.window).alias("w"))
    return grouped.agg(*[F.expr(f"{value} AS {name}") for name, value in measures.items()]).selectExpr(
        "source",
        "w.start AS window_start",
        "w.end AS window_end",
        "w.end - INTERVAL '0.001' SECOND AS window_time",
        "total_events",
        "bad_events",
        f"{points_to_pct(share_points('bad_events', 'total_events'))} AS error_rate_pct",
        *counters,
        "round(avg_freshness, 1) AS avg_freshness_sec",
        *seen,
    )


def sums(contract: Contract = ORDER_EVENTS) -> dict[str, str]:
    """Sums that make up a window, over judged events: SQL by column.  They can be added up."""
    return {
        "total_events": "count(*)",
        "bad_events": "count_if(NOT is_valid)",
        **{rule.counter: f"count_if({rule.flag})" for rule in contract.rules},
        "freshness_sum": f"coalesce(sum({FRESHNESS}), 0)",
        "freshness_rows": f"count({FRESHNESS})",
    }


def of_sums(summed: DataFrame, contract: Contract = ORDER_EVENTS) -> DataFrame:
    """Window metrics from added sums, with window_start and window_end."""
    return summed.selectExpr(
        "source",
        "window_start",
        "window_end",
        "window_end - INTERVAL '0.001' SECOND AS window_time",
        "total_events",
        "bad_events",
        f"{points_to_pct(share_points('bad_events', 'total_events'))} AS error_rate_pct",
        *[rule.counter for rule in contract.rules],
        "round(freshness_sum / nullif(freshness_rows, 0), 1) AS avg_freshness_sec",
    )


def schema(contract: Contract = ORDER_EVENTS, with_first_seen: bool = False) -> T.StructType:
    counters = [rule.counter for rule in contract.rules]
    return schemas.metrics_schema(counters, [first_seen(c) for c in counters] if with_first_seen else [])


def merge_blank_sources(metrics: DataFrame, contract: Contract = ORDER_EVENTS) -> DataFrame:
    """Metrics with first-seen times as the serving layer groups them.

    Merges the windows of events without a source from their counts and first-seen
    times, so that the raw events need not be read again.  The mean freshness is
    left out: alerts do not use it, and means do not add up.
    """
    counters = [rule.counter for rule in contract.rules]
    window = ("source", "window_start", "window_end", "window_time")
    sums = [F.expr(f"sum({name}) AS {name}") for name in ("total_events", "bad_events", *counters)]
    earliest = [F.expr(f"min({first_seen(name)}) AS {first_seen(name)}") for name in counters]
    merged = name_blank_sources(metrics).groupBy(*window).agg(*sums, *earliest)
    rate = points_to_pct(share_points("bad_events", "total_events"))
    return merged.withColumn("error_rate_pct", F.expr(rate))


def reason_counts(metrics: DataFrame, contract: Contract = ORDER_EVENTS) -> DataFrame:
    """Broken rules per source and window, one row per rule that occurred.

    Unpivots the aggregated counters; exploding each event's violations before
    the aggregation would give the same rows for more work.
    """
    pairs = ", ".join(f"'{rule.code}', {rule.counter}" for rule in contract.rules)
    unpivoted = f"stack({len(contract.rules)}, {pairs}) AS (reason, n)"
    return metrics.selectExpr("source", "window_start", "window_end", unpivoted).filter("n > 0")
