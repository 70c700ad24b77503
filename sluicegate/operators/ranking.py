"""Newest-first reports and latest-per-source views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluicegate.functions.exact import half_up, number
from sluicegate.operators.series import newest
from sluicegate.settings import BREACH, DEFAULTS, SEVERITY, SEVERITY_OTHER, WATCH, Settings


def top(df: DataFrame, count: int, *order: Column) -> DataFrame:
    """The first ``count`` rows in the given order, with their ``rank``.

    Spark keeps the best ``count`` rows per task and merges those; the ranking
    then runs over the few rows that are left.
    """
    return df.orderBy(*order).limit(count).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def _newest_events(time: str) -> list[Column]:
    return [F.col(time).desc(), F.col("event_id"), F.col("source")]


def latest_raw(raw: DataFrame, count: int = 20) -> DataFrame:
    """The newest raw events."""
    return top(raw, count, *_newest_events("received_time")).withColumnRenamed("received_time", "received")


def latest_verdicts(raw: DataFrame, judge, count: int = 25) -> DataFrame:
    """Verdicts on the newest events.  Only these events are judged."""
    return judge(top(raw, count, *_newest_events("received_time"))).select(
        "rank", "source", "event_id", "amount", "currency", "is_valid", "violations", "received_time"
    )


def latest_quarantine(quarantine: DataFrame, count: int = 25) -> DataFrame:
    feed = quarantine.select("source", "event_id", "violations", "quarantined_at")
    return top(feed, count, *_newest_events("quarantined_at"))


def dlq_feed(quarantine: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The newest rejects, newest first."""
    return latest_quarantine(quarantine, settings.feed_rows).withColumnRenamed("quarantined_at", "at")


def latest_metrics(metrics: DataFrame, count: int = 25) -> DataFrame:
    scorecards = metrics.select(
        "source", "total_events", "bad_events", "error_rate_pct", "avg_freshness_sec", "window_end"
    )
    return top(scorecards, count, F.col("window_end").desc(), F.col("source"))


def latest_per_source(rows: DataFrame, time: str = "ts") -> DataFrame:
    """The newest row per source, as an aggregate: Spark combines it map-side."""
    return (
        rows.groupBy("source")
        .agg(F.max_by(F.struct(*rows.columns), F.col(time)).alias("latest"))
        .select("latest.*")
    )


def source_health(alerts: DataFrame) -> DataFrame:
    """One row per source: its latest alert, time to breach to one decimal."""
    return latest_per_source(alerts).selectExpr(
        "source",
        "status",
        "current_error_pct",
        "forecast_error_pct",
        f"{half_up('minutes_to_sla_breach', 1)} AS eta_min",
        "top_reason",
    )


# A chart point.
POINT = (
    "ts",
    "current_error_pct AS current",
    "forecast_error_pct AS forecast",
    "forecast_upper_pct AS upper",
)


def history(alerts: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The newest points per source, as a chart shows them."""
    return newest(alerts, settings.history_points, "ts").selectExpr("source", *POINT)


def severity(status: str) -> str:
    """Place of a status on the health board, as a SQL expression."""
    known = " ".join(f"WHEN '{name}' THEN {place}" for name, place in SEVERITY.items())
    return f"CASE {status} {known} ELSE {SEVERITY_OTHER} END"


def worst_first() -> list[Column]:
    """Breaches first, then the nearest breach; no breach in sight comes last."""
    return [F.col("severity"), F.col("minutes_to_sla_breach").asc_nulls_last(), F.col("source")]


def health_board(alerts: DataFrame) -> DataFrame:
    """Latest alert per source, worst first.

    Sorted in parallel; there is no position column, since numbering all rows
    would take them through one task.
    """
    board = latest_per_source(alerts).withColumn("severity", F.expr(severity("status")))
    return board.orderBy(*worst_first())


def status_counts(board: DataFrame) -> DataFrame:
    """How many sources breach and how many are to be watched."""
    return board.agg(
        F.expr(f"count_if(status = '{BREACH}') AS breaching"),
        F.expr(f"count_if(status = '{WATCH}') AS watching"),
    )


def worst_source_history(alerts: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The newest points of the source that heads the health board.

    The few points of each source are nested beside its latest state, so that
    picking the worst source needs neither a join nor a second scan.
    """
    nested = (
        newest(alerts, settings.history_points, "ts")
        .groupBy("source")
        .agg(
            F.expr("max_by(struct(status, minutes_to_sla_breach), ts) AS now"),
            F.expr(f"sort_array(collect_list(struct({', '.join(POINT)}))) AS points"),
        )
        .selectExpr("source", f"{severity('now.status')} AS severity", "now.minutes_to_sla_breach", "points")
    )
    worst = nested.orderBy(*worst_first()).limit(1)
    return worst.select("source", F.inline("points"))


def chart_bounds(points: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Upper end of a chart's axis: twice the SLA at least, rounded up to tens."""
    highest = f"greatest({number(settings.sla_pct * 2)}, max(current), max(forecast))"
    return points.agg(F.expr(f"{highest} AS data_max"), F.expr("count(*) AS points")).withColumn(
        "axis_max", F.expr("CAST(greatest(10, ceil(data_max / 10.0D) * 10) AS DOUBLE)")
    )
