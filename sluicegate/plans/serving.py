"""The serving side: reload stored outputs, snapshot, report texts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.functions.text import clock_text, eta_text, or_dash, pct_text
from sluicegate.operators import ranking
from sluicegate.settings import DEFAULTS, NO_REASON, OK, Settings
from sluicegate.sources import tables


def usable_alerts(stored: DataFrame) -> DataFrame:
    """Stored alert rows that name a source."""
    return stored.filter("source IS NOT NULL AND source <> ''")


def served_alerts(stored: DataFrame) -> DataFrame:
    """Stored alerts of any variant as the serving layer reads them.

    Numbers that are missing, or that the variant does not have, read as 0; a time to
    breach reads as none.
    """
    named = usable_alerts(stored)
    numbers = ("current_error_pct", "forecast_error_pct", "forecast_upper_pct")
    filled = {c: F.coalesce(F.col(c), F.lit(0.0)) if c in stored.columns else F.lit(0.0) for c in numbers}
    if "minutes_to_sla_breach" not in stored.columns:
        filled["minutes_to_sla_breach"] = F.lit(None).cast("double")
    return named.withColumns(filled)


def served_rejects(stored: DataFrame) -> DataFrame:
    """Stored rejects; missing violations read as none."""
    return stored.withColumn("violations", F.expr("coalesce(violations, CAST(array() AS ARRAY<STRING>))"))


def history_points(stored: DataFrame, now: str = "current_timestamp()") -> DataFrame:
    """Chart points of stored alerts; missing numbers read as 0, a missing time as now."""
    return usable_alerts(stored).selectExpr(
        "source",
        f"coalesce(ts, {now}) AS ts",
        "coalesce(current_error_pct, 0.0D) AS current",
        "coalesce(forecast_error_pct, 0.0D) AS forecast",
        "coalesce(forecast_upper_pct, 0.0D) AS upper",
    )


def reject_rows(stored: DataFrame, now: str = "current_timestamp()") -> DataFrame:
    """Feed rows of stored rejects; missing violations read as none."""
    return stored.selectExpr(
        "source",
        "event_id",
        "coalesce(violations, CAST(array() AS ARRAY<STRING>)) AS violations",
        f"coalesce(quarantined_at, {now}) AS at",
    )


@dataclass(frozen=True)
class Snapshot:
    """What a dashboard shows at one moment."""

    sources: DataFrame
    history: DataFrame
    dlq: DataFrame


def snapshot(alerts: DataFrame, quarantine: DataFrame, settings: Settings = DEFAULTS) -> Snapshot:
    named = served_alerts(alerts)
    return Snapshot(
        sources=ranking.health_board(named),
        history=ranking.history(named, settings),
        dlq=ranking.dlq_feed(served_rejects(quarantine), settings),
    )


def load_snapshot(
    spark: SparkSession,
    root: str,
    table: str = "serving_alerts",
    since: str | None = None,
    settings: Settings = DEFAULTS,
) -> Snapshot:
    """Snapshot of stored tables; ``since`` limits how far back folders are read.

    ``table`` is any of the alert tables.
    """
    return snapshot(
        tables.read_table(spark, root, table, since),
        tables.read_table(spark, root, "quarantine_events", since),
        settings,
    )


def snapshot_json(board: DataFrame) -> DataFrame:
    """One JSON document per source state, as a state endpoint would send it."""
    return board.select("source", F.to_json(F.struct(*board.columns), {"ignoreNullFields": "false"}).alias("state"))


def health_report(board: DataFrame) -> DataFrame:
    """The health board in words."""
    return board.selectExpr(
        "source",
        f"coalesce(status, '{OK}') AS status",
        f"{pct_text('current_error_pct')} AS error_rate",
        f"{pct_text('forecast_error_pct')} AS forecast",
        f"{eta_text('minutes_to_sla_breach')} AS time_to_breach",
        f"{or_dash('CAST(total_events AS STRING)')} AS events_per_window",
        f"nullif(top_reason, '{NO_REASON}') AS top_failure_mode",
        "severity",
    )


def dlq_report(feed: DataFrame) -> DataFrame:
    """The reject feed in words."""
    rules = or_dash("nullif(array_join(violations, ' '), '')")
    return feed.selectExpr(
        "rank",
        f"{clock_text('at')} AS time",
        f"{or_dash('source')} AS source",
        "coalesce(event_id, 'null') AS event_id",
        f"{rules} AS failed_rules",
    )
