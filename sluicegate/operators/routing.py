"""The two exits: every judged event goes to exactly one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.operators.contract import EVENT_TIME

LANES = ("clean_events", "quarantine_events")


def clean_events(verdicts: DataFrame, *keep: str) -> DataFrame:
    """Valid events; ``keep`` names further columns, such as the one a writer lays out by."""
    return verdicts.filter("is_valid").select(
        "event_id", "source", "amount", "currency", "user_id", F.col(EVENT_TIME).alias("event_time"), *keep
    )


def quarantine_events(verdicts: DataFrame, *keep: str) -> DataFrame:
    """Rejected events with the codes of the rules they broke."""
    return verdicts.filter(~F.col("is_valid")).select(
        "event_id",
        "source",
        "amount",
        "currency",
        "user_id",
        F.col("event_ts").alias("raw_event_ts"),
        "violations",
        F.col("received_time").alias("quarantined_at"),
        *keep,
    )


def route_counts(verdicts: DataFrame) -> DataFrame:
    """Rows per lane; both lanes are listed even when one is empty."""
    counts = verdicts.agg(F.count_if("is_valid").alias("clean"), F.count_if(~F.col("is_valid")).alias("bad"))
    lanes = F.array(
        F.struct(F.lit(LANES[0]).alias("lane"), F.col("clean").alias("rows")),
        F.struct(F.lit(LANES[1]).alias("lane"), F.col("bad").alias("rows")),
    )
    return counts.select(F.inline(lanes))
