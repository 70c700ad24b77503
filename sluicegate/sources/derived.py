"""Raw order events derived from the ``events`` test table.

A deterministic injector corrupts at most one field per event, so each bad row
maps to exactly one rule code.  One source degrades: its bad rate climbs along a
smooth ramp from its base rate to the peak.  Pure projection: no shuffle, and
only four of the table's columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluicegate import schemas
from sluicegate.functions.exact import number
from sluicegate.functions.once import computed_once

# Event spacing, start of the stream, ramp and rates.
MILLIS_PER_EVENT = 50
EPOCH_MILLIS = 1704067200000  # 2024-01-01 00:00:00 UTC
RAMP_START_MILLIS = 90000
RAMP_MILLIS = 180000
PEAK_RATE = 0.35
DEGRADING_SOURCE, DEGRADING_BASE = "purchase", 0.01
BASE_RATES = {"click": 0.005, "view": 0.02}
OTHER_BASE = 0.01
STALE_BY_MILLIS = 1200000

# What each corruption mode writes.
CLEAN, NO_USER, BAD_AMOUNT, BAD_CURRENCY, BAD_TIME, NO_ID, STALE = -1, 0, 1, 2, 3, 4, 5
BAD_AMOUNTS = ("-50.0D", "250000.0D", "999999.0D")
GOOD_CURRENCIES = ("'USD'", "'EUR'", "'GBP'", "'JPY'", "'INR'")
BAD_CURRENCIES = ("'usd'", "'BTC'", "'XYZ'", "''", "'US'")
BAD_TIMES = ("'not-a-date'", "'13/45/2026'", "''")

# Fixed value: how a source stamps its events; quotes escaped for SQL.
ISO_MILLIS = r"yyyy-MM-dd\'T\'HH:mm:ss.SSS\'Z\'"


def _cycle(turn: str, choices: tuple[str, ...]) -> str:
    """The choice at ``turn`` modulo the number of choices."""
    return f"element_at(array({', '.join(choices)}), CAST({turn} % {len(choices)} + 1 AS INT))"


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(schemas.EVENTS).parquet(f"{folder}/events.parquet")


def stream_events(spark: SparkSession, folder: str, **options: object) -> DataFrame:
    """The same table as a file stream."""
    reader = spark.readStream.schema(schemas.EVENTS)
    for key, value in {"pathGlobFilter": "events.parquet", **options}.items():
        reader = reader.option(key, value)
    return reader.parquet(folder)


def injection(events: DataFrame) -> DataFrame:
    """Bad rate and corruption mode of every event."""
    ramped = events.selectExpr(
        "*",
        f"event_id * {MILLIS_PER_EVENT} AS elapsed_ms",
        f"""greatest(0.0D, least(1.0D, (event_id * {MILLIS_PER_EVENT} - {number(RAMP_START_MILLIS)})
                                       / {number(RAMP_MILLIS)})) AS ramp""",
    )
    degraded = (
        f"{number(DEGRADING_BASE)} + ramp * ramp * (3 - 2 * ramp)"
        f" * ({number(PEAK_RATE)} - {number(DEGRADING_BASE)})"
    )
    steady = " ".join(f"WHEN '{source}' THEN {number(base)}" for source, base in BASE_RATES.items())
    rate = f"CASE event_type WHEN '{DEGRADING_SOURCE}' THEN {degraded} {steady} ELSE {number(OTHER_BASE)} END"
    draw = "(event_id * 7919 + user_id * 104729) % 10000"
    pick = "CAST((event_id * 131 + user_id * 17) % 6 AS INT)"
    rated = ramped.selectExpr(*events.columns, "elapsed_ms", f"{rate} AS rate")
    return computed_once(rated, "mode", f"CASE WHEN {draw} < rate * 10000 THEN {pick} ELSE {CLEAN} END")


def raw_events(events: DataFrame, *keep: str) -> DataFrame:
    """The raw event stream; ``keep`` adds ``sequence`` or ``mode`` columns."""
    received = f"{EPOCH_MILLIS} + elapsed_ms"
    stamped = f"timestamp_millis({received} - CASE WHEN mode = {STALE} THEN {STALE_BY_MILLIS} ELSE 0 END)"
    columns = {
        "event_id": f"CASE WHEN mode <> {NO_ID} THEN 'e-' || event_id END",
        "source": "event_type",
        "amount": f"CASE WHEN mode = {BAD_AMOUNT} THEN {_cycle('event_id', BAD_AMOUNTS)} ELSE value END",
        "currency": f"""CASE WHEN mode = {BAD_CURRENCY} THEN {_cycle('event_id', BAD_CURRENCIES)}
                             ELSE {_cycle('(event_id + user_id)', GOOD_CURRENCIES)} END""",
        "user_id": f"CASE WHEN mode <> {NO_USER} THEN 'u-' || user_id END",
        "event_ts": f"""CASE WHEN mode = {BAD_TIME} THEN {_cycle('event_id', BAD_TIMES)}
                             ELSE date_format({stamped}, '{ISO_MILLIS}') END""",
        "received_time": f"timestamp_millis({received})",
    }
    extra = {"sequence": "event_id", "mode": "mode"}
    selected = [f"{columns[f.name]} AS {f.name}" for f in schemas.RAW_EVENTS.fields]
    return injection(events).selectExpr(*selected, *[f"{extra[name]} AS {name}" for name in keep])


def read_raw(spark: SparkSession, folder: str, *keep: str) -> DataFrame:
    return raw_events(read_events(spark, folder), *keep)
