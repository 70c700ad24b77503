"""Declared schemas.  Every column is nullable: the input is not trusted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_STRING, _DOUBLE, _LONG, _TIME = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# What a producer puts on the wire.  Unknown extra fields are ignored.
PAYLOAD = _schema(
    event_id=_STRING,
    source=_STRING,
    amount=_DOUBLE,
    currency=_STRING,
    user_id=_STRING,
    event_ts=_STRING,
)

# The payload plus the time at which the event was received.
RAW_EVENTS = T.StructType([*PAYLOAD.fields, T.StructField("received_time", _TIME, True)])

CLEAN_EVENTS = _schema(
    event_id=_STRING,
    source=_STRING,
    amount=_DOUBLE,
    currency=_STRING,
    user_id=_STRING,
    event_time=_TIME,
)

QUARANTINE_EVENTS = _schema(
    event_id=_STRING,
    source=_STRING,
    amount=_DOUBLE,
    currency=_STRING,
    user_id=_STRING,
    raw_event_ts=_STRING,
    violations=T.ArrayType(_STRING),
    quarantined_at=_TIME,
)

def metrics_schema(counters: list[str], first_seen: list[str] = ()) -> T.StructType:
    """Window metrics of a contract with these counters."""
    return _schema(
        source=_STRING,
        window_start=_TIME,
        window_end=_TIME,
        window_time=_TIME,
        total_events=_LONG,
        bad_events=_LONG,
        error_rate_pct=_DOUBLE,
        **{name: _LONG for name in counters},
        avg_freshness_sec=_DOUBLE,
        **{name: _TIME for name in first_seen},
    )


DQ_METRICS = _schema(
    source=_STRING,
    window_start=_TIME,
    window_end=_TIME,
    window_time=_TIME,
    total_events=_LONG,
    bad_events=_LONG,
    error_rate_pct=_DOUBLE,
    cnt_missing_id=_LONG,
    cnt_missing_user=_LONG,
    cnt_amount_range=_LONG,
    cnt_bad_currency=_LONG,
    cnt_bad_timestamp=_LONG,
    cnt_stale=_LONG,
    avg_freshness_sec=_DOUBLE,
)

DQ_ALERTS = _schema(
    source=_STRING,
    ts=_TIME,
    total_events=_LONG,
    current_error_pct=_DOUBLE,
    forecast_error_pct=_DOUBLE,
    forecast_upper_pct=_DOUBLE,
    error_rate_slope=_DOUBLE,
    sla_pct=_DOUBLE,
    minutes_to_sla_breach=_DOUBLE,
    status=_STRING,
    top_reason=_STRING,
)

DQ_ALERTS_SIMPLE = _schema(
    source=_STRING,
    ts=_TIME,
    total_events=_LONG,
    current_error_pct=_DOUBLE,
    forecast_error_pct=_DOUBLE,
    status=_STRING,
    top_reason=_STRING,
)

SERVING_ALERTS = _schema(
    source=_STRING,
    ts=_TIME,
    total_events=_LONG,
    current_error_pct=_DOUBLE,
    forecast_error_pct=_DOUBLE,
    forecast_upper_pct=_DOUBLE,
    minutes_to_sla_breach=_DOUBLE,
    status=_STRING,
    top_reason=_STRING,
)


# Messages that are no JSON: kept, but without fields there is nothing to check.
UNDECODABLE_MESSAGES = _schema(wire_text=_STRING, received_time=_TIME)

# Events that came after their window was closed, or without a record time: routed like any
# other, but in no window.
LATE_EVENTS = T.StructType([*RAW_EVENTS.fields, T.StructField("late", T.BooleanType(), True)])

# What became of the events of a batch: counted in windows, late, or without a record time.
EVENT_TOTALS = _schema(counted_at=_TIME, events=_LONG, counted=_LONG, late=_LONG, timeless=_LONG)

# The last rates of a source's blocks of windows, kept beside the metrics for later batches.
BLOCK_TAILS = T.StructType(
    [*_schema(source=_STRING, block=_LONG, batch=_LONG).fields, T.StructField("tail", T.ArrayType(_LONG), True)]
)

# The columns of the ``events`` test table that raw events are derived from.
EVENTS = _schema(event_id=_LONG, user_id=_LONG, event_type=_STRING, value=_DOUBLE)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto a declared table schema, by name."""
    return df.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields])
