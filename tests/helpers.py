"""Rows that several tests build their tables from."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from sluicegate import schemas

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def event(second: float = 0.0, **changes):
    """One valid raw event received ``second`` seconds after the start."""
    received = START + timedelta(seconds=second)
    row = {
        "event_id": f"e-{second}",
        "source": "shop",
        "amount": 10.0,
        "currency": "USD",
        "user_id": "u-1",
        "event_ts": received.strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z",
        "received_time": received,
    }
    row.update(changes)
    return tuple(row[f.name] for f in schemas.RAW_EVENTS.fields)


def raw_frame(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_EVENTS)


def metric(source, window, error_rate_pct, total=100, **counters):
    """One window metrics row; counters not named are 0."""
    start = START + timedelta(seconds=10 * window)
    end = start + timedelta(seconds=10)
    names = [n for n in schemas.DQ_METRICS.names if n.startswith("cnt_")]
    return (
        source,
        start,
        end,
        end - timedelta(milliseconds=1),
        total,
        round(total * error_rate_pct / 100),
        float(error_rate_pct),
        *[counters.get(n, 0) for n in names],
        0.0,
    )


def metrics_frame(spark, rows):
    return spark.createDataFrame(rows, schemas.DQ_METRICS)
