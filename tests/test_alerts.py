"""Status and time to breach at their thresholds, in all three variants."""

from __future__ import annotations

import pytest

from sluicegate import schemas
from sluicegate.operators import alerts as alerting
from sluicegate.operators.metrics import first_seen
from sluicegate.operators.contract import ORDER_EVENTS
from sluicegate.plans.pipeline import Firewall
from sluicegate.sources import derived


def judged(spark, current, forecast, early=False):
    """Status and time to breach for a given current and forecast rate."""
    rising = "error_rate_slope > 0.01D" if early else "forecast_error_pct > current_error_pct"
    near = f"({rising} AND coalesce({alerting._minutes_until(alerting.DEFAULTS)} < 5.0D, false))"
    row = spark.sql(f"SELECT {current}D AS current_error_pct, {forecast}D AS forecast_error_pct").selectExpr(
        "*", "forecast_error_pct - current_error_pct AS error_rate_slope"
    )
    got = row.selectExpr(
        f"{alerting.status(early_warning=near) if early else alerting.status()} AS status",
        f"{alerting.minutes_to_breach(rising)} AS eta",
    ).first()
    return got["status"], got["eta"]


@pytest.mark.parametrize(
    "current, forecast, expected",
    [
        (1.99, 1.99, ("OK", None)),
        (2.0, 0.0, ("BREACH", 0.0)),
        (0.5, 2.0, ("WATCH", 1.5 / 1.5 * (10 / 60))),
        (0.5, 0.505, ("OK", 1.5 / (0.505 - 0.5) * (10 / 60))),
        (0.5, 0.4, ("OK", None)),
    ],
)
def test_two_rule_status(spark, current, forecast, expected):
    assert judged(spark, current, forecast) == expected


@pytest.mark.parametrize(
    "current, forecast, status, has_eta",
    [
        (0.5, 0.5, "OK", False),  # no rise: no division by zero either
        (0.5, 0.505, "OK", False),  # below the slope threshold
        (0.5, 0.552, "WATCH", True),  # 4.8 minutes away
        (0.5, 0.548, "OK", True),  # 5.2 minutes away
        (0.5, 2.5, "WATCH", True),
        (3.0, 9.0, "BREACH", True),
    ],
)
def test_early_warning(spark, current, forecast, status, has_eta):
    got_status, eta = judged(spark, current, forecast, early=True)
    assert got_status == status and (eta is not None) == has_eta


def test_declared_schemas(spark, sf_medium):
    raw = derived.read_raw(spark, sf_medium)
    for name, schema in (
        ("dq_alerts", schemas.DQ_ALERTS),
        ("dq_alerts_simple", schemas.DQ_ALERTS_SIMPLE),
        ("serving_alerts", schemas.SERVING_ALERTS),
        ("clean_events", schemas.CLEAN_EVENTS),
        ("quarantine_events", schemas.QUARANTINE_EVENTS),
    ):
        got = getattr(Firewall(), name)(raw)
        assert [(f.name, f.dataType.simpleString()) for f in got.schema.fields] == [
            (f.name, f.dataType.simpleString()) for f in schema.fields
        ]


def test_trained_variants_wait_for_their_warm_up(spark, sf_small):
    raw = derived.read_raw(spark, sf_small)
    assert Firewall().dq_alerts(raw).isEmpty() and Firewall().dq_alerts_simple(raw).isEmpty()
    assert Firewall().serving_alerts(raw).count() == 25


def test_first_seen_columns_follow_the_counters():
    assert [first_seen(rule.counter) for rule in ORDER_EVENTS.rules][0] == "first_missing_id"
