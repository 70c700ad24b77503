"""Windows, rates, failure counts and the three top reasons."""

from __future__ import annotations

from datetime import timedelta

from helpers import START, event, metric, metrics_frame, raw_frame

from sluicegate import schemas
from sluicegate.operators import metrics as measuring
from sluicegate.operators import reasons
from sluicegate.plans.pipeline import Firewall
from sluicegate.sources import derived


def naive(seconds):
    return (START + timedelta(seconds=seconds)).replace(tzinfo=None)


def test_metrics_have_the_declared_schema(spark, sf_small):
    got = Firewall().dq_metrics(derived.read_raw(spark, sf_small))
    assert [(f.name, f.dataType) for f in got.schema.fields] == [
        (f.name, f.dataType) for f in schemas.DQ_METRICS.fields
    ]


def test_windows_are_aligned_and_half_open(spark):
    rows = [event(0), event(9.999), event(10), event(25)]
    got = Firewall().dq_metrics(raw_frame(spark, rows)).orderBy("window_start").collect()
    assert [(m["window_start"], m["window_end"], m["total_events"]) for m in got] == [
        (naive(0), naive(10), 2),
        (naive(10), naive(20), 1),
        (naive(20), naive(30), 1),
    ]
    assert got[0]["window_time"] == naive(9.999)


def test_rate_rounds_half_up_to_hundredths(spark):
    # 1 of 8 = 12.5 %, 1 of 3 = 33.33 %, 1 of 800 = 0.125 %
    def window(at, total):
        return [event(at + i / 1000, user_id=None if i == 0 else "u") for i in range(total)]

    rows = window(0, 8) + window(10, 3) + window(20, 800)
    got = Firewall().dq_metrics(raw_frame(spark, rows)).orderBy("window_start").collect()
    assert [m["error_rate_pct"] for m in got] == [12.5, 33.33, 0.13]


def test_freshness_mean_skips_malformed_times(spark):
    rows = [
        event(0, event_ts="bad"),
        event(1, event_ts="2023-12-31T23:59:51Z"),
        event(2, event_ts="2024-01-01T00:00:02Z"),
        event(10, event_ts="bad"),
    ]
    got = Firewall().dq_metrics(raw_frame(spark, rows)).orderBy("window_start").collect()
    assert [m["avg_freshness_sec"] for m in got] == [5.0, None]


def test_sources_without_a_name_stay_apart_in_the_tables_and_merge_when_served(spark):
    rows = [event(0, source=None), event(1, source=""), event(2, source="a")]
    raw = raw_frame(spark, rows)
    assert {(m["source"], m["total_events"]) for m in Firewall().dq_metrics(raw).collect()} == {
        (None, 1),
        ("", 1),
        ("a", 1),
    }
    assert {(m["source"], m["total_events"]) for m in Firewall().serving_metrics(raw).collect()} == {
        ("unknown", 2),
        ("a", 1),
    }


def test_reason_counts_cover_every_bad_event(spark, sf_medium):
    raw = derived.read_raw(spark, sf_medium)
    per_window = Firewall().dq_metrics(raw)
    counted = measuring.reason_counts(per_window).groupBy().sum("n").first()[0]
    assert counted >= per_window.groupBy().sum("bad_events").first()[0] == 531


def test_top_reasons_differ_where_they_should(spark):
    rows = [
        metric("most", 0, 5, cnt_bad_currency=1, cnt_stale=3),
        metric("tie", 0, 5, cnt_missing_user=2, cnt_stale=2),
        metric("none", 0, 0),
        metric("id", 0, 5, cnt_missing_id=1),
    ]
    got = metrics_frame(spark, rows).selectExpr(
        "source", f"{reasons.most_frequent()} AS full", f"{reasons.first_occurring()} AS simple"
    )
    assert {r["source"]: (r["full"], r["simple"]) for r in got.collect()} == {
        "most": ("STALE_EVENT", "INVALID_CURRENCY"),
        "tie": ("MISSING_USER_ID", "MISSING_USER_ID"),
        "none": ("NONE", "NONE"),
        "id": ("MISSING_EVENT_ID", "MISSING_EVENT_ID"),
    }


def test_serving_breaks_ties_by_what_came_first(spark):
    rows = [
        event(0, source="late", currency="x"),
        event(1, source="late", user_id=None),
        event(0, source="early", user_id=None),
        event(1, source="early", currency="x"),
        event(0, source="same", user_id=None, currency="x"),
        event(0, source="fine"),
        event(0, source="many", user_id=None),
        event(1, source="many", currency="x"),
        event(2, source="many", currency="x"),
    ]
    got = Firewall().serving_metrics(raw_frame(spark, rows)).selectExpr(
        "source", f"{reasons.most_frequent_first_seen()} AS reason"
    )
    assert {r["source"]: r["reason"] for r in got.collect()} == {
        "late": "INVALID_CURRENCY",
        "early": "MISSING_USER_ID",
        "same": "MISSING_USER_ID",
        "fine": "NONE",
        "many": "INVALID_CURRENCY",
    }
