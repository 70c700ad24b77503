"""Rules at their boundaries, several violations at once, and routing."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from helpers import START, event, raw_frame

from sluicegate.operators import routing
from sluicegate.operators.contract import ORDER_EVENTS, Contract, one_of, present
from sluicegate.plans import batch
from sluicegate.plans.pipeline import Firewall
from sluicegate.sources import derived, tables


def check(spark, rows):
    return Firewall().events_verdict(raw_frame(spark, rows)).orderBy("received_time").collect()


def violations_of(spark, column, values):
    """Violations of otherwise valid events, one per value of the column."""
    return [r["violations"] for r in check(spark, [event(i, **{column: v}) for i, v in enumerate(values)])]


def test_amount_bounds_are_valid_and_everything_outside_is_not(spark):
    found = violations_of(spark, "amount", [0.0, 100000.0, -0.01, 100000.01, None, float("nan")])
    assert found == [[], []] + [["AMOUNT_OUT_OF_RANGE"]] * 4


@pytest.mark.parametrize("column, code", [("event_id", "MISSING_EVENT_ID"), ("user_id", "MISSING_USER_ID")])
def test_ids_must_be_non_empty_but_may_be_blank(spark, column, code):
    assert violations_of(spark, column, [None, "", " ", "x"]) == [[code], [code], [], []]


def test_currency_is_case_sensitive(spark):
    found = violations_of(spark, "currency", ["USD", "INR", "usd", "", None, "US"])
    assert found == [[], []] + [["INVALID_CURRENCY"]] * 4


@pytest.mark.parametrize(
    "text",
    [
        None,
        "",
        "now",
        "today",
        "12:30",
        "2026",
        "2026-13-45",
        "2026-02-30",
        "not-a-date",
        "13/45/2026",
        " 2024-01-01",
        "2024-01-01\n",
        "2024-01-01T00:00:00.000Zx",
    ],
)
def test_malformed_times(spark, text):
    [row] = check(spark, [event(0, event_ts=text)])
    assert row["violations"] == ["MALFORMED_TIMESTAMP"]
    assert row["parsed_event_ts"] is None and row["freshness_sec"] is None


def test_iso_times_are_instants(spark):
    texts = ["2024-01-01T00:00:00.000Z", "2024-01-01 05:30:00+05:30", "2024-01-01", "2024-01-01T00:00:00.000999999Z"]
    rows = check(spark, [event(0, event_ts=t) for t in texts])
    assert [r["freshness_sec"] for r in rows] == [0, 0, 0, 0]
    assert {r["parsed_event_ts"] for r in rows} == {START.replace(tzinfo=None)}


def test_freshness_counts_whole_seconds(spark):
    ages = [300.0, 300.9, 301.0, -60.0]
    stamp = "2024-01-01T00:00:00Z"
    rows = [event(i, received_time=START + timedelta(seconds=a), event_ts=stamp) for i, a in enumerate(ages)]
    found = {r["event_id"]: (r["freshness_sec"], r["violations"]) for r in check(spark, rows)}
    assert [found[f"e-{i}"] for i in range(4)] == [(300, []), (300, []), (301, ["STALE_EVENT"]), (-60, [])]


def test_all_rules_at_once_in_contract_order(spark):
    nothing = event(0, event_id=None, source=None, amount=None, currency=None, user_id=None, event_ts=None)
    stale = event(1, event_id="", amount=-1.0, currency="x", user_id="", event_ts="2020-01-01")
    first, second = check(spark, [nothing, stale])
    common = ["MISSING_EVENT_ID", "MISSING_USER_ID", "AMOUNT_OUT_OF_RANGE", "INVALID_CURRENCY"]
    assert first["violations"] == [*common, "MALFORMED_TIMESTAMP"]
    assert second["violations"] == [*common, "STALE_EVENT"]


def test_flags_verdict_and_violations_agree(spark, sf_small):
    rows = Firewall().events_verdict(derived.read_raw(spark, sf_small)).collect()
    for row in rows:
        flagged = [rule.code for rule in ORDER_EVENTS.rules if row[rule.flag]]
        assert row["violations"] == flagged
        assert row["is_valid"] == (not flagged)
        assert not (row["v_bad_timestamp"] and row["v_stale"])


def test_every_injected_corruption_is_found_and_nothing_else(spark, sf_medium):
    by_mode = {
        -1: [],
        0: ["MISSING_USER_ID"],
        1: ["AMOUNT_OUT_OF_RANGE"],
        2: ["INVALID_CURRENCY"],
        3: ["MALFORMED_TIMESTAMP"],
        4: ["MISSING_EVENT_ID"],
        5: ["STALE_EVENT"],
    }
    judged = Firewall().events_verdict(derived.read_raw(spark, sf_medium, "mode"))
    pairs = judged.groupBy("mode", "violations").count().collect()
    assert {r["mode"]: r["violations"] for r in pairs} == by_mode
    assert sum(r["count"] for r in pairs if r["mode"] >= 0) == 531


def test_clean_and_quarantine_partition_the_input(spark, sf_small):
    raw = derived.read_raw(spark, sf_small)
    judged = Firewall().events_verdict(raw)
    same = ["event_id", "source", "amount", "currency", "user_id"]
    both = routing.clean_events(judged).select(same).unionAll(routing.quarantine_events(judged).select(same))
    assert both.exceptAll(raw.select(same)).isEmpty()
    assert raw.select(same).exceptAll(both).isEmpty()


def test_both_lanes_are_counted_when_one_is_empty(spark):
    judged = Firewall().events_verdict(raw_frame(spark, [event(0), event(1)]))
    assert {tuple(r) for r in routing.route_counts(judged).collect()} == {
        ("clean_events", 2),
        ("quarantine_events", 0),
    }


def test_a_contract_of_ones_own(spark):
    contract = Contract(
        (present("NO_SOURCE", "no_source", "source"), one_of("BAD_NAME", "bad_name", "user_id", ("o'neil", "a\\b")))
    )
    rows = [event(0, user_id="o'neil"), event(1, user_id="a\\b", source=""), event(2, user_id="oneil")]
    judged = Firewall(contract).events_verdict(raw_frame(spark, rows)).orderBy("received_time").collect()
    assert [r["violations"] for r in judged] == [[], ["NO_SOURCE"], ["BAD_NAME"]]
    metrics = Firewall(contract).dq_metrics(raw_frame(spark, rows)).collect()
    assert sum(m["cnt_no_source"] for m in metrics) == 1 and sum(m["cnt_bad_name"] for m in metrics) == 1


def test_tables_of_a_contract_of_ones_own_can_be_stored(spark, tmp_path):
    contract = Contract((present("NO_SOURCE", "no_source", "source"), present("NO_USER", "no_user", "user_id")))
    rows = [event(10 * i + j, source="a" if j else None, user_id=None) for i in range(10) for j in range(2)]
    batch.store_tables(raw_frame(spark, rows), str(tmp_path), Firewall(contract))
    served = tables.read_table(spark, str(tmp_path), "serving_alerts").collect()
    assert {(r["source"], r["top_reason"]) for r in served} == {("a", "NO_USER"), ("unknown", "NO_SOURCE")}
    alerts = tables.read_table(spark, str(tmp_path), "dq_alerts").collect()
    assert {(r["source"], r["top_reason"]) for r in alerts} == {("a", "NO_USER"), (None, "NO_SOURCE")}


def test_random_combinations_agree_with_the_rules_in_plain_python(spark):
    rng = random.Random(7)
    choices = {
        "event_id": [None, "", " ", "e"],
        "user_id": [None, "", "u"],
        "amount": [None, -1.0, 0.0, 99.5, 100000.0, 100000.5, float("nan"), float("inf")],
        "currency": [None, "", "USD", "usd", "JPY", "EURO"],
        "age": [None, -5, 0, 300, 301, 100000],
    }
    picked = [{name: rng.choice(values) for name, values in choices.items()} for _ in range(400)]

    def stamp(age):
        return "soon" if age is None else (START - timedelta(seconds=age)).strftime("%Y-%m-%dT%H:%M:%SZ")

    def expected(row):
        amount, age = row["amount"], row["age"]
        broken = {
            "MISSING_EVENT_ID": not row["event_id"],
            "MISSING_USER_ID": not row["user_id"],
            "AMOUNT_OUT_OF_RANGE": amount is None or not 0 <= amount <= 100000,
            "INVALID_CURRENCY": row["currency"] not in ("USD", "EUR", "GBP", "JPY", "INR"),
            "MALFORMED_TIMESTAMP": age is None,
            "STALE_EVENT": age is not None and age > 300,
        }
        return [code for code, is_broken in broken.items() if is_broken]

    rows = [
        event(0, source=str(i), event_ts=stamp(row["age"]), **{k: v for k, v in row.items() if k != "age"})
        for i, row in enumerate(picked)
    ]
    found = {int(r["source"]): r["violations"] for r in Firewall().events_verdict(raw_frame(spark, rows)).collect()}
    assert found == {i: expected(row) for i, row in enumerate(picked)}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_mean_the_same_in_every_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    texts = ["2024-01-01T00:00:00", "2024-01-01 00:00:00", "2024-01-01", "2024-01-01T05:30:00+05:30", "2024-01-01T00:00:00Z"]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = raw_frame(spark, [event(5, event_id=str(i), event_ts=text) for i, text in enumerate(texts)])
        judged = Firewall().events_verdict(rows).selectExpr("freshness_sec", "is_valid").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [(r["freshness_sec"], r["is_valid"]) for r in judged] == [(5, True)] * len(texts)
