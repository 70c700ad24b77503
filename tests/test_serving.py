"""Reports, boards, reloading stored outputs, views and teardown."""

from __future__ import annotations

from datetime import timedelta

import pytest
from helpers import START, event, raw_frame
from pyspark.sql import functions as F

from sluicegate import schemas
from sluicegate.operators import ranking
from sluicegate.plans import batch, catalog, serving
from sluicegate.plans.pipeline import Firewall
from sluicegate.sources import derived, tables


def alert(source, window, status="OK", eta=None, current=0.0, forecast=0.0, reason="NONE", total=40):
    ts = START + timedelta(seconds=10 * window)
    return (source, ts, total, current, forecast, forecast, eta, status, reason)


def alerts_frame(spark, rows):
    return spark.createDataFrame(rows, schemas.SERVING_ALERTS)


def test_board_shows_the_latest_row_worst_first(spark):
    rows = [
        alert("ok-late", 1, "OK", 9.0),
        alert("ok-none", 1, "OK"),
        alert("watch", 1, "WATCH", 3.0),
        alert("was-bad", 1, "BREACH", 0.0),
        alert("was-bad", 2, "OK", 1.0),
        alert("breach-b", 1, "BREACH", 0.0),
        alert("breach-a", 1, "BREACH", 0.0),
        alert("odd", 1, "SLEEPING", 0.0),
    ]
    board = ranking.health_board(alerts_frame(spark, rows))
    assert [r["source"] for r in board.collect()] == [
        "breach-a",
        "breach-b",
        "watch",
        "was-bad",
        "ok-late",
        "ok-none",
        "odd",
    ]
    assert tuple(ranking.status_counts(board).first()) == (2, 1)


def test_history_keeps_the_newest_points_and_the_chart_fits_them(spark):
    rows = [alert("bad", w, "BREACH", 0.0, current=float(w), forecast=float(w) / 2) for w in range(60)]
    rows += [alert("good", w) for w in range(60)]
    frame = alerts_frame(spark, rows)
    points = ranking.worst_source_history(frame).collect()
    assert {p["source"] for p in points} == {"bad"}
    assert [p["current"] for p in points] == [float(w) for w in range(20, 60)]
    assert ranking.history(frame).count() == 80
    assert ranking.chart_bounds(ranking.worst_source_history(frame)).first()["axis_max"] == 60.0
    calm = alerts_frame(spark, [alert("good", 0, current=1.0)])
    low = ranking.chart_bounds(ranking.worst_source_history(calm)).first()
    assert (low["data_max"], low["axis_max"]) == (4.0, 10.0)


def test_report_texts(spark):
    rows = [
        alert("a", 1, "BREACH", 0.0, 12.345, 3.0, "STALE_EVENT"),
        alert("b", 1, "WATCH", 0.5, 1.0, None, "NONE"),
        alert("c", 1, None, 3.25, None, 0.0, None, total=None),
        alert("d", 1, "OK", None),
    ]
    board = ranking.health_board(alerts_frame(spark, rows))
    got = {r["source"]: r for r in serving.health_report(board).collect()}
    assert [got[s]["time_to_breach"] for s in "abcd"] == ["now", "30s", "3.3 min", "—"]
    assert [got[s]["status"] for s in "abcd"] == ["BREACH", "WATCH", "OK", "OK"]
    assert got["b"]["error_rate"] == "1.00%" and got["b"]["forecast"] == "—" and got["c"]["error_rate"] == "—"
    assert got["c"]["events_per_window"] == "—"
    assert [got[s]["top_failure_mode"] for s in "abcd"] == ["STALE_EVENT", None, None, None]


def test_reject_feed_is_newest_first_and_bounded(spark):
    rows = [event(i, event_id=None if i == 59 else f"e-{i}", source=None, user_id=None) for i in range(60)]
    feed = Firewall().dlq_feed(raw_frame(spark, rows)).orderBy("rank").collect()
    assert [r["rank"] for r in feed] == list(range(1, 51))
    assert [r["event_id"] for r in feed[:2]] == [None, "e-58"]
    report = serving.dlq_report(Firewall().dlq_feed(raw_frame(spark, rows))).orderBy("rank").first()
    assert (report["time"], report["source"], report["event_id"]) == ("00:00:59", "unknown", "null")
    assert report["failed_rules"] == "MISSING_EVENT_ID MISSING_USER_ID"


def test_stored_rejects_are_shown_as_they_are(spark):
    rows = [(None, None, 1.0, "USD", "u", "t", None, START)]
    feed = ranking.dlq_feed(spark.createDataFrame(rows, schemas.QUARANTINE_EVENTS))
    shown = serving.dlq_report(feed).first()
    assert (shown["source"], shown["failed_rules"]) == ("—", "—")


def test_all_tables_of_a_batch_are_stored(spark, tmp_path, sf_medium):
    root, firewall = str(tmp_path), Firewall()
    raw = derived.read_raw(spark, sf_medium)
    batch.store_tables(raw, root)
    batch.store_lanes(raw, root, firewall)
    for name in set(tables.SCHEMAS) - {"undecodable_messages", "late_events", "event_totals"}:
        stored, computed = tables.read_table(spark, root, name), getattr(firewall, name)(raw)
        assert stored.exceptAll(computed).isEmpty() and computed.exceptAll(stored).isEmpty()
        # Lanes lie side by side; each is a file.
        assert len([f for f in stored.inputFiles() if "lane=" not in f or f"lane={name}/" in f]) == 1


def test_reloaded_alerts_get_their_defaults(spark, tmp_path):
    rows = [
        alert("a", 1, current=None, forecast=None),
        alert("", 1),
        alert(None, 1),
        ("b", None, 1, 5.0, 6.0, 7.0, None, "OK", "NONE"),
    ]
    root = str(tmp_path)
    tables.write_batch(alerts_frame(spark, rows), root, "serving_alerts", 0, F.lit("2024-01-01"))
    stored = tables.read_table(spark, root, "serving_alerts")
    got = {r["source"]: r for r in serving.history_points(stored, "TIMESTAMP '2030-01-01'").collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"]["current"], got["a"]["forecast"], got["a"]["upper"]) == (0.0, 0.0, 0.0)
    assert got["b"]["ts"].year == 2030


def test_snapshot_of_stored_tables(spark, tmp_path, sf_small):
    root, firewall = str(tmp_path), Firewall()
    raw = derived.read_raw(spark, sf_small)
    tables.write_batch(firewall.serving_alerts(raw), root, "serving_alerts", 0, F.col("ts"))
    tables.write_batch(firewall.quarantine_events(raw), root, "quarantine_events", 0, F.col("quarantined_at"))
    shot = serving.load_snapshot(spark, root)
    assert shot.sources.count() == 5 and shot.history.count() == 25 and shot.dlq.count() == 11
    assert serving.load_snapshot(spark, root, since="2024-01-02").sources.isEmpty()
    states = serving.snapshot_json(shot.sources).collect()
    assert all('"minutes_to_sla_breach":' in r["state"] for r in states)


def test_writing_a_batch_again_replaces_it(spark, tmp_path):
    root = str(tmp_path)
    for rows in ([alert("a", 1), alert("b", 1)], [alert("a", 1)]):
        tables.write_batch(alerts_frame(spark, rows), root, "serving_alerts", 7, F.col("ts"))
    tables.write_batch(alerts_frame(spark, []), root, "serving_alerts", 8, F.col("ts"))
    assert [r["source"] for r in tables.read_table(spark, root, "serving_alerts").collect()] == ["a"]


def test_views_answer_sql_and_are_torn_down(spark, sf_small):
    catalog.register(derived.read_raw(spark, sf_small))
    assert catalog.listed(spark) == list(catalog.VIEWS)
    assert spark.sql("SELECT count(*) FROM quarantine_events").first()[0] == 11
    assert spark.sql("SELECT sum(total_events) FROM dq_metrics").first()[0] == 1000
    assert catalog.teardown(spark) == list(reversed(catalog.VIEWS))
    assert catalog.listed(spark) == []


def test_views_of_stored_tables_follow_what_is_stored(spark, tmp_path, sf_medium):
    root, firewall = str(tmp_path), Firewall()
    raw = derived.read_raw(spark, sf_medium)
    tables.write_batch(firewall.dq_alerts(raw), root, "dq_alerts", 0, F.col("ts"))
    assert catalog.register_stored(spark, root) == ["dq_alerts", "source_health"]
    assert spark.sql("SELECT count(*) FROM source_health WHERE status = 'BREACH'").first()[0] >= 1
    tables.write_batch(firewall.serving_alerts(raw), root, "serving_alerts", 0, F.col("ts"))
    tables.write_batch(firewall.quarantine_events(raw), root, "quarantine_events", 0, F.col("quarantined_at"))
    assert len(catalog.register_stored(spark, root)) == 7
    counts = [spark.table(name).count() for name in ("health_board", "source_history", "dlq_feed")]
    assert counts == [5, 200, 50]
    assert set(catalog.teardown(spark)) == set(catalog.VIEWS) & {
        "dq_alerts",
        "serving_alerts",
        "quarantine_events",
        "health_board",
        "source_history",
        "source_health",
        "dlq_feed",
    }


def test_teardown_leaves_tables_of_others_alone(spark):
    spark.sql("DROP TABLE IF EXISTS raw_events")
    spark.range(3).write.saveAsTable("raw_events")
    try:
        assert "raw_events" not in catalog.teardown(spark)
        assert spark.table("raw_events").count() == 3
    finally:
        spark.sql("DROP TABLE raw_events")


@pytest.mark.parametrize("table", ["dq_alerts", "dq_alerts_simple", "serving_alerts"])
def test_every_alert_table_can_be_served(spark, sf_medium, tmp_path, table):
    raw = derived.read_raw(spark, sf_medium)
    rows = getattr(Firewall(), table)(raw).withColumn("current_error_pct", F.lit(None).cast("double"))
    tables.write_batch(rows, str(tmp_path), table, 0, F.col("ts"))
    rejects = Firewall().quarantine_events(raw).withColumn("violations", F.lit(None).cast("array<string>"))
    tables.write_batch(rejects, str(tmp_path), "quarantine_events", 0, F.col("quarantined_at"))
    shown = serving.load_snapshot(spark, str(tmp_path), table)
    assert shown.sources.count() == 5
    assert shown.history.filter("current IS NULL").isEmpty()
    assert shown.dlq.filter("violations IS NULL").isEmpty() and shown.dlq.count() == 50
