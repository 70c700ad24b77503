"""Streams give what a batch gives, survive restarts and keep late events."""

from __future__ import annotations

import time

import pytest
from helpers import START, event, raw_frame

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from sluicegate.plans import batch
from sluicegate.plans.pipeline import Firewall
from sluicegate.sources import derived, ingest, tables, wire
from sluicegate.streaming import idle, running
from sluicegate.streaming.alerts import start_alerts, start_serving_alerts
from sluicegate.streaming.metrics import start_metrics
from sluicegate.streaming.route import lane_writer, start_routing, start_undecodable


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def raw(spark, sf_medium):
    return derived.read_raw(spark, sf_medium)


def arrive(raw, path, *quarters):
    """Add the given quarters of the raw events to a folder, one file each."""
    for quarter in quarters:
        seconds = "unix_millis(received_time) / 1000 - 1704067200"
        part = raw.filter(f"{seconds} >= {125 * quarter} AND {seconds} < {125 * (quarter + 1)}")
        part.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)


def closed(rows, column="window_end"):
    """Rows of windows that a watermark 10 s behind the last event has passed."""
    return rows.filter(f"{column} <= TIMESTAMP '2024-01-01 00:08:09.95'")


def test_routing_goes_on_after_a_restart(spark, raw, tmp_path):
    root, checkpoint, path = (str(tmp_path / name) for name in ("out", "checkpoint", "raw"))
    for quarters in ((0, 1), (2, 3)):
        arrive(raw, path, *quarters)
        stream = ingest.stream_files(spark, path, max_files=1)
        query = start_routing(stream, root, checkpoint, available_now=True)
        query.awaitTermination()
        assert sum(p["numInputRows"] for p in query.recentProgress) > 0
    firewall = Firewall()
    assert same_rows(tables.read_table(spark, root, "clean_events"), firewall.clean_events(raw))
    assert same_rows(tables.read_table(spark, root, "quarantine_events"), firewall.quarantine_events(raw))


def test_a_repeated_batch_changes_nothing(spark, raw, tmp_path):
    root = str(tmp_path)
    judged = Firewall().events_verdict(raw)
    write = lane_writer(root)
    for _ in range(2):
        write(judged, 0)
    assert tables.read_table(spark, root, "quarantine_events").count() == 531
    assert tables.read_table(spark, root, "clean_events").count() == 9469


def test_metrics_of_a_stream_equal_those_of_a_batch(spark, raw, tmp_path):
    root, path = str(tmp_path / "out"), str(tmp_path / "raw")
    arrive(raw, path, 0, 1, 2, 3)
    stream = ingest.stream_files(spark, path, max_files=1)
    start_metrics(stream, root, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    stored = tables.read_table(spark, root, "dq_metrics")
    assert same_rows(stored, closed(Firewall().dq_metrics(raw)))
    # A few files per batch that closed windows, however many state stores there are.
    assert len(stored.inputFiles()) <= 4 * tables.FILES_PER_DAY


def test_alerts_keep_their_state_over_batches_and_a_restart(spark, raw, tmp_path):
    root, checkpoint, path = (str(tmp_path / name) for name in ("out", "checkpoint", "raw"))
    for quarters in ((0, 1), (2, 3)):
        arrive(raw, path, *quarters)
        stream = ingest.stream_files(spark, path, max_files=1)
        start_alerts(stream, root, checkpoint, available_now=True).awaitTermination()
    firewall = Firewall()
    assert same_rows(tables.read_table(spark, root, "dq_alerts"), closed(firewall.dq_alerts(raw), "ts"))
    assert same_rows(tables.read_table(spark, root, "dq_alerts_simple"), closed(firewall.dq_alerts_simple(raw), "ts"))
    assert same_rows(tables.read_table(spark, root, "dq_metrics"), closed(firewall.dq_metrics(raw)))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_late_events_are_routed_but_not_counted_in_closed_windows(spark, tmp_path):
    path = str(tmp_path / "raw")
    batches = (
        [event(1), event(5), event(100)],
        # The watermark now stands at 90 s; this batch closes the first window.
        [event(101)],
        [event(6, event_id="late", user_id=None), event(102)],
        [event(300)],
    )
    for rows in batches:
        raw_frame(spark, rows).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    stream = ingest.stream_files(spark, path, max_files=1)
    query = start_metrics(stream, str(tmp_path / "m"), str(tmp_path / "cm"), available_now=True)
    query.awaitTermination()
    start_routing(stream, str(tmp_path / "r"), str(tmp_path / "cr"), available_now=True).awaitTermination()
    metrics = tables.read_table(spark, str(tmp_path / "m"), "dq_metrics").orderBy("window_start").collect()
    assert [(m["total_events"], m["bad_events"]) for m in metrics] == [(2, 0), (3, 0)]
    assert running.dropped_late(query) == 1
    rejects = tables.read_table(spark, str(tmp_path / "r"), "quarantine_events").collect()
    assert [r["event_id"] for r in rejects] == ["late"]


def test_messages_are_decoded_routed_and_none_is_lost(spark, raw, tmp_path):
    path, root = str(tmp_path / "messages"), str(tmp_path / "out")
    first = raw.filter("received_time < TIMESTAMP '2024-01-01 00:01:00'")
    sent = wire.encode(first, schema_id="IF(event_id IS NULL, NULL, 123)").select("value", "received_time")
    broken = spark.createDataFrame([(bytearray(b"{oops"), START)], sent.schema)
    sent.unionAll(broken).coalesce(1).write.parquet(path)
    messages = spark.readStream.schema(sent.schema).parquet(path)
    decoded = wire.decode(messages)
    start_routing(wire.events_of(decoded), root, str(tmp_path / "c1"), available_now=True).awaitTermination()
    start_undecodable(decoded, root, str(tmp_path / "c2"), available_now=True).awaitTermination()
    firewall = Firewall()
    assert same_rows(tables.read_table(spark, root, "clean_events"), firewall.clean_events(first))
    assert same_rows(tables.read_table(spark, root, "quarantine_events"), firewall.quarantine_events(first))
    assert [r["wire_text"] for r in tables.read_table(spark, root, "undecodable_messages").collect()] == ["{oops"]


def test_unnamed_sources_keep_state_too(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = [event(s, source=source, user_id=None) for s in (1, 11, 21, 31) for source in (None, "", "a")]
    raw = raw_frame(spark, [*rows, event(500)])
    raw.coalesce(1).write.parquet(path)
    stream = ingest.stream_files(spark, path)
    root = str(tmp_path / "out")
    start_serving_alerts(stream, root, str(tmp_path / "c"), available_now=True).awaitTermination()
    expected = Firewall().serving_alerts(raw).filter("ts < TIMESTAMP '2024-01-01 00:05:00'")
    assert same_rows(tables.read_table(spark, root, "serving_alerts"), expected) and expected.count() == 8


def finished(query, root, wanted, seconds=90):
    deadline, rows = time.time() + seconds, []
    try:
        while len(rows) < wanted and time.time() < deadline and query.isActive:
            time.sleep(1)
            try:
                rows = tables.read_table(query_session(query), root, "dq_metrics").collect()
            except AnalysisException:
                continue  # nothing stored yet
    finally:
        stopped = running.stop_all(query_session(query))
    assert stopped == ["sluicegate_metrics"]
    return rows


def query_session(query):
    return SparkSession.active()


def test_idle_windows_close_and_no_backlog_is_lost(spark, tmp_path):
    """Four old files, one per trigger, with the closing of idle windows on from the start."""
    path, root = str(tmp_path / "raw"), str(tmp_path / "out")
    for part in range(4):
        raw_frame(spark, [event(100 * part + i) for i in range(100)]).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    query = start_metrics(
        ingest.stream_files(spark, path, max_files=1), root, str(tmp_path / "c"), idle_close=2.0, every="1 second"
    )
    rows = finished(query, root, 40)
    assert len(rows) == 40 and sum(r["total_events"] for r in rows) == 400


def test_a_bounded_run_stores_every_window(spark, raw, tmp_path):
    root, path, checkpoint = (str(tmp_path / name) for name in ("out", "raw", "checkpoint"))
    arrive(raw, path, 0, 1, 2, 3)

    def start():
        stream = ingest.stream_files(spark, path, max_files=1)
        return start_alerts(stream, root, checkpoint, idle_close=1e9, available_now=True)

    idle.run_to_end(start, checkpoint)
    assert same_rows(tables.read_table(spark, root, "dq_metrics"), Firewall().dq_metrics(raw))
    assert same_rows(tables.read_table(spark, root, "dq_alerts"), Firewall().dq_alerts(raw))


def test_writers_of_one_folder_keep_each_others_rows(spark, tmp_path):
    """A batch job, a stream, and a stream with another checkpoint; then the first one again."""
    root = str(tmp_path / "out")
    batch.store_tables(raw_frame(spark, [event(i) for i in range(200)]), root)
    for name, first in (("a", 1000), ("b", 2000), ("a", 3000)):
        path = str(tmp_path / f"raw-{name}")
        raw_frame(spark, [event(first + i) for i in range(3)]).coalesce(1).write.mode("append").parquet(path)
        stream = ingest.stream_files(spark, path)
        start_routing(stream, root, str(tmp_path / f"c-{name}"), available_now=True).awaitTermination()
    assert tables.read_table(spark, root, "clean_events").count() == 209
