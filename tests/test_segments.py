"""Segments of framed messages, and both lanes from one pass."""

from __future__ import annotations

import pytest
from helpers import START, event, raw_frame

from sluicegate.plans import batch
from sluicegate.plans.pipeline import Firewall
from sluicegate.sources import segments, tables

MESSAGES = [(b"", START), (b"\n", None), (b"\x00\x00\x00\x05{}\n\n", START), (b"\xff" * 70_000, START), (b"{}", None)]


def test_messages_come_back_whole(spark, tmp_path):
    path = str(tmp_path / "s")
    frame = spark.createDataFrame([*MESSAGES, (None, START)], "value binary, received_time timestamp")
    segments.write_segments(frame.repartition(3), path, frames_per_file=2)
    segments.write_segments(frame.limit(1), path)
    found = [(bytes(r.value), r.received_time) for r in segments.read_segments(spark, path).collect()]
    wanted = [(bytes(r.value), r.received_time) for r in frame.filter("value IS NOT NULL").union(frame.limit(1)).collect()]
    assert sorted(found, key=str) == sorted(wanted, key=str)


def test_a_cut_segment_is_an_error():
    whole = b"\x00\x00\x00\x02" + b"\x00" * 8 + b"ab\n"
    assert list(segments.frames(whole)) == [(b"ab", 0)]
    for cut in range(1, len(whole)):
        with pytest.raises(ValueError):
            list(segments.frames(whole[:cut]))


def test_a_stream_of_segments_is_bounded_and_goes_on(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("s", "out", "c"))
    seen = []
    for part in range(2):
        rows = spark.createDataFrame([(b"%d" % (10 * part + i), START) for i in range(6)], "value binary, received_time timestamp")
        segments.write_segments(rows.repartition(6, "value"), path, frames_per_file=1)
        stream = segments.stream_segments(spark, path, max_files=2)
        query = stream.writeStream.foreachBatch(lambda b, n: seen.append([int(r.value) for r in b.collect()]))
        query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    assert sorted(x for some in seen for x in some) == [*range(6), *range(10, 16)]
    assert len([s for s in seen if s]) >= 6 and max(map(len, seen)) <= 2


def test_lanes_and_metrics_come_from_one_pass(spark, tmp_path):
    root = str(tmp_path)
    rows = [event(i, user_id=None if i % 7 == 0 else "u", source=(None, "", "a")[i % 3]) for i in range(100)] + [event(5, received_time=None)]
    raw, firewall = raw_frame(spark, rows), Firewall()
    batch.store_tables(raw, root)
    for table, wanted in (("clean_events", firewall.clean_events(raw)), ("quarantine_events", firewall.quarantine_events(raw)), ("dq_metrics", firewall.dq_metrics(raw)), ("dq_alerts", firewall.dq_alerts(raw)), ("serving_alerts", firewall.serving_alerts(raw))):
        found = tables.read_table(spark, root, table)
        assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty(), table
    assert set(tables.stored(spark, root)) >= {"clean_events", "quarantine_events", "dq_metrics"}
    plan = tables.read_table(spark, root, "quarantine_events")._jdf.queryExecution().executedPlan().toString()
    assert "lane" in plan and "PartitionFilters" in plan
    metrics = tables.read_judged(spark, root, firewall.contract)
    scan = firewall_scan(metrics, firewall)
    assert "event_ts" not in scan and "currency" not in scan


def firewall_scan(judged, firewall):
    from sluicegate.operators import metrics as measuring

    plan = measuring.window_metrics(judged, firewall.contract)._jdf.queryExecution().executedPlan().toString()
    return plan[plan.index("ReadSchema") :]
