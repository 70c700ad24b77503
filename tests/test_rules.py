"""Contracts from a table of rules."""

from __future__ import annotations

import pytest
from helpers import event, raw_frame

from sluicegate.operators import metrics as measuring
from sluicegate.operators import rules
from sluicegate.operators.contract import ORDER_EVENTS
from sluicegate.plans.pipeline import Firewall
from sluicegate.settings import CURRENCIES
from sluicegate.sources import ingest, tables
from sluicegate.streaming.alerts import start_alerts

OWN = [
    (0, "MISSING_EVENT_ID", "missing_id", "present", "event_id", None, None, None, None, 5),
    (1, "MISSING_USER_ID", "missing_user", "present", "user_id", None, None, None, None, 2),
    (2, "AMOUNT_OUT_OF_RANGE", "amount_range", "range", "amount", 0.0, 100000.0, None, None, 1),
    (3, "INVALID_CURRENCY", "bad_currency", "one_of", "currency", None, None, list(CURRENCIES), None, 0),
    (4, "MALFORMED_TIMESTAMP", "bad_timestamp", "time", "event_ts", None, None, None, None, 3),
    (5, "STALE_EVENT", "stale", "fresh", "event_ts", None, None, None, 300, 4),
]


def test_the_usual_contract_as_a_table(spark):
    made = rules.compiled(spark.createDataFrame(OWN[::-1], rules.SCHEMA))
    rows = [event(1, user_id=None), event(2, amount=-1.0, currency="x"), event(3, event_ts="?"), event(4, event_id="")]
    raw = raw_frame(spark, rows)
    assert made.judge(raw).collect() == ORDER_EVENTS.judge(raw).collect()
    assert made.counters == ORDER_EVENTS.counters and made.tie_order == ORDER_EVENTS.tie_order


@pytest.mark.parametrize("change", [{1: "MISSING_EVENT_ID"}, {0: 0}, {2: "missing_id"}, {3: "odd"}])
def test_tables_that_are_no_contract(spark, change):
    bad = tuple(change.get(i, v) for i, v in enumerate(OWN[1]))
    with pytest.raises(ValueError):
        rules.compiled(spark.createDataFrame([OWN[0], bad], rules.SCHEMA))
    two = [OWN[4], (*OWN[5][:4], "other_ts", *OWN[5][5:])]
    with pytest.raises(ValueError):
        rules.compiled(spark.createDataFrame(two, rules.SCHEMA))


def test_another_contract_from_streams_to_stored_reads(spark, tmp_path):
    """Other counters, and the event's own time in another column."""
    root = str(tmp_path / "out")
    assert rules.load(spark, root) is None
    mine = [(0, "NOBODY", "nobody", "present", "user_id", None, None, None, None, None), (1, "UNTIMED", "untimed", "time", "currency", None, None, None, None, None)]
    rules.store(spark.createDataFrame(mine, rules.SCHEMA), root)
    firewall = Firewall(rules.load(spark, root))
    rows = [event(i, user_id=None if i % 3 == 0 else "u", currency="2024-01-01" if i % 4 else "EUR") for i in range(120)]
    raw_frame(spark, [*rows, event(300)]).coalesce(1).write.parquet(str(tmp_path / "raw"))
    start_alerts(ingest.stream_files(spark, str(tmp_path / "raw")), root, str(tmp_path / "c"), firewall, available_now=True).awaitTermination()
    schema = measuring.schema(rules.load(spark, root))
    found = tables.read_table(spark, root, "dq_metrics", schema=schema)
    wanted = firewall.dq_metrics(raw_frame(spark, rows))
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty() and wanted.count() == 12
    reasons = {r.top_reason for r in tables.read_table(spark, root, "dq_alerts").collect()}
    assert reasons == {"NOBODY"}
