"""The message envelope, and readers of files."""

from __future__ import annotations

import json
from datetime import datetime

from helpers import START, event, raw_frame

from sluicegate import schemas
from sluicegate.plans.pipeline import Firewall
from sluicegate.sources import derived, ingest, wire

GOOD = {"event_id": "e-1", "source": "shop", "amount": 1.5, "currency": "USD", "user_id": "u", "event_ts": "t"}


def decoded(spark, values):
    rows = [(i, bytearray(v) if v is not None else None, START) for i, v in enumerate(values)]
    sent = spark.createDataFrame(rows, "n int, value binary, received_time timestamp")
    return wire.decode(sent)


def enveloped(schema_id: int, body: bytes) -> bytes:
    return b"\x00" + schema_id.to_bytes(4, "big") + body


def test_plain_and_enveloped_messages_decode_whatever_the_schema_id(spark):
    body = json.dumps(GOOD).encode()
    values = [body, enveloped(1, body), enveloped(0x7B, body), enveloped(0x5B, body), enveloped(0x7B5B7B5B, body)]
    rows = decoded(spark, values).collect()
    assert [r["wire_state"] for r in rows] == ["decoded"] * 5
    assert {tuple(r[k] for k in GOOD) for r in rows} == {tuple(GOOD.values())}


def test_garbage_is_kept_apart_and_blanks_are_skipped(spark):
    values = [b"not json", enveloped(1, b'{"event_id": "e'), b"", None, b"null", b'{"event_id": "e"}']
    frame = decoded(spark, values)
    assert [r["wire_state"] for r in frame.orderBy("n").collect()] == [
        "corrupt",
        "corrupt",
        "empty",
        "empty",
        "empty",
        "decoded",
    ]
    assert {r["wire_text"] for r in wire.undecodable(frame).collect()} == {"not json", '{"event_id": "e'}
    assert wire.events_of(frame).count() == 1


def test_fields_of_the_wrong_type_reach_the_contract(spark):
    values = [b'{"event_id": 7, "amount": "42", "extra": {"a": 1}}', b"{}", b"42"]
    events = wire.events_of(decoded(spark, values))
    assert events.schema == schemas.RAW_EVENTS
    judged = Firewall().events_verdict(events).collect()
    assert {(r["event_id"], r["amount"]) for r in judged} == {("7", None), (None, None)}
    assert all("AMOUNT_OUT_OF_RANGE" in r["violations"] for r in judged)


def test_encode_then_decode_is_the_identity(spark, sf_small):
    raw = derived.read_raw(spark, sf_small, "sequence")
    sent = wire.encode(raw, schema_id="CASE sequence % 3 WHEN 1 THEN 123 WHEN 2 THEN 2000000000 END")
    back = wire.events_of(wire.decode(sent.select("value", "received_time")))
    plain = raw.drop("sequence")
    assert back.exceptAll(plain).isEmpty() and plain.exceptAll(back).isEmpty()


def test_a_message_is_parsed_once(spark):
    plan = wire.events_of(decoded(spark, [b"{}"]))._jdf.queryExecution().executedPlan().toString()
    # The second one is for texts with a closing bracket in them alone.
    assert plan.count("from_json") - plan.count("from_json(StructField(only") == 1


def test_output_tables_travel_as_messages(spark, sf_medium):
    raw = derived.read_raw(spark, sf_medium)
    for name, schema in (("dq_alerts", schemas.DQ_ALERTS), ("quarantine_events", schemas.QUARANTINE_EVENTS)):
        rows = getattr(Firewall(), name)(raw)
        sent = wire.messages_of(rows, schema)
        assert sent.filter("key IS NULL").isEmpty()
        back = wire.rows_of(wire.decode(sent, schema), schema)
        assert back.schema == schema and back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()


def test_files_are_read_with_the_declared_schema(spark, tmp_path):
    rows = [event(0), event(1, user_id=None)]
    raw = raw_frame(spark, rows)
    for fmt in ("parquet", "json", "orc", "csv"):
        path = str(tmp_path / fmt)
        raw.write.format(fmt).save(path)
        back = ingest.read_files(spark, path, fmt)
        assert back.schema == schemas.RAW_EVENTS
        assert back.exceptAll(raw).isEmpty() and back.count() == 2


def test_zoneless_times_become_instants(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),)], "received_time timestamp_ntz")
    assert ingest.as_instants(df).schema["received_time"].dataType.simpleString() == "timestamp"


def test_a_hot_source_is_spread_when_keyed(spark):
    raw = raw_frame(spark, [event(i / 10) for i in range(400)])
    keyed = ingest.by_source(raw, 8)
    sizes = [r[0] for r in keyed.groupBy("source").count().select("count").collect()]
    assert sizes == [400]
    used = keyed.selectExpr("spark_partition_id() AS p").distinct().count()
    assert used > 3


def test_only_a_single_object_is_an_event(spark):
    one = b'{"event_id": "e"}'
    refused = [one + one, one + b"\n" + one, one + b" trailing", b"[" + one + b"," + one + b"]", b"[" + one + b"]"]
    refused += [b"42", b'"text"', b"true", one + b" ] [ " + one, one + b"} , {" + one, one + b"]", b'{"only":' + one]
    values = [*refused, one, b"  " + one + b"\n", b'{"event_id": "a ] b", "x": [1, 2]}']
    frame = decoded(spark, values)
    rows = frame.orderBy("n").collect()
    assert [r["wire_state"] for r in rows] == ["corrupt"] * len(refused) + ["decoded"] * 3
    assert [r["wire_text"] for r in rows[: len(refused)]] == [v.decode() for v in refused]
    assert [r["event_id"] for r in rows[len(refused) :]] == ["e", "e", "a ] b"]
