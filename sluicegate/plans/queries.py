"""Every operator as a named query over the test tables.

Times are shown as epoch milliseconds and arrays as comma-separated text, so that
two engines' results can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.operators import anchored, forecast, metrics, ranking, reasons, routing, rules
from sluicegate.operators.contract import ORDER_EVENTS, Contract, one_of
from sluicegate.plans import batch, replay, serving
from sluicegate.plans.pipeline import Firewall
from sluicegate.session import work_folder
from sluicegate.settings import CURRENCIES, INVALID_CURRENCY
from sluicegate.sources import derived, ingest, segments, tables, wire
from sluicegate.streaming import idle
from sluicegate.streaming.alerts import start_alerts, start_serving_alerts
from sluicegate.streaming.board import LiveBoard
from sluicegate.streaming.ledger import Ledger, start_ledger
from sluicegate.streaming.metrics import start_metrics
from sluicegate.streaming.route import start_routing

Query = Callable[[SparkSession, str], DataFrame]

FIREWALL = Firewall()


def comparable(df: DataFrame) -> DataFrame:
    shown = {T.TimestampType: "unix_millis({0}) AS {0}", T.ArrayType: "array_join({0}, ',') AS {0}"}
    return df.selectExpr(*[shown.get(type(f.dataType), "{0}").format(f.name) for f in df.schema.fields])


def _over_raw(build: Callable[[DataFrame], DataFrame], *keep: str) -> Query:
    """A query that is one function of the raw events."""
    return lambda spark, folder: comparable(build(derived.read_raw(spark, folder, *keep)))


# Sources


def inject_rate(spark: SparkSession, folder: str) -> DataFrame:
    rated = derived.injection(derived.read_events(spark, folder))
    return rated.select("event_id", F.col("event_type").alias("source"), "elapsed_ms", "rate", "mode")


def wire_decode(spark: SparkSession, folder: str) -> DataFrame:
    """Round trip through the envelope: plain JSON, ids that contain the byte of a
    brace (123) or bracket (91), and messages whose last byte was lost."""
    raw = derived.read_raw(spark, folder, "sequence")
    schema_id = "CASE sequence % 4 WHEN 1 THEN 1 WHEN 2 THEN 123 WHEN 3 THEN 91 END"
    sent = wire.encode(raw, schema_id=schema_id).select("sequence", "received_time", "value")
    cut = "substring(value, 1, length(value) - 1)"
    damaged = sent.selectExpr(
        "sequence", "received_time", f"CASE WHEN sequence % 50 = 7 THEN {cut} ELSE value END AS value"
    )
    return comparable(wire.decode(damaged).drop("wire_text"))


# Contract and routing


def violations(raw: DataFrame) -> DataFrame:
    return FIREWALL.events_checked(raw).select("sequence", "mode", "violations")


def events_verdict(raw: DataFrame) -> DataFrame:
    return FIREWALL.events_verdict(raw).select(
        "sequence", "event_id", "source", "amount", "currency", "user_id", "event_ts", "violations", "is_valid"
    )


def route_counts(raw: DataFrame) -> DataFrame:
    return routing.route_counts(FIREWALL.events_verdict(raw))


# Metrics, reasons and forecasts

_WINDOW = ("source", "window_start", "window_end")


def reason_counts(raw: DataFrame) -> DataFrame:
    return metrics.reason_counts(FIREWALL.dq_metrics(raw))


def top_reason_full(raw: DataFrame) -> DataFrame:
    return FIREWALL.dq_metrics(raw).selectExpr(*_WINDOW, f"{reasons.most_frequent()} AS top_reason")


def top_reason_simple(raw: DataFrame) -> DataFrame:
    return FIREWALL.dq_metrics(raw).selectExpr(*_WINDOW, f"{reasons.first_occurring()} AS top_reason")


def top_reason_serving(raw: DataFrame) -> DataFrame:
    return FIREWALL.serving_metrics(raw).selectExpr(*_WINDOW, f"{reasons.most_frequent_first_seen()} AS top_reason")


def forecast_damped(raw: DataFrame) -> DataFrame:
    known = forecast.forecast_damped(FIREWALL.dq_metrics(raw))
    return known.select(*_WINDOW, "error_rate_pct", "forecast_error_pct")


def forecast_trend(raw: DataFrame) -> DataFrame:
    known = forecast.forecast_trend(FIREWALL.dq_metrics(raw))
    return known.select(*_WINDOW, "error_rate_pct", "forecast_error_pct")


def _some_blank(raw: DataFrame) -> DataFrame:
    blanked = "CASE sequence % 11 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE source END"
    return raw.withColumn("source", F.expr(blanked))


def serving_windows(raw: DataFrame) -> DataFrame:
    """Serving alerts when some events come without a source."""
    return FIREWALL.serving_alerts(_some_blank(raw))


# Reports


def latest_verdicts(raw: DataFrame) -> DataFrame:
    return ranking.latest_verdicts(raw, FIREWALL.events_verdict)


def latest_quarantine(raw: DataFrame) -> DataFrame:
    return ranking.latest_quarantine(FIREWALL.quarantine_events(raw))


def latest_metrics(raw: DataFrame) -> DataFrame:
    return ranking.latest_metrics(FIREWALL.dq_metrics(raw))


def dlq_report(raw: DataFrame) -> DataFrame:
    return serving.dlq_report(FIREWALL.dlq_feed(raw))


def health_report(raw: DataFrame) -> DataFrame:
    return serving.health_report(FIREWALL.health_board(raw))


def status_counts(raw: DataFrame) -> DataFrame:
    return ranking.status_counts(FIREWALL.health_board(raw))


def chart_bounds(raw: DataFrame) -> DataFrame:
    return ranking.chart_bounds(FIREWALL.worst_source_history(raw))


# Stored outputs


def alerts_reload(spark: SparkSession, folder: str) -> DataFrame:
    """Store alerts with gaps in them, then serve the history from the stored table."""
    root = work_folder(spark, "alerts-reload")
    full = FIREWALL.dq_alerts(derived.read_raw(spark, folder))
    gaps = full.withColumns(
        {
            "source": F.expr("CASE total_events % 13 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE source END"),
            "current_error_pct": F.expr("CASE WHEN total_events % 7 <> 0 THEN current_error_pct END"),
            "forecast_error_pct": F.expr("CASE WHEN total_events % 5 <> 0 THEN forecast_error_pct END"),
            "forecast_upper_pct": F.expr("CASE WHEN total_events % 3 <> 0 THEN forecast_upper_pct END"),
        }
    )
    tables.write_batch(gaps, root, "dq_alerts", 0, F.col("ts"))
    return comparable(serving.history_points(tables.read_table(spark, root, "dq_alerts")))


def quarantine_reload(spark: SparkSession, folder: str) -> DataFrame:
    """Store rejects, some without their violations, then serve the feed rows from them."""
    root = work_folder(spark, "quarantine-reload")
    rejects = FIREWALL.quarantine_events(derived.read_raw(spark, folder))
    gaps = rejects.withColumn("violations", F.when(F.col("event_id").isNotNull(), F.col("violations")))
    tables.write_batch(gaps, root, "quarantine_events", 0, F.col("quarantined_at"))
    return comparable(serving.reject_rows(tables.read_table(spark, root, "quarantine_events")))


def _stored(raw: DataFrame, table: str) -> DataFrame:
    root = work_folder(raw.sparkSession, "stored")
    batch.store_metrics_and_alerts(FIREWALL.events_verdict(raw), root, FIREWALL)
    return comparable(tables.read_table(raw.sparkSession, root, table))


def stored_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts computed from stored metrics."""
    return _stored(derived.read_raw(spark, folder), "dq_alerts")


def stored_serving_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Serving alerts from stored metrics, the blank sources merged window by window."""
    raw = derived.read_raw(spark, folder, "sequence")
    return _stored(_some_blank(raw), "serving_alerts")


def _in_batches(raw: DataFrame, name: str, store: Callable = batch.store_tables, whole: bool = False, again: int = 0) -> str:
    """Store the events in three batches, which are cut between windows and not between blocks.

    ``whole``: as committed tables.  ``again``: so many of the batches are stored a second time, the
    judged events being compacted before the last of them.
    """
    root = work_folder(raw.sparkSession, name)
    if whole:
        tables.commit_whole(raw.sparkSession, root)
    seconds = FIREWALL.settings.window_seconds
    window = F.floor(F.unix_seconds("received_time") / F.lit(seconds))
    first, last = raw.agg(F.min(window), F.max(window)).first()
    cuts = [first + (last - first + 1) * part // 3 for part in range(4)] if first is not None else [0] * 4
    for turn, number in enumerate([*range(3), *range(again)]):
        if turn == again + 2 > 2:
            tables.compact(raw.sparkSession, root, tables.JUDGED)
        some = raw.filter((window >= cuts[number]) & (window < cuts[number + 1]))
        store(some, root, FIREWALL, number)
    return root


def batched_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts of three batches, of which each goes on from the tails of those before."""
    root = _in_batches(derived.read_raw(spark, folder), "batched")
    return comparable(tables.read_table(spark, root, "dq_alerts"))


def batched_serving_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """The serving variant in three batches, with events that lack a source."""
    root = _in_batches(_some_blank(derived.read_raw(spark, folder, "sequence")), "batched-serving")
    return comparable(tables.read_table(spark, root, "serving_alerts"))


def committed_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts of three batches, their metrics and tails read through manifests."""
    root = _in_batches(derived.read_raw(spark, folder), "committed-alerts", whole=True)
    return comparable(tables.read_table(spark, root, "dq_alerts"))


def committed_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Rejects of three batches, the first stored again, then compaction, then the second stored again."""
    raw = derived.read_raw(spark, folder)
    root = _in_batches(raw, "committed-rejects", batch.store_lanes, whole=True, again=2)
    return comparable(tables.read_table(spark, root, "quarantine_events"))


# Streams: the events table is streamed to its end, then the stored output is read.


def _streamed(spark: SparkSession, folder: str, start, name: str, **options: object) -> str:
    """Run a stream over the events to its end; those with windows until the last one is closed."""
    root = work_folder(spark, name)
    checkpoint = f"{root}/checkpoint"

    def run():
        return start(
            derived.raw_events(derived.stream_events(spark, folder)),
            f"{root}/tables",
            checkpoint,
            available_now=True,
            state_partitions=spark.sparkContext.defaultParallelism,
            **options,
        )

    if options:
        idle.run_to_end(run, checkpoint, FIREWALL)
    else:
        run().awaitTermination()
    return f"{root}/tables"


def lanes_of(spark: SparkSession, root: str) -> DataFrame:
    """Both stored lanes, in the same columns."""
    clean = tables.read_table(spark, root, "clean_events").select(
        F.lit("clean_events").alias("lane"),
        "event_id",
        "source",
        "amount",
        "currency",
        "user_id",
        F.unix_millis("event_time").alias("time_ms"),
        F.lit("").alias("violations"),
    )
    rejects = tables.read_table(spark, root, "quarantine_events").select(
        F.lit("quarantine_events").alias("lane"),
        "event_id",
        "source",
        "amount",
        "currency",
        "user_id",
        F.unix_millis("quarantined_at").alias("time_ms"),
        F.array_join("violations", ",").alias("violations"),
    )
    return clean.unionByName(rejects)


def stream_route(spark: SparkSession, folder: str) -> DataFrame:
    return lanes_of(spark, _streamed(spark, folder, start_routing, "stream-route"))


def _as_files(spark: SparkSession, folder: str, name: str) -> str:
    """Events written as a producer would send them, keyed by source, as files of JSON lines."""
    root = work_folder(spark, name)
    events = ingest.by_source(derived.read_raw(spark, folder), 6)
    events.write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(f"{root}/raw")
    return root


def stored_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events read back from keyed files with the declared schema."""
    root = _as_files(spark, folder, "stored-events")
    return comparable(ingest.read_files(spark, f"{root}/raw", "json"))


def stream_replayed(spark: SparkSession, folder: str) -> DataFrame:
    """Files replayed from the first one, two per micro-batch, and routed; run again, which adds nothing."""
    root = _as_files(spark, folder, "stream-replayed")
    for _ in range(2):
        stream = ingest.stream_files(spark, f"{root}/raw", "json", max_files=2)
        start_routing(stream, f"{root}/tables", f"{root}/checkpoint", available_now=True).awaitTermination()
    return lanes_of(spark, f"{root}/tables")


def wire_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events framed and enveloped, streamed from segments a few at a time, stopped and started again."""
    root = work_folder(spark, "wire-stream")
    raw = derived.read_raw(spark, folder, "sequence")
    schema_id = "CASE sequence % 4 WHEN 1 THEN 1 WHEN 2 THEN 123 WHEN 3 THEN 10 END"
    sent = wire.encode(raw, schema_id=schema_id).select("sequence", "value", "received_time")
    for part in range(2):
        some = sent.filter(F.expr(f"sequence % 2 = {part}")).select("value", "received_time")
        segments.write_segments(some.repartition(3, "value"), f"{root}/segments")
        decoded = wire.decode(segments.stream_segments(spark, f"{root}/segments", max_files=2))
        events = wire.events_of(decoded)
        start_routing(events, f"{root}/tables", f"{root}/checkpoint", available_now=True).awaitTermination()
    return lanes_of(spark, f"{root}/tables")


def stream_metrics(spark: SparkSession, folder: str) -> DataFrame:
    root = _streamed(spark, folder, start_metrics, "stream-metrics", idle_close=1e9)
    return comparable(tables.read_table(spark, root, "dq_metrics"))


def stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    root = _streamed(spark, folder, start_alerts, "stream-alerts", idle_close=1e9)
    return comparable(tables.read_table(spark, root, "dq_alerts"))


def stream_serving_alerts(spark: SparkSession, folder: str) -> DataFrame:
    root = _streamed(spark, folder, start_serving_alerts, "stream-serving", idle_close=1e9)
    return comparable(tables.read_table(spark, root, "serving_alerts"))


def stream_late(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Run the ledger over four deliveries of events, a batch each; some of the first come with the last.

    A delivery is as many files as its size asks for, so that no task writes or reads a whole one.
    """
    root = work_folder(spark, "stream-late")
    events = derived.read_events(spark, folder)
    last = events.agg(F.max("event_id")).first()[0] or 0
    part = F.expr(f"CASE WHEN event_id * 2 < {last} AND event_id % 100 = 7 THEN 3 ELSE least(3, event_id * 4 DIV {last + 1}) END")
    timeless = F.expr("CASE WHEN sequence % 1000 <> 500 THEN received_time END")
    for number in range(4):  # the ledger goes on where it was, with what was delivered since
        raw = derived.raw_events(events.filter(part == number).hint("rebalance"), "sequence")
        raw.withColumn("received_time", timeless).drop("sequence").write.mode("append").parquet(f"{root}/raw")
        stream = ingest.stream_files(spark, f"{root}/raw", max_files=None)
        start_ledger(stream, f"{root}/tables", f"{root}/checkpoint", FIREWALL, available_now=True).awaitTermination()
    return f"{root}/tables", f"{root}/checkpoint"


def late_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events that came too late, or without a record time, one by one."""
    root, _ = stream_late(spark, folder)
    return comparable(tables.read_table(spark, root, "late_events"))


def event_totals(spark: SparkSession, folder: str) -> DataFrame:
    """What became of all events: those counted are in closed or in open windows."""
    root, checkpoint = stream_late(spark, folder)
    names = ("events", "counted", "late", "timeless")
    totals = tables.read_table(spark, root, "event_totals").agg(*[F.sum(c).alias(c) for c in names])
    closed = tables.read_table(spark, root, "dq_metrics").select("total_events")
    windows = closed.union(Ledger(checkpoint, FIREWALL).open_windows(spark).select("total_events"))
    return totals.crossJoin(F.broadcast(windows.agg(F.sum("total_events").alias("in_windows"))))


def live_board(spark: SparkSession, folder: str) -> DataFrame:
    """The board that a stream keeps current, after its last batch."""
    root = _streamed(spark, folder, start_serving_alerts, "live-board", idle_close=1e9)
    return comparable(LiveBoard(root).board(spark))


def live_history(spark: SparkSession, folder: str) -> DataFrame:
    """The chart points that a stream keeps current, after its last batch."""
    root = _streamed(spark, folder, start_serving_alerts, "live-history", idle_close=1e9)
    return comparable(LiveBoard(root).history(spark))


# The contract that rejects are judged by again: two more currencies.
_LENIENT = Firewall(
    Contract(
        tuple(
            one_of(rule.code, "bad_currency", "currency", (*CURRENCIES, "BTC", "usd")) if rule.code == INVALID_CURRENCY else rule
            for rule in ORDER_EVENTS.rules
        ),
        ORDER_EVENTS.tie_order,
    )
)


def quarantine_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Every reject after two replays: whether it was released, and after how many attempts."""
    root = work_folder(spark, "quarantine-replay")
    batch.store_lanes(derived.read_raw(spark, folder), root, FIREWALL)
    for _ in range(2):
        replay.replay(spark, root, _LENIENT)
    rejects = replay.with_hash(tables.read_table(spark, root, "quarantine_events"))
    known = rejects.join(replay.history(spark, root), "row_hash")
    return comparable(known.select("event_id", "source", "currency", "violations", "attempts", "released"))


def replayed_clean(spark: SparkSession, folder: str) -> DataFrame:
    """The clean table after two replays: each released event is in it once."""
    root = work_folder(spark, "replayed-clean")
    batch.store_lanes(derived.read_raw(spark, folder), root, FIREWALL)
    for _ in range(2):
        replay.replay(spark, root, _LENIENT)
    return comparable(tables.read_table(spark, root, "clean_events"))


def stored_newest_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The feed of a stored table of many days, read from its newest days."""
    root = work_folder(spark, "newest-rejects")
    raw = derived.read_raw(spark, folder, "sequence")
    rejects = routing.quarantine_events(FIREWALL.events_verdict(raw), "sequence")
    spread = rejects.withColumn("quarantined_at", F.expr("quarantined_at + make_interval(0, 0, 0, CAST(sequence % 7 AS INT))"))
    tables.write_batch(spread, root, "quarantine_events", 0, F.col("quarantined_at"), gather=True)
    rows = tables.newest_rows(spark, root, "quarantine_events", 25)
    return comparable(ranking.latest_quarantine(rows))


# A second contract as a table of rules: other limits, other counters, the user's id as an allowed list of one.
_RULES = [
    (0, "NO_ID", "no_id", "present", "event_id", None, None, None, None, 2),
    (1, "AMOUNT", "amount", "range", "amount", 1.0, 150.0, None, None, 1),
    (2, "FOREIGN", "foreign", "one_of", "currency", None, None, ["EUR", "USD"], None, None),
    (3, "NO_TIME", "no_time", "time", "event_ts", None, None, None, None, 0),
    (4, "OLD", "old", "fresh", "event_ts", None, None, None, 60, None),
]


def _second_contract(spark: SparkSession, folder: str) -> tuple[str, Firewall]:
    """Store all tables under a contract read from a table, and that table beside them."""
    root = work_folder(spark, "second-contract")
    rules.store(spark.createDataFrame(_RULES, rules.SCHEMA), root)
    firewall = Firewall(rules.load(spark, root))
    batch.store_tables(derived.read_raw(spark, folder), root, firewall)
    return root, firewall


def contract_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Stored window metrics under the second contract, with its own counters."""
    root, _ = _second_contract(spark, folder)
    schema = metrics.schema(rules.load(spark, root))
    return comparable(tables.read_table(spark, root, "dq_metrics", schema=schema).drop("avg_freshness_sec", "window_time"))


def contract_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Rejects of a stream under the second contract."""
    root = work_folder(spark, "contract-rejects")
    rules.store(spark.createDataFrame(_RULES, rules.SCHEMA), root)
    firewall = Firewall(rules.load(spark, root))
    raw = derived.raw_events(derived.stream_events(spark, folder))
    start_routing(raw, f"{root}/tables", f"{root}/checkpoint", firewall, available_now=True).awaitTermination()
    return comparable(tables.read_table(spark, f"{root}/tables", "quarantine_events"))


def anchored_windows(raw: DataFrame) -> DataFrame:
    return anchored.anchored_windows(FIREWALL.events_verdict(raw)).drop("window_time")


QUERIES: dict[str, Query] = {
    "raw_events": _over_raw(lambda raw: raw, "sequence", "mode"),
    "inject_rate": inject_rate,
    "wire_decode": wire_decode,
    "events_checked": _over_raw(FIREWALL.events_checked, "sequence"),
    "violations": _over_raw(violations, "sequence", "mode"),
    "events_verdict": _over_raw(events_verdict, "sequence"),
    "clean_events": _over_raw(FIREWALL.clean_events),
    "quarantine_events": _over_raw(FIREWALL.quarantine_events),
    "route_counts": _over_raw(route_counts),
    "dq_metrics": _over_raw(FIREWALL.dq_metrics),
    "reason_counts": _over_raw(reason_counts),
    "top_reason_full": _over_raw(top_reason_full),
    "top_reason_simple": _over_raw(top_reason_simple),
    "top_reason_serving": _over_raw(top_reason_serving),
    "forecast_damped": _over_raw(forecast_damped),
    "forecast_trend": _over_raw(forecast_trend),
    "dq_alerts": _over_raw(FIREWALL.dq_alerts),
    "dq_alerts_simple": _over_raw(FIREWALL.dq_alerts_simple),
    "serving_alerts": _over_raw(FIREWALL.serving_alerts),
    "serving_windows": _over_raw(serving_windows, "sequence"),
    "source_health": _over_raw(FIREWALL.source_health),
    "source_history": _over_raw(FIREWALL.source_history),
    "latest_raw": _over_raw(ranking.latest_raw),
    "latest_verdicts": _over_raw(latest_verdicts),
    "latest_quarantine": _over_raw(latest_quarantine),
    "latest_metrics": _over_raw(latest_metrics),
    "dlq_feed": _over_raw(FIREWALL.dlq_feed),
    "dlq_report": _over_raw(dlq_report),
    "health_board": _over_raw(FIREWALL.health_board),
    "health_report": _over_raw(health_report),
    "status_counts": _over_raw(status_counts),
    "worst_source_history": _over_raw(FIREWALL.worst_source_history),
    "chart_bounds": _over_raw(chart_bounds),
    "alerts_reload": alerts_reload,
    "quarantine_reload": quarantine_reload,
    "stored_alerts": stored_alerts,
    "stored_serving_alerts": stored_serving_alerts,
    "batched_alerts": batched_alerts,
    "batched_serving_alerts": batched_serving_alerts,
    "committed_alerts": committed_alerts,
    "committed_rejects": committed_rejects,
    "stored_events": stored_events,
    "stream_replayed": stream_replayed,
    "stream_route": stream_route,
    "wire_stream": wire_stream,
    "stream_metrics": stream_metrics,
    "stream_alerts": stream_alerts,
    "stream_serving_alerts": stream_serving_alerts,
    "late_events": late_events,
    "event_totals": event_totals,
    "live_board": live_board,
    "live_history": live_history,
    "anchored_windows": _over_raw(anchored_windows),
    "contract_metrics": contract_metrics,
    "contract_rejects": contract_rejects,
    "quarantine_replay": quarantine_replay,
    "replayed_clean": replayed_clean,
    "stored_newest_rejects": stored_newest_rejects,
}
