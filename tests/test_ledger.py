"""What goes from batch to batch: tails, open windows, the live board, replays; windows by first event."""

from __future__ import annotations

import random
import time
from datetime import timedelta
from pathlib import Path

import pytest
from helpers import START, event, metric, metrics_frame, raw_frame

from pyspark.sql import functions as F

from sluicegate import schemas
from sluicegate.operators import anchored, routing
from sluicegate.operators.contract import ORDER_EVENTS, Contract
from sluicegate.operators.forecast import RECENT, with_recent
from sluicegate.plans import queries, replay
from sluicegate.plans.pipeline import Firewall
from sluicegate.settings import Settings
from sluicegate.sources import folders, ingest, tables
from sluicegate.streaming import ledger as ledgers
from sluicegate.streaming import running
from sluicegate.streaming.board import LiveBoard
from sluicegate.streaming.kept import Kept, Tails
from sluicegate.streaming.ledger import Ledger, ledger_writer, start_ledger

FIREWALL = Firewall()


def rates(n, seed=1):
    rng = random.Random(seed)
    return [metric(source, w, rng.randrange(10001) / 100) for source in ("a", "b", None) for w in range(n) if rng.random() < 0.8]


def recent_of(rows):
    return {(r.source, r.window_start): list(r[RECENT]) for r in rows.collect()}


@pytest.mark.parametrize("block_windows", [4, 65536])
def test_tails_carry_rates_over_batches(spark, tmp_path, block_windows):
    rows, settings = rates(60), Settings(block_windows=block_windows)
    wanted = recent_of(with_recent(metrics_frame(spark, rows), 7))
    tails, found = Tails(str(tmp_path / "tails"), 7, settings), {}
    parts = [(0, 3), (3, 4), (4, 40), (40, 40), (40, 60)]
    for number, (low, high) in enumerate(parts):
        closed = metrics_frame(spark, [r for r in rows if low <= (r[1] - START).total_seconds() / 10 < high])
        for _ in range(2):  # a repeated batch gives the same
            known = tails.known(closed, number)
            again = recent_of(known)
            assert found.keys().isdisjoint(again)
            tails.keep(known, number)
        plan = known._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan
        found |= again
    assert found == wanted
    assert len(folders.numbers(spark, str(tmp_path / "tails"), "batch_id")) <= 3


def test_kept_tables_read_what_came_before(spark, tmp_path):
    kept = Kept(str(tmp_path / "k"), "n bigint")
    assert kept.before(spark, 5).collect() == [] and kept.newest(spark).collect() == []
    for number in (1, 2, 5):
        kept.keep(spark.range(number, number + 1).select(F.col("id").alias("n")), number)
    assert [r.n for r in kept.before(spark, 5).collect()] == [2] and [r.n for r in kept.newest(spark).collect()] == [5]


def late_run(spark, folder, cuts):
    """The same events in files cut at ``cuts``; 50 of the first ones come with the last file."""
    rows = [event(i / 2, event_id=f"e{i}", user_id=None if i % 9 == 0 else "u") for i in range(400)]
    late, rest = rows[:100:2], rows[1:100:2] + rows[100:]
    timeless = [event(3, event_id=f"t{i}", received_time=None) for i in range(4)]
    edges = [0, *cuts, len(rest)]
    for low, high in zip(edges, edges[1:], strict=False):
        part = rest[low:high] + (late + timeless if high == len(rest) else [])
        raw_frame(spark, part).coalesce(1).write.mode("append").parquet(f"{folder}/raw")
        time.sleep(0.05)
    stream = ingest.stream_files(spark, f"{folder}/raw", max_files=1)
    start_ledger(stream, f"{folder}/out", f"{folder}/c", available_now=True).awaitTermination()
    return rest + late


@pytest.mark.parametrize("cuts", [(200,), (60, 130, 200, 340)])
def test_every_late_event_is_counted(spark, tmp_path, cuts):
    folder = str(tmp_path)
    late_run(spark, folder, cuts)
    found = tables.read_table(spark, f"{folder}/out", "late_events")
    assert found.filter("late").count() == 50 and found.filter("NOT late AND received_time IS NULL").count() == 4
    totals = tables.read_table(spark, f"{folder}/out", "event_totals").agg(*[F.sum(c).alias(c) for c in ("events", "counted", "late", "timeless")]).first()
    assert tuple(totals) == (404, 350, 50, 4)
    closed = tables.read_table(spark, f"{folder}/out", "dq_metrics")
    opened = Ledger(f"{folder}/c", FIREWALL).open_windows(spark)
    assert closed.select(F.sum("total_events")).first()[0] + opened.select(F.sum("total_events")).first()[0] == 350
    counted = FIREWALL.dq_metrics(spark.read.schema(schemas.RAW_EVENTS).parquet(f"{folder}/raw").filter("received_time >= TIMESTAMP '2024-01-01 00:00:50Z'"))
    assert closed.filter("window_start >= TIMESTAMP '2024-01-01 00:00:50Z'").unionByName(opened).exceptAll(counted).isEmpty()


def test_a_repeated_batch_of_the_ledger_changes_nothing(spark, tmp_path):
    write = ledger_writer(str(tmp_path / "out"), str(tmp_path / "c"), FIREWALL)
    batches = [raw_frame(spark, rows) for rows in ([event(1), event(45)], [event(2), event(46), event(90)], [])]
    for number, rows in enumerate(batches):
        for _ in range(2):
            write(rows, number, "w")
    root = str(tmp_path / "out")
    assert [r.event_id for r in tables.read_table(spark, root, "late_events").collect()] == ["e-2"]
    assert sorted(r.total_events for r in tables.read_table(spark, root, "dq_metrics").collect()) == [1, 2]
    assert tables.read_table(spark, root, "event_totals").agg(F.sum("events"), F.sum("late")).first()[:] == (5, 1)


def test_tasks_of_the_ledger_follow_the_windows(spark, tmp_path, monkeypatch):
    """Not the session's shuffle partitions: what is held, and so every table and file, is split by rows."""
    rows = raw_frame(spark, [event(s, source=f"s{k}") for k in range(40) for s in (1, 25, 35)])
    kept = []
    for number, most in enumerate((1000, 30)):
        monkeypatch.setattr(ledgers, "WINDOWS_PER_TASK", most)
        folder = tmp_path / str(number)
        ledger_writer(str(folder / "out"), str(folder / "c"), FIREWALL)(rows, 0, "w")
        files = [len(list(folder.glob(f"{below}/**/part-*.parquet"))) for below in ("c-ledger/open", "out/dq_metrics")]
        assert files == [1, 1] if number == 0 else min(files) > 1
        opened = Ledger(str(folder / "c"), FIREWALL).open_windows(spark)
        closed = tables.read_table(spark, str(folder / "out"), "dq_metrics").select(opened.columns)
        assert (opened.count(), closed.count()) == (80, 40)
        kept.append(sorted(map(str, opened.unionByName(closed).collect())))
    assert kept[0] == kept[1]


def test_deliveries_are_written_and_read_by_many_tasks(spark, tmp_path):
    """Each is one batch all the same: what is late depends on it."""
    columns = ("id AS event_id", "id % 7 AS user_id", "if(id % 2 = 0, 'click', 'view') AS event_type", "1D AS value")
    spark.range(4000).selectExpr(*columns).write.parquet(f"{tmp_path}/events.parquet")
    with running.query_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}):
        root, checkpoint = queries.stream_late(spark, str(tmp_path))
    assert len(list(Path(root).parent.glob("raw/part-*.parquet"))) > 4
    late = tables.read_table(spark, root, "late_events").collect()
    assert sorted(r.event_id for r in late if r.late) == sorted(f"e-{n}" for n in range(7, 2000, 100))
    assert sorted(r.event_id for r in late if r.received_time is None) == sorted(f"e-{n}" for n in range(500, 4000, 1000))
    totals = tables.read_table(spark, root, "event_totals")
    assert totals.count() == 4 and totals.agg(F.sum("events"), F.sum("late"), F.sum("timeless")).first()[:] == (4000, 20, 4)
    windows = tables.read_table(spark, root, "dq_metrics").select("total_events").union(Ledger(checkpoint, FIREWALL).open_windows(spark).select("total_events"))
    assert windows.agg(F.sum("total_events")).first()[0] == 3976


def test_the_board_is_current_after_every_batch(spark, tmp_path):
    settings = Settings(history_points=3)
    firewall, board = Firewall(settings=settings), LiveBoard(str(tmp_path), settings)
    raw = raw_frame(spark, [event(s + k, source=source, user_id=None if s % 20 else "u") for s in range(0, 120, 10) for k in range(3) for source in ("a", "", None, "b") if source != "b" or s < 50])
    served = firewall.serving_alerts(raw).cache()
    for number, until in enumerate((20, 30, 80, 80, 130)):
        low = (0, 20, 30, 80, 80)[number]
        at = [F.lit(START + timedelta(seconds=s)) for s in (low, until)]
        batch = served.filter((F.col("ts") > at[0]) & (F.col("ts") <= at[1]))
        for _ in range(2):
            board.update(batch, number, "w")
        sofar = served.filter(F.col("ts") <= at[1])
        from sluicegate.operators import ranking

        assert board.board(spark).collect() == ranking.health_board(sofar).collect()
        assert sorted(map(str, board.history(spark).collect())) == sorted(map(str, ranking.history(sofar, settings).collect()))


def brute_anchored(rows, width):
    out = {}
    for source in {s for s, _ in rows}:
        start = None
        for at in sorted(t for s, t in rows if s == source):
            if start is None or at - start >= width:
                start = at
            out[source, start] = out.get((source, start), 0) + 1
    return out


@pytest.mark.parametrize(("seed", "gap", "slots"), [(1, 4, 1024), (2, 60, 2), (3, 3000, 3), (4, 1, 4)])
def test_windows_begin_with_first_events(spark, monkeypatch, seed, gap, slots):
    monkeypatch.setattr(anchored, "SLOTS", slots)
    monkeypatch.setattr(anchored, "LEVELS", 14)
    rng, rows = random.Random(seed), []
    for source in ("a", "b", "", None, "once"):
        at = rng.randrange(50)
        for _ in range(1 if source == "once" else 60):
            at += rng.choice([0, 0.5, 10, rng.randrange(1, gap + 1)])
            rows.append((source, at))
    raw = raw_frame(spark, [event(t, source=s) for s, t in rows] + [event(1, source="a", received_time=None)])
    found = anchored.anchored_windows(FIREWALL.events_verdict(raw)).collect()
    mine = {(r.source, (r.window_start - START.replace(tzinfo=None)).total_seconds() if r.window_start.tzinfo is None else (r.window_start - START).total_seconds()): r.total_events for r in found}
    assert mine == brute_anchored([(s or "unknown", t) for s, t in rows], 10)
    assert all(r.window_end - r.window_start == timedelta(seconds=10) for r in found)


def test_no_events_have_no_windows(spark):
    assert anchored.anchored_windows(FIREWALL.events_verdict(raw_frame(spark, []))).collect() == []


def test_rejects_are_released_once(spark, tmp_path):
    root = str(tmp_path)
    rows = [event(1, event_id="x", currency="BTC"), event(2, event_id="y", user_id=None), event(3, event_id="x2", currency="BTC"), event(3, event_id="x2", currency="BTC"), event(4)]
    judged = FIREWALL.events_verdict(raw_frame(spark, rows))
    tables.write_batch(routing.quarantine_events(judged), root, "quarantine_events", 0, F.col("quarantined_at"))
    tables.write_batch(routing.clean_events(judged, "received_time"), root, "clean_events", 0, F.col("received_time"))
    lenient = Firewall(Contract(tuple(r for r in ORDER_EVENTS.rules if r.flag != "v_bad_currency")))
    assert [replay.replay(spark, root, firewall) for firewall in (FIREWALL, lenient, lenient, lenient)] == [0, 1, 2, 3]
    clean = sorted(r.event_id for r in tables.read_table(spark, root, "clean_events").collect())
    assert clean == ["e-4", "x", "x2", "x2"]
    assert [r.event_id for r in replay.open_rejects(spark, root).collect()] == ["y"]
    assert sorted((r.attempts, r.released) for r in replay.history(spark, root).collect()) == [(2, True), (2, True), (3, False)]


def test_a_short_list_reads_the_newest_day(spark, tmp_path):
    root = str(tmp_path)
    rows = [event(86400 * day + s, user_id=None) for day in range(9) for s in range(4)] + [event(5, user_id=None, received_time=None)]
    rejects = FIREWALL.quarantine_events(raw_frame(spark, rows))
    tables.write_batch(rejects, root, "quarantine_events", 0, F.col("quarantined_at"))
    assert tables.days(spark, root, "quarantine_events")[0] == "2024-01-09" and len(tables.days(spark, root, "quarantine_events")) == 9
    for count, n_days in ((1, 1), (4, 1), (5, 2), (9, 4)):
        found = tables.newest_rows(spark, root, "quarantine_events", count)
        assert found.count() == 4 * n_days
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in plan and len(found.inputFiles()) >= n_days
    assert tables.newest_rows(spark, root, "quarantine_events", 99).count() == 37
    assert tables.days(spark, root, "nothing") == []
