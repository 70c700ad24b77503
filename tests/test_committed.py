"""Committed tables: whole batches, pruned days, compaction, races."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from helpers import event, raw_frame

from sluicegate.plans import batch
from sluicegate.plans.pipeline import Firewall
from sluicegate.sources import committed, derived, folders, tables
from sluicegate.streaming.route import start_routing

FIREWALL = Firewall()
REJECTS = "quarantine_events"
DAY_SECONDS = 86400


@pytest.fixture
def root(spark, tmp_path):
    tables.commit_whole(spark, str(tmp_path))
    return str(tmp_path)


def store(spark, root, batch_id, ids, days=3, writer=tables.BATCH_JOB):
    """One reject per id and day."""
    rows = [event(DAY_SECONDS * day + i, event_id=f"{name}{day}", user_id=None) for day in range(days) for i, name in enumerate(ids)]
    rejects = FIREWALL.quarantine_events(raw_frame(spark, rows))
    tables.write_batch(rejects, root, REJECTS, batch_id, F.col("quarantined_at"), writer=writer)


def ids(rows):
    return sorted(r.event_id for r in rows.select("event_id").collect())


def expected(*names, days=range(3)):
    return sorted(f"{name}{day}" for name in names for day in days)


def stored_ids(spark, root, **how):
    return ids(tables.read_table(spark, root, REJECTS, **how))


def test_a_repeated_batch_leaves_no_gap(spark, root):
    store(spark, root, 0, "ab")
    store(spark, root, 1, "c")
    opened = tables.read_table(spark, root, REJECTS)
    store(spark, root, 0, "ax")
    assert stored_ids(spark, root) == expected("a", "c", "x")
    # Who began to read before still reads the table as it was.
    assert ids(opened) == expected("a", "b", "c")


def test_a_batch_that_breaks_off_is_not_seen(spark, root):
    store(spark, root, 0, "ab")
    rejects = tables.read_table(spark, root, REJECTS)
    broken = rejects.withColumn("user_id", F.when(F.col("event_id") == "b1", F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        tables.write_batch(broken, root, REJECTS, 0, F.col("quarantined_at"))
    assert stored_ids(spark, root) == expected("a", "b")
    # Its files are there, and no reader of folders is meant to see them.
    assert len([n for n in folders.names(spark, f"{root}/{REJECTS}") if n.startswith("part=")]) == 2


def test_a_read_of_recent_days_names_only_their_folders(spark, root):
    for number in range(3):
        store(spark, root, number, "ab", days=5)
    recent = tables.read_table(spark, root, REJECTS, since="2024-01-04")
    assert ids(recent) == sorted(expected("a", "b", days=(3, 4)) * 3)
    assert {f.split("received_date=")[1].split("/")[0] for f in recent.inputFiles()} == {"2024-01-04", "2024-01-05"}
    assert tables.days(spark, root, REJECTS) == [f"2024-01-0{day}" for day in (5, 4, 3, 2, 1)]
    assert tables.newest_rows(spark, root, REJECTS, 4).count() == 6
    assert tables.read_table(spark, root, REJECTS, since="2025-01-01").collect() == []


def test_compaction_changes_no_row_and_batches_still_replace_theirs(spark, root):
    for number, name in enumerate("abcd"):
        store(spark, root, number, name)
    store(spark, root, 0, "s", writer="stream")
    before = len(committed.entries(spark, f"{root}/{REJECTS}"))
    assert (before, tables.compact(spark, root, REJECTS, before="2024-01-03")) == (15, 10)
    assert stored_ids(spark, root) == expected("a", "b", "c", "d", "s")
    assert len(committed.entries(spark, f"{root}/{REJECTS}")) == 2 + 5
    store(spark, root, 1, "xy")
    store(spark, root, 1, "y")
    assert stored_ids(spark, root) == expected("a", "c", "d", "s", "y")
    assert ids(tables.read_batch(spark, root, REJECTS, 1)) == expected("y")
    assert ids(tables.read_batch(spark, root, REJECTS, 2)) == expected("c")
    assert ids(tables.read_batch(spark, root, REJECTS, 0, writer="stream")) == expected("s")
    assert tables.compact(spark, root, REJECTS) == 2 + 2 + 5
    assert stored_ids(spark, root) == expected("a", "c", "d", "s", "y")
    assert tables.compact(spark, root, REJECTS) == 0
    assert all(not e.without for e in committed.entries(spark, f"{root}/{REJECTS}"))


def test_a_batch_stored_during_compaction_is_kept(spark, root, monkeypatch):
    for number, name in enumerate("abc"):
        store(spark, root, number, name)
    part, raced = committed._write_part, []

    def slow(rows, path, keys):
        found = part(rows, path, keys)
        if not raced:
            raced.append(True)
            store(spark, root, 1, "z")
        return found

    monkeypatch.setattr(committed, "_write_part", slow)
    tables.compact(spark, root, REJECTS)
    assert raced and stored_ids(spark, root) == expected("a", "c", "z")


def test_a_version_is_moved_into_place_once(spark, root):
    path = f"{root}/{REJECTS}"
    spark.range(1).write.json(f"{path}/_manifest/_staged-x")
    assert not folders.moved(spark, f"{path}/_manifest/_staged-x", f"{path}/_manifest/version=0")
    assert folders.moved(spark, f"{path}/_manifest/_staged-x", f"{path}/_manifest/version=9")
    with pytest.raises(Exception, match="nothing"):
        folders.moved(spark, f"{path}/nothing", f"{path}/elsewhere")


def test_writers_at_the_same_time_lose_nothing(spark, root):
    writers = [threading.Thread(target=store, args=(spark, root, 0, name), kwargs={"writer": f"w-{name}"}) for name in "abcd"]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    assert stored_ids(spark, root) == expected("a", "b", "c", "d")


def test_old_versions_go_with_what_only_they_name(spark, root):
    for name in "abc":
        store(spark, root, 0, name)
    store(spark, root, 1, "d")
    assert tables.expire(spark, root, REJECTS, spare=50) == 0
    assert tables.expire(spark, root, REJECTS, spare=0) == 2
    assert stored_ids(spark, root) == expected("c", "d")
    assert folders.numbers(spark, f"{root}/{REJECTS}/_manifest", "version") == [4]


def test_empty_batches_and_rows_without_a_day(spark, root):
    assert tables.stored(spark, root) == [] and stored_ids(spark, root) == []
    rows = [event(1, event_id="n", user_id=None, received_time=None), event(2, event_id="d", user_id=None)]
    rejects = FIREWALL.quarantine_events(raw_frame(spark, rows))
    tables.write_batch(rejects, root, REJECTS, 0, F.col("quarantined_at"))
    assert stored_ids(spark, root) == ["d", "n"] and stored_ids(spark, root, since="2024-01-01") == ["d"]
    assert tables.stored(spark, root) == [REJECTS] and tables.days(spark, root, REJECTS) == ["2024-01-01"]
    store(spark, root, 1, "e", days=1)
    assert tables.compact(spark, root, REJECTS) == 2 and stored_ids(spark, root) == ["d", "e0", "n"]
    tables.write_batch(rejects.limit(0), root, REJECTS, 0, F.col("quarantined_at"))
    assert stored_ids(spark, root) == ["e0"]


def test_stored_folders_are_not_taken_over(spark, tmp_path):
    store(spark, str(tmp_path), 0, "a")
    with pytest.raises(ValueError, match="not committed"):
        tables.commit_whole(spark, str(tmp_path))


def test_all_tables_and_streams_go_through_manifests(spark, tmp_path, root, sf_small):
    raw = derived.read_raw(spark, sf_small)
    batch.store_tables(raw, root)
    batch.store_tables(raw, root)
    for name in ("clean_events", REJECTS, "dq_metrics", "dq_alerts", "dq_alerts_simple", "serving_alerts"):
        found, computed = tables.read_table(spark, root, name), getattr(FIREWALL, name)(raw)
        assert found.exceptAll(computed).isEmpty() and computed.exceptAll(found).isEmpty()
    # A lane's folders are all that is read of the judged events.
    assert all("lane=quarantine_events" in f for f in tables.read_table(spark, root, REJECTS).inputFiles())
    stream = derived.raw_events(derived.stream_events(spark, sf_small))
    start_routing(stream, root, f"{tmp_path}-checkpoint", available_now=True).awaitTermination()
    total = tables.read_table(spark, root, "clean_events").count() + tables.read_table(spark, root, REJECTS).count()
    assert total == 2 * raw.count()
    assert tables.compact(spark, root, tables.JUDGED) > 0
    assert tables.read_judged(spark, root, FIREWALL.contract).count() == total
