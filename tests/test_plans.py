"""The plans a large cluster depends on: few shuffles, pruned scans, no Python."""

from __future__ import annotations

import re

import pytest
from helpers import event, raw_frame

from sluicegate.operators import forecast, series
from sluicegate.plans.pipeline import Firewall
from sluicegate.plans.queries import QUERIES
from sluicegate.sources import ingest


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Raw events as a deployment would read them."""
    path = str(tmp_path_factory.mktemp("raw") / "events")
    raw_frame(spark, [event(i / 4) for i in range(400)]).write.parquet(path)
    return ingest.read_files(spark, path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> int:
    return len(re.findall(r"Exchange (?:hash|range)partitioning", text))


# Queries that are one plan, without a stored table in between.
STORING = {"wire_stream", "late_events", "event_totals", "live_board", "live_history", "anchored_windows", "quarantine_replay", "replayed_clean", "contract_metrics", "contract_rejects"}
BATCH = [name for name in QUERIES if not name.startswith(("stream_", "stored_", "batched_")) and not name.endswith("_reload") and name not in STORING]


@pytest.mark.parametrize("name", BATCH)
def test_no_query_leaves_the_jvm_or_joins(spark, sf_small, name):
    text = plan(QUERIES[name](spark, sf_small))
    assert "Python" not in text and "Pandas" not in text
    assert "Join" not in text and "CartesianProduct" not in text
    # One scan, of the four columns needed at most.
    assert text.count("FileScan") == 1
    assert "props" not in text.split("ReadSchema")[1]


@pytest.mark.parametrize(
    "name, expected",
    [
        ("events_verdict", 0),
        ("clean_events", 0),
        ("quarantine_events", 0),
        ("dq_metrics", 1),
        ("serving_metrics", 1),
        ("dlq_feed", 0),
        # Metrics, then frames within blocks, then frames across block borders.
        ("dq_alerts", 3),
        ("serving_alerts", 3),
        # Metrics, then the newest rows per source; the rest reuses that layout.
        ("source_health", 2),
        ("source_history", 2),
        ("worst_source_history", 2),
    ],
)
def test_number_of_shuffles(stored, name, expected):
    assert shuffles(plan(getattr(Firewall(), name)(stored))) == expected


def test_stored_metrics_are_shuffled_once_for_forecasts(spark, stored, tmp_path):
    """Whole rows go through one exchange; the others have tails alone, or are cut before."""
    metrics, tails = str(tmp_path / "metrics"), str(tmp_path / "tails")
    Firewall().dq_metrics(stored).write.parquet(metrics)
    rows = spark.read.parquet(metrics)
    forecast.block_tails(rows, 30).write.parquet(tails)
    assert "WindowGroupLimit" in plan(forecast.block_tails(rows, 30))
    handed = series.carried(spark.read.parquet(tails), 30)
    assert "cnt_" not in plan(handed)
    text = plan(forecast.with_recent_from(rows, handed, 30))
    assert "Join" not in text and "Python" not in text
    assert shuffles(text) - shuffles(plan(handed)) == 1


def test_metrics_combine_before_the_shuffle(stored):
    text = plan(Firewall().dq_metrics(stored))
    assert text.index("Exchange") < text.index("partial_count")


def test_newest_rows_are_cut_before_the_shuffle(stored):
    text = plan(Firewall().source_history(stored))
    assert re.search(r"Exchange hashpartitioning\(source.*\n.*WindowGroupLimit .*Partial", text)


def test_contract_conditions_reach_the_scan_and_times_are_parsed_once(stored):
    text = plan(Firewall().clean_events(stored))
    pushed = re.search(r"PushedFilters: \[(.*)", text).group(1)
    assert "IsNotNull(user_id)" in pushed and "GreaterThanOrEqual(amount,0.0)" in pushed
    assert text.count("RLIKE") == 1
    assert plan(Firewall().quarantine_events(stored)).count("RLIKE") == 1


def test_only_needed_columns_are_read(stored):
    text = plan(Firewall().dq_metrics(stored).select("source", "window_start", "total_events"))
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert "amount" not in schema and "user_id" not in schema


def test_newest_events_use_a_top_k(stored):
    assert "TakeOrderedAndProject" in plan(Firewall().dlq_feed(stored))
