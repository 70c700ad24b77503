"""Forecasts against plain arithmetic, and frames across block borders."""

from __future__ import annotations

import random
from dataclasses import replace
from fractions import Fraction
from math import floor

import pytest
from helpers import metric, metrics_frame

from sluicegate.operators import forecast
from sluicegate.operators.series import carried, newest, tails, trailing, trailing_from
from sluicegate.settings import DEFAULTS


def half_up(value: Fraction) -> int:
    return floor(value + Fraction(1, 2))


def damped(points: list[int]) -> float:
    recent = points[-5:]
    value = Fraction(sum(recent), len(recent)) + Fraction(recent[-1] - recent[0], 2)
    return max(0, min(10000, half_up(value))) / 100


def trend(points: list[int]) -> float | None:
    """Least squares by the textbook formula, in fractions."""
    recent = points[-30:]
    m = len(recent)
    if m < 8:
        return None
    mean_x, mean_y = Fraction(m + 1, 2), Fraction(sum(recent), m)
    slope = sum((j - mean_x) * (y - mean_y) for j, y in enumerate(recent, 1)) / sum(
        (j - mean_x) ** 2 for j in range(1, m + 1)
    )
    return half_up(mean_y + slope * (m + 1 - mean_x)) / 100


def random_series(seed: int) -> dict[str | None, list[tuple[int, int]]]:
    """Sources with gaps, among them one without a name and a very short one."""
    rng = random.Random(seed)
    series = {}
    for source, windows, density in (("dense", 150, 1.0), ("gappy", 300, 0.3), (None, 120, 0.8), ("short", 4, 1.0)):
        kept = [w for w in range(windows) if rng.random() < density]
        series[source] = [(w, rng.choice([0, 0, rng.randrange(400), rng.randrange(10001)])) for w in kept]
    # A long silence: the frame must reach over many empty blocks.
    series["sparse"] = [(w * 97, rng.randrange(500)) for w in range(60)]
    # Before and after the epoch, where block numbers change their sign.
    epoch = -170_406_720
    series["old"] = [(epoch + w, rng.randrange(500)) for w in range(-70, 70)]
    return series


def as_metrics(spark, series):
    rows = [metric(s, w, p / 100) for s, points in series.items() for w, p in points]
    random.Random(1).shuffle(rows)
    return metrics_frame(spark, rows)


def by_source(rows):
    got = {}
    for row in sorted(rows, key=lambda r: r["window_start"]):
        got.setdefault(row["source"], []).append(row["forecast_error_pct"])
    return got


@pytest.mark.parametrize("block", [1, 3, 7, 31, 100, 65536])
def test_forecasts_do_not_depend_on_the_block_size(spark, block):
    series = random_series(block)
    metrics = as_metrics(spark, series)
    settings = replace(DEFAULTS, block_windows=block)
    for add, plain in ((forecast.forecast_damped, damped), (forecast.forecast_trend, trend)):
        expected = {s: [plain([p for _, p in pts[: i + 1]]) for i in range(len(pts))] for s, pts in series.items()}
        assert by_source(add(metrics, settings).collect()) == expected


def test_newest_rows_give_the_same_forecast_as_the_whole_series(spark):
    series = random_series(5)
    metrics = as_metrics(spark, series)
    recent = newest(metrics, DEFAULTS.train_max, "window_start")
    got = by_source(forecast.forecast_trend(recent, recent_only=True).collect())
    assert {s: f[-1] for s, f in got.items()} == {s: trend([p for _, p in pts]) for s, pts in series.items()}


def cut_in_batches(series, cuts):
    """The same series in batches: per source, windows before the first cut, then those before the next."""
    bounds = [None, *cuts, None]
    for low, high in zip(bounds, bounds[1:], strict=False):
        yield {
            s: [p for p in points if (low is None or p[0] >= low) and (high is None or p[0] < high)]
            for s, points in series.items()
        }


@pytest.mark.parametrize("block, cuts", [(3, [40]), (31, [13, 13, 14, 90]), (65536, [13, 14, 15])])
def test_batches_go_on_from_the_tails_of_earlier_ones(spark, tmp_path, block, cuts):
    series = random_series(block)
    settings = replace(DEFAULTS, block_windows=block)
    for depth, finish, plain in ((5, forecast.add_damped, damped), (30, forecast.add_trend, trend)):
        got: dict = {}
        folder = str(tmp_path / f"tails-{depth}")
        for number, part in enumerate(cut_in_batches(series, cuts)):
            rows = as_metrics(spark, part)
            forecast.block_tails(rows, depth, number, settings).write.mode("append").parquet(folder)
            handed = carried(spark.read.parquet(folder), depth, number)
            known = forecast.with_recent_from(rows, handed, depth, settings)
            assert known.columns == [*rows.columns, forecast.RECENT]
            for source, values in by_source(finish(known).collect()).items():
                got[source] = got.get(source, []) + values
        assert got == {s: [plain([p for _, p in pts[: i + 1]]) for i in range(len(pts))] for s, pts in series.items()}


def test_frames_count_rows_without_a_value(spark):
    """Null values take a place in a frame and are left out of its list, inside blocks and across."""
    rng = random.Random(3)
    rows = [(s, w, None if rng.random() < 0.3 else w) for s in ("a", None) for w in range(60) if rng.random() < 0.7]
    frame = spark.createDataFrame(rows, "source string, w int, v long").selectExpr(
        "source", "timestamp_seconds(w * 10) AS window_start", "v", "1 AS block", "2 AS batch", "3 AS tail"
    )
    settings = replace(DEFAULTS, block_windows=7)
    handed = carried(tails(frame, "v", 6, settings=settings), 6)
    once = trailing_from(frame, handed, "v", 6, "recent", settings=settings)
    key = lambda r: (r["source"] or "", r["window_start"])
    assert once.columns == [*frame.columns, "recent"]
    assert sorted(once.collect(), key=key) == sorted(trailing(frame, "v", 6, "recent", settings=settings).collect(), key=key)
    empty = frame.limit(0)
    assert trailing_from(empty, carried(tails(empty, "v", 6), 6), "v", 6, "recent").collect() == []


def test_damped_forecast_is_clamped_and_trend_is_not(spark):
    falling = [(w, max(0, 10000 - 1000 * w)) for w in range(12)]
    rising = [(w, min(10000, 1200 * w)) for w in range(12)]
    metrics = as_metrics(spark, {"falling": falling, "rising": rising})
    low = by_source(forecast.forecast_damped(metrics).collect())
    assert min(low["falling"]) >= 0 and max(low["rising"]) == 100.0
    high = by_source(forecast.forecast_trend(metrics).collect())
    assert high["falling"][:7] == [None] * 7
    assert max(f for f in high["rising"] if f is not None) > 100.0


def test_a_straight_line_is_continued(spark):
    metrics = as_metrics(spark, {"line": [(w, 100 + 7 * w) for w in range(40)]})
    got = by_source(forecast.forecast_trend(metrics).collect())["line"]
    assert got[7:] == [(100 + 7 * (w + 1)) / 100 for w in range(7, 40)]
