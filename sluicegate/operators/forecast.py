"""One-window-ahead forecasts of a source's error rate.

A forecast is a closed form over ``recent_points``, the newest rates of the source
with the current one last.  A batch takes these from window frames and a stream
from its state; the forms are shared.  Rates are integers in hundredths of a
percent, so no result depends on the order of additions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.functions.exact import floor_ratio, pct_to_points, points_to_pct
from sluicegate.operators.series import bounded, tails, trailing, trailing_from
from sluicegate.settings import DEFAULTS, Settings

POINTS = "error_points"
RECENT = "recent_points"
FORECAST = "forecast_error_pct"
MAX_POINTS = 10000  # 100 %

_SUM = "aggregate({values}, 0L, (total, value) -> total + value)"


def with_points(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn(POINTS, F.expr(pct_to_points("error_rate_pct")))


def with_recent(
    metrics: DataFrame, depth: int, settings: Settings = DEFAULTS, recent_only: bool = False
) -> DataFrame:
    """Add ``recent_points``, at most ``depth`` of them.

    ``recent_only`` says that the series were already cut to their newest rows,
    so that one frame per source is small.
    """
    series = with_points(metrics)
    if recent_only:
        return bounded(series, POINTS, depth, RECENT).drop(POINTS)
    return trailing(series, POINTS, depth, RECENT, settings=settings).drop(POINTS)


def block_tails(metrics: DataFrame, depth: int, batch: int = 0, settings: Settings = DEFAULTS) -> DataFrame:
    """The last rates of every source and block, which later blocks and batches look back on."""
    return tails(with_points(metrics), POINTS, depth, batch, settings=settings)


def with_recent_from(metrics: DataFrame, handed: DataFrame, depth: int, settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``recent_points`` to stored metrics, from what ``series.carried`` hands to their blocks."""
    return trailing_from(with_points(metrics), handed, POINTS, depth, RECENT, settings=settings).drop(POINTS)


def add_damped(known: DataFrame) -> DataFrame:
    """Mean of the recent rates plus half their rise, kept within 0..100 %."""
    sums = known.selectExpr(
        "*",
        f"CAST(size({RECENT}) AS BIGINT) AS _n",
        f"{_SUM.format(values=RECENT)} AS _sum",
        f"try_element_at({RECENT}, -1) - try_element_at({RECENT}, 1) AS _rise",
    )
    points = floor_ratio("2 * _sum + _n * _rise + _n", "2 * _n")
    clamped = f"least(greatest({points}, 0), {MAX_POINTS})"
    return sums.selectExpr(*known.columns, f"{points_to_pct(clamped)} AS {FORECAST}")


def add_trend(known: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Least-squares line through the training points, read one step ahead.

    NULL during warm-up.  Not clamped: a falling series may forecast below zero.
    With positions ``j = 1..m`` the line at ``m + 1`` is a fraction of integers,
    rounded half up.
    """
    by_position = f"transform({RECENT}, (value, i) -> value * (i + 1))"
    sums = known.selectExpr(
        "*",
        f"CAST(size({RECENT}) AS BIGINT) AS _m",
        f"{_SUM.format(values=RECENT)} AS _sum",
        f"{_SUM.format(values=by_position)} AS _weighted",
    ).selectExpr("*", "_m * (_m + 1) div 2 AS _positions", "_m * _m * (_m * _m - 1) div 12 AS _spread")
    ahead = "_sum * _spread + (_m * _weighted - _positions * _sum) * (_m * (_m + 1) - _positions)"
    points = floor_ratio(f"2 * ({ahead}) + _m * _spread", "2 * _m * _spread")
    value = f"CASE WHEN _m >= {settings.train_min} THEN {points_to_pct(points)} END"
    return sums.selectExpr(*known.columns, f"{value} AS {FORECAST}")


def trained(known: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The rows past warm-up, which have a trained forecast."""
    return known.filter(f"size({RECENT}) >= {settings.train_min}")


def forecast_damped(metrics: DataFrame, settings: Settings = DEFAULTS, recent_only: bool = False) -> DataFrame:
    """Add ``forecast_error_pct`` by the damped trend."""
    return add_damped(with_recent(metrics, settings.damped_points, settings, recent_only)).drop(RECENT)


def forecast_trend(metrics: DataFrame, settings: Settings = DEFAULTS, recent_only: bool = False) -> DataFrame:
    """Add ``forecast_error_pct`` by the trained line, NULL during warm-up."""
    return add_trend(with_recent(metrics, settings.train_max, settings, recent_only), settings).drop(RECENT)
