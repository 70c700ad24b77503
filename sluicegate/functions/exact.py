"""Percentages in integer arithmetic, as SQL expressions.

Rates and forecasts are carried in hundredths of a percent ("points"), rounded
half up, so that a result never depends on the order in which doubles were added.
"""

from __future__ import annotations


def number(value: float) -> str:
    """A DOUBLE literal; a bare ``2.0`` would be a decimal."""
    return f"{float(value)!r}D"


def floor_ratio(above: str, below: str) -> str:
    """Integer quotient rounded down; a non-positive divisor counts as 1."""
    below = f"greatest({below}, 1)"
    return f"((({above}) - pmod({above}, {below})) div {below})"


def share_points(part: str, whole: str) -> str:
    """``part / whole`` in hundredths of a percent, half up; 0 for an empty whole."""
    return floor_ratio(f"20000 * {part} + {whole}", f"2 * {whole}")


def points_to_pct(points: str) -> str:
    return f"({points}) / 100.0D"


def pct_to_points(pct: str) -> str:
    """Inverse of :func:`points_to_pct` for a stored two-decimal percentage."""
    return f"CAST(round({pct} * 100.0D, 0) AS BIGINT)"


def half_up(value: str, scale: int) -> str:
    """Round a non-negative double half up to ``scale`` decimals."""
    shift = number(10**scale)
    return f"CAST(floor({value} * {shift} + 0.5D) AS DOUBLE) / {shift}"
