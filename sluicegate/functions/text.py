"""Texts of the health report, as SQL expressions."""

from __future__ import annotations

from sluicegate.functions.exact import half_up
from sluicegate.settings import DASH


def or_dash(text: str) -> str:
    return f"coalesce({text}, '{DASH}')"


def pct_text(pct: str) -> str:
    """``12.34%``, or a dash when unknown."""
    return or_dash(f"CASE WHEN {pct} IS NOT NULL AND NOT isnan({pct}) THEN format_string('%.2f%%', {pct}) END")


def eta_text(minutes: str) -> str:
    """``now``, ``42s``, ``3.5 min``, or a dash when no breach is in sight."""
    return or_dash(
        f"""CASE WHEN {minutes} IS NULL OR isnan({minutes}) THEN NULL
                 WHEN {minutes} <= 0 THEN 'now'
                 WHEN {minutes} < 1 THEN format_string('%ds', floor({minutes} * 60.0D + 0.5D))
                 ELSE format_string('%.1f min', {half_up(minutes, 1)}) END"""
    )


def clock_text(ts: str) -> str:
    """UTC time of day, whatever the session's zone."""
    seconds = f"pmod(unix_seconds({ts}), 86400)"
    parts = (f"{seconds} div 3600", f"{seconds} div 60 % 60", f"{seconds} % 60")
    return f"format_string('%02d:%02d:%02d', {', '.join(parts)})"
