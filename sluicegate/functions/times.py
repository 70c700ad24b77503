"""Time parsing and arithmetic that depends neither on the clock nor on DST."""

from __future__ import annotations

# Fixed value: the accepted ISO-8601 shape.  Spark's own cast also takes '2026',
# '12:30' (today) or 'now', which would tie a verdict to the wall clock.
ISO_8601 = (
    r"\A\d\d\d\d-\d\d-\d\d"
    r"(?:[T ]\d\d:\d\d:\d\d(?:\.\d{1,9})?(?:Z|[+-]\d\d:\d\d)?)?\z"
)


def parse_iso(text: str) -> str:
    """Timestamp of an ISO-8601 text, NULL when it is missing or malformed.

    Cut to whole milliseconds, the precision of the declared tables.  A time without an
    offset is UTC, whatever the session's zone.
    """
    zoned = f"""CASE WHEN length({text}) = 10 THEN {text} || 'T00:00:00Z'
                     WHEN right({text}, 1) = 'Z' OR substr({text}, -6, 1) IN ('+', '-') THEN {text}
                     ELSE {text} || 'Z' END"""
    parsed = f"timestamp_millis(unix_millis(try_cast({zoned} AS TIMESTAMP)))"
    return f"CASE WHEN {text} RLIKE r'{ISO_8601}' THEN {parsed} END"


def utc_day(ts: str) -> str:
    """The UTC date of a timestamp, whatever the session's zone."""
    return f"date_from_unix_date(CAST(floor(unix_millis({ts}) / 86400000) AS INT))"


def seconds_between(earlier: str, later: str) -> str:
    """Whole seconds from ``earlier`` to ``later``, truncated; may be negative."""
    return f"(unix_micros({later}) - unix_micros({earlier})) div 1000000"
