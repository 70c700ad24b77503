"""Fixed values of the firewall and the parameters a deployment may change."""

from __future__ import annotations

from dataclasses import dataclass

# Rule codes, in contract order.
MISSING_EVENT_ID = "MISSING_EVENT_ID"
MISSING_USER_ID = "MISSING_USER_ID"
AMOUNT_OUT_OF_RANGE = "AMOUNT_OUT_OF_RANGE"
INVALID_CURRENCY = "INVALID_CURRENCY"
MALFORMED_TIMESTAMP = "MALFORMED_TIMESTAMP"
STALE_EVENT = "STALE_EVENT"

# Contract limits.
AMOUNT_MIN = 0
AMOUNT_MAX = 100000
CURRENCIES = ("USD", "EUR", "GBP", "JPY", "INR")
MAX_AGE_SECONDS = 300

# Which code wins when two failure modes are equally frequent.
TIE_ORDER = (
    INVALID_CURRENCY,
    AMOUNT_OUT_OF_RANGE,
    MISSING_USER_ID,
    MALFORMED_TIMESTAMP,
    STALE_EVENT,
    MISSING_EVENT_ID,
)
NO_REASON = "NONE"

# Alert states and the order a health board shows them in.
BREACH, WATCH, OK = "BREACH", "WATCH", "OK"
SEVERITY = {BREACH: 0, WATCH: 1, OK: 2}
SEVERITY_OTHER = 3

UNKNOWN_SOURCE = "unknown"
DASH = "—"


@dataclass(frozen=True)
class Settings:
    """Tunable parameters."""

    window_seconds: int = 10
    sla_pct: float = 2.0
    # Early warning: rising faster than `slope_floor` points per window and due
    # to cross the SLA in less than `warn_minutes`.
    warn_minutes: float = 5.0
    slope_floor: float = 0.01
    # Trained (least-squares) forecast.
    train_min: int = 8
    train_max: int = 30
    # Damped-trend forecast: the current point and up to four before it.
    damped_points: int = 5
    history_points: int = 40
    feed_rows: int = 50
    watermark: str = "10 seconds"
    # Windows per block when a long series is cut up for trailing frames
    # (65,536 windows of 10 s are about a week).
    block_windows: int = 65536

    @property
    def window(self) -> str:
        return f"{self.window_seconds} seconds"

    @property
    def window_minutes(self) -> float:
        return self.window_seconds / 60.0


DEFAULTS = Settings()
