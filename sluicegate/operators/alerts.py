"""Alert rows: the forecast turned into a status and a time to breach.

Three variants, which differ on purpose:

=================  ===================  =================  ====================
                   ``alerts``           ``alerts_simple``  ``serving_alerts``
=================  ===================  =================  ====================
forecast           trained, after       trained, after     damped, from the
                   warm-up              warm-up            first window on
time to breach     if rising by more    none               if the forecast is
                   than a threshold                        above the current
WATCH              forecast over SLA,   forecast over SLA  forecast over SLA
                   or breach is near
top reason         most frequent,       first that         most frequent,
                   fixed tie order      occurred           first seen wins
=================  ===================  =================  ====================
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from sluicegate import schemas
from sluicegate.functions.exact import number
from sluicegate.operators import forecast, reasons
from sluicegate.operators.contract import ORDER_EVENTS, Contract
from sluicegate.operators.forecast import FORECAST
from sluicegate.settings import BREACH, DEFAULTS, OK, WATCH, Settings

CURRENT = "current_error_pct"
RISE = "error_rate_slope"
ETA = "minutes_to_sla_breach"


def _minutes_until(settings: Settings) -> str:
    """Minutes until the SLA is crossed if every window adds the forecast rise."""
    windows = f"try_divide({number(settings.sla_pct)} - {CURRENT}, {RISE})"
    return f"{windows} * {number(settings.window_minutes)}"


def _breached(settings: Settings) -> str:
    return f"{CURRENT} >= {number(settings.sla_pct)}"


def minutes_to_breach(rising: str, settings: Settings = DEFAULTS) -> str:
    """0 when breached already, NULL when no breach is in sight."""
    return f"CASE WHEN {_breached(settings)} THEN 0.0D WHEN {rising} THEN {_minutes_until(settings)} END"


def status(settings: Settings = DEFAULTS, early_warning: str = "false") -> str:
    return f"""CASE WHEN {_breached(settings)} THEN '{BREACH}'
                    WHEN {FORECAST} >= {number(settings.sla_pct)} OR {early_warning} THEN '{WATCH}'
                    ELSE '{OK}' END"""


def _alert_rows(forecasts: DataFrame, top_reason: str) -> DataFrame:
    return forecasts.selectExpr(
        "source",
        "window_end AS ts",
        "total_events",
        f"error_rate_pct AS {CURRENT}",
        FORECAST,
        f"{FORECAST} AS forecast_upper_pct",
        f"{FORECAST} - error_rate_pct AS {RISE}",
        f"{top_reason} AS top_reason",
    )


def alerts_from_recent(
    known: DataFrame, settings: Settings = DEFAULTS, contract: Contract = ORDER_EVENTS
) -> DataFrame:
    """The full variant, from metrics that carry ``recent_points``."""
    forecasts = forecast.add_trend(forecast.trained(known, settings), settings)
    rising = f"{RISE} > {number(settings.slope_floor)}"
    near = f"{_minutes_until(settings)} < {number(settings.warn_minutes)}"
    full = _alert_rows(forecasts, reasons.most_frequent(contract)).selectExpr(
        "*",
        f"{number(settings.sla_pct)} AS sla_pct",
        f"{minutes_to_breach(rising, settings)} AS {ETA}",
        f"{status(settings, early_warning=f'({rising} AND coalesce({near}, false))')} AS status",
    )
    return schemas.conform(full, schemas.DQ_ALERTS)


def alerts_simple_from_recent(
    known: DataFrame, settings: Settings = DEFAULTS, contract: Contract = ORDER_EVENTS
) -> DataFrame:
    """The simple variant, from metrics that carry ``recent_points``."""
    forecasts = forecast.add_trend(forecast.trained(known, settings), settings)
    rows = _alert_rows(forecasts, reasons.first_occurring(contract))
    return schemas.conform(rows.selectExpr("*", f"{status(settings)} AS status"), schemas.DQ_ALERTS_SIMPLE)


def serving_alerts_from_recent(
    known: DataFrame, settings: Settings = DEFAULTS, contract: Contract = ORDER_EVENTS
) -> DataFrame:
    """The serving variant; the metrics must carry the first-seen times."""
    rows = _alert_rows(forecast.add_damped(known), reasons.most_frequent_first_seen(contract))
    full = rows.selectExpr(
        "*",
        f"{minutes_to_breach(f'{FORECAST} > {CURRENT}', settings)} AS {ETA}",
        f"{status(settings)} AS status",
    )
    return schemas.conform(full, schemas.SERVING_ALERTS)


def alerts(
    metrics: DataFrame,
    settings: Settings = DEFAULTS,
    contract: Contract = ORDER_EVENTS,
    recent_only: bool = False,
) -> DataFrame:
    known = forecast.with_recent(metrics, settings.train_max, settings, recent_only)
    return alerts_from_recent(known, settings, contract)


def alerts_simple(
    metrics: DataFrame,
    settings: Settings = DEFAULTS,
    contract: Contract = ORDER_EVENTS,
    recent_only: bool = False,
) -> DataFrame:
    known = forecast.with_recent(metrics, settings.train_max, settings, recent_only)
    return alerts_simple_from_recent(known, settings, contract)


def serving_alerts(
    metrics: DataFrame,
    settings: Settings = DEFAULTS,
    contract: Contract = ORDER_EVENTS,
    recent_only: bool = False,
) -> DataFrame:
    known = forecast.with_recent(metrics, settings.damped_points, settings, recent_only)
    return serving_alerts_from_recent(known, settings, contract)
