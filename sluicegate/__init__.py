"""Sluicegate: a data-quality firewall for event tables and event streams on Spark.

Raw events are tested against a declarative contract, split into a clean and a
quarantine table, scored per source in tumbling windows, forecast one window
ahead and turned into OK / WATCH / BREACH alerts.  Everything is a function from
DataFrame to DataFrame; the same functions serve batch and Structured Streaming.
"""

from sluicegate.settings import DEFAULTS, Settings

__all__ = ["DEFAULTS", "Settings"]
