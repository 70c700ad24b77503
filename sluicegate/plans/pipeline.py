"""The tables of the firewall, each derived from raw events.

Alerts are computed from the window metrics, which are far smaller than the raw
events.  Views that only show the newest state cut the metrics to the rows their
forecast can see before computing it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from sluicegate.operators import alerts as alerting
from sluicegate.operators import metrics as measuring
from sluicegate.operators import ranking, routing
from sluicegate.operators.contract import ORDER_EVENTS, Contract
from sluicegate.operators.series import newest
from sluicegate.settings import DEFAULTS, Settings


class Firewall:
    """A contract and its settings, applied to raw events."""

    def __init__(self, contract: Contract = ORDER_EVENTS, settings: Settings = DEFAULTS):
        self.contract = contract
        self.settings = settings

    # Contract and routing: one projection, no shuffle.

    def events_checked(self, raw: DataFrame) -> DataFrame:
        return self.contract.check(raw)

    def events_verdict(self, raw: DataFrame) -> DataFrame:
        return self.contract.judge(raw)

    def clean_events(self, raw: DataFrame) -> DataFrame:
        return routing.clean_events(self.events_verdict(raw))

    def quarantine_events(self, raw: DataFrame) -> DataFrame:
        return routing.quarantine_events(self.events_verdict(raw))

    # Window metrics: one shuffle of partial aggregates.

    def dq_metrics(self, raw: DataFrame) -> DataFrame:
        return measuring.window_metrics(self.events_verdict(raw), self.contract, self.settings)

    def serving_metrics(self, raw: DataFrame) -> DataFrame:
        """Metrics as the serving layer keeps them: named sources, first-seen times."""
        named = measuring.name_blank_sources(raw)
        return measuring.window_metrics(
            self.events_verdict(named), self.contract, self.settings, with_first_seen=True
        )

    # Alerts over the whole history.

    def dq_alerts(self, raw: DataFrame) -> DataFrame:
        return alerting.alerts(self.dq_metrics(raw), self.settings, self.contract)

    def dq_alerts_simple(self, raw: DataFrame) -> DataFrame:
        return alerting.alerts_simple(self.dq_metrics(raw), self.settings, self.contract)

    def serving_alerts(self, raw: DataFrame) -> DataFrame:
        return alerting.serving_alerts(self.serving_metrics(raw), self.settings, self.contract)

    # Views of the newest state.  A forecast reaches back a fixed number of
    # windows, so older metrics cannot change what these show.

    def source_health(self, raw: DataFrame) -> DataFrame:
        recent = newest(self.dq_metrics(raw), self.settings.train_max, "window_start")
        return ranking.source_health(alerting.alerts(recent, self.settings, self.contract, recent_only=True))

    def serving_recent(self, raw: DataFrame, points: int = 1) -> DataFrame:
        """Serving alerts of which at least the newest ``points`` per source are exact."""
        reach = points + self.settings.damped_points - 1
        recent = newest(self.serving_metrics(raw), reach, "window_start")
        return alerting.serving_alerts(recent, self.settings, self.contract, recent_only=True)

    def source_history(self, raw: DataFrame) -> DataFrame:
        return ranking.history(self.serving_recent(raw, self.settings.history_points), self.settings)

    def health_board(self, raw: DataFrame) -> DataFrame:
        return ranking.health_board(self.serving_recent(raw))

    def worst_source_history(self, raw: DataFrame) -> DataFrame:
        return ranking.worst_source_history(
            self.serving_recent(raw, self.settings.history_points), self.settings
        )

    def dlq_feed(self, raw: DataFrame) -> DataFrame:
        """The newest rejects as the serving layer shows them, with named sources."""
        rejects = self.quarantine_events(measuring.name_blank_sources(raw))
        return ranking.dlq_feed(rejects, self.settings)
