"""The firewall's tables as temporary views, for use from SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluicegate.operators import ranking
from sluicegate.plans import serving
from sluicegate.plans.pipeline import Firewall
from sluicegate.settings import DEFAULTS, Settings
from sluicegate.sources import tables
from sluicegate.streaming.running import stop_all

# In order of dependency.
VIEWS = (
    "raw_events",
    "events_checked",
    "events_verdict",
    "clean_events",
    "quarantine_events",
    "dq_metrics",
    "dq_alerts",
    "dq_alerts_simple",
    "serving_alerts",
    "health_board",
    "source_history",
    "source_health",
    "dlq_feed",
)


def register(raw: DataFrame, firewall: Firewall | None = None) -> None:
    """Create a view of every table over the given raw events."""
    firewall = firewall or Firewall()
    raw.createOrReplaceTempView("raw_events")
    for name in VIEWS[1:]:
        getattr(firewall, name)(raw).createOrReplaceTempView(name)


def register_stored(
    spark: SparkSession, root: str, since: str | None = None, settings: Settings = DEFAULTS
) -> list[str]:
    """Create views of the stored tables and of the boards over them.

    Spark lists a table's files when its view is made: register again to show the
    batches stored since.  ``since`` (a date) keeps it from reading older folders.
    """
    stored = {name: tables.read_table(spark, root, name, since) for name in tables.stored(spark, root)}
    for name, rows in stored.items():
        rows.createOrReplaceTempView(name)
    boards = {}
    if "serving_alerts" in stored:
        named = serving.served_alerts(stored["serving_alerts"])
        boards["health_board"] = ranking.health_board(named)
        boards["source_history"] = ranking.history(named, settings)
    if "dq_alerts" in stored:
        boards["source_health"] = ranking.source_health(stored["dq_alerts"])
    if "quarantine_events" in stored:
        boards["dlq_feed"] = ranking.dlq_feed(serving.served_rejects(stored["quarantine_events"]), settings)
    for name, rows in boards.items():
        rows.createOrReplaceTempView(name)
    return [*stored, *boards]


def listed(spark: SparkSession) -> list[str]:
    """Names of the firewall's views that exist, in dependency order.

    Stored tables of the same names belong to somebody else.
    """
    existing = {table.name for table in spark.catalog.listTables() if table.isTemporary}
    return [name for name in VIEWS if name in existing]


def teardown(spark: SparkSession) -> list[str]:
    """Stop the firewall's streams, then drop its temporary views, dependents first.

    Tables are left alone: nothing here creates any.
    """
    stop_all(spark)
    dropped = []
    for name in reversed(listed(spark)):
        if spark.catalog.dropTempView(name):
            dropped.append(name)
    return dropped
