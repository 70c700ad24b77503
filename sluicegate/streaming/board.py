"""The health board and the chart points, kept current from every micro-batch.

One row per source: its latest alert and its newest points.  A batch upserts the sources
whose windows it closed; nothing reads the history of alerts again.  Each writer has a
board of its own, and a reader takes the newest row of a source over all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate import schemas
from sluicegate.operators import ranking
from sluicegate.operators.series import KEY, newest
from sluicegate.settings import DEFAULTS, Settings
from sluicegate.sources import folders
from sluicegate.streaming.kept import Kept, same_source

TABLE = "live_board"
_LATEST = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in schemas.SERVING_ALERTS.fields)
_POINTS = "ts: timestamp, current: double, forecast: double, upper: double"
SCHEMA = f"{KEY} string, latest struct<{_LATEST}>, points array<struct<{_POINTS}>>"


class LiveBoard:
    """Boards below ``root``, one per writer."""

    def __init__(self, root: str, settings: Settings = DEFAULTS) -> None:
        self.path, self.settings = f"{root.rstrip('/')}/{TABLE}", settings

    def _kept(self, writer: str) -> Kept:
        return Kept(f"{self.path}/writer={writer}", SCHEMA)

    def update(self, served: DataFrame, batch_id: int, writer: str) -> None:
        """Upsert the latest row and the newest points of each source of a batch's serving alerts."""
        if served.isEmpty():
            return
        kept, many = self._kept(writer), self.settings.history_points
        before = kept.before(served.sparkSession, batch_id)
        names = schemas.SERVING_ALERTS.names
        now = (
            newest(served, many, "ts")
            .groupBy(KEY)
            .agg(
                F.max_by(F.struct(*names), "ts").alias("now"),
                F.sort_array(F.collect_list(F.struct(*[F.expr(p) for p in ranking.POINT]))).alias("added"),
            )
        )
        none = F.array().cast(f"array<struct<{_POINTS}>>")
        points = F.concat(F.coalesce("points", none), F.coalesce("added", none))
        last = F.slice(points, F.greatest(F.size(points) - many, F.lit(0)) + 1, many)
        merged = before.join(now, same_source(before, now), "full").select(
            F.coalesce(now[KEY], before[KEY]).alias(KEY), F.coalesce("now", "latest").alias("latest"), last.alias("points")
        )
        kept.keep(merged, batch_id)

    def _rows(self, spark: SparkSession) -> DataFrame:
        writers = [n.partition("=")[2] for n in folders.names(spark, self.path) if n.startswith("writer=")]
        rows = spark.createDataFrame([], SCHEMA)
        for writer in writers:
            rows = rows.unionByName(self._kept(writer).newest(spark))
        row = F.max_by(F.struct("latest", "points"), F.col("latest.ts"))
        return rows.groupBy(KEY).agg(row.alias("row")).select("row.*") if len(writers) > 1 else rows.select("latest", "points")

    def board(self, spark: SparkSession) -> DataFrame:
        """The latest alert of every source, worst first."""
        return ranking.health_board(self._rows(spark).select("latest.*"))

    def history(self, spark: SparkSession) -> DataFrame:
        """The newest points of every source."""
        return self._rows(spark).select(F.col(f"latest.{KEY}").alias(KEY), F.inline("points"))
