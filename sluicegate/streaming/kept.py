"""Small tables that go from one micro-batch to the next.

Each batch reads what the last batch before it wrote and writes its own folder, so a batch
that is repeated reads and writes the same.  A few folders are left for readers; older
ones go.  What is kept grows with the number of sources or of open windows, never with the
events, and is merged by joins and aggregates: no row passes through Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.operators.forecast import POINTS, RECENT, with_points
from sluicegate.operators.series import KEY, trailing
from sluicegate.settings import DEFAULTS, Settings
from sluicegate.sources import folders

BATCH = "batch_id"
# Folders that stay beside the newest one.
SPARE = 2


@dataclass(frozen=True)
class Kept:
    """A table below ``path`` that every batch rewrites."""

    path: str
    schema: str

    def _read(self, spark: SparkSession, batch_id: int | None) -> DataFrame:
        if batch_id is None:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.path}/{BATCH}={batch_id}")

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What the last batch before ``batch_id`` left; empty at first."""
        return self._read(spark, max((n for n in folders.numbers(spark, self.path, BATCH) if n < batch_id), default=None))

    def newest(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, max(folders.numbers(spark, self.path, BATCH), default=None))

    def keep(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        columns = spark.createDataFrame([], self.schema).columns
        rows.select(*columns).write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch_id}")
        older = [n for n in folders.numbers(spark, self.path, BATCH) if n < batch_id]
        for n in older[: -SPARE or None]:
            folders.remove(spark, f"{self.path}/{BATCH}={n}")


def same_source(own: DataFrame, other: DataFrame) -> Column:
    """Events without a source are a source of their own."""
    return own[KEY].eqNullSafe(other[KEY])


class Tails:
    """The newest ``depth`` rates of every source: what a forecast needs of closed windows."""

    def __init__(self, path: str, depth: int, settings: Settings = DEFAULTS) -> None:
        self.kept = Kept(path, f"{KEY} string, points array<bigint>")
        self.depth, self.settings = depth, settings

    def known(self, closed: DataFrame, batch_id: int) -> DataFrame:
        """The windows that a batch closed, with ``recent_points``.

        Frames are made inside blocks of the batch's own windows, however many a source has.
        Only a source's first windows in the batch, fewer than ``depth``, look at the tail.
        """
        tails = self.kept.before(closed.sparkSession, batch_id)
        own = trailing(with_points(closed), POINTS, self.depth, RECENT, settings=self.settings).drop(POINTS)
        short = own.filter(F.size(RECENT) < self.depth)
        longer = F.concat(F.coalesce("points", F.array().cast("array<bigint>")), F.col(RECENT))
        joined = short.join(tails, same_source(short, tails), "left").select(
            *[short[c] for c in closed.columns], F.slice(longer, F.greatest(F.size(longer) - self.depth, F.lit(0)) + 1, self.depth).alias(RECENT)
        )
        return own.filter(F.size(RECENT) >= self.depth).unionByName(joined)

    def keep(self, known: DataFrame, batch_id: int) -> None:
        """The tails after a batch, from its ``known`` windows; other sources keep theirs."""
        if known.isEmpty():
            return
        before = self.kept.before(known.sparkSession, batch_id)
        newest = known.groupBy(KEY).agg(F.max_by(RECENT, "window_start").alias("now"))
        merged = before.join(newest, same_source(before, newest), "full").select(
            F.coalesce(newest[KEY], before[KEY]).alias(KEY), F.coalesce("now", "points").alias("points")
        )
        self.kept.keep(merged, batch_id)
