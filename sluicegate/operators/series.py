"""Trailing frames over per-source series, without one task per source.

A window function partitioned by source alone would sort a whole series in one
task.  Two ways around it:

* :func:`newest` keeps the last rows per source.  Spark applies the limit before
  the shuffle, so what reaches a task is bounded, whatever the history's length.
* :func:`trailing` needs every row.  It computes the frames inside blocks of time
  first.  Only the first rows of a block lack predecessors; for these a second
  pass looks at the rows next to block borders.  The result is exact, also when
  windows are missing, because frames count rows and not time.
* :func:`trailing_from` does the same for stored series in one shuffle of whole rows.
  The last values of each block are a narrow table of their own (:func:`tails`), from which
  every block is handed the values before its first row (:func:`carried`).  That table also
  lets a new batch of rows go on where stored ones ended, without reading these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluicegate.settings import DEFAULTS, Settings

KEY = "source"
BLOCK, TAIL, BATCH = "block", "tail", "batch"
_CARRY = "_carry"


def newest(series: DataFrame, count: int, order: str, key: str = KEY) -> DataFrame:
    """The ``count`` newest rows per key."""
    last_first = Window.partitionBy(key).orderBy(F.col(order).desc())
    return series.withColumn("_nth", F.row_number().over(last_first)).filter(F.col("_nth") <= count).drop("_nth")


def _last(value: str, ordered: WindowSpec, depth: int) -> Column:
    """Oldest first, at most ``depth`` values: a row's own and those before it."""
    return F.collect_list(value).over(ordered.rowsBetween(1 - depth, 0))


def _block(order: str, settings: Settings) -> Column:
    return F.floor(F.unix_seconds(order) / F.lit(settings.block_windows * settings.window_seconds))


def trailing(
    series: DataFrame, value: str, depth: int, name: str, order: str = "window_start", settings: Settings = DEFAULTS
) -> DataFrame:
    """Add ``name``: the newest ``depth`` values up to each row of its own series."""
    inside = Window.partitionBy(KEY, "_block").orderBy(order)
    local = series.withColumn("_block", _block(order, settings)).select(
        "*",
        (F.row_number().over(inside) < depth).alias("_head"),
        F.lead(F.lit(True), depth - 1, False).over(inside).alias("_followed"),
        _last(value, inside, depth).alias("_local"),
    )
    # Heads and tails of all blocks form one lane per source, in which every head
    # finds its true predecessors; other rows stay with their block.  The lane has
    # at most 2 * (depth - 1) rows per block, so a decade is a few ten thousand.
    inner = ~F.col("_head") & F.col("_followed")
    joint = local.withColumn("_lane", F.when(inner, F.col("_block"))).withColumn(
        "_local", F.when(~F.col("_head"), F.col("_local"))
    )
    across = Window.partitionBy(KEY, "_lane").orderBy(order)
    return joint.withColumn("_joint", _last(value, across, depth)).select(
        *series.columns, F.coalesce("_local", "_joint").alias(name)
    )


def _newest_values(values: Column, count: int) -> Column:
    """The last ``count`` values of an array, or all if there are fewer."""
    return F.slice(values, F.greatest(F.lit(1), F.size(values) - F.lit(count - 1)), F.lit(count))


def tails(
    series: DataFrame, value: str, depth: int, batch: int = 0, order: str = "window_start", settings: Settings = DEFAULTS
) -> DataFrame:
    """One row per source and block: its last ``depth - 1`` values, the oldest first.

    Reads three columns, and cuts the blocks before it shuffles them.
    """
    narrow = series.select(KEY, _block(order, settings).alias(BLOCK), F.col(order).alias("_at"), F.col(value).alias("_value"))
    last_first = Window.partitionBy(KEY, BLOCK).orderBy(F.col("_at").desc())
    kept = narrow.withColumn("_nth", F.row_number().over(last_first)).filter(F.col("_nth") < depth)
    oldest_first = F.sort_array(F.collect_list(F.struct("_at", "_value")))
    values = F.transform(oldest_first, lambda pair: pair["_value"])
    return kept.groupBy(KEY, BLOCK).agg(values.alias(TAIL)).withColumn(BATCH, F.lit(batch).cast("long"))


def carried(known: DataFrame, depth: int, batch: int = 0) -> DataFrame:
    """Per source and block of a batch, the ``depth - 1`` values before its first row.

    ``known`` are the tails of this batch and of earlier ones; later batches are left out.
    Rows of a source in a batch must be newer than those in earlier batches; a batch may begin
    inside a block.  Of earlier batches only the newest tails matter: each has a value at least,
    so that as many as there are values to carry will do, however many were stored.
    """
    in_order = Window.partitionBy(KEY).orderBy(BLOCK, BATCH)
    last_first = Window.partitionBy(KEY).orderBy(F.col(BLOCK).desc(), F.col(BATCH).desc())
    earlier = known.filter(F.col(BATCH) < batch).withColumn("_nth", F.row_number().over(last_first))
    nearest = earlier.filter(F.col("_nth") < depth).drop("_nth")
    blocks = nearest.unionByName(known.filter(F.col(BATCH) == batch))
    before = F.flatten(F.collect_list(TAIL).over(in_order.rowsBetween(-max(1, depth - 1), -1)))
    handed = blocks.select(KEY, BLOCK, BATCH, _newest_values(before, depth - 1).alias(_CARRY))
    return handed.filter(F.col(BATCH) == batch).select(KEY, BLOCK, _CARRY)


def trailing_from(
    series: DataFrame,
    handed: DataFrame,
    value: str,
    depth: int,
    name: str,
    order: str = "window_start",
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """What :func:`trailing` adds, from the values ``handed`` to each block by :func:`carried`.

    They travel as one more row per block, which sorts before all others (``order`` is never
    null), so that neither a join nor a second shuffle is needed.
    """
    wide = series.withColumn("_block", _block(order, settings)).withColumn("_own", F.struct(F.col(value).alias("v")))
    rows = wide.unionByName(handed.withColumnRenamed(BLOCK, "_block"), allowMissingColumns=True)
    inside = Window.partitionBy(KEY, "_block").orderBy(F.col(order).asc_nulls_first())
    # The added row has no value of its own, and lies in no frame that is full without it.
    local = rows.select(
        "*",
        _last("_own", inside, depth).alias("_local"),
        F.first(_CARRY).over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("_before"),
    ).filter(F.col(_CARRY).isNull())
    own = F.transform("_local", lambda pair: pair["v"])
    longer = F.concat(F.coalesce("_before", F.slice(own, 1, 0)), own)
    values = F.when(F.size("_local") < depth, _newest_values(longer, depth)).otherwise(own)
    return local.select(*series.columns, F.filter(values, lambda v: v.isNotNull()).alias(name))


def bounded(series: DataFrame, value: str, depth: int, name: str, order: str = "window_start") -> DataFrame:
    """The same column for series already cut to their newest rows."""
    return series.withColumn(name, _last(value, Window.partitionBy(KEY).orderBy(order), depth))
