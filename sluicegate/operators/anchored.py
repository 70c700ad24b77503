"""Windows that begin with a source's first event, and then with the first event after the last window.

The next window of an event begins with the first event of its source that is a whole
window later, so starts form a chain through the source's events.  Following it event by
event would take one task per source.  Here every event points to the start that would
follow it, found within slots of time; doubling the pointers takes the chain from one
start to all of them in as many rounds as the number of windows has binary digits, each a
join on source and time, which no source can make uneven.

Time is that of record; events without it are in no window.  Events without a source are
one source.  The last window of a source lasts as long as any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluicegate.operators import metrics as measuring
from sluicegate.operators.contract import ORDER_EVENTS, Contract
from sluicegate.session import work_folder
from sluicegate.settings import DEFAULTS, Settings

# Slots of time that make up a longer one, and how often they do: with windows of ten seconds, 340 years.
SLOTS, LEVELS = 1024, 4


def _stored(rows: DataFrame, purpose: str) -> DataFrame:
    """Written once to the shared folder and read again: a lost executor costs a round at most."""
    path = work_folder(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def pointers(moments: DataFrame, width: int) -> DataFrame:
    """(source, at, next): the first moment of the source at or behind ``at + width``, if any.

    Looked for in the slot where it should be, then among the first moments of the slots
    behind it, in ever longer slots.
    """
    events = moments.select("source", F.col("at").alias("t"))
    asked = moments.select("source", "at", (F.col("at") + width).alias("t"))
    found: DataFrame | None = None
    for level in range(LEVELS):
        span = width * SLOTS**level
        slot = F.floor(F.col("t") / F.lit(span)).cast("long").alias("slot")
        none = F.lit(None).cast("long")
        both = events.select("source", slot, "t", none.alias("at")).unionByName(asked.select("source", slot, "t", "at"))
        # Questions come before an event of the same time.
        behind = Window.partitionBy("source", "slot").orderBy("t", F.col("at").isNull()).rowsBetween(0, Window.unboundedFollowing)
        answer = F.min(F.when(F.col("at").isNull(), F.col("t"))).over(behind)
        told = _stored(both.withColumn("next", answer).filter("at IS NOT NULL"), "anchored-next")
        known = told.filter("next IS NOT NULL").select("source", "at", "next")
        found = known if found is None else found.unionByName(known)
        asked = told.filter("next IS NULL").select("source", "at", ((F.col("slot") + 1) * F.lit(span)).alias("t"))
        events = _stored(events.groupBy("source", slot).agg(F.min("t").alias("t")).select("source", "t"), "anchored-slots")
        if events.groupBy("source").count().filter("count > 1").isEmpty():
            break  # nothing lies behind the one slot of each source
    return found


def starts(moments: DataFrame, width: int) -> DataFrame:
    """(source, at) of every window start."""
    jump = _stored(pointers(moments, width), "anchored-jumps")
    known = _stored(moments.groupBy("source").agg(F.min("at").alias("at")), "anchored-starts")
    while True:
        ahead = _stored(known.join(jump, ["source", "at"]).select("source", F.col("next").alias("at")), "anchored-starts")
        if ahead.isEmpty():
            return known
        known = known.unionByName(ahead)
        far = jump.select("source", F.col("at").alias("next"), F.col("next").alias("last"))
        jump = _stored(jump.join(far, ["source", "next"]).select("source", "at", F.col("last").alias("next")), "anchored-jumps")


def anchored_windows(verdicts: DataFrame, contract: Contract = ORDER_EVENTS, settings: Settings = DEFAULTS) -> DataFrame:
    """Metrics of judged events in windows anchored at each source's first event."""
    width = settings.window_seconds * 1_000_000
    sums = measuring.sums(contract)
    timed = measuring.name_blank_sources(verdicts.filter("received_time IS NOT NULL"))
    by_moment = timed.groupBy("source", F.unix_micros("received_time").alias("at"))
    moments = _stored(by_moment.agg(*[F.expr(f"{value} AS {name}") for name, value in sums.items()]), "anchored-moments")
    begun = starts(moments.select("source", "at"), width)
    # Starts are a window apart, so a slot has one at most, and an event's start is in its slot or the one before.
    slot = F.floor(F.col("at") / F.lit(width)).cast("long")
    own = begun.select("source", slot.alias("slot"), F.col("at").alias("here"))
    last = begun.select("source", (slot + 1).alias("slot"), F.col("at").alias("before"))
    placed = moments.withColumn("slot", slot).join(own, ["source", "slot"], "left").join(last, ["source", "slot"], "left")
    start = F.when(F.col("here") <= F.col("at"), F.col("here")).otherwise(F.col("before"))
    added = placed.groupBy("source", start.alias("start")).agg(*[F.sum(name).alias(name) for name in sums])
    windows = added.withColumns({"window_start": F.timestamp_micros("start"), "window_end": F.timestamp_micros(F.col("start") + width)})
    return measuring.of_sums(windows, contract)
