"""Stored tables: one parquet folder each, ``writer=W/batch_id=N/received_date=D/``.

Writing a batch replaces its own folder, so a repeated micro-batch changes
nothing; readers miss its rows meanwhile, unless the table is a committed one
(``committed.py``), which the functions below tell by its manifest.  Every writer has a folder of its own: a stream that of its checkpoint, the
batch job ``batch``.  Writers therefore never replace each other's rows.  The date is that of receipt, which a producer cannot forge, and lets a
reader of recent rows skip the older folders.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate import schemas
from sluicegate.functions.times import utc_day
from sluicegate.operators.contract import EVENT_TIME, FRESHNESS, ORDER_EVENTS, Contract
from sluicegate.sources import committed, folders
from sluicegate.sources.committed import BATCH, DAY, LANE, WRITER

BATCH_JOB = "batch"
# Files per day that a micro-batch writes at most, so that no day is one task.
FILES_PER_DAY = 4

SCHEMAS = {
    "clean_events": schemas.CLEAN_EVENTS,
    "quarantine_events": schemas.QUARANTINE_EVENTS,
    "dq_metrics": schemas.DQ_METRICS,
    "dq_alerts": schemas.DQ_ALERTS,
    "dq_alerts_simple": schemas.DQ_ALERTS_SIMPLE,
    "serving_alerts": schemas.SERVING_ALERTS,
    "undecodable_messages": schemas.UNDECODABLE_MESSAGES,
    "late_events": schemas.LATE_EVENTS,
    "event_totals": schemas.EVENT_TOTALS,
}


def write_batch(
    rows: DataFrame,
    root: str,
    table: str,
    batch_id: int,
    day: Column,
    schema: T.StructType | None = None,
    gather: bool = False,
    writer: str = BATCH_JOB,
) -> None:
    """Store one batch of a table, replacing an earlier attempt at it.

    ``schema`` is for metrics of a contract of one's own.  ``gather`` brings the rows
    of a day together before writing; without it a table whose rows were shuffled by
    another key ends up with a file per task and day.  Adaptive execution splits
    large days and merges small ones.
    """
    stored = schemas.conform(
        rows.withColumn("_day_of", day.cast("timestamp")).withColumn(DAY, F.expr(utc_day("_day_of"))),
        _with_day(schema or SCHEMAS[table]),
    )
    if gather:
        stored = stored.hint("rebalance", DAY)
    _write(stored, f"{root}/{table}", batch_id, writer, [DAY])


def _write(rows: DataFrame, path: str, batch_id: int, writer: str, keys: list[str]) -> None:
    if committed.enabled(rows.sparkSession, path):
        committed.write(rows, path, batch_id, writer, keys)
    else:
        rows.write.mode("overwrite").partitionBy(*keys).parquet(f"{path}/{WRITER}={writer}/{BATCH}={batch_id}")


# Judged events hold both lanes, each in folders of its own.
JUDGED = "judged_events"
CLEAN, QUARANTINE = "clean_events", "quarantine_events"
_LANES = {
    CLEAN: {},
    QUARANTINE: {"raw_event_ts": "event_ts", "quarantined_at": "received_time"},
}


def judged_schema(contract: Contract) -> T.StructType:
    """Raw columns, what the contract found, and its flags: all that lanes and metrics need."""
    found = [
        T.StructField("event_time", T.TimestampType()),
        T.StructField(FRESHNESS, T.LongType()),
        T.StructField("violations", T.ArrayType(T.StringType())),
    ]
    flags = [T.StructField(rule.flag, T.BooleanType()) for rule in contract.rules]
    return T.StructType([*schemas.RAW_EVENTS.fields, *found, *flags])


def write_judged(judged: DataFrame, root: str, batch_id: int, contract: Contract, writer: str = BATCH_JOB) -> None:
    """Store judged events, split by lane and day, in one pass over them."""
    lane = F.when(F.col("is_valid"), F.lit(CLEAN)).otherwise(F.lit(QUARANTINE))
    schema = judged_schema(contract)
    rows = judged.withColumnRenamed(EVENT_TIME, "event_time").select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], lane.alias(LANE), F.expr(utc_day("received_time")).alias(DAY)
    )
    _write(rows, f"{root}/{JUDGED}", batch_id, writer, [LANE, DAY])


def _folders(schema: T.StructType, lane: bool) -> T.StructType:
    keys = [T.StructField(WRITER, T.StringType()), T.StructField(BATCH, T.LongType())]
    return T.StructType([*_with_day(schema).fields, *keys, *[T.StructField(LANE, T.StringType())] * lane])


def _read(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    since: str | None = None,
    lane: str | None = None,
    batch: tuple[str, int] | None = None,
) -> DataFrame:
    """Rows of a table's folders, of some days, a lane, or one (writer, batch) of them."""
    if committed.enabled(spark, path):
        return committed.read(spark, path, schema, since, lane, batch)
    rows = spark.read.schema(schema).parquet(path)
    if since is not None:
        rows = rows.filter(F.col(DAY) >= F.lit(since).cast("date"))
    if lane is not None:
        rows = rows.filter(F.col(LANE) == lane)
    if batch is not None:
        rows = rows.filter((F.col(WRITER) == batch[0]) & (F.col(BATCH) == batch[1]))
    return rows


def read_judged(
    spark: SparkSession, root: str, contract: Contract, batch: tuple[str, int] | None = None
) -> DataFrame:
    """Stored judged events, or those of one (writer, batch), with ``is_valid``."""
    schema = judged_schema(contract)
    rows = _read(spark, f"{root}/{JUDGED}", _folders(schema, lane=True), batch=batch)
    return rows.select(*schema.names, (F.col(LANE) == CLEAN).alias("is_valid"), BATCH, WRITER)


def _lane(spark: SparkSession, root: str, table: str, schema: T.StructType, since: str | None) -> DataFrame:
    """A lane of the judged events, as the table it stands for."""
    names = _LANES[table]
    stored = T.StructType([T.StructField(names.get(f.name, f.name), f.dataType) for f in schema.fields])
    rows = _read(spark, f"{root}/{JUDGED}", _folders(stored, lane=True), since, lane=table)
    return rows.select(*[F.col(names.get(n, n)).alias(n) for n in schema.names])


@contextmanager
def packed(rows: DataFrame, tasks: int | None = None) -> Iterator[DataFrame]:
    """Rows of a micro-batch (with window_start), computed once and laid out for few files.

    Closed windows come spread thinly over as many partitions as there are state
    stores, and adaptive execution, which would merge these, is off inside a stream
    with state and leaves the partitions of held rows alone.
    Rows of a day and share of the sources are brought together instead, in ``tasks``
    partitions if the caller knows how many rows there are.  Holding them
    keeps the stateful plan from running once per table written.
    """
    keys = (F.expr(utc_day("window_start")), F.pmod(F.xxhash64("source"), F.lit(FILES_PER_DAY)))
    held = (rows.repartition(tasks, *keys) if tasks else rows.repartition(*keys)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def read_table(
    spark: SparkSession, root: str, table: str, since: str | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """A stored table; ``since`` (a date) prunes older folders.

    The lanes are kept among the judged events, and beside them what was written to them alone.
    """
    schema = schema or SCHEMAS[table]
    path = f"{root}/{table}"
    if table in _LANES and _exists(spark, f"{root}/{JUDGED}"):
        rows = _lane(spark, root, table, schema, since)
        if not _exists(spark, path):
            return rows
        return rows.unionByName(_read(spark, path, _folders(schema, lane=False), since).select(*schema.names))
    return _read(spark, path, _folders(schema, lane=False), since).select(*schema.names)


def read_batch(
    spark: SparkSession, root: str, table: str, batch_id: int, schema: T.StructType | None = None, writer: str = BATCH_JOB
) -> DataFrame:
    """One batch of a stored table; no folder of another is listed."""
    schema = schema or SCHEMAS[table]
    path = f"{root}/{table}"
    if committed.enabled(spark, path):
        return committed.read(spark, path, _folders(schema, lane=False), batch=(writer, batch_id)).select(*schema.names)
    return spark.read.schema(schema).parquet(f"{path}/{WRITER}={writer}/{BATCH}={batch_id}")


def days(spark: SparkSession, root: str, table: str) -> list[str]:
    """Days that a stored table has rows of, the newest first; told from its folders or manifest."""
    found = set()
    for path, lane in ((f"{root}/{table}", None), *[(f"{root}/{JUDGED}", table)] * (table in _LANES)):
        if committed.enabled(spark, path):
            found |= committed.days(spark, path, lane)
        else:
            below = f"{WRITER}=*/{BATCH}=*/" + (f"{LANE}={lane}/" if lane else "") + f"{DAY}=*"
            names = folders.names_below(spark, path, below)
            found |= {name.partition("=")[2] for name in names if "__" not in name}
    return sorted(found, reverse=True)


def newest_rows(
    spark: SparkSession, root: str, table: str, count: int, schema: T.StructType | None = None
) -> DataFrame:
    """Rows of the newest days of a table, as few days as hold ``count`` rows.

    Whoever sorts by the time of receipt, newest first, finds the first ``count`` rows of the
    whole table in them.  Days are taken one, two, four at a time, so that a long history
    is not read for a short list.  Rows without a day are taken only when all days are.
    """
    known = days(spark, root, table)
    taken = 1
    while taken <= len(known):
        rows = read_table(spark, root, table, since=known[taken - 1], schema=schema)
        if rows.limit(count).count() >= count:
            return rows
        taken *= 2
    return read_table(spark, root, table, schema=schema)


def _schema(table: str, contract: Contract) -> T.StructType:
    return judged_schema(contract) if table == JUDGED else SCHEMAS[table]


def commit_whole(spark: SparkSession, root: str) -> None:
    """Make every table below ``root`` a committed one; whatever writes there later goes through manifests."""
    committed.enable(spark, root, [*SCHEMAS, JUDGED])


def compact(
    spark: SparkSession,
    root: str,
    table: str,
    before: str | None = None,
    schema: T.StructType | None = None,
    contract: Contract = ORDER_EVENTS,
) -> int:
    """Bring the folders of each day of a committed table together; ``contract`` is that of judged events."""
    stored_as = _folders(schema or _schema(table, contract), lane=table == JUDGED)
    return committed.compact(spark, f"{root}/{table}", stored_as, before)


def expire(spark: SparkSession, root: str, table: str, spare: int = committed.SPARE_VERSIONS) -> int:
    """Remove what only old versions of a committed table name."""
    return committed.expire(spark, f"{root}/{table}", spare)


def stored(spark: SparkSession, root: str) -> list[str]:
    """Names of the tables that have been stored below ``root``."""
    judged = _exists(spark, f"{root}/{JUDGED}")
    return [name for name in SCHEMAS if (judged and name in _LANES) or _exists(spark, f"{root}/{name}")]


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder can be read, on whatever file system it lies."""
    if committed.enabled(spark, path):
        return committed.written(spark, path)
    try:
        spark.read.schema("present int").parquet(path)
    except AnalysisException:
        return False
    return True


def _with_day(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
