"""Raw event readers, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate import schemas
from sluicegate.sources import wire

def as_instants(df: DataFrame) -> DataFrame:
    """Cast zone-less timestamps to instants, which a watermark requires."""
    zoneless = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({name: F.col(name).cast("timestamp") for name in zoneless}) if zoneless else df


def read_files(spark: SparkSession, path: str, fmt: str = "parquet", **options: object) -> DataFrame:
    """Raw events from files, read with the declared permissive schema."""
    return spark.read.schema(schemas.RAW_EVENTS).options(**options).format(fmt).load(path)


def stream_files(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = 1000, **options: object
) -> DataFrame:
    """Raw events as a file stream; existing files are replayed first.

    ``max_files`` bounds a micro-batch, so that a replay of a long history does
    not become one batch; None lifts the bound.
    """
    reader = spark.readStream.schema(schemas.RAW_EVENTS).options(**options).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def _kafka_messages(reader, servers: str, topic: str, options: dict) -> DataFrame:
    settings = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", **options}
    rows = reader.format("kafka").options(**settings).load()
    return rows.select("value", F.col("timestamp").alias("received_time"))


def stream_kafka(
    spark: SparkSession,
    servers: str,
    topic: str = "raw_events",
    schema: T.StructType = schemas.PAYLOAD,
    max_messages: int | None = 5_000_000,
    **options: object,
) -> DataFrame:
    """Decoded messages of a topic from its start; needs Spark's Kafka connector.

    Raw events by default; the schema of an output table reads that table back.
    ``max_messages`` bounds a micro-batch, as a replay would else be one; None lifts it.
    """
    bound = {"maxOffsetsPerTrigger": max_messages} if max_messages else {}
    return wire.decode(_kafka_messages(spark.readStream, servers, topic, {**bound, **options}), schema)


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str = "raw_events",
    schema: T.StructType = schemas.PAYLOAD,
    **options: object,
) -> DataFrame:
    """The same as a bounded batch."""
    return wire.decode(_kafka_messages(spark.read, servers, topic, options), schema)


def write_kafka(rows: DataFrame, schema: T.StructType, servers: str, topic: str) -> None:
    """Send a batch of an output table to a topic, for example from a micro-batch."""
    sink = wire.messages_of(rows, schema).write.format("kafka")
    sink.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def by_source(events: DataFrame, partitions: int | None = None) -> DataFrame:
    """Events keyed by source, as a producer would key its messages.

    For writing out only.  Sources are few and uneven, so nothing here aggregates
    behind this layout; a hash of the event spreads each source over tasks.
    """
    keys = ("source", F.expr("pmod(xxhash64(event_id, user_id, event_ts, received_time), 16)"))
    return events.repartition(partitions, *keys) if partitions else events.repartition(*keys)
