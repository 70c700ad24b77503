"""Segments: files of framed messages, as a broker's log keeps them, read by a batch or a stream.

A frame is the length of its message (4 bytes) and the time of receipt (8 bytes,
microseconds, big-endian), the message, and a line feed.  Frames are put together by SQL
and written by Spark's text writer, which adds the line feed.  Reading goes by length, so a
message may contain any byte.  A stream reads a folder's files from the first one on, so
many per micro-batch at most, and its checkpoint says which it has read.

A frame that is cut off, or not followed by a line feed, is an error: nothing is skipped.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_HEAD = struct.Struct(">Iq")
_END = b"\n"
# A message without a time of receipt.
_NEVER = -(1 << 63)
# Messages that are handed on at once.
_ROWS = 4096
LAYOUT = "value binary, received_time timestamp"


def write_segments(messages: DataFrame, path: str, frames_per_file: int = 1_000_000) -> None:
    """Append messages (value, received_time) to a folder of segments."""
    frame = f"""unhex(lpad(hex(octet_length(value)), 8, '0'))
                || unhex(lpad(hex(coalesce(unix_micros(received_time), {_NEVER + 1}L - 1L)), 16, '0')) || value"""
    rows = messages.filter("value IS NOT NULL").selectExpr(f"CAST({frame} AS STRING) AS value")
    rows.write.mode("append").option("lineSep", _END.decode()).option("maxRecordsPerFile", frames_per_file).text(path)


def frames(content: bytes) -> Iterator[tuple[bytes, int | None]]:
    """(message, microseconds) of every frame of a file."""
    data, at = memoryview(content), 0
    while at < len(data):
        if at + _HEAD.size > len(data):
            raise ValueError(f"the frame at byte {at} is cut off")
        size, micros = _HEAD.unpack_from(data, at)
        start = at + _HEAD.size
        at = start + size + len(_END)
        if bytes(data[at - len(_END) : at]) != _END:
            raise ValueError(f"the frame before byte {at} is cut off")
        yield bytes(data[start : start + size]), None if micros == _NEVER else micros


def _unframed(files: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def some(rows: list[tuple[bytes, int | None]]) -> pa.RecordBatch:
            times = pa.array([t for _, t in rows], pa.int64()).cast(pa.timestamp("us", tz="UTC"))
            return pa.RecordBatch.from_arrays([pa.array([m for m, _ in rows], pa.binary()), times], names=["value", "received_time"])

        for batch in batches:
            for content in batch.column(0):
                rows = []
                for row in frames(content.as_py()):
                    rows.append(row)
                    if len(rows) == _ROWS:
                        yield some(rows)
                        rows = []
                if rows:
                    yield some(rows)

    return files.filter("length > 0").select("content").mapInArrow(run, LAYOUT)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """(value, received_time) of all messages below a folder."""
    return _unframed(spark.read.format("binaryFile").load(path))


def stream_segments(spark: SparkSession, path: str, max_files: int | None = 100) -> DataFrame:
    """The same as a stream, from the first segment on; ``max_files`` bounds a micro-batch."""
    schema = spark.read.format("binaryFile").load(path).schema
    reader = spark.readStream.format("binaryFile").schema(schema)
    return _unframed((reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path))
