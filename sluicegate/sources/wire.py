"""The wire envelope: plain JSON, or a zero byte, a 4-byte schema id and JSON.

Raw events arrive in it, and the output tables can be sent and read back in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate import schemas
from sluicegate.functions.once import computed_once

# First byte of an envelope, 1-based offset of the JSON in it.
MAGIC = "X'00'"
PAYLOAD_AT = 6

DECODED, CORRUPT, EMPTY = "decoded", "corrupt", "empty"


def payload_text(value: str) -> str:
    """JSON text of a message, as a SQL expression.

    The payload is found by its offset, never by looking for a brace: a schema
    id may itself contain the byte of one.
    """
    enveloped = f"substring({value}, 1, 1) = {MAGIC}"
    return f"CAST(CASE WHEN {enveloped} THEN substring({value}, {PAYLOAD_AT}) ELSE {value} END AS STRING)"


def decode(messages: DataFrame, schema: T.StructType = schemas.PAYLOAD, value: str = "value") -> DataFrame:
    """Replace ``value`` by the fields of ``schema``, ``wire_state`` and ``wire_text``.

    A field of the wrong type becomes NULL and the row stays in the stream, so the
    contract reports it.  A message is ``decoded`` if its text is exactly one JSON object;
    joined or trailing documents, arrays, scalars and broken text are ``corrupt``, and
    ``wire_text`` keeps what was not decoded.
    """
    layout = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in schema.fields)
    # In brackets, anything but one document makes no list of one.
    parse = f"from_json('[' || wire_text || ']', 'array<struct<{layout}>>')"
    parsed = computed_once(messages.withColumn("wire_text", F.expr(payload_text(value))), "_payload", parse)
    # Text that closes the bracket itself cannot close a brace as well.
    alone = """instr(wire_text, ']') = 0
               OR from_json('{"only":' || wire_text || '}', 'only string').only IS NOT NULL"""
    state = f"""CASE WHEN wire_text IS NULL OR trim(wire_text) IN ('', 'null') THEN '{EMPTY}'
                     WHEN size(_payload) = 1 AND _payload[0] IS NOT NULL AND ltrim(wire_text) LIKE '{{%'
                          AND ({alone}) THEN '{DECODED}'
                     ELSE '{CORRUPT}' END"""
    return parsed.withColumn("wire_state", F.expr(state)).selectExpr(
        *[name for name in messages.columns if name != value],
        "wire_state",
        f"CASE WHEN wire_state = '{CORRUPT}' THEN wire_text END AS wire_text",
        *[f"CASE WHEN wire_state = '{DECODED}' THEN _payload[0].{name} END AS {name}" for name in schema.names],
    )


def rows_of(decoded: DataFrame, schema: T.StructType) -> DataFrame:
    """The messages that carry a row, in the given schema."""
    return schemas.conform(decoded.filter(F.col("wire_state") == DECODED), schema)


def events_of(decoded: DataFrame) -> DataFrame:
    return rows_of(decoded, schemas.RAW_EVENTS)


def undecodable(decoded: DataFrame) -> DataFrame:
    """Messages that are not one JSON object.

    They have no fields a rule could test, so they are kept apart from the
    quarantine table rather than dropped.
    """
    return decoded.filter(F.col("wire_state") == CORRUPT).select("wire_text", "received_time")


def encode(
    rows: DataFrame, schema: T.StructType = schemas.PAYLOAD, schema_id: str = "CAST(NULL AS INT)"
) -> DataFrame:
    """Add ``value``, the message that carries each row.

    ``schema_id`` is an integer expression; where it is NULL the message is plain
    JSON without the envelope.
    """
    body = f"encode(to_json(struct({', '.join(schema.names)}), map('ignoreNullFields', 'false')), 'UTF-8')"
    prefix = f"{MAGIC} || unhex(lpad(hex({schema_id}), 8, '0'))"
    return rows.withColumn("_body", F.expr(body)).selectExpr(
        *rows.columns, f"CASE WHEN ({schema_id}) IS NULL THEN _body ELSE {prefix} || _body END AS value"
    )


def messages_of(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Messages (``key``, ``value``) of a table, keyed by source."""
    return encode(rows, schema).selectExpr("CAST(source AS BINARY) AS key", "value")
