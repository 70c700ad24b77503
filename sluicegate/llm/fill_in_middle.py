"""Fill-in-middle texts through piece tables.

A document is a table of descriptors (buffer, start, length) over two buffers that never
change: its text, and the sentinels.  Cutting splits a descriptor; a form is a permutation
of the three parts, each behind the descriptor of its sentinel; a digest streams over the
descriptors.  The way back reads an output as a table over itself: it is cut at the
sentinels, these are dropped, and the inverse permutation gives the text.

Where a text is cut, and which form it takes, follows from a digest of its doc_id, so
reruns agree.  Positions count code points.  Null texts are empty.  Empty texts, texts that
hold a sentinel, and a share of all others stay plain.  Rows without a doc_id draw from
the digest of an empty number; repeated rows get equal outputs.  Long texts are cut whole.
An empty table gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.common import text_slices

PREFIX, MIDDLE, SUFFIX = range(3)
TEXT, MARKS = range(2)
# The sentinels of prefix, middle and suffix, in one buffer.
SENTINELS = b"<P><M><S>"
_MARK = 3
# The order of the parts in each form.
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
PLAIN = "plain"

Piece = tuple[int, int, int]


@dataclass(frozen=True)
class PieceTable:
    """Descriptors (buffer, start, length) over buffers that are never written."""

    buffers: tuple[bytes, ...]
    pieces: tuple[Piece, ...]

    @classmethod
    def of(cls, text: bytes) -> PieceTable:
        return cls((text, SENTINELS), ((TEXT, 0, len(text)),))

    def split(self, number: int, at: int) -> PieceTable:
        """Descriptor ``number`` in two, the first ``at`` bytes long."""
        buffer, start, length = self.pieces[number]
        if not 0 <= at <= length:
            raise ValueError(f"no byte {at} in a piece of {length}")
        both = ((buffer, start, at), (buffer, start + at, length - at))
        return replace(self, pieces=self.pieces[:number] + both + self.pieces[number + 1 :])

    def picked(self, numbers: Iterable[int]) -> PieceTable:
        """The descriptors ``numbers``, in that order."""
        return replace(self, pieces=tuple(self.pieces[i] for i in numbers))

    def marked(self, parts: Iterable[int]) -> PieceTable:
        """Each descriptor behind the sentinel of its part."""
        out: list[Piece] = []
        for part, piece in zip(parts, self.pieces, strict=True):
            out += [(MARKS, part * _MARK, _MARK), piece]
        return replace(self, pieces=tuple(out))

    def chunks(self) -> Iterator[memoryview]:
        for buffer, start, length in self.pieces:
            yield memoryview(self.buffers[buffer])[start : start + length]

    def sha256(self) -> str:
        """Digest of the text the table stands for, which is not put together."""
        digest = hashlib.sha256()
        for chunk in self.chunks():
            digest.update(chunk)
        return digest.hexdigest()

    def text(self) -> bytes:
        return b"".join(self.chunks())


def mark(part: int) -> bytes:
    return SENTINELS[part * _MARK : (part + 1) * _MARK]


def arranged(text: bytes, form: str, first: int, second: int) -> PieceTable:
    """The text cut at two bytes and put in a form."""
    table = PieceTable.of(text)
    if form == PLAIN:
        return table
    return table.split(0, first).split(1, second - first).picked(FORMS[form]).marked(FORMS[form])


def rebuilt(output: bytes, form: str) -> PieceTable:
    """The table of the text that was put in a form, over the output alone."""
    table = PieceTable.of(output)
    if form == PLAIN:
        return table
    order = FORMS[form]
    for i, part in enumerate(order):  # sentinel, part, sentinel, part and so on
        start = table.pieces[-1][1]
        at = output.find(mark(part), start)
        if at < 0 or (i == 0 and at):
            raise ValueError(f"an output of form {form} lacks a sentinel")
        if i:
            table = table.split(len(table.pieces) - 1, at - start)
        table = table.split(len(table.pieces) - 1, _MARK)
    parts = table.picked(range(1, len(table.pieces), 2))
    return parts.picked(sorted(range(len(order)), key=order.__getitem__))


class CodePoints:
    """Where the code points of a text begin."""

    def __init__(self, text: bytes) -> None:
        self.size = len(text)
        self.starts = None if text.isascii() else np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
        self.n = self.size if self.starts is None else len(self.starts)

    def byte(self, number: int) -> int:
        if self.starts is None or number >= self.n:
            return number if self.starts is None else self.size
        return int(self.starts[number])


@dataclass(frozen=True)
class Draw:
    """How documents draw their cuts and forms."""

    seed: str = "1:"
    arranged_percent: int = 90
    spm_percent: int = 20

    def numbers(self, doc_id: int | None) -> list[int]:
        digest = hashlib.sha256(f"{self.seed}{'' if doc_id is None else doc_id}".encode()).digest()
        return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]

    def plan(self, doc_id: int | None, text: bytes, n: int) -> tuple[str, int, int]:
        """(form, end of the prefix, end of the middle), ends in code points."""
        h = self.numbers(doc_id)
        ends = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        if not text or any(mark(part) in text for part in (PREFIX, MIDDLE, SUFFIX)) or h[2] % 100 >= self.arranged_percent:
            return PLAIN, *ends
        return ("spm" if h[3] % 100 < self.spm_percent else "psm"), *ends


_LAYOUT = {
    "doc_id": "bigint",
    "n": "bigint",
    "form": "string",
    "prefix_chars": "bigint",
    "middle_chars": "bigint",
    "pieces": "array<struct<buffer: int, start: bigint, length: bigint>>",
    "output": "string",
    "output_sha256": "string",
}


def _texts(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).view(pa.string())


def fill_in_middle(docs: DataFrame, draw: Draw | None = None) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, pieces, output, output_sha256) of every row.

    ``pieces`` are the output's descriptors: buffer 0 is the text, in bytes, buffer 1 the
    sentinels.  One pass; nothing is shuffled.
    """
    drawn = draw or Draw()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_slices(batch.column(1)):
                ids = batch.column(0).slice(at, len(texts))
                rows = []
                for doc_id, text in zip(ids.to_pylist(), texts, strict=True):
                    points = CodePoints(text)
                    form, first, second = drawn.plan(doc_id, text, points.n)
                    table = arranged(text, form, points.byte(first), points.byte(second))
                    sizes = (None, None) if form == PLAIN else (first, second - first)
                    rows.append((points.n, form, *sizes, table.pieces, table.text(), table.sha256()))
                n, form, prefix, middle, pieces, output, digest = zip(*rows, strict=True)
                flat = np.array([x for p in pieces for x in p], np.int64).reshape(-1, 3)
                parts = pa.StructArray.from_arrays(
                    [pa.array(flat[:, 0].astype(np.int32)), pa.array(flat[:, 1]), pa.array(flat[:, 2])], names=["buffer", "start", "length"]
                )
                bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(n, pa.int64()),
                        pa.array(form, pa.string()),
                        pa.array(prefix, pa.int64()),
                        pa.array(middle, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(bounds), parts),
                        _texts(list(output)),
                        pa.array(digest, pa.string()),
                    ],
                    names=list(_LAYOUT),
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in _LAYOUT.items()))


def restored(rows: DataFrame) -> DataFrame:
    """The rows with ``text`` and ``restored_sha256``, both from ``output`` and ``form`` alone.

    Columns of these two names are replaced; a missing output is empty, and plain.
    """
    before = rows.drop("text", "restored_sha256")
    schema = T.StructType([*before.schema.fields, T.StructField("text", T.StringType()), T.StructField("restored_sha256", T.StringType())])
    names = schema.names
    output, form = before.columns.index("output"), before.columns.index("form")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, outputs in text_slices(batch.column(output)):
                part = batch.slice(at, len(outputs))
                tables = [rebuilt(o, f if o else PLAIN) for o, f in zip(outputs, part.column(form).to_pylist(), strict=True)]
                columns = [*part.columns, _texts([t.text() for t in tables]), pa.array([t.sha256() for t in tables], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return before.mapInArrow(run, schema)


def digests(docs: DataFrame, draw: Draw | None = None) -> DataFrame:
    """Forms, sizes and digests of all outputs and of the texts rebuilt from them."""
    there_and_back = restored(fill_in_middle(docs, draw).drop("pieces"))
    return there_and_back.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


ORACLE = """
WITH numbered AS (
  SELECT doc_id, coalesce(text, '') AS body, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM numbered),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS q,
         CASE WHEN n = 0 OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, substr(body, 1, p) AS a, substr(body, p + 1, q - p) AS b, substr(body, q + 1) AS c FROM cut),
put AS (
  SELECT *, CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b
                      ELSE '<S>' || c || '<P>' || a || '<M>' || b END AS output
  FROM parts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
       sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output
                        WHEN 'psm' THEN substr(output, 4, strpos(output, '<S>') - 4) || substr(output, strpos(output, '<M>') + 3)
                                        || substr(output, strpos(output, '<S>') + 3, strpos(output, '<M>') - strpos(output, '<S>') - 3)
                        ELSE substr(output, strpos(output, '<P>') + 3, strpos(output, '<M>') - strpos(output, '<P>') - 3)
                             || substr(output, strpos(output, '<M>') + 3) || substr(output, 4, strpos(output, '<P>') - 4) END) AS restored_sha256
FROM put
"""
