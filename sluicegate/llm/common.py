"""Reading tables, stored intermediates, and words of whole texts as numpy arrays."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Bytes of text that are looked at together; a longer text is looked at alone.
SLICE_BYTES = 1 << 20
_GROWTH = 0x9E3779B97F4A7C15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which the cluster shares.

    Where the setting is absent, a local session gets a folder of its own, once.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read again: lineage ends there."""
    path = shared_path(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that the rows do not have yet, whatever the case of theirs."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


def text_slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Whole texts as UTF-8 (null: empty), in runs of about ``limit`` bytes: (first row, texts)."""
    texts = [t or b"" for t in column.cast(pa.binary()).to_pylist()]
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > limit:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text)
    if texts:
        yield first, texts[first:]


def byte_table(word: str) -> np.ndarray:
    """Which of the 256 bytes belong to words: ``visible`` or ``alnum``.

    ``visible`` is ``[^\\x20\\x09-\\x0D]``; ``alnum`` is ASCII digits and letters and all
    bytes of other characters, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing.
    """
    code = np.arange(256)
    if word == "visible":
        return ~((code == 32) | ((code >= 9) & (code <= 13)))
    digit, letter = (code >= 48) & (code <= 57), (code >= 97) & (code <= 122)
    return digit | letter | (code >= 128)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """Words of several texts.

    ``data`` holds each word and one blank behind it, lower-cased in A-Z; ``starts`` and
    ``ends`` are byte positions; the words of text i are ``bounds[i]`` to ``bounds[i + 1]``.
    """

    def __init__(self, texts: list[bytes], word: str) -> None:
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        data = _LOWER[raw]
        inside = byte_table(word)[data]
        keep = inside.copy()
        keep[1:] |= inside[:-1]  # one separator behind each word
        kept = inside[keep]
        self.data = np.where(kept, data[keep], np.uint8(32))
        blanks = np.flatnonzero(~kept)
        self.ends = blanks
        self.starts = np.concatenate([np.zeros(1, np.int64), blanks[:-1] + 1]) if len(blanks) else blanks
        edge = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        self.bounds = np.concatenate([[0], np.searchsorted(edge, np.cumsum(sizes), side="left")])

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        """A 64-bit polynomial hash per word, mixed."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        power, inverse = _powers(2 * SLICE_BYTES) if len(self.data) < 2 * SLICE_BYTES else _new_powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * power[: len(self.data)], out=total[1:])
        return mixed((total[self.ends] - total[self.starts]) * inverse[self.starts])


def _new_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    base = 0xC2B2AE3D27D4EB4F
    up = np.full(n, base, np.uint64)
    down = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _new_powers(n)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = values.astype(np.uint64) + np.uint64(((seed + 1) * _GROWTH) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Ordered hashes of every k neighbours; shorter by k - 1."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
    return mixed(out)
