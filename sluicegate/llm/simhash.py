"""SimHash near-duplicates: fingerprints linked through vantage-point trees.

A tree of vantage points cuts the Hamming space of all different fingerprints into
shards.  A fingerprint lives in one shard; where it lies within the link radius of a
border, it is also sent as a question to the shard beyond, and on to each shard below
that the triangle inequality cannot rule out.  A shard answers from its own rows, again
by vantage points, and hands on a forest instead of all its pairs.

The tree is grown on a bounded sample; every fingerprint is then placed and asked.

Null and empty texts have fingerprint zero and are linked like any other.  Repeated rows
share a fingerprint, and so a component.  Rows without a doc_id take part; a component's
id is its smallest doc_id (null if it has none).  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluicegate.llm.common import Words, fresh, stored, text_slices
from sluicegate.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
# Different fingerprints per shard, and the bound of the sample that the tree is grown on.
SHARD_ROWS = 4096
SAMPLE_ROWS = 1 << 17
# Pairs that are compared at once inside a shard.
BLOCK_PAIRS = 1 << 21


def fingerprints(texts: list[bytes], shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """A 64-bit fingerprint per text; texts without words have zero."""
    words = Words(texts, "visible")
    data = words.data.tobytes()
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for i, (a, b) in enumerate(zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True)):
        n = max(1, b - a - shingle_words + 1) if b > a else 0
        if not n:
            continue
        starts = words.starts[a : a + n].tolist()
        ends = words.ends[b - n : b].tolist()
        hashes = np.fromiter(
            (digest(data[s:e], SEED) for s, e in zip(starts, ends, strict=True)), np.uint64, n
        )
        ones = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[i] = weights[ones * 2 > n].sum(dtype=np.uint64)
    return out


def with_fingerprint(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [fingerprints(texts, shingle_words) for _, texts in text_slices(batch.column(1))]
            fps = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    kept = docs.select("doc_id", F.col("text").cast("string"))
    return kept.mapInArrow(run, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, fp bigint")


@dataclass
class Tree:
    """Vantage points by node; ``radius`` -1 marks a leaf, whose ``left`` is its shard."""

    point: np.ndarray
    radius: np.ndarray
    left: np.ndarray
    right: np.ndarray


def _split(values: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, int, np.ndarray] | None:
    """The vantage point, of a few tried, whose border holds the fewest values."""
    best = None
    for point in rng.choice(values, min(8, len(values)), replace=False):
        far = np.bitwise_count(values ^ point)
        radius = int(np.median(far))
        if radius == far.max():
            radius -= 1
        inner = far <= radius
        if not inner.any() or inner.all():
            continue
        border = np.count_nonzero(np.abs(far.astype(np.int16) - radius) <= MAX_BITS)
        uneven = abs(2 * np.count_nonzero(inner) - len(values))
        if best is None or border + uneven < best[0]:
            best = (border + uneven, point, radius, inner)
    return best and best[1:]


def grow(sample: np.ndarray, total: int, shard_rows: int = SHARD_ROWS) -> Tree:
    """A tree whose shards are expected to hold about ``shard_rows`` of ``total`` values."""
    rng = np.random.default_rng(SEED)
    enough = max(8.0, shard_rows * len(sample) / max(1, total))
    point, radius, left, right = [], [], [], []
    shards = 0
    todo = [(sample, -1, False)]
    while todo:
        values, parent, is_right = todo.pop()
        node = len(point)
        if parent >= 0:
            (right if is_right else left)[parent] = node
        found = _split(values, rng) if len(values) > enough else None
        point.append(found[0] if found else np.uint64(0))
        radius.append(found[1] if found else -1)
        left.append(-1 if found else shards)
        right.append(-1)
        if found:
            todo += [(values[found[2]], node, False), (values[~found[2]], node, True)]
        else:
            shards += 1
    return Tree(np.array(point, np.uint64), np.array(radius), np.array(left), np.array(right))


def place(tree: Tree, values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, index of the value, asks): one home per value, and the shards it asks."""
    out = []
    todo = [(0, np.arange(len(values)), np.zeros(0, np.int64))]
    while todo:
        node, home, asking = todo.pop()
        if not len(home) + len(asking):
            continue
        if tree.radius[node] < 0:
            out += [(tree.left[node], home, False), (tree.left[node], asking, True)]
            continue
        point, radius = tree.point[node], int(tree.radius[node])
        far = np.bitwise_count(values[home] ^ point).astype(np.int16)
        asked = np.bitwise_count(values[asking] ^ point).astype(np.int16)
        # A pair that this border parts is asked for from inside only.
        out_of_inner = home[(far <= radius) & (far > radius - bits)]
        todo.append((tree.left[node], home[far <= radius], asking[asked <= radius + bits]))
        beyond = np.concatenate([asking[asked > radius - bits], out_of_inner])
        todo.append((tree.right[node], home[far > radius], beyond))
    shard = np.concatenate([np.full(len(i), s, np.int32) for s, i, _ in out] or [np.zeros(0, np.int32)])
    index = np.concatenate([i for _, i, _ in out] or [np.zeros(0, np.int64)])
    asks = np.concatenate([np.full(len(i), a) for _, i, a in out] or [np.zeros(0, bool)])
    return shard, index, asks


def _near(a: np.ndarray, b: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a and b within ``bits``, every pair of blocks compared."""
    step = max(1, BLOCK_PAIRS // max(1, len(b)))
    found = [np.nonzero(np.bitwise_count(a[i : i + step, None] ^ b[None, :]) <= bits) for i in range(0, len(a), step)]
    first = [x + i * step for i, (x, _) in enumerate(found)]
    none = [np.zeros(0, np.int64)]
    return np.concatenate(first or none), np.concatenate([y for _, y in found] or none)


class _Forest:
    """Labels of values that links join; the smallest index of a tree is its label."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                return
            la, lb = la[apart], lb[apart]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while (label[label] != label).any():
                label[:] = label[label]


def link(data: np.ndarray, asking: np.ndarray, bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links among ``data`` and between ``asking`` and ``data``: (value, root)."""
    values = np.concatenate([data, asking])
    forest, rng = _Forest(len(values)), np.random.default_rng(SEED)
    todo = [(np.arange(len(data)), np.arange(len(values)))]
    while todo:
        home, questions = todo.pop()
        if not len(home) or not len(questions):
            continue
        found = _split(values[home], rng) if len(home) * len(questions) > BLOCK_PAIRS and len(home) > 64 else None
        if found is None:
            a, b = _near(values[questions], values[home], bits)
            forest.join(questions[a], home[b])
            continue
        point, radius, inner = found
        far = np.bitwise_count(values[questions] ^ point).astype(np.int16)
        todo.append((home[inner], questions[far <= radius + bits]))
        todo.append((home[~inner], questions[far > radius - bits]))
    moved = np.flatnonzero(forest.label != np.arange(len(values)))
    return values[moved], values[forest.label[moved]]


def links(fps: DataFrame, bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A forest (u, v) over different fingerprints (column fp) that spans all links."""
    spark = fps.sparkSession
    total = fps.count()
    # Chosen by a scramble: a bounded sample that reruns repeat.
    some = fps.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) <= (SAMPLE_ROWS << 30) // max(1, total))
    sample = np.sort(some.toPandas()["fp"].to_numpy(np.int64))
    tree = spark.sparkContext.broadcast(grow(sample.view(np.uint64), total, shard_rows))

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = frame["fp"].to_numpy(np.int64)
            for at in range(0, len(values), 4096):
                part = values[at : at + 4096]
                shard, index, asks = place(tree.value, part.view(np.uint64), bits)
                yield pd.DataFrame({"shard": shard, "fp": part[index], "asks": asks})

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        values, asks = frame["fp"].to_numpy(np.int64).view(np.uint64), frame["asks"].to_numpy(bool)
        u, v = link(np.sort(values[~asks]), np.sort(values[asks]), bits)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    placed = fps.select("fp").mapInPandas(route, "shard int, fp bigint, asks boolean")
    return placed.groupBy("shard").applyInPandas(answer, "u bigint, v bigint")


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """(doc_id, fp, fingerprint, component_id) of every row of ``docs`` (doc_id, text)."""
    prints = stored(with_fingerprint(docs, shingle_words), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    roots = components(links(nodes, bits, shard_rows))
    tied = nodes.join(roots, F.col("fp") == F.col("node"), "left")
    tied = tied.select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = tied.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = tied.join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def deduplicated(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """One row of each component stays: of its smallest doc_id, the first row by text.

    Rows without a doc_id cannot be told apart from each other, and stay.
    """
    groups = near_duplicates(docs, shingle_words, bits).filter("doc_id = component_id").select("doc_id").distinct()
    nth, key, kept = fresh(docs, "nth"), fresh(docs, "kept_id"), stored(groups, "kept")
    kept = kept.withColumnRenamed("doc_id", key)
    one = Window.partitionBy("doc_id").orderBy("text")
    found = docs.filter("doc_id IS NOT NULL").join(kept, F.col("doc_id") == F.col(key), "left_semi")
    found = found.withColumn(nth, F.row_number().over(one)).filter(F.col(nth) == 1).drop(nth)
    return found.union(docs.filter("doc_id IS NULL"))
