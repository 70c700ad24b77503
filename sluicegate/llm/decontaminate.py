"""Benchmark decontamination by winnowing.

Of the k-gram hashes in every window of neighbouring k-grams the smallest is kept, so that
texts sharing a run of ``WINDOW_WORDS`` words keep at least one k-gram of it in common.
Kept k-grams of documents and of benchmark items are joined in Spark, and each match is
extended over the words around it.  A document's fingerprint carries the hashes of the
words within reach, so the extension needs no second look at the texts.

Items of fewer words than a window are matched as a whole: winnowing promises nothing for
them, so all runs of their length are looked up.

Before the join, fingerprints that no item can have are sorted out with a bit map of fixed
size.  If a benchmark grows so large that the map fills up, the join gets more rows and the
result is the same.

Words are lower-cased in A-Z.  Null and empty texts have no words and hit nothing; items
without words have no window.  Repeated documents (equal id and text) count once per id
and text; repeated item ids count once.  Empty tables give no rows, or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import Words, fresh, grams, mixed, stored, text_slices

WINDOW_WORDS = 13
GRAM_WORDS = 5
# A document is contaminated if a twentieth of its words is hit.
SHARE = 20
MAP_BITS = 1 << 24
# A fingerprint that a third of all documents have is spread over so many parts.
SALTS = 32


def _last_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minima of every ``width`` neighbours, by doubling."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def winnowed(fps: np.ndarray, width: int) -> np.ndarray:
    """Which k-grams are the smallest of some window of ``width`` neighbours (all, if fewer)."""
    if len(fps) <= width:
        return fps == fps.min() if len(fps) else np.zeros(0, bool)
    least = _last_min(fps, width)
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    # A k-gram was kept if the largest of the minima of its windows is itself.
    return ~_last_min(~padded, width) == fps


def _around(hashes: np.ndarray, bounds: np.ndarray, at: np.ndarray, row: np.ndarray, reach: int, size: int) -> np.ndarray:
    """Hashes of the words from ``reach`` before to ``reach`` behind a run; zero outside the text."""
    index = at[:, None] + np.arange(-reach, size + reach)[None, :]
    inside = (index >= bounds[row][:, None]) & (index < bounds[row + 1][:, None])
    return np.where(inside, hashes[np.clip(index, 0, max(0, len(hashes) - 1))] | np.uint64(1), np.uint64(0))


def marks(texts: list[bytes], sizes: list[int], window: int, gram: int, only: np.ndarray | None) -> Iterator[tuple]:
    """(row, word position, fingerprint, size, hashes around) of texts; ``only`` is a bit map."""
    words = Words(texts, "alnum")
    hashes, bounds = words.hashes(), words.bounds
    row_of = np.repeat(np.arange(len(texts)), words.counts)
    for size in sorted({gram, *sizes}):
        fps = mixed(grams(hashes, size), size)
        n = len(fps)
        if not n:
            continue
        whole = row_of[:n] == row_of[size - 1 :]
        wanted = whole & seen(only, fps) if only is not None else whole
        if size == gram and gram not in sizes:
            # Runs over the end of a text are the largest, so that windows there are short.
            wanted &= winnowed(np.where(whole, fps, np.uint64(2**64 - 1)), window - gram + 1)
        at = np.flatnonzero(wanted)
        reach = window - size if size == gram else 0
        for i in range(0, len(at), 65536):
            some = at[i : i + 65536]
            around = _around(hashes, bounds, some, row_of[some], reach, size)
            yield row_of[some], some - bounds[row_of[some]], fps[some], size, around


def seen(bits: np.ndarray, fps: np.ndarray) -> np.ndarray:
    slot = fps & np.uint64(len(bits) * 8 - 1)
    return (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _items(benchmark: DataFrame, window: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """Different word sequences of items (item, size, fp, around), and the ids that have each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_slices(batch.column(1)):
                words = Words(texts, "alnum")
                hashes, ids = words.hashes(), batch.column(0).slice(first, len(texts)).to_pylist()
                for i, n in enumerate(words.counts.tolist()):
                    own = hashes[words.bounds[i] : words.bounds[i + 1]]
                    if n:
                        yield pa.RecordBatch.from_pydict(
                            {
                                "item_id": pa.array([ids[i]], pa.string()),
                                "item": pa.array([fold(own)], pa.int64()),
                                "n": pa.array([n], pa.int32()),
                                "text": pa.array([texts[i]], pa.binary()),
                            }
                        )

    listed = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    listed = stored(listed.mapInArrow(run, "item_id string, item bigint, n int, text binary"), "items")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, n, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                # Whole sequences of short items; of others all k-grams that winnowing keeps.
                sizes, width = ([n], window) if n < window else ([], window)
                for _, pos, fps, size, around in marks([text], sizes, width, gram, None):
                    if n >= window or size == n:
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(pos), item)),
                                pa.array(np.full(len(pos), min(n, window), np.int32)),
                                pa.array(np.full(len(pos), size, np.int32)),
                                pa.array(fps.view(np.int64)),
                                _lists(around),
                            ],
                            names=["item", "least", "size", "fp", "item_around"],
                        )

    one = listed.groupBy("item").agg(F.min("n").alias("n"), F.min("text").alias("text")).select("item", "n", "text")
    kept = stored(one.mapInArrow(index, "item bigint, least int, size int, fp bigint, item_around array<bigint>"), "item_marks")
    return kept, listed.select("item_id", "item", "n").distinct()


def fold(hashes: np.ndarray) -> int:
    """One number for a sequence of word hashes."""
    order = mixed(np.arange(len(hashes), dtype=np.uint64))
    return int(mixed((hashes * (order | np.uint64(1))).sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0])


def _lists(matrix: np.ndarray) -> pa.ListArray:
    rows, wide = matrix.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(rows + 1, dtype=np.int32) * wide), pa.array(np.ascontiguousarray(matrix).view(np.int64).ravel())
    )


def _bit_map(kept: DataFrame, bits: int) -> np.ndarray:
    """A bit per low end of a fingerprint: a fixed size, however large the benchmark."""
    slots = kept.select(F.expr(f"fp & {bits - 1}L AS slot")).distinct()
    per_byte = slots.groupBy(F.expr("slot >> 3").alias("byte")).agg(F.sum(F.expr("1 << CAST(slot & 7 AS INT)")).alias("v"))
    out = np.zeros(bits // 8, np.uint8)
    for batch in per_byte.toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy().astype(np.uint8)
    return out


def _runs(frame: pd.DataFrame, window: int, gram: int) -> pd.DataFrame:
    """Spans [start, stop) of words that a match covers once it is extended both ways."""
    out = []
    for size, part in frame.groupby("size"):
        size = int(size)
        a = np.stack(part["around"].to_numpy()).view(np.uint64)
        b = np.stack(part["item_around"].to_numpy()).view(np.uint64)
        same = (a == b) & (a != 0)
        reach = (a.shape[1] - size) // 2
        before = np.cumprod(same[:, :reach][:, ::-1], axis=1).sum(axis=1)
        behind = np.cumprod(same[:, reach + size :], axis=1).sum(axis=1)
        good = same[:, reach : reach + size].all(axis=1) & (before + size + behind >= part["least"].to_numpy())
        pos = part["pos"].to_numpy()
        spans = part[["row_key", "item"]].assign(start=pos - before, stop=pos + size + behind)
        out.append(spans[good])
    spans = pd.concat(out) if out else frame.iloc[:0].assign(start=0, stop=0)[["row_key", "item", "start", "stop"]]
    # Neighbouring matches mostly extend to the same span.
    return spans.drop_duplicates()


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, gram: int = GRAM_WORDS) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated) of every row of ``docs``.

    ``items`` is the sorted list of the ids of items with windows in the document.
    """
    spark = docs.sparkSession
    kept, listed = _items(benchmark, window, gram)
    bits = spark.sparkContext.broadcast(_bit_map(kept, MAP_BITS))
    # At most window - 1 lengths.
    short = [r[0] for r in listed.filter(F.col("n") < window).select("n").distinct().collect()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row_key", "doc_id", "n_words", "pos", "size", "fp", "around"]
        for batch in batches:
            for first, texts in text_slices(batch.column(1)):
                ids = batch.column(0).slice(first, len(texts))
                words = Words(texts, "alnum")
                # The key of a row is that of its words; rows with the same words have the same hits.
                hashes = words.hashes()
                keys = np.array(
                    [fold(hashes[a:b]) for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)], np.int64
                )
                none = pa.nulls(len(texts), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), ids, pa.array(words.counts), none, none, none.cast(pa.int64()), pa.nulls(len(texts), pa.list_(pa.int64()))],
                    names=names,
                )
                for row, pos, fps, size, around in marks(texts, short, window, gram, bits.value):
                    n = len(row)
                    if n:
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(keys[row]),
                                pa.nulls(n, ids.type),
                                pa.nulls(n, pa.int64()),
                                pa.array(pos.astype(np.int32)),
                                pa.array(np.full(n, size, np.int32)),
                                pa.array(fps.view(np.int64)),
                                _lists(around),
                            ],
                            names=names,
                        )

    rows = docs.select("doc_id", F.col("text").cast("string"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = stored(
        rows.mapInArrow(
            run, f"row_key bigint, doc_id {kind}, n_words bigint, pos int, size int, fp bigint, around array<bigint>"
        ),
        "marks",
    )
    salted = found.filter("fp IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("row_key", "pos"), F.lit(SALTS)))
    spread = kept.select("*", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt"))
    pairs = salted.join(spread, ["fp", "size", "salt"]).select(
        "row_key", "pos", "size", "around", "item", "least", "item_around"
    )

    def extend(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield _runs(frame, window, gram)

    spans = stored(pairs.mapInPandas(extend, "row_key bigint, item bigint, start int, stop int").distinct(), "spans")
    covered = spans.select("row_key", "start", "stop").distinct()
    # One text's spans; equal texts have one key.
    per_text = covered.groupBy("row_key").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    step = """aggregate(spans, named_struct('total', 0L, 'reached', 0),
        (s, x) -> IF(x.stop > s.reached,
                     named_struct('total', s.total + x.stop - greatest(x.start, s.reached), 'reached', x.stop), s),
        s -> s.total)"""
    hit = per_text.select("row_key", F.expr(step).alias("n_hit"))
    ids = spans.select("row_key", "item").distinct().join(listed, "item").select("row_key", "item_id").distinct()
    ids = ids.groupBy("row_key").agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    results = stored(hit.join(ids, "row_key"), "hits")
    counted = found.filter("n_words IS NOT NULL").select("row_key", "doc_id", "n_words")
    return counted.join(results, "row_key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.expr("CAST(array() AS array<string>)")).alias("items"),
        F.expr(f"coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= n_words").alias("contaminated"),
    )


def digests(found: DataFrame) -> DataFrame:
    """The items as the digest of their comma-joined ids."""
    digest = F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose doc_id is not that of a contaminated row; rows without an id stay."""
    key = fresh(docs, "bad_id")
    bad = overlaps(docs, benchmark).filter("contaminated AND doc_id IS NOT NULL")
    bad = stored(bad.select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return docs.join(bad, F.col("doc_id") == F.col(key), "left_anti")
