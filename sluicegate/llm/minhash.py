"""MinHash fingerprints: universal hash permutations over word shingles, in numpy.

A signature holds, per permutation ``a * x + b`` modulo 2**32, the smallest value over a
text's different shingles of five words; a fingerprint keeps the low 16 bits of each.  The
likeness of two fingerprints is the part of positions in which they agree, which is
expected to be the Jaccard similarity of the shingle sets.

Near copies are found by bands of the signature, joined in Spark, and verified by the
Jaccard similarity of the shingle sets themselves.  In a bucket of a band every member is
verified against a leader; members that are not linked to it try the next leader, so that
a bucket of copies costs one comparison per member and no link is lost.

Null and empty texts, and texts without words, have no shingles: their fingerprint is all
f, they are like each other (1) and unlike all others (0).  Texts of fewer words than a
shingle are one shingle.  Repeated rows have equal fingerprints.  Rows without a doc_id
come last in the order of descending ids.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import Words, grams, mixed, stored, text_slices
from sluicegate.llm.components import components

SHINGLE_WORDS = 5
PERMUTATIONS = 64
BANDS = 16
LIKE = 0.8
MAP_BITS = 1 << 24
SALTS = 16
_SEED = 20240613
# Text per run of neighbouring ids, and how many runs, each a task and a row on the driver, there may be:
# beyond half a terabyte runs get longer.  They are read in order, a slice at a time, so memory stays bounded.
RUN_BYTES = 8 << 20
MOST_RUNS = 1 << 16
_BLOCK = 2048
NONE = np.uint16(0xFFFF)

_draw = np.random.default_rng(_SEED)
_A = _draw.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _draw.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)


def shingles(texts: list[bytes], size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Hashes (32 bits) of the shingles of each text, repeats included."""
    words = Words(texts, "visible")
    hashes = words.hashes()
    whole = (grams(hashes, size) >> np.uint64(32)).astype(np.uint32)
    out = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(whole[a : b - size + 1])
        else:
            out.append((grams(hashes[a:b], b - a) >> np.uint64(32)).astype(np.uint32) if b > a else whole[:0])
    return out


def signature(values: np.ndarray) -> np.ndarray:
    """Smallest value of each permutation; all ones without shingles."""
    low = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(values), _BLOCK):
        np.minimum(low, (values[i : i + _BLOCK, None] * _A + _B).min(axis=0), out=low)
    return low


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """A row of 16-bit numbers per text."""
    found = shingles(texts)
    out = np.full((len(texts), PERMUTATIONS), NONE, np.uint16)
    for i, values in enumerate(found):
        if len(values):
            # Never all ones, which marks texts without shingles.
            out[i] = np.minimum(signature(values) & np.uint32(0xFFFF), 0xFFFE)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Part of the positions in which fingerprints (rows) agree."""
    return (a == b).mean(axis=1)


def as_text(rows: np.ndarray) -> list[str]:
    return [r.astype(">u2").tobytes().hex() for r in rows]


def edited(text: str, following: str) -> str:
    """The last third of the code points, rounded down, replaced by as many of the next text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _runs(docs: DataFrame, run_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Rows with the run of neighbouring ids they are in, and the first row of each run."""
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = whole.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = min(MOST_RUNS, 1 + size // run_bytes)
    cuts = whole.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0] or []
    splits = [-float("inf"), *sorted({float(c) for c in cuts} or {0.0}), float("inf")]
    rows = whole.withColumn("tie", F.xxhash64("text")).withColumn("at", F.col("doc_id").cast("double"))
    cutter = Bucketizer(splits=splits, inputCol="at", outputCol="low", handleInvalid="keep")
    last = len(splits) - 2
    run = F.when(F.col("doc_id").isNull(), F.lit(last + 1)).otherwise(F.lit(last) - F.col("low").cast("int"))
    rows = cutter.transform(rows).select("doc_id", "text", "tie", run.alias("run"))
    first = F.max(F.struct(F.col("doc_id").isNotNull(), "doc_id", "tie")).alias("first")
    return rows, rows.groupBy("run").agg(first).select("run", "first.doc_id", "first.tie")


def with_next(docs: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Per document its own and its edited text's digest, fingerprints and likeness.

    Texts move once, to runs of neighbouring ids; the first text of a run is sent to the
    run before it as well.
    """
    rows, first = _runs(docs, run_bytes)
    # One row per run, MOST_RUNS at most; so is the table that is broadcast.
    heads = sorted((r.run, r.doc_id, r.tie) for r in first.collect())
    before = [(heads[i - 1][0], doc_id, tie) for i, (_, doc_id, tie) in enumerate(heads)]
    spark = docs.sparkSession
    tails = spark.createDataFrame(before, "to int, head_id long, head_tie long")
    same = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    places = F.array_compact(
        F.array(
            F.struct(F.col("run").alias("run"), F.lit(False).alias("tail")),
            F.when(F.col("to").isNotNull(), F.struct(F.col("to").alias("run"), F.lit(True).alias("tail"))),
        )
    )
    placed = rows.join(F.broadcast(tails), same, "left").select("doc_id", "text", "tie", F.inline(places))
    order = ["run", "tail", F.col("doc_id").desc_nulls_last(), F.col("tie").desc()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row before, whose next one is still to come
        for batch in batches:
            for at, texts in text_slices(batch.column(1)):
                ids = batch.column(0).slice(at, len(texts)).to_pylist()
                runs = batch.column(2).slice(at, len(texts)).to_pylist()
                tail = batch.column(3).slice(at, len(texts)).to_pylist()
                prints = fingerprints(texts)
                all_rows = [held] * (held is not None) + list(zip(ids, texts, runs, tail, prints, strict=True))
                held = all_rows[-1]
                pairs = [(x, y) for x, y in zip(all_rows, all_rows[1:], strict=False) if x[2] == y[2] and not x[3]]
                if not pairs:
                    continue
                own = [x[1].decode() for x, _ in pairs]
                changed = [edited(t, y[1].decode()).encode() for t, (_, y) in zip(own, pairs, strict=True)]
                after = np.concatenate([fingerprints(part) for _, part in text_slices(pa.array(changed, pa.binary()))])
                base, following = np.stack([x[4] for x, _ in pairs]), np.stack([y[4] for _, y in pairs])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x[0] for x, _ in pairs], pa.int64()),
                        pa.array([len(t) for t in own], pa.int64()),
                        pa.array([hashlib.sha256(c).hexdigest() for c in changed]),
                        pa.array(as_text(base)),
                        pa.array(as_text(after)),
                        pa.array(likeness(base, after)),
                        pa.array(likeness(base, following)),
                    ],
                    names=names,
                )

    sorted_runs = placed.repartition(len(heads) or 1, "run").sortWithinPartitions(*order).select("doc_id", "text", "run", "tail")
    return sorted_runs.mapInArrow(
        work,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def bands(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit hash per band of each signature (rows)."""
    parts = signatures.reshape(len(signatures), BANDS, PERMUTATIONS // BANDS).astype(np.uint64)
    out = np.zeros((len(signatures), BANDS), np.uint64) + mixed(np.arange(BANDS, dtype=np.uint64))
    for j in range(PERMUTATIONS // BANDS):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return out


def _set_key(values: np.ndarray) -> int:
    """A 64-bit key of a set of shingles, given sorted and without repeats."""
    spread = mixed(values.astype(np.uint64))
    both = np.array([len(values)], np.uint64) + spread.sum(dtype=np.uint64)
    return int(mixed(both ^ np.bitwise_xor.reduce(spread, initial=np.uint64(0))).view(np.int64)[0])


def _described(docs: DataFrame) -> DataFrame:
    """(doc_id, set_key, buckets) of every row; a bucket is a band's number and content."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_slices(batch.column(1)):
                sets = [np.unique(s) for s in shingles(texts)]
                found = bands(np.stack([signature(s) for s in sets])).view(np.int64)
                buckets = [b.tolist() if len(s) else [] for s, b in zip(sets, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.array([_set_key(s) for s in sets], pa.int64()),
                        pa.array(buckets, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "set_key", "buckets"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return rows.mapInArrow(work, "doc_id bigint, set_key bigint, buckets array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set_key, shingles) of the keys ``wanted``, each once.

    A bit map of fixed size sorts most other texts out before their sets are moved.
    """
    slots = wanted.select(F.expr(f"set_key & {MAP_BITS - 1}L AS slot")).distinct()
    per_byte = slots.groupBy(F.expr("slot >> 3").alias("byte")).agg(F.sum(F.expr("1 << CAST(slot & 7 AS INT)")).alias("v"))
    some = np.zeros(MAP_BITS // 8, np.uint8)
    for batch in per_byte.toArrow().to_batches():
        some[batch.column(0).to_numpy()] = batch.column(1).to_numpy().astype(np.uint8)
    bits = docs.sparkSession.sparkContext.broadcast(some)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_slices(batch.column(0)):
                sets = [np.unique(s) for s in shingles(texts)]
                keys = np.array([_set_key(s) for s in sets], np.int64)
                slot = keys & np.int64(MAP_BITS - 1)
                kept = np.flatnonzero((bits.value[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[kept]), pa.array([sets[i].tobytes() for i in kept], pa.binary())],
                    names=["set_key", "shingles"],
                )

    rows = docs.select(F.col("text").cast("string"))
    found = rows.mapInArrow(work, "set_key bigint, shingles binary").join(wanted, "set_key", "left_semi")
    return found.dropDuplicates(["set_key"])


def _verified(pairs: DataFrame, sets: DataFrame, like: float) -> DataFrame:
    """The pairs (leader, set_key) whose shingle sets are alike enough, as links (u, v)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common >= like * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    # A leader may have very many members: its set is sent to several tasks.
    salted = pairs.withColumn("salt", F.expr(f"pmod(xxhash64(set_key), {SALTS})"))
    own = sets.select(F.col("set_key").alias("leader"), F.col("shingles").alias("a"))
    places = salted.select("leader", "salt").distinct().join(own, "leader")
    joined = salted.join(places, ["leader", "salt"]).join(sets.withColumnRenamed("shingles", "b"), "set_key")
    return joined.select("leader", "set_key", "a", "b").mapInArrow(work, "u bigint, v bigint")


def near_copies(docs: DataFrame, like: float = LIKE) -> DataFrame:
    """(doc_id, class_id) of every row: the smallest doc_id that verified links reach.

    Pairs that share a band are candidates.  In each round every bucket verifies its members
    against its leader, which then leaves the bucket; buckets whose members are all in one
    class by then are done.  So every candidate pair is verified or in one class anyway.
    """
    described = stored(_described(docs), "described")
    nodes = stored(
        described.groupBy("set_key").agg(F.min("doc_id").alias("first_id"), F.first("buckets").alias("buckets")), "sets"
    )
    members = nodes.select("set_key", F.explode("buckets").alias("bucket"))
    shared_buckets = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    members = stored(members.join(shared_buckets, "bucket"), "members")
    sets = stored(_sets(docs, members.select("set_key").distinct()), "shingles")
    links = None
    while True:
        leaders = members.groupBy("bucket").agg(F.min("set_key").alias("leader"))
        pairs = stored(members.join(leaders, "bucket").filter("set_key <> leader").select("leader", "set_key").distinct(), "pairs")
        if pairs.isEmpty():
            break
        new = _verified(pairs, sets, like)
        links = stored(new if links is None else links.union(new), "verified")
        roots = stored(components(links), "roots")
        rest = members.join(leaders, "bucket").filter("set_key <> leader").select("bucket", "set_key")
        labelled = rest.join(roots, F.col("set_key") == F.col("node"), "left").withColumn("label", F.coalesce("root", "set_key"))
        open_buckets = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        members = stored(rest.join(open_buckets.filter("low <> high").select("bucket"), "bucket"), "members")
    tied = nodes.select("set_key", "first_id")
    if links is not None:
        tied = tied.join(roots, F.col("set_key") == F.col("node"), "left")
        tied = tied.select("set_key", "first_id", F.coalesce("root", "set_key").alias("root"))
    else:
        tied = tied.withColumn("root", F.col("set_key"))
    smallest = tied.groupBy("root").agg(F.min("first_id").alias("class_id"))
    named = tied.join(smallest, "root").select("set_key", "class_id")
    return described.join(named, "set_key").select("doc_id", "class_id")
