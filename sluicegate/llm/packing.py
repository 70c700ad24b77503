"""Token ids of documents in binary files, each id in the fewest bits the vocabulary needs.

Documents are spread over files by ranges of their ids, so that files in the order of
their names hold documents in the order of their ids.  Spark writes the files: a row is a
block, the text writer puts its bytes and a separator.  A block starts with its own sizes
and the offsets of its documents, so a reader steps from block to block by length and
unpacks one document or all of them with numpy.

A block, little-endian: ``SGTK``, version and bits (a byte each), two bytes unused, the
number of documents (u32) and ids (u64); per document its id (i64), whether it has one
(u8) and the number of ids before and up to it in the block (u64, one more than
documents); the packed ids, lowest bit first.  Then eight bytes of separator.

Null and empty texts have the end id alone.  Rows without a doc_id come first.  Repeated
rows are written as often as they occur, those of one id in the order of a hash of their
text.  An empty table gives no blocks and no rows.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluicegate.llm.common import shared_path, stored

END_ID = 1
# Text per file, ids per block (a longer document has a block to itself).
FILE_BYTES = 8 << 20
BLOCK_IDS = 1 << 18
BLOCKS_PER_FILE = 64
# Words whose ids a worker remembers.
REMEMBERED = 500_000

MAGIC, VERSION, SEPARATOR = b"SGTK", 1, "\x1eSG-END\x1e"
_HEAD = struct.Struct("<4sBBHIQ")
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
# ASCII marks but the apostrophe, which may begin a piece of letters.
_MARK = np.isin(np.arange(256), [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"])


def byte_characters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself where it shows,
    else the next one from 256 on."""
    shows = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shows else next(hidden)) for b in range(256)]


def _composed_later(raw: np.ndarray, lowered: np.ndarray) -> np.ndarray:
    """The lowered bytes, but words with combining marks (U+0300 to U+036F) as they are."""
    word = np.cumsum(_BLANK[raw])
    marked = np.zeros(int(word[-1]) + 1, bool)
    marked[word[(raw == 0xCC) | (raw == 0xCD)]] = True
    return np.where(marked[word], raw, lowered)


class Encoder:
    """Encodes texts through the library, each different word once.

    The vocabulary's pieces never reach over white space, so a text's ids are those of its
    words in turn.  ASCII letters are lower-cased first, as the library does, and a word is cut
    between a letter and a mark, as a piece ends there.  A word of lower-case letters alone
    is one piece, and goes straight to the library's model; all other words take the
    library's whole way.  Words with combining marks keep their case until then: the library
    composes letters before it lowers them, and some compose only when small.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.characters = byte_characters()
        # The short cut is for vocabularies that fold case and cut words into letters.
        probe = "Ab, straße"
        steps = [self._piece("ab"), self._way([","])[0], self._piece("straße")]
        self.short = [i for step in steps for i in step] == self._way([probe])[0]
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.starts, self.pool = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _way(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _piece(self, word: str) -> list[int]:
        written = word if word.isascii() else "".join(map(self.characters.__getitem__, word.encode()))
        return [t.id for t in self.tokenizer.model.tokenize(written)]

    def _learn(self, words: list[bytes]) -> None:
        new = list(dict.fromkeys(words))
        for first in range(0, len(new), 8192):
            some = new[first : first + 8192]
            texts = [w.decode() for w in some]
            ids: list[list[int] | None] = [None] * len(some)
            rest = []
            for i, text in enumerate(texts):
                # Letters that case and composition leave as they are.
                if self.short and text.isalpha() and text.islower() and is_normalized("NFC", text):
                    ids[i] = self._piece(text)
                else:
                    rest.append(i)
            for i, found in zip(rest, self._way([texts[i] for i in rest]), strict=True):
                ids[i] = found
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))
            self.known.update(zip(some, range(len(self.known), len(self.known) + len(some)), strict=True))
            self.pool = np.concatenate([self.pool, flat])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def _words(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """Words of all texts, and how many come before each text and after the last."""
        whole = b"\n".join([*texts, b""])
        if not self.short or b"<|" in whole:  # special tokens are told by their case
            split = [t.split() for t in texts]
            counts = np.fromiter(map(len, split), np.int64, len(split))
            return [w for ws in split for w in ws], np.concatenate([[0], np.cumsum(counts)])
        data = np.frombuffer(whole.lower(), np.uint8)
        if b"\xcc" in whole or b"\xcd" in whole:
            data = _composed_later(np.frombuffer(whole, np.uint8), data)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        letter = (data >= 97) & (data <= 122)
        # Two-byte letters of western languages: all of their block but the signs for times and division.
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        cut = np.flatnonzero(letter[:-1] & _MARK[data[1:]]) + 1
        ends = ends + np.searchsorted(cut, ends)
        data = np.insert(data, cut, np.uint8(32))
        blank = _BLANK[data]
        first = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
        return data.tobytes().split(), np.concatenate([[0], np.searchsorted(first, ends)])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids per text); no end ids."""
        if len(self.known) > REMEMBERED:
            self.forget()
        words, bounds = self._words(texts)
        index = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(index < 0)
        if len(missing):
            new = [words[i] for i in missing.tolist()]
            self._learn(new)
            index[missing] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
        first, sizes = self.starts[index], self.starts[index + 1] - self.starts[index]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.pool[np.repeat(first - upto[:-1], sizes) + np.arange(upto[-1])]
        return ids, np.diff(upto[bounds])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, the lowest first; padded to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    out = []
    for i in range(0, len(ids), 1 << 16):  # a multiple of eight ids ends at a byte
        some = ids[i : i + (1 << 16)].astype("<u4")
        spread = np.unpackbits(some.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
        out.append(np.packbits(spread.ravel(), bitorder="little").tobytes())
    return b"".join(out)


def unpack(packed: bytes | memoryview, bits: int, start: int, stop: int) -> np.ndarray:
    """The ids ``start`` to ``stop``; only their own bytes are looked at."""
    if bits in (8, 16, 32):
        wide = bits // 8
        return np.frombuffer(packed, f"<u{wide}", stop - start, start * wide).astype(np.uint32)
    low, high = start * bits // 8, -(-stop * bits // 8)
    spread = np.unpackbits(np.frombuffer(packed, np.uint8, high - low, low), bitorder="little")
    spread = spread[start * bits - low * 8 :][: (stop - start) * bits].reshape(-1, bits)
    return (spread.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def block(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    head = _HEAD.pack(MAGIC, VERSION, bits, 0, len(doc_ids), len(ids))
    known = np.array([d is not None for d in doc_ids], np.uint8)
    keys = np.array([d or 0 for d in doc_ids], "<i8")
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("<u8")
    return b"".join([head, keys.tobytes(), known.tobytes(), offsets.tobytes(), pack(ids, bits)])


class Block:
    """A block at a position of a file's bytes; documents are unpacked when asked for."""

    def __init__(self, data: memoryview, at: int) -> None:
        magic, version, self.bits, _, n, self.n_ids = _HEAD.unpack_from(data, at)
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"no block of token ids at byte {at}")
        at += _HEAD.size
        keys = np.frombuffer(data, "<i8", n, at).tolist()
        known = np.frombuffer(data, np.uint8, n, at + 8 * n).tolist()
        self.doc_ids = [k if has else None for k, has in zip(keys, known, strict=True)]
        self.offsets = np.frombuffer(data, "<u8", n + 1, at + 9 * n).astype(np.int64)
        at += 9 * n + 8 * (n + 1)
        self.end = at + -(-self.n_ids * self.bits // 8)
        self.packed = data[at : self.end]
        separator = SEPARATOR.encode()
        if bytes(data[self.end : self.end + len(separator)]) != separator:
            raise ValueError("a block of token ids is cut off")
        self.end += len(separator)

    def document(self, i: int) -> np.ndarray:
        return unpack(self.packed, self.bits, int(self.offsets[i]), int(self.offsets[i + 1]))


def blocks(content: bytes) -> Iterator[Block]:
    data, at = memoryview(content), 0
    while at < len(data):
        found = Block(data, at)
        yield found
        at = found.end


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> None:
    """Write the ids of ``docs`` (doc_id, text) below ``path``; a repeated task replaces its file."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = 1 + size // file_bytes
    order = ["doc_id", F.xxhash64("text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        bits = bits_for(max(words.size, end_id + 1))
        keys: list[int | None] = []
        parts: list[np.ndarray] = []
        held = 0

        def full() -> pa.RecordBatch:
            sizes = np.array([len(p) for p in parts], np.int64)
            out = block(keys, sizes, np.concatenate(parts), bits)
            return pa.RecordBatch.from_pydict({"block": pa.array([out], pa.binary())})

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                found = [t or b"" for t in rows.column(1).cast(pa.binary()).to_pylist()]
                ids, sizes = words.encode(found)
                stops = np.cumsum(sizes)
                for key, start, stop in zip(rows.column(0).to_pylist(), (stops - sizes).tolist(), stops.tolist(), strict=True):
                    keys.append(key)
                    parts.append(np.append(ids[start:stop], np.uint32(end_id)))
                    held += stop - start + 1
                    if held >= BLOCK_IDS:
                        yield full()
                        keys, parts, held = [], [], 0
        if keys:
            yield full()

    spread = texts.repartitionByRange(files, *order).sortWithinPartitions(*order)
    packed = spread.mapInArrow(run, "block binary").select(F.col("block").cast("string").alias("value"))
    packed.write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", BLOCKS_PER_FILE).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, doc_id, within, n_tokens, ids_crc32) of every document in the files below ``path``."""
    found = spark.read.format("binaryFile").load(path).filter("length > 0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                before = 0
                for part in blocks(content):
                    n = len(part.doc_ids)
                    ids = [part.document(i) for i in range(n)]
                    sums = [zlib.crc32(d.astype("<u4").tobytes()) for d in ids]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([os.path.basename(name)] * n, pa.string()),
                            pa.array(part.doc_ids, pa.int64()),
                            pa.array(before + part.offsets[:-1]),
                            pa.array(np.diff(part.offsets)),
                            pa.array(sums, pa.int64()),
                        ],
                        names=["file", "doc_id", "within", "n_tokens", "ids_crc32"],
                    )
                    before += part.n_ids

    layout = "file string, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint"
    return found.select("path", "content").mapInArrow(run, layout)


def placed(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the rows of ``read``: ``start`` counts from the first file's first id."""
    # One row per file.  The ranges of ids are in the order of part number and file counter; as text,
    # part-100000 would come before part-99999.
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("ids"))
    numbers = [F.regexp_extract("file", pattern, 1).cast("long") for pattern in (r"^part-(\d+)", r"-c(\d+)[^-]*$")]
    before = F.sum("ids").over(Window.orderBy(*numbers, "file").rowsBetween(Window.unboundedPreceding, -1))
    offsets = files.select(F.col("file").alias("named"), F.coalesce(before, F.lit(0)).alias("before"))
    found = rows.join(offsets, F.col("file") == F.col("named"))
    return found.select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Write the files and read them back: (doc_id, start, n_tokens, ids_crc32) per document."""
    spark = docs.sparkSession
    path = path or shared_path(spark, "token-ids")
    write(docs, path, tokenizer, end_id)
    return placed(stored(read(spark, path), "token-rows"))


def document(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """(doc_id, ids) of one document: only the block that holds it is unpacked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                for part in blocks(content):
                    for i in (i for i, d in enumerate(part.doc_ids) if d == doc_id):
                        yield pa.RecordBatch.from_pydict(
                            {"doc_id": pa.array([doc_id]), "ids": pa.array([part.document(i).astype(np.int64)], pa.list_(pa.int64()))}
                        )

    found = spark.read.format("binaryFile").load(path).filter("length > 0").select("content")
    return found.mapInArrow(run, "doc_id bigint, ids array<bigint>")
