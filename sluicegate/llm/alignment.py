"""Tokens of two tokenizers aligned by the bytes they stand for.

Every token points to the farthest-right token of the other tokenizer that it overlaps; a
token of the second one whose end is an end of the first one too points to itself.
Doubling these pointers, for all tokens of many texts at once, takes each token to the
last one of its component, which is its group.  All tokens of a group are linked across.

Texts are cut into units first, between a visible character and a blank behind it: no
token of either vocabulary reaches over that place, so both end there, a unit's tokens
are those it has within its text, and groups lie within units.  A worker aligns each
different unit once and then puts texts together from units.  Where a vocabulary has
tokens that reach over such a place, whole texts are the units.

Counts of linked ids cover all documents.  Most links are of few pairs of ids: pairs that
more than a set part of all (document, pair) rows have are sent to every task, and their
number is bounded by that part; all others are joined by a shuffle.

Null and empty texts, and texts whose tokens do not spell a blank and the text, byte by
byte, have no tokens.  Special tokens in a text are text.  Repeated rows, and rows without
a doc_id, are documents of their own.  Long texts are read whole.  An empty table gives no
rows.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluicegate.llm.common import stored, text_slices
from sluicegate.llm.packing import byte_characters

# Different units that a worker remembers, and the links of theirs.
REMEMBERED = 400_000
REMEMBERED_LINKS = 4_000_000
# Pairs of a group beyond this number are counted by different ids instead of one by one.
WIDE_GROUP = 1 << 16
_CHUNK = 1 << 22
# Pairs of ids that are sent to every task: fewer than so many.
HOT_PAIRS = 1 << 18


def places(text: bytes) -> np.ndarray:
    """Bytes of a text that are a blank behind a visible character."""
    data = np.concatenate([np.zeros(3, np.uint8), np.frombuffer(text, np.uint8)])
    blank = np.flatnonzero(data[4:] == 32) + 4
    one, two, three = data[blank - 1], data[blank - 2], data[blank - 3]
    # Blanks beyond ASCII: U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
    wide = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    wide |= (three == 0xE1) & (two == 0x9A) & (one == 0x80)
    wide |= (three == 0xE2) & (two == 0x80) & ((one <= 0x8A) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF))
    wide |= (three == 0xE2) & (two == 0x81) & (one == 0x9F)
    wide |= (three == 0xE3) & (two == 0x80) & (one == 0x80)
    return blank[(one > 32) & (one != 127) & ~wide] - 3


class Spelling:
    """The bytes of every token of a vocabulary, in one pool."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.pool = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.n = len(tokens)
        self.reaches = any(len(places(t)) for t in tokens if b" " in t)

    def write(self, ids: np.ndarray) -> np.ndarray:
        return self.pool[_ranges(self.starts[ids], self.sizes[ids])]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def _totals(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``sizes`` values; empty runs are zero."""
    upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(sizes)
    return upto[ends] - upto[ends - sizes]


class ByteLevel:
    """A byte-level vocabulary of the ``tokenizers`` library."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        tokens = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab().items():
            tokens[i] = bytes(map(byte_of.__getitem__, token)) if all(c in byte_of for c in token) else token.encode()
        self.spelling = Spelling(tokens)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts, which begin with a blank."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """A vocabulary of the ``sentencepiece`` library, which puts a blank before a text."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.spelling = Spelling([self._bytes(i) for i in range(self.model.get_piece_size())])
        # The library gives an empty text no tokens, though a blank at the end of one has some.
        self.blank = self.model.encode("a ")[len(self.model.encode("a")) :]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = self.model.encode([t[1:] for t in texts], num_threads=1)
        return [ids if len(t) > 1 else self.blank for t, ids in zip(texts, found, strict=True)]


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token of both kinds, given where tokens end; groups count up from 0.

    Both kinds cover the same bytes without gaps.
    """
    n = len(a_ends)
    of_a = np.searchsorted(b_ends, a_ends)  # the token that holds the last byte reaches farthest right
    of_b = np.searchsorted(a_ends, b_ends)
    last = a_ends[of_b] == b_ends
    successor = np.concatenate([n + of_a, np.where(last, n + np.arange(len(b_ends)), of_b)])
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            break
        successor = further
    label = np.cumsum(last) - 1
    return label[successor[:n] - n], label[successor[n:] - n]


def _counted(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, sorted, and the sum of their times."""
    found, at = np.unique(keys, return_inverse=True)
    out = np.zeros(len(found), np.int64)
    np.add.at(out, at, times)
    return found, out


def linked(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, owner: np.ndarray, n_b: int, n_a: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, key, times): the links of each owner; ``owner`` is that of each group.

    A key is ``a * n_b + b``.
    """
    n = len(owner)
    na, nb = np.bincount(a_group, minlength=n), np.bincount(b_group, minlength=n)
    a_first, b_first = np.cumsum(na) - na, np.cumsum(nb) - nb
    wide = na * nb > WIDE_GROUP
    scale = n_a * n_b
    keys: list[np.ndarray] = []
    times: list[np.ndarray] = []
    # Every token of a narrow group meets all tokens of the other kind in it.
    some = np.flatnonzero(~wide[a_group])
    upto = np.cumsum(nb[a_group[some]])
    first = 0
    while first < len(some):
        after = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + _CHUNK)))
        part = some[first:after]
        group = a_group[part]
        sizes = nb[group]
        other = b[_ranges(b_first[group], sizes)]
        found, n_times = np.unique(np.repeat(owner[group] * scale + a[part] * n_b, sizes) + other, return_counts=True)
        keys.append(found)
        times.append(n_times)
        first = after
    for group in np.flatnonzero(wide).tolist():
        x, x_times = np.unique(a[a_first[group] : a_first[group] + na[group]], return_counts=True)
        y, y_times = np.unique(b[b_first[group] : b_first[group] + nb[group]], return_counts=True)
        keys.append((owner[group] * scale + x[:, None] * n_b + y[None, :]).ravel())
        times.append((x_times[:, None] * y_times[None, :]).ravel())
    if not keys:
        none = np.zeros(0, np.int64)
        return none, none, none
    found, n_times = (keys[0], times[0]) if len(keys) == 1 else _counted(np.concatenate(keys), np.concatenate(times))
    return found // scale, found % scale, n_times


class Aligner:
    """Aligns texts of UTF-8 bytes; remembers the units it has met."""

    def __init__(self, first: str, second: str) -> None:
        self.a, self.b = ByteLevel(first), Pieces(second)
        self.cuts = not (self.a.spelling.reaches or self.b.spelling.reaches)
        self.n_a, self.n_b = self.a.spelling.n, self.b.spelling.n
        # Every id in decimals, and a place for the mark behind it.
        self.decimals = Spelling([b"%d," % i for i in range(max(self.n_a, self.n_b))])
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.texts: list[bytes] = []
        self.facts = np.zeros((0, 5), np.int64)  # valid, tokens of either kind, groups, links
        self.firsts = np.zeros(1, np.int64)
        self.keys, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def units(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """Units of all texts, each text behind a blank, and how many each text has."""
        whole = b"".join(b" " + t for t in texts)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        begins = np.cumsum(sizes) - sizes
        if not self.cuts:
            starts = begins
        else:
            starts = np.union1d(begins, places(whole))
        ends = np.append(starts[1:], len(whole))
        found = [whole[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        return found, np.diff(np.append(np.searchsorted(starts, begins), len(starts)))

    def _learn(self, new: list[bytes]) -> None:
        texts = [u.decode("utf-8", "replace") for u in new]
        a_ids, b_ids = self.a.encode(texts), self.b.encode(texts)
        n = len(new)
        na, nb = (np.fromiter(map(len, ids), np.int64, n) for ids in (a_ids, b_ids))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64, int(k.sum())) for ids, k in ((a_ids, na), (b_ids, nb)))
        sizes = np.fromiter(map(len, new), np.int64, n)
        valid = (_totals(self.a.spelling.sizes[a], na) == sizes) & (_totals(self.b.spelling.sizes[b], nb) == sizes)
        a, b = a[np.repeat(valid, na)], b[np.repeat(valid, nb)]
        data = np.frombuffer(b"".join(u for u, ok in zip(new, valid.tolist(), strict=True) if ok), np.uint8)
        wrong = (self.a.spelling.write(a) != data) | (self.b.spelling.write(b) != data)
        if wrong.any():
            spoiled = np.flatnonzero(valid)[_totals(wrong, sizes[valid]) > 0]
            still = valid.copy()
            still[spoiled] = False
            a, b = a[np.repeat(still[valid], na[valid])], b[np.repeat(still[valid], nb[valid])]
            valid = still
        na, nb, sizes = na * valid, nb * valid, sizes * valid
        a_ends, b_ends = np.cumsum(self.a.spelling.sizes[a]), np.cumsum(self.b.spelling.sizes[b])
        a_group, b_group = terminals(a_ends, b_ends)
        n_groups = int(b_group[-1]) + 1 if len(b_group) else 0
        last = np.searchsorted(b_group, np.arange(n_groups), side="right") - 1
        owner = np.searchsorted(np.cumsum(sizes), b_ends[last])
        in_a, in_b = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
        groups = np.bincount(owner, minlength=n)
        links = np.zeros(n, np.int64)
        np.add.at(links, owner, in_a * in_b)
        of, keys, times = linked(a, b, a_group, b_group, owner, self.n_b, self.n_a)
        self._remember(new, np.stack([valid, na, nb, groups, links], axis=1), of, keys, times)
        self.texts += self._written(a, b, a_group, b_group, in_a, in_b, na + nb)

    def _written(self, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, per_unit: np.ndarray) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of every unit; the tokens of a group follow each other, the first kind first."""
        ids, marks = np.zeros(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        a_at = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[a_group]
        b_at = np.arange(len(b)) + np.cumsum(in_a)[b_group]
        ids[a_at], ids[b_at] = a, b
        ends = np.cumsum(in_a + in_b) - 1
        marks[ends] = ord(";")
        marks[ends - in_b] = ord("|")
        text, sizes = self.decimals.write(ids), self.decimals.sizes[ids]
        text[np.cumsum(sizes) - 1] = marks
        whole, stops = text.tobytes(), np.cumsum(_totals(sizes, per_unit)).tolist()
        return [whole[start : max(start, stop - 1)] for start, stop in zip([0, *stops[:-1]], stops, strict=True)]

    def _remember(self, new: list[bytes], facts: np.ndarray, of: np.ndarray, keys: np.ndarray, times: np.ndarray) -> None:
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.facts = np.concatenate([self.facts, facts])
        self.firsts = np.concatenate([self.firsts, self.firsts[-1] + np.cumsum(np.bincount(of, minlength=len(new)))])
        self.keys, self.times = np.concatenate([self.keys, keys]), np.concatenate([self.times, times])

    def align(self, texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Of texts that are not empty: (numbers, groups, links per text, keys, times).

        ``numbers`` has tokens of both kinds, groups and links of each text.
        """
        if len(self.known) > REMEMBERED or len(self.keys) > REMEMBERED_LINKS:
            self.forget()
        units, sizes = self.units(texts)
        index = np.fromiter(map(self.known.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(index < 0)
        if len(missing):
            new = [units[i] for i in missing.tolist()]
            self._learn(list(dict.fromkeys(new)))
            index[missing] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
        facts = self.facts[index]
        valid = _totals(facts[:, 0], sizes) == sizes
        numbers = np.stack([_totals(facts[:, k], sizes) * valid for k in range(1, 5)], axis=1)
        groups, at = [], 0
        order = index.tolist()
        for n, ok in zip(sizes.tolist(), valid.tolist(), strict=True):
            groups.append(b";".join(map(self.texts.__getitem__, order[at : at + n])) if ok else b"")
            at += n
        text = np.repeat(np.arange(len(texts)), sizes)
        used = valid[text]
        index, text = index[used], text[used]
        first, n_links = self.firsts[index], self.firsts[index + 1] - self.firsts[index]
        place = _ranges(first, n_links)
        scale = self.n_a * self.n_b
        found, times = _counted(np.repeat(text * scale, n_links) + self.keys[place], self.times[place])
        return numbers, groups, np.bincount(found // scale, minlength=len(texts)), found % scale, times


@lru_cache(maxsize=2)
def aligner(first: str, second: str) -> Aligner:
    return Aligner(first, second)


def aligned(docs: DataFrame, first: str, second: str, with_groups: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_ids, keys, times) of every row.

    ``keys`` are the different pairs of linked ids, ``a * n_ids + b``; ``times`` says how
    many links are of each.  ``with_groups`` adds ``groups``, their ids in order.
    """
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_ids", "keys", "times"] + ["groups"] * with_groups

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(first, second)
        for batch in batches:
            for at, texts in text_slices(batch.column(1)):
                n = len(texts)
                full = [i for i, t in enumerate(texts) if t]
                numbers, per_text = np.zeros((n, 4), np.int64), np.zeros(n, np.int64)
                groups, keys, times = [b""] * n, np.zeros(0, np.int64), np.zeros(0, np.int64)
                if full:
                    numbers[full], found, per_text[full], keys, times = work.align([texts[i] for i in full])
                    for i, text in zip(full, found, strict=True):
                        groups[i] = text
                bounds = pa.array(np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32))
                columns = [
                    batch.column(0).slice(at, n),
                    *(pa.array(numbers[:, k]) for k in range(4)),
                    pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in groups]),
                    pa.array(np.full(n, work.n_b, np.int64)),
                    pa.ListArray.from_arrays(bounds, pa.array(keys)),
                    pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int32))),
                ]
                yield pa.RecordBatch.from_arrays(columns + [pa.array([g.decode() for g in groups])] * with_groups, names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    layout = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_ids bigint, keys array<bigint>, times array<int>"
    return rows.mapInArrow(run, layout + ", groups string" * with_groups)


def pair_counts(found: DataFrame) -> DataFrame:
    """(key, n, best): how many documents hold a pair of ids linked, and whether no pair of
    its first id is in more.  A first id has as many pairs as there are second ids at most."""
    pairs = found.select("n_ids", F.explode("keys").alias("key"))
    counts = pairs.groupBy("key", "n_ids").agg(F.count("*").alias("n"))
    own = Window.partitionBy(F.expr("key div n_ids"))
    return counts.select("key", "n", (F.col("n") == F.max("n").over(own)).alias("best"))


def alignment(docs: DataFrame, first: str, second: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    found = aligned(docs, first, second).withColumn("row", F.monotonically_increasing_id())
    found = stored(found, "aligned")
    counts = stored(pair_counts(found), "pair-counts")
    total = found.agg(F.sum(F.size("keys"))).first()[0] or 0
    pairs = found.select("row", F.explode(F.arrays_zip("keys", "times")).alias("p"))
    pairs = pairs.select("row", F.col("p.keys").alias("linked"), F.col("p.times").alias("times"))
    # The counts add up to ``total``, so fewer than ``hot_pairs`` of them are larger than this.
    often = total // hot_pairs
    hot, rare = counts.filter(F.col("n") > often), counts.filter(F.col("n") <= often)
    same = F.col("linked") == F.col("key")
    sums = [F.sum(F.expr("CASE WHEN best THEN times ELSE 0 END")).alias("n_best"), F.sum(F.expr("times * n")).alias("count_sum")]
    told = pairs.join(F.broadcast(hot), same, "left")
    by_hot = told.filter("key IS NOT NULL").groupBy("row").agg(*sums)
    by_rare = told.filter("key IS NULL").select("row", "linked", "times").join(rare, same).groupBy("row").agg(*sums)
    both = by_hot.union(by_rare).groupBy(F.col("row").alias("of")).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    narrow = found.drop("keys", "times", "n_ids").join(both, F.col("row") == F.col("of"), "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return narrow.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *numbers, "groups_sha256")
