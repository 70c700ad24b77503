"""Exact duplicates, fill-in-middle texts and aligned tokens."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from functools import lru_cache

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluicegate.llm import alignment, common, exact_dedup, fill_in_middle
from sluicegate.llm.common import table
from sluicegate.llm.queries import ALIGNED


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def frame(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    columns = "doc_id long, text string, row int, digest string, keep_id long, form string, output string, keys int, Batch string"
    return spark.createDataFrame([(*r, 1, "d", 2, "f", "o", 3, "b") for r in rows], columns)


def dedup_rows():
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", "c d", "", None, f"own {i}", "hot", "hot"])) for i in range(300)]
    return rows + [(7, rows[7][1]), (7, rows[7][1]), (7, "other"), (None, "hot"), (None, "lone"), (None, "lone"), (400, "long " * 200_000), (401, "long " * 200_000), (-3, "a ")]


def brute_decisions(rows):
    groups, left = {}, Counter()
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    out = []
    for d, t in rows:
        ids = groups[t or ""]
        keep = max((i for i in ids if i is not None), default=None)
        kept = d == keep and not left[t or ""]
        left[t or ""] += kept
        out.append((d, keep, len(ids), kept, sha(t)))
    return sorted(out, key=str)


def test_digests_decide_across_batches(spark):
    rows = dedup_rows()
    docs = frame(spark, rows)
    found = exact_dedup.newest_first(docs, buckets=5)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_decisions(rows)
    assert exact_dedup.newest_first(docs.limit(0), buckets=2).collect() == []
    nobody = frame(spark, [(None, "x"), (None, "x"), (None, None)])
    assert sorted((r.group_size, r.kept) for r in exact_dedup.newest_first(nobody, buckets=2).collect()) == [(1, True), (2, False), (2, True)]


def test_an_index_outlives_its_session(spark):
    path = common.shared_path(spark, "test-index")
    rows = dedup_rows()
    first = exact_dedup.DigestIndex(spark, path, 4)
    kept = exact_dedup.deduplicated(frame(spark, rows), first, "monday")
    assert kept.columns == frame(spark, rows).columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id is not None) == sorted((d, t) for d, t, *_ in {(d, t) for (d, _, _, k, s) in brute_decisions(rows) if k for d2, t in rows if d2 == d and sha(t) == s and d is not None})
    spark.sql(f"DROP TABLE {first.table}")
    again = exact_dedup.DigestIndex(spark, path, 9)
    assert again.buckets == 4 and again.entries().count() == len({t or "" for _, t in rows})
    # The same batch once more changes nothing; a later one keeps what is new.
    before = sorted(map(tuple, again.entries().collect()))
    exact_dedup.decided(frame(spark, rows), again, "monday").collect()
    assert sorted(map(tuple, again.entries().collect())) == before
    later = [(900, "hot"), (901, "fresh"), (902, "fresh"), (None, None)]
    found = {r.doc_id: (r.keep_id, r.kept, r.group_size) for r in exact_dedup.decided(frame(spark, later), again, "tuesday").collect()}
    hot = [d for d, t in rows if t == "hot"]
    assert found[900] == (max(d for d in hot if d is not None), False, len(hot) + 1)
    assert found[901] == (902, False, 2) and found[902] == (902, True, 2)
    assert not found[None][1]
    small = again.compacted(common.shared_path(spark, "test-compact"))
    assert sorted(map(tuple, small.entries().collect())) == sorted(map(tuple, again.entries().collect()))
    plan = small.entries().join(again.entries().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan


def test_hot_groups_are_joined_apart(spark, monkeypatch):
    rows = [(i, "hot" if i % 3 else f"pair {i // 6}") for i in range(600)]
    monkeypatch.setattr(exact_dedup, "HOT_GROUPS", 10)
    assert sorted(map(tuple, exact_dedup.newest_first(frame(spark, rows), buckets=3).collect()), key=str) == brute_decisions(rows)


def fim_rows():
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice(["a", "é", "中", "😀", "<", "P>", "<S", "S>", "M", " ", "\n", "\x00"]) for _ in range(rng.randrange(40)))) for i in range(500)]
    return rows + [(1000, None), (1001, ""), (1002, "x<P>y"), (1003, "<M>"), (None, "null id"), (5, rows[5][1]), (-8, "minus"), (2000, "länge " * 300_000), (2001, "<" * 50)]


def brute_output(doc_id, text):
    text = text or ""
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(text)
    p, q = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b, c = text[:p], text[p:q], text[q:]
    if h[3] % 100 < 20:
        return n, "spm", p, q - p, f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", p, q - p, f"<P>{a}<S>{c}<M>{b}"


def test_outputs_and_the_way_back(spark):
    rows = fim_rows()
    docs = frame(spark, rows)
    found = fill_in_middle.fill_in_middle(docs)
    wanted = sorted(((d, *brute_output(d, t)) for d, t in rows), key=str)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found.collect()), key=str) == wanted
    assert {r.form for r in found.select("form").collect()} == {"plain", "psm", "spm"}
    back = fill_in_middle.restored(found.withColumn("text", F.lit("gone")))
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=str) == sorted(((d, t or "") for d, t in rows), key=str)
    digests = fill_in_middle.digests(docs).collect()
    assert sorted(((r.doc_id, r.output_sha256, r.restored_sha256) for r in digests), key=str) == sorted(((d, sha(brute_output(d, t)[-1]), sha(t)) for d, t in rows), key=str)
    for r in found.filter("doc_id < 20").collect():
        text, marks = (dict(rows)[r.doc_id] or "").encode(), fill_in_middle.SENTINELS
        assert "".join((text, marks)[p.buffer][p.start : p.start + p.length].decode() for p in r.pieces) == r.output
    assert fill_in_middle.digests(docs.limit(0)).collect() == []
    other = fill_in_middle.fill_in_middle(docs, fill_in_middle.Draw("2:", 100, 100)).select("form").distinct().collect()
    assert {r.form for r in other} == {"plain", "spm"}


def test_outputs_agree_with_their_sql(spark):
    rows = [r for r in fim_rows() if "\x00" not in (r[1] or "")]
    own = duckdb.connect()
    documents = frame(spark, rows).select("doc_id", "text").toArrow()
    own.register("documents", documents)
    wanted = sorted(map(tuple, own.sql(fill_in_middle.ORACLE).fetchall()), key=str)
    assert sorted(map(tuple, fill_in_middle.digests(frame(spark, rows)).collect()), key=str) == wanted


def test_tables_are_split_and_picked():
    whole = fill_in_middle.PieceTable.of(b"abcdef")
    cut = whole.split(0, 2).split(1, 0)
    assert cut.text() == b"abcdef" and len(cut.pieces) == 3 and len(whole.pieces) == 1
    assert cut.picked([2, 0]).text() == b"cdefab" and cut.picked([2, 0]).sha256() == sha("cdefab")
    with pytest.raises(ValueError):
        whole.split(0, 7)
    with pytest.raises(ValueError):
        fill_in_middle.rebuilt(b"<P>a<S>b", "psm")


PATHS = [public_tokenizers.path(p) for p in ALIGNED]


@lru_cache(maxsize=1)
def libraries():
    first = Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=PATHS[1]), {c: i for i, c in enumerate(alignment.byte_characters())}


def whole_tokens(text):
    """Both tokenizers over the whole text, and the bytes of their tokens."""
    first, second, shown = libraries()
    a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    a_bytes = [bytes(shown[c] for c in first.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
    spelled = (" " + text).encode()
    return (a, b, a_bytes, b_bytes) if text and b"".join(a_bytes) == b"".join(b_bytes) == spelled else ([], [], [], [])


def brute_groups(text):
    a, b, a_bytes, b_bytes = whole_tokens(text or "")
    ends = [np.cumsum([len(x) for x in some], dtype=int).tolist() for some in (a_bytes, b_bytes)]
    groups, i, j = [], 0, 0
    at = [{end: k + 1 for k, end in enumerate(some)} for some in ends]
    for end in sorted(at[0].keys() & at[1].keys()):
        x, y = at[0][end], at[1][end]
        groups.append((a[i:x], b[j:y]))
        i, j = x, y
    return groups


def brute_alignment(rows):
    groups = [brute_groups(t) for _, t in rows]
    links = [[(x, y) for a, b in some for x in a for y in b] for some in groups]
    counts = Counter(pair for some in links for pair in set(some))
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(n, best.get(x, 0))
    out = []
    for (d, _), some, pairs in zip(rows, groups, links, strict=True):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in some)
        out.append((d, sum(len(a) for a, _ in some), sum(len(b) for _, b in some), len(some), len(pairs), sum(counts[p] == best[p[0]] for p in pairs), sum(counts[p] for p in pairs), sha(text) if text else ""))
    return sorted(out, key=str)


PARTS = ["the", "Token", "ization", "zażółć", "中文字", "日本", "😀", "é", "é", "ﬁ", "123", "4567", " ", "  ", "   ", "\n", "\n\n ", "\t", "\xa0", "　", " ", "​", "\x85", " ", " ",
         "'s", "'ll", "don't", "—", "”", "...", "!", "<|endoftext|>", "<s>", "<0x41>", "▁", "\x00", "\x7f", "ß", "़", "x" * 40, "http://a.b/c?d=e", "Ω", "नमस्ते", "안녕"]


def odd_texts(n, seed=8):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(1, 25))) for _ in range(n)]


def test_units_have_the_groups_of_whole_texts():
    some = [t for t in odd_texts(1500) if t]
    work = alignment.Aligner(*PATHS)
    assert work.cuts
    numbers, groups, _, _, _ = work.align([t.encode() for t in some])
    for text, found, mine in zip(some, groups, numbers.tolist(), strict=True):
        wanted = brute_groups(text)
        assert found.decode() == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in wanted), repr(text)
        assert mine[2] == len(wanted)
    work.cuts = False
    work.forget()
    again = work.align([t.encode() for t in some])
    assert again[1] == groups and np.array_equal(again[0], numbers)


@pytest.mark.parametrize("seed", range(5))
def test_pointers_end_at_the_last_token_of_a_component(seed):
    rng = np.random.default_rng(seed)
    n = 3000
    both = [np.append(np.sort(rng.choice(np.arange(1, n), rng.integers(1, n // 2), replace=False)), n) for _ in range(2)]
    a, b = alignment.terminals(*both)
    common_ends = np.intersect1d(*both)
    assert np.array_equal(a, np.searchsorted(common_ends, both[0])) and np.array_equal(b, np.searchsorted(common_ends, both[1]))
    # No common end but the last: one chain through all tokens.
    a, b = alignment.terminals(np.append(np.arange(2, n, 2), n), np.append(np.arange(3, n, 2), n))
    assert not a.any() and not b.any()


def test_wide_groups_are_counted(monkeypatch):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 5, 60), rng.integers(0, 7, 50)
    a_group, b_group = np.sort(np.append(rng.integers(0, 3, 57), [0, 1, 2])), np.sort(np.append(rng.integers(0, 3, 47), [0, 1, 2]))
    owner = np.array([0, 0, 1])
    wanted = Counter((owner[g], x * 7 + y) for x, g in zip(a, a_group, strict=True) for y, h in zip(b, b_group, strict=True) if g == h)
    for wide, chunk in ((1 << 16, 1 << 22), (100, 1 << 22), (1 << 16, 7)):
        monkeypatch.setattr(alignment, "WIDE_GROUP", wide)
        monkeypatch.setattr(alignment, "_CHUNK", chunk)
        of, keys, times = alignment.linked(a, b, a_group, b_group, owner, 7, 5)
        assert dict(zip(zip(of.tolist(), keys.tolist(), strict=True), times.tolist(), strict=True)) == wanted


@pytest.mark.parametrize("hot_pairs", [4, 1 << 18])
def test_alignment_of_documents(spark, hot_pairs):
    texts = odd_texts(120, 9) + ["the Token the Token", "中" * 3000, "word " * 20_000, " " * 500, "0" * 700, "aAbB" * 300]
    rows = [(i * 3 - 50, t) for i, t in enumerate(texts)] + [(9000, None), (9001, ""), (None, "the Token"), (1, "x"), (1, "x")]
    found = alignment.alignment(frame(spark, rows), *PATHS, hot_pairs=hot_pairs)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_alignment(rows)
    assert alignment.alignment(frame(spark, rows).limit(0), *PATHS).collect() == []


def test_alignment_of_the_smallest_documents(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, alignment.alignment(docs, *PATHS).collect()), key=str) == brute_alignment(rows)
    whole = alignment.aligned(docs, *PATHS, with_groups=True).select("groups", "groups_sha256").collect()
    assert all(r.groups_sha256 == (sha(r.groups) if r.groups else "") for r in whole)
