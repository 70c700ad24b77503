"""Words, fingerprints, decontamination and MinHash against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from sluicegate.llm import common, decontaminate, minhash, simhash
from sluicegate.llm.components import components

PIECES = ["a", "B", "é", "ß", "x1", ".", ",", " ", "  ", "\n", "\t", "-", "the", "Idiot", "\x0b", "\xa0", "中", "0", "q"]


def texts(n, seed=0, size=40):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, size))) for _ in range(n)]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


PATTERNS = {"visible": r"[^\x20\x09-\x0D]+", "alnum": r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"}


@pytest.mark.parametrize("kind", PATTERNS)
def test_words_are_those_of_the_pattern(kind):
    some = texts(300) + ["", " ", "x"]
    words = common.Words([t.encode() for t in some], kind)
    data = words.data.tobytes()
    for i, text in enumerate(some):
        mine = [data[words.starts[j] : words.ends[j]].decode() for j in range(words.bounds[i], words.bounds[i + 1])]
        assert mine == re.findall(PATTERNS[kind], lowered(text))


def test_word_hashes_tell_words_apart():
    some = texts(500, seed=4)
    words = common.Words([t.encode() for t in some], "visible")
    data, hashes = words.data.tobytes(), words.hashes()
    spelled = [data[s:e] for s, e in zip(words.starts, words.ends, strict=True)]
    assert len({*hashes.tolist()}) == len({*spelled})
    assert len({*zip(spelled, hashes.tolist(), strict=True)}) == len({*spelled})


def brute_fingerprint(text):
    words = re.findall(PATTERNS["visible"], lowered(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    some = texts(200, seed=1)
    assert simhash.fingerprints([t.encode() for t in some]).tolist() == [brute_fingerprint(t) for t in some]


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
    for _ in range(3):
        base = np.concatenate([base, base[: n // 4] ^ (np.uint64(1) << rng.integers(0, 64, n // 4).astype(np.uint64))])
    return np.unique(base)


@pytest.mark.parametrize("shard_rows", [16, 200, 10**6])
def test_shards_find_every_link(shard_rows):
    values = clustered(800, 3)
    tree = simhash.grow(values[::2], len(values), shard_rows)
    shard, index, asks = simhash.place(tree, values, 3)
    assert np.array_equal(np.sort(index[~asks]), np.arange(len(values)))
    mine = simhash._Forest(len(values))
    for s in range(shard.max() + 1):
        here = shard == s
        u, v = simhash.link(values[index[here & ~asks]], values[index[here & asks]])
        mine.join(np.searchsorted(values, u), np.searchsorted(values, v))
    a, b = simhash._near(values, values, 3)
    true = simhash._Forest(len(values))
    true.join(a, b)
    assert np.array_equal(mine.label, true.label)


def brute_components(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= 3 and label[j] > label[i]:
                    label[j], changed = label[i], True
    ids = [min((rows[j][0] for j in range(len(rows)) if label[j] == at and rows[j][0] is not None), default=None) for at in label]
    return sorted(zip([r[0] for r in rows], [f"{p:016x}" for p in prints], ids, strict=True), key=str)


def near_rows():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    rows, base = [], [" ".join(rng.choice(words) for _ in range(150)) for _ in range(12)]
    for i in range(60):
        parts = base[i % 12].split()
        parts[rng.randrange(len(parts))] = rng.choice(words)
        rows.append((i * 3 + 1, " ".join(parts)))
    return rows + [(None, None), (None, ""), (7, " "), (500, rows[0][1]), (500, rows[0][1]), (None, rows[3][1])]


def test_near_duplicates(spark):
    rows = near_rows()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fp string, _root int")
    found = simhash.near_duplicates(docs, shard_rows=8).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, found), key=str) == brute_components(rows)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for d, _, c in brute_components(rows) if d is not None})
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
    assert simhash.deduplicated(docs.limit(0)).collect() == []


def test_components_of_a_long_path_and_a_hub(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, j) for j in range(6, 60)] + [(70, 70)]
    found = components(spark.createDataFrame(links, "u long, v long"))
    roots = {r.node: r.root for r in found.collect()}
    assert roots == {i: 100 for i in range(101, 161)} | {j: 5 for j in range(6, 60)}


def brute_overlaps(docs, items):
    windows = {}
    for item, text in items:
        words = re.findall(PATTERNS["alnum"], lowered(text or ""))
        n = min(13, len(words))
        for i in range(len(words) - n + 1 if words else 0):
            windows.setdefault(n, {}).setdefault(tuple(words[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        words = re.findall(PATTERNS["alnum"], lowered(text or ""))
        hit, found = [False] * len(words), set()
        for n, there in windows.items():
            for i in range(len(words) - n + 1):
                if items_here := there.get(tuple(words[i : i + n])):
                    found |= items_here
                    hit[i : i + n] = [True] * n
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), sum(hit), len(found), digest, sum(hit) > 0 and 20 * sum(hit) >= len(words)))
    return sorted(out, key=str)


def overlap_rows(seed=2):
    rng = random.Random(seed)
    words = ["a", "b", "c", "d", "é1"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 5, 12, 13, 14, 40])))) for i in range(30)]
    docs = [(i, ", ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    for i in range(60, 90):
        item = rng.choice(items)[1].split()
        cut = rng.randint(0, len(item))
        docs.append((i, " ".join([*"xyz", *item[cut : cut + 20], *"zyx" * rng.randint(0, 30)])))
    return docs + [(None, None), (90, ""), (1, docs[1][1]), (91, items[-1][1].upper())], items + [(99, None), (4, items[4][1])]


def test_overlaps(spark):
    docs, items = overlap_rows()
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, fp int, item int")
    benchmark = spark.createDataFrame([(*i, "n") for i in items], "item_id long, text string, n string")
    found = decontaminate.digests(decontaminate.overlaps(frame, benchmark)).collect()
    assert sorted(map(tuple, found), key=str) == brute_overlaps(docs, items)
    none = decontaminate.overlaps(frame, benchmark.limit(0))
    assert none.filter("n_hit > 0 OR contaminated").count() == 0 and none.count() == len(docs)
    assert decontaminate.overlaps(frame.limit(0), benchmark).collect() == []
    kept = decontaminate.decontaminated(frame, benchmark)
    bad = {d[0] for d in brute_overlaps(docs, items) if d[-1]}
    assert kept.columns == frame.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(d[0]) for d in docs if d[0] not in bad)


@pytest.mark.parametrize("seed", range(3))
def test_winnowing_keeps_a_gram_of_every_window(seed):
    fps = np.random.default_rng(seed).integers(0, 30, 200, dtype=np.uint64)
    kept = decontaminate.winnowed(fps, 9)
    for i in range(len(fps) - 8):
        window = fps[i : i + 9]
        assert kept[i : i + 9][window == window.min()].all()


def test_documents_against_the_benchmark_table(spark, sf_small):
    docs, items = common.table(spark, sf_small, "documents"), common.table(spark, sf_small, "benchmark")
    found = decontaminate.digests(decontaminate.overlaps(docs, items)).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]
    assert sorted(map(tuple, found), key=str) == brute_overlaps(*rows)


def test_edited_texts(spark):
    rows = [(i, t) for i, t in enumerate(texts(80, seed=6, size=300))] + [(200, None), (201, ""), (40, "same id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash.with_next(docs, run_bytes=2000).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: -r[0])
    assert len(found) == len(rows)
    for row in found:
        wanted = set()
        for at, (doc, text) in enumerate(order):
            after = [order[(at + 1) % len(order)], order[(at + 2) % len(order)], order[at - 1]]  # ties stand either way
            for following in after:
                changed = minhash.edited(text, following[1])
                wanted |= {(doc, len(text), hashlib.sha256(changed.encode()).hexdigest())}
        assert (row.doc_id, row.n_chars, row.edited_sha256) in wanted
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    assert minhash.with_next(docs.limit(0)).collect() == []
    single = minhash.with_next(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert single.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and single.near_next == 1.0


def test_likeness_estimates_jaccard():
    rng = random.Random(5)
    errors = []
    for _ in range(60):
        words = [f"w{rng.randrange(400)}" for _ in range(400)]
        other = [w if rng.random() < 0.95 else "z" for w in words]
        sets = [{tuple(t[i : i + 5]) for i in range(396)} for t in (words, other)]
        prints = minhash.fingerprints([" ".join(t).encode() for t in (words, other)])
        errors.append(minhash.likeness(prints[:1], prints[1:])[0] - len(sets[0] & sets[1]) / len(sets[0] | sets[1]))
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.1


def brute_classes(rows, like=0.8):
    def shingles(text):
        words = re.findall(PATTERNS["visible"], lowered(text or ""))
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, j in itertools.permutations(range(len(rows)), 2):
            alike = sets[i] == sets[j] or len(sets[i] & sets[j]) >= like * len(sets[i] | sets[j])
            if alike and label[i] < label[j]:
                label[j], changed = label[i], True
    return sorted((d, min(rows[k][0] for k in range(len(rows)) if label[k] == at)) for (d, _), at in zip(rows, label, strict=True))


def test_near_copies_are_verified_and_none_is_lost(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(500)]
    rows, at = [], 0
    for _ in range(8):
        base = [rng.choice(words) for _ in range(120)]
        for changes in (0, 0, 1, 1, 2, 3, 6, 10):
            copy = list(base)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((at := at + 3, " ".join(copy)))
    rows += [(1, ""), (2, None), (500, " "), (501, "one"), (502, "One"), (700, rows[0][1])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, bucket int")
    found = sorted(tuple(r) for r in minhash.near_copies(docs).collect())
    wanted = brute_classes(rows)
    # Bands find alike sets with near certainty, and verified links are never wrong.
    same = sum(f == w for f, w in zip(found, wanted, strict=True))
    assert same >= len(rows) - 2 and all(c in {w for w, _ in wanted} for _, c in found)
    assert minhash.near_copies(docs.limit(0)).collect() == []
