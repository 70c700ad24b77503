"""Token files and archives: exact round trips."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brute import PATH, brute_ids
from sluicegate.llm import common, packing, warc

PIECES = [*"abzAZ019.,;'!%$ \n\té", "ß", "Σς", "é", "Å", "İ", "<|", "|>", "don't", ", ", ". ", "\xa0", "中", "<|endoftext|>", "\x00"]


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 13, 16, 17, 31, 32])
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 70_001, dtype=np.uint64).astype(np.uint32)
    packed = packing.pack(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    assert np.array_equal(packing.unpack(packed, bits, 0, len(ids)), ids)
    assert np.array_equal(packing.unpack(packed, bits, 66_003, 66_019), ids[66_003:66_019])
    assert packing.bits_for(1 << bits) == bits


def odd_texts(n):
    rng = random.Random(11)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_words_have_the_ids_of_whole_texts():
    some = odd_texts(4000)
    encoder, library = packing.Encoder(PATH), Tokenizer.from_file(PATH)
    ids, sizes = encoder.encode([t.encode() for t in some])
    mine = [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]
    assert mine == [e.ids for e in library.encode_batch(some, add_special_tokens=False)]


def test_letters_with_combining_marks():
    letters = [chr(c) for c in range(33, 0x180)] + ["Ω", "Ж", "ſ", "K", "ẞ", "א"]
    some = [f"{a}{chr(m)}{b}" for a in letters for m in range(0x300, 0x370) for b in ("", "x")]
    some += [f"{a}\u0323{chr(m)} {a.lower()}!" for a in letters for m in range(0x300, 0x310)]
    encoder, library = packing.Encoder(PATH), Tokenizer.from_file(PATH)
    ids, sizes = encoder.encode([t.encode() for t in some])
    mine = [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]
    assert mine == [e.ids for e in library.encode_batch(some, add_special_tokens=False)]


def test_files_hold_all_documents_in_order(spark):
    rows = [(i * 7 - 300, t) for i, t in enumerate(odd_texts(300))] + [(9000, None), (9001, "")]
    mixed_up = random.Random(1).sample(rows, len(rows))
    docs = spark.createDataFrame([(*r, 0) for r in mixed_up], "doc_id long, text string, start int")
    path = common.shared_path(spark, "test-ids")
    packing.write(docs, path, PATH, file_bytes=1000)
    found = packing.read(spark, path)
    assert found.select("file").distinct().count() > 2
    total = found.groupBy("file").sum("n_tokens").orderBy("file").collect()
    before, at = {}, 0
    for name, n in total:
        before[name], at = at, at + n
    mine = sorted((r.doc_id, before[r.file] + r.within, r.n_tokens, r.ids_crc32) for r in found.collect())
    assert mine == brute_ids(rows)
    one = packing.document(spark, path, rows[17][0]).first()
    assert one.ids == [*Tokenizer.from_file(PATH).encode(rows[17][1], add_special_tokens=False).ids, 1]


def test_files_beyond_five_digits_keep_their_order(spark):
    order = ["part-00009-u-c000.txt", "part-99999-u-c000.txt", "part-99999-u-c999.txt", "part-99999-u-c1000.txt"]
    order += ["part-100000-u-c000.txt", "part-100001-c1-2d-c000.txt", "part-1000000-u-c000.txt"]
    rows = [(name, 10 * i + k, 5 * k, 5, 0) for i, name in enumerate(order) for k in range(2)]
    found = packing.placed(spark.createDataFrame(rows, "file string, doc_id long, within long, n_tokens long, ids_crc32 long"))
    starts = {r.doc_id: r.start for r in found.collect()}
    assert starts == {10 * i + k: 10 * i + 5 * k for i in range(len(order)) for k in range(2)}


def test_token_files_are_ordered_by_number(spark, monkeypatch):
    """Part numbers of six digits come after those of five, through the operator itself."""
    rows = [(i, f"text number {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    name = "CASE WHEN doc_id < 10 THEN 'part-99999-u-c000.txt' WHEN doc_id < 25 THEN 'part-100000-u-c000.txt' ELSE 'part-100000-u-c001.txt' END"
    first = "CASE WHEN doc_id < 10 THEN 0 WHEN doc_id < 25 THEN 10 ELSE 25 END"
    sizes = {d: start for d, start, _, _ in brute_ids(rows)}
    read = packing.read

    def renamed(session, path):
        starts = session.createDataFrame(list(sizes.items()), "at long, base long")
        found = read(session, path).withColumns({"file": F.expr(name), "at": F.expr(first)})
        own = found.withColumnRenamed("at", "first_doc").join(starts, F.col("first_doc") == F.col("at"))
        base = session.createDataFrame(list(sizes.items()), "doc_id long, whole long")
        return own.join(base, "doc_id").selectExpr("file", "doc_id", "whole - base AS within", "n_tokens", "ids_crc32")

    monkeypatch.setattr(packing, "read", renamed)
    assert sorted(map(tuple, packing.token_files(docs, PATH).collect())) == brute_ids(rows)


def test_token_files_of_repeated_null_and_no_rows(spark):
    rows = [(None, "x"), (2, "a b"), (2, "a b"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = packing.token_files(docs, PATH).collect()
    assert sorted(map(tuple, found), key=str) == sorted(brute_ids(rows), key=str)
    assert packing.token_files(docs.limit(0), PATH).collect() == []


def pages():
    tricky = "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 9
    return [
        (4, "http://a/", "é" * 60), (2, "http://b/\r\nX: y", "é" * 60), (9, None, "é" * 60), (None, "http://c/", "é" * 60),
        (11, "u", "short"), (12, "u", "short"), (13, "u", None), (14, "u", ""), (20, "u", tricky), (21, "u", tricky),
        (30, "u", "r" * 300), (30, "u", "r" * 300), (31, "u", "r" * 300), (40, "u", "long " * 100_000),
    ]


def test_archives_keep_payloads_once(spark):
    rows = pages()
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    path = common.shared_path(spark, "test-warc")
    found = warc.archived(frame, path).collect()
    first = {}
    for page, _, text in rows:
        if page is not None and len((text or "").encode()) >= 100:
            first[text] = min(page, first.get(text, page))
    wanted = []
    for page, _, text in rows:
        data = (text or "").encode()
        origin = first.get(text)
        again = origin is not None and (page is None or page > origin)
        wanted.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", origin if again else None))
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
    payloads = [(r.page_id, bytes(r.payload).decode()) for r in warc.resolved(spark, path).collect()]
    assert sorted(payloads, key=str) == sorted(((p, t or "") for p, _, t in rows), key=str)
    assert warc.archived(frame.limit(0)).collect() == []


def test_a_cut_archive_is_an_error():
    whole = zlib.compressobj(wbits=31)
    record = b"WARC/1.1\r\nContent-Length: 10\r\n\r\n12345"
    with pytest.raises(ValueError):
        list(warc.parse(whole.compress(record) + whole.flush()))
