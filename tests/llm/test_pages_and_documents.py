"""Main text, mixing, toxicity, licences and pseudonyms."""

from __future__ import annotations

import itertools
import os
import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from sluicegate.llm import html_text, licenses, mixing, pseudonyms, toxicity
from sluicegate.llm.common import table

KEY = b"test"


def text_of(page):
    return [t for t, _ in html_text.candidate_lines(page)]


@pytest.mark.parametrize(
    ("page", "lines"),
    [
        (None, []),
        ("", []),
        ("plain  words\n here", ["plain words here"]),
        ("<article><h1>T &amp; U</h1><p>One<br>two&nbsp;three<p>Four</article><footer>f</footer>", ["T & U", "One two three", "Four"]),
        ("<nav>menu</nav><main><p>A</p><aside>no</aside><p>B</p></main><div>after</div>", ["A", "B"]),
        ("<article><header><h1>H</h1></header><p>x</p><section class='reader-comments'><p>me</p></section></article>", ["H", "x"]),
        ("<body><div class=ad>buy</div><p>text</p><div id='cookieNotice'>ok?</div><form>f</form></body>", ["text"]),
        ("<script>var t='</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes</p>", ["yes"]),
        ("<ul><li><a href=x>One</a></li></ul><p>See <a href=y>this</a> now</p>", ["See this now"]),
        ("<nav><li>never closed<article><p>body</p></article>", ["body"]),
        ("<p>a &lt; b &#233; &eacute; 1 < 2</p>", ["a < b é é 1 < 2"]),
        ("<p title='a > b'>quoted</p><p unclosed='>x</p>", ["quoted", "x"]),
        ("<p>" * 3000 + "deep" + "</p>" * 3000, ["deep"]),
        ("<div class='layout with-sidebar'><p>Main story text.</p></div>", ["Main story text."]),
        ("<article class='post related-topic'><p>Main story text.</p></article>", ["Main story text."]),
        ("<div id='search-results'><p>Main story text.</p></div>", ["Main story text."]),
        ("<div class='content menu-open'><p>Main story text.</p></div>", ["Main story text."]),
        ("<div class='sidebar'><p>Main story text.</p></div>", ["Main story text."]),
        ("<div class='widget'><h1>T</h1><p>Main story text.</p></div><p>More.</p>", ["T", "Main story text.", "More."]),
        ("<article><div class='social-science'><p>On social science.</p></div><p>End of it.</p></article>", ["On social science.", "End of it."]),
        ("<article><div class='notice'><p>Nearly all of the story is here.</p></div><p>End.</p></article>", ["Nearly all of the story is here.", "End."]),
        ("<article><p>A long story of some words.</p><p class='notice'>Please note</p></article>", ["A long story of some words."]),
        ("<div class='ad'>Buy very many things here and now</div><article><p>Short.</p></article>", ["Short."]),
        ("<article><p>Short.</p><div id='comments'><p>I do not agree at all with this</p></div></article>", ["Short."]),
        ("<p>One two three four five six</p><ul class='related-posts'><li><a>Other things</a> now</ul>", ["One two three four five six"]),
        ("<div class=ad>never closed<main><p>body</p></main>", ["body"]),
        ("<div class='share-buttons'>Tell <span>all</span></div><p>the text of it</p>", ["the text of it"]),
    ],
)
def test_lines_of_a_page(page, lines):
    assert text_of(page) == lines


def brute_common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(14))] for _ in range(2))
        at = html_text.shared(a, b)
        assert at == sorted(set(at)) and len(at) == brute_common(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in at)


def test_alignment_of_large_and_of_equal_lines(monkeypatch):
    begin = time.monotonic()
    assert len(html_text.shared([1] * 20_000, [2] + [1] * 19_000 + [3])) == 19_000
    rng = random.Random(1)
    a, b = ([rng.randrange(2) for _ in range(20_000)] for _ in range(2))
    n = len(html_text.shared(a, b))
    assert time.monotonic() - begin < 20
    monkeypatch.setattr(html_text, "TABLE_BITS", 1 << 22)
    assert len(html_text.shared(a, b)) == n
    for bits in (1, 20, 100):
        monkeypatch.setattr(html_text, "TABLE_BITS", bits)
        for _ in range(100):
            a, b = ([rng.randrange(4) for _ in range(rng.randrange(14))] for _ in range(2))
            at = html_text.shared(a, b)
            assert at == sorted(set(at)) and len(at) == brute_common(a, b)
            rest = iter(b)
            assert all(a[i] in rest for i in at)


def test_pages_lose_what_their_neighbour_has(spark):
    frame = "<div>Our site</div>{}<div>Imprint and more</div>"
    rows = [(i, f"http://h{i % 2}/a/{i:02}?q={i}", frame.format(f"<p>Text {i} of many words</p><p>End {i}.</p>")) for i in range(20)]
    rows += [(50, "http://h0/a/98", "<article><p>same words</p></article>"), (51, "http://h0/a/99", "<article><p>same words</p></article>")]
    rows += [(60, None, None), (61, "http://alone/", "<p>only</p>"), (2, rows[2][1], rows[2][2])]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    for run_pages in (4, 2000):
        found = html_text.main_text(pages, run_pages).collect()
        texts = {r.page_id: r.text for r in found}
        assert len(found) == len(rows)
        assert texts[50] == texts[51] == "same words" and texts[60] == "" and texts[61] == "only"
        if run_pages == 2000:
            assert all(texts[i] == f"Text {i} of many words\nEnd {i}." for i in range(20))
        assert all(r.n_chars == len(r.text) for r in found)
    assert html_text.main_text(pages.limit(0)).collect() == []


def test_differencing_decides_outside_the_article(spark):
    page = "<div>Top {}</div><article><p>Story {} has many words of its own</p><p>Same passage</p></article><div>Our house and its rules</div><div>Own note {}</div>"
    rows = [(i, f"http://h/{i}", page.format("story", i, i)) for i in range(6)] + [(9, "http://alone/", page.format("x", 9, 9))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in html_text.main_text(pages).collect()}
    assert texts == {i: f"Story {i} has many words of its own\nSame passage\nOwn note {i}" for i in range(6)} | {9: "Story 9 has many words of its own\nSame passage"}


def test_furniture_goes_beside_copies_and_across_runs(spark):
    frame = "<div>A long line of furniture that every page of this site has</div>{}<div>Imprint and more of it</div>"
    rows = [(i, f"http://short/{i:02}", frame.format(f"<p>Text {i}</p>")) for i in range(12)]
    story = "<p>One story told at length, many words</p><p>and its second half, many more words</p><p>and its end, also of many words indeed</p>"
    rows += [(100 + i, f"http://copies/a?copy={i}", frame.format(story)) for i in range(9)]
    rows += [(200 + i, f"http://near/a{i}", frame.format(story + f"<p>Read {i} times</p>")) for i in range(9)]
    rows += [(300 + i, f"http://{h}/b", frame.format("<p>Quite another text of some length, in all its words</p>")) for i, h in enumerate(("copies", "near"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    told = "One story told at length, many words\nand its second half, many more words\nand its end, also of many words indeed"
    wanted = {i: f"Text {i}" for i in range(12)} | {100 + i: told for i in range(9)}
    wanted |= {200 + i: f"{told}\nRead {i} times" for i in range(9)}
    wanted |= {300 + i: "Quite another text of some length, in all its words" for i in range(2)}
    for run_pages in (1, 2, 3, 5, 2000):
        assert {r.page_id: r.text for r in html_text.main_text(pages, run_pages).collect()} == wanted, run_pages


def mixed_rows():
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a", "b", "c", "d", None, "a", "a"])) for i in range(400)]
    return rows + [(1000, "big " * 5000, "e"), (1001, None, "f"), (None, "no id here", "a"), (5, rows[5][1], rows[5][2])]


def test_mix_agrees_with_its_sql(spark):
    docs = spark.createDataFrame([(*r, 1.0, 2) for r in mixed_rows()], "doc_id long, text string, source string, key double, size int")
    found = mixing.mix(docs)
    own = duckdb.connect()
    documents = docs.select("doc_id", "text", "source").toArrow()  # noqa: F841
    own.register("documents", documents)
    wanted = [tuple(r) for r in own.sql(mixing.ORACLE).fetchall()]
    rows = [tuple(r) for r in found.select("doc_id", "size", "source_size", "target", "taken", "source", "copies").collect()]
    assert sorted(rows, key=str) == sorted(wanted, key=str)
    total = sum(r[1] for r in rows)
    targets = {r[5]: (r[3], r[2]) for r in rows}
    assert all(t <= 2 * s for t, s in targets.values())
    assert sum(t for t, _ in targets.values()) == pytest.approx(1.5 * total)
    assert all(r[4] <= 2 * r[1] for r in rows)
    kept = mixing.mixed_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r[6] for r in rows)
    assert mixing.mix(docs.limit(0)).collect() == [] and mixing.mixed_documents(docs.limit(0)).collect() == []


def test_heavier_documents_come_first(spark):
    rows = [(i, "w " * 10, "s") for i in range(2000)] + [(10_000 + i, "w " * 10, "t") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weight = F.when(F.col("doc_id") % 2 == 0, F.lit(1.0)).otherwise(F.lit(0.2))
    taken = mixing.mix(docs, weight).filter("source = 't'").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("taken").alias("n"))
    n = {r.odd: r.n for r in taken.collect()}
    assert n[0] > 1.2 * n[1]


def test_clauses_are_read_in_their_context():
    reader = toxicity.Reader(toxicity.Model())
    kinds = {
        "You are an idiot.": "insult targeted",
        "You are not an idiot.": "insult targeted negated",
        "She said you are an idiot": "insult targeted reported",
        "I will kill you": "threat",
        "You I will kill": "threat targeted",
        "idiotic idioms": None,
        "a fine day": None,
        "": None,
    }
    for text, kind in kinds.items():
        assert list(reader.kinds(text)) == ([kind] if kind else []), text
    assert sum(reader.kinds("idiot. " * 50_000).values()) == 50_000
    model = toxicity.Model()
    scores = [toxicity.score(model, reader.kinds(t)) for t in ("You idiot. You moron.", "You are not an idiot.", "fine")]
    assert scores[0] > 0.5 > scores[1] >= scores[2]


@pytest.mark.parametrize("gap", [10, 1990, 1991, 1992, 1993, 1994, 1995, 1996, 2000, 5000, 30_000])
def test_clauses_are_read_whole(gap):
    reader, far = toxicity.Reader(toxicity.Model()), ("word " * gap)[:gap] + " "
    assert reader.kinds(f"The paper said {far}idiot {far}scum.") == {"insult reported": 1}
    assert reader.kinds(f"idiot {far}scum. Moron {far}end") == {"insult": 2}


def test_stems_become_words_or_stems():
    counts = [("idio", 50), ("idiot", 50), ("=idiot", 49), ("lowe", 40), ("lowei", 40), ("loweis", 12), ("=loweis", 12)]
    assert toxicity.insult_class(counts) == (frozenset({"idiot"}), ("lowei",))


def toxic_rows():
    rng = random.Random(2)
    plain = ["".join(rng.choice("abcdeno") for _ in range(6)) for _ in range(300)]
    rows = []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(60)]
        bad = i % 3 == 0
        if bad:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(["grubnik", "zorfelix", "Zorfelon", "zorfelar"])
        rows.append((i, " ".join(words) + ".", int(bad)))
    return rows


def test_toxicity_is_learned_from_labels_that_are_not_held_out(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(None, None, "x"), (9999, "", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, toxic) for i, _, toxic in rows], "doc_id long, toxic int")
    truth = {i: toxic for i, _, toxic in rows}
    found = toxicity.toxicity(docs, labels).collect()
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(found) == 602 and len(held) > 60
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert {r.predicted for r in found if r.doc_id in (None, 9999)} == {0}
    flipped = labels.withColumn("toxic", F.when(toxicity.is_held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.toxicity(docs, flipped).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in found)
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []
    assert toxicity.toxicity(docs, labels.limit(0)).count() == 602


def test_toxicity_of_held_out_documents(spark, sf_medium):
    docs, labels = table(spark, sf_medium, "documents"), table(spark, sf_medium, "labels")
    found = toxicity.toxicity(docs, labels).join(labels, "doc_id").filter("held_out").select("predicted", "toxic").collect()
    assert sum(r.predicted == r.toxic for r in found) >= 0.9 * len(found)


def test_toxic_documents_of_the_held_out_ones(spark, sf_medium):
    large = os.path.join(os.path.dirname(sf_medium), "sf0.1")
    docs, labels = table(spark, large, "documents"), table(spark, large, "labels")
    found = toxicity.toxicity(docs, labels).join(labels, "doc_id").filter("held_out").select("predicted", "toxic").collect()
    right = sum(r.predicted == r.toxic == 1 for r in found)
    assert right >= 0.8 * sum(r.toxic for r in found) > 0
    assert right >= 0.9 * sum(r.predicted for r in found)


NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "GPL": "licensed under the GNU General Public License, version 3",
    "MIT": "Released under the MIT License",
    "CC-BY-NC": "Licensed under CC BY-NC 4.0",
    "all-rights-reserved": "All rights reserved",
}


def test_licences_of_documents(spark, sf_small):
    docs = table(spark, sf_small, "documents").select("doc_id", "text").withColumn("families", F.lit("x"))
    more = [
        (10_001, "Chapter one.\nSPDX-License-Identifier: MIT\nThe end."),
        (10_002, "He passed the driving test and got his license under the old rules."),
        (10_003, None),
        (10_004, ""),
        (10_005, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal"),
        (10_006, "words " * 50_000 + "\nAll rights reserved."),
        (10_006, "words " * 50_000 + "\nAll rights reserved."),
    ]
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string").withColumn("families", F.lit("x")))
    model = licenses.train(docs)
    found = licenses.findings(docs, model).collect()
    got = [(r.doc_id, sorted(x.family for x in r.licences)) for r in found]
    rows = {r.doc_id: r.text for r in docs.collect()}
    for doc, families in got:
        if doc < 10_000:
            lines = (rows[doc] or "").split("\n")
            assert families == sorted(f for line in lines for f, notice in NOTICES.items() if notice in line), doc
    extra = {d: f for d, f in got if d > 10_000}
    assert extra == {10_001: ["MIT"], 10_002: [], 10_003: [], 10_004: [], 10_005: ["MIT"], 10_006: ["all-rights-reserved"]}
    assert len(found) == docs.count()
    assert licenses.findings(docs.limit(0), model).collect() == []


# Paragraphs that are no templates, with the families they grant.
LABELLED = [
    ("This library is distributed under the terms of the GNU Lesser General Public License v2.1.", "LGPL"),
    ("Our server is licensed under the GNU Affero General Public License version 3 or later.", "AGPL"),
    ("The plugin is made available under the terms of the Eclipse Public License 2.0.", "EPL"),
    ("SPDX-License-Identifier: AGPL-3.0-or-later", "AGPL"),
    ("SPDX-License-Identifier: GPL-2.0-only", "GPL"),
    ("SPDX-License-Identifier: LGPL-3.0-only", "LGPL"),
    ("SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause"),
    ("SPDX-License-Identifier: ISC", "ISC"),
    ("SPDX-License-Identifier: Apache-2.0 OR MIT", "Apache-2.0,MIT"),
    ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", "Apache-2.0,MIT"),
    ("This project is licensed under the BSD 2-Clause License.", "BSD-2-Clause"),
    ("Released under the ISC License by its author.", "ISC"),
    ("All text on this page is licensed under CC BY-ND 4.0.", "CC-BY-ND"),
    ("Photos are licensed under CC BY-NC-SA 4.0 unless noted.", "CC-BY-NC-SA"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "CC-BY-NC-ND"),
    ("This article is licensed under a Creative Commons Attribution-ShareAlike 3.0 License.", "CC-BY-SA"),
    ("The data set is licensed under CC BY 4.0.", "CC-BY"),
    ("You can redistribute it under the terms of the GNU General Public License, version 2.", "GPL"),
    ("The code of this site is released under the MIT license, see the file.", "MIT"),
    ("This file is subject to the terms of the Mozilla Public License, v. 2.0.", "MPL-2.0"),
    ("Licensed under the BSD 3-Clause License (see below).", "BSD"),
    ("Copyright 2019 by the publisher. All rights reserved.", "all-rights-reserved"),
    ("The figures are released under CC0 1.0 and dedicated to the public domain.", "CC0"),
    ("This tool is released under the Unlicense.", "Unlicense"),
    ("This software is not licensed under the MIT license.", ""),
    ("The code is no longer released under the Apache License, Version 2.0.", ""),
    ("Licensed under the Sleepycat License.", ""),
    ("This work is licensed under the Boost Software License, version 1.0.", ""),
    ("Licensed under the Common Public Attribution License 1.0.", ""),
    ("This work is licensed under the Open Government Licence version 3.", ""),
    ("Released under the Microsoft Reciprocal License.", ""),
    ("She studied at MIT and published a book on general licensing.", ""),
    ("The Apache helicopter was seen by the public.", ""),
    ("Er fuhr mit dem Zug und kam mit Freunden wieder.", ""),
    ("The driver was licensed by the city of Boston.", ""),
    ("A total eclipse was made available to the public under a clear sky.", ""),
]


def test_licences_of_labelled_paragraphs(spark, sf_small):
    docs = table(spark, sf_small, "documents").select("doc_id", "text")
    frame = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(LABELLED)], "doc_id long, text string")
    found = {r.doc_id: {x.family for x in r.licences} for r in licenses.findings(frame, licenses.train(docs)).collect()}
    wanted = {i: set(filter(None, families.split(","))) for i, (_, families) in enumerate(LABELLED)}
    right = sum(len(found[i] & wanted[i]) for i in wanted)
    wrong = {LABELLED[i][0]: (found[i], wanted[i]) for i in wanted if found[i] != wanted[i]}
    assert right >= 0.9 * sum(map(len, wanted.values())), wrong
    assert right >= 0.9 * sum(map(len, found.values())), wrong
    assert len(wrong) <= 3, wrong


def test_licences_are_scanned_without_python(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    scan = licenses.findings(docs, licenses.Model({"mit license": [0.0] * len(licenses.FAMILIES)}, [0.0] * len(licenses.FAMILIES), {}))
    for plan in (scan, mixing.keyed(docs)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text and "Exchange" not in text


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000, 4097])
def test_permutations(size):
    p = pseudonyms.Permutation(KEY, "x", size)
    out = [p.forth(x) for x in range(size)]
    assert sorted(out) == list(range(size)) and [p.back(y) for y in out] == list(range(size))


VALUES = {
    "mail": ["bosbt.42@mail8.example.com", "A.b+c@x.org"],
    "phone": ["+1 (988) 555-2485", "(626) 555-5759", "415-555-2671"],
    "card": ["4944339490429605", "4111-1111-1111-1111", "3782 822463 10005"],
    "ip": ["70.123.182.155", "8.8.4.4"],
    "date": ["1980-02-29", "31.12.1999", "12/31/1999", "2020/01/05"],
    "ssn": ["123-45-6789"],
    "iban": ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"],
    "abroad": ["+49 30 1234567"],
}


@pytest.mark.parametrize(("kind", "value"), [(k, v) for k, vs in VALUES.items() for v in vs])
def test_values_keep_their_format_and_check(kind, value):
    text = f"before {value}, after {value}."
    new, spans = pseudonyms.pseudonymised(text, KEY)
    assert [k for k, _, _ in spans] == [kind, kind] and [text[s:e] for _, s, e in spans] == [value, value]
    assert value not in new and len(new) == len(text)
    first, second = new[7 : 7 + len(value)], new[-1 - len(value) : -1]
    assert first == second
    assert [("0" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c) for c in first] == [
        ("0" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c) for c in value
    ]
    again, found = pseudonyms.pseudonymised(new, KEY, back=True)
    assert again == text and [k for k, _, _ in found] == [kind, kind]
    assert pseudonyms.pseudonymised(text, b"other")[0] != new


@pytest.mark.parametrize("after", [" BIC", " 42", " BIC CAIXESBB", " USE 12 ABCD", " DE89 3704 0044 0532 0130 00", " AB12@x.org", " or so", ""])
@pytest.mark.parametrize("value", ["ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "NO93 8601 1117 947"])
def test_account_numbers_end_before_other_words(value, after):
    new, spans = pseudonyms.pseudonymised(f"to {value}{after}", KEY)
    assert spans[0] == ("iban", 3, 3 + len(value)) and value not in new
    assert len(spans) == 1 + after.startswith((" DE", " AB"))
    assert pseudonyms.pseudonymised(new, KEY, back=True)[0] == f"to {value}{after}"


def test_long_mail_names_are_replaced_whole():
    name = "anna.maria" * 20
    text = f"mail {name}@example.com now"
    new, spans = pseudonyms.pseudonymised(text, KEY)
    assert spans == [("mail", 5, 5 + len(name) + len("@example.com"))]
    assert "anna" not in new and "maria" not in new
    assert pseudonyms.pseudonymised(new, KEY, back=True)[0] == text


@pytest.mark.parametrize(
    "text", ["", "4944339490429606", "999.1.1.1", "2021-13-45", "1.2.3.4.5", "a@b", "123-00-6789", "version 1.2", "1234", "DE88 3704 0044 0532 0130 00"]
)
def test_what_fails_its_check_stays(text):
    assert pseudonyms.pseudonymised(text, KEY) == (text, [])


def test_addresses_do_not_overlap():
    rng = random.Random(9)
    some = ["a@b.com@c.com", "x@y.org@z.org@w.net", "@@a@b.co", "a@b.c-d@e.com", "1@2.com@3.com"]
    some += ["".join(rng.choice(["a", "B", "7", ".", "@", "@", "-", "_", "x.com", "y.org", "@z.net", " ", "555-2671", "415-"]) for _ in range(rng.randrange(2, 30))) for _ in range(3000)]
    for text in some:
        new, spans = pseudonyms.pseudonymised(text, KEY)
        assert len(new) == len(text)
        assert all(e <= s for (_, _, e), (_, s, _) in itertools.pairwise(spans))
        again, back = pseudonyms.pseudonymised(new, KEY, back=True)
        assert again == text and back == spans, text
    assert [s for s in pseudonyms.pseudonymised("a@b.com@c.com", KEY)[1]] == [("mail", 0, 7)]


def test_pseudonyms_of_documents(spark):
    rows = [(1, "call (626) 555-5759 now"), (2, None), (3, ""), (None, "(626) 555-5759"), (4, "x " * 200_000 + "70.123.182.155"), (4, "a")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, spans int")
    found = pseudonyms.pseudonyms(docs, KEY).collect()
    assert sorted((str(r.doc_id), r.n_private) for r in found) == [("1", 1), ("2", 0), ("3", 0), ("4", 0), ("4", 1), ("None", 1)]
    texts = {str(r.doc_id): r.text for r in found if r.n_private}
    assert texts["1"][5:19] == texts["None"] and {r.text for r in found if r.doc_id in (2, 3)} == {None, ""}
    assert pseudonyms.pseudonyms(docs.limit(0), KEY).collect() == []
    with pytest.raises(ValueError):
        pseudonyms.pseudonyms(docs, b"")
