"""Licence notices in documents: a trained paragraph classifier, DataFrame functions only.

A paragraph (a line of a document) is a set of word n-grams.  A sparse multinomial logistic
regression over them tells licence families from paragraphs without a licence, the class
``unknown``.  It is trained on variants of fixed templates and on a bounded sample of the
corpus's own paragraphs; a temperature, fitted on training rows kept apart, calibrates its
probabilities.  A prediction counts as a finding if a template of its family confirms it; a
template that names its family confirms only what names it too.  A paragraph that is a notice
may grant several licences by name, which are all found; denials and notices of licences
that are no family here are ``unknown``.

Scoring is a projection: a document's paragraphs are filtered, scored and compared inside
its own row, so nothing is shuffled.  No template can confirm a paragraph that lacks all of its
marks, its words rarest in the corpus, so a pattern of the marks sorts the others out first.

Null and empty texts have no findings.  Paragraphs are read whole, however long.  Repeated
rows get equal results.  An empty table gives no rows; templates alone are learned from then.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm.common import stored

# The bound of the corpus paragraphs that stand for ``unknown`` in training.
SAMPLE_DOCS = 400
SAMPLE_PARAGRAPHS = 4000
N_GRAMS = 3
# The most frequent n-grams of notices, which the classifier has weights for.
VOCABULARY = 8000
# Calibrated probability from which a family is predicted, and the part of a template's
# words (or of the paragraph's, for a quoted part of a template) that confirms it.
LEAST_PROBABILITY = 0.5
LEAST_TEMPLATE = 0.7
LEAST_WORDS = 3
UNKNOWN = "unknown"
TEMPERATURES = (0.5, 0.7, 0.85, 1.0, 1.2, 1.5, 2.0, 3.0)

# Usual notices of licence families.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is released under the Apache 2.0 license.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
        "Released under the simplified BSD license.",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Released under the GPL version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1 or later.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "Released under the LGPL version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "Released under the AGPL version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "EPL": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "Licensed under the Eclipse Public License 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-ND": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-NC-SA": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-ND": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
    "CC0": (
        "Released under CC0 1.0, dedicated to the public domain.",
        "SPDX-License-Identifier: CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ),
    "all-rights-reserved": (
        "All rights reserved.",
        "Copyright the authors. All rights reserved.",
        "No part of this publication may be reproduced without written permission of the publisher.",
    ),
}
# Sentences near the subject that are no notice.
NO_NOTICE = (
    "He has a driving license and a copy of the book.",
    "The version of the work that the public saw was free.",
    "All the people in general had rights under the law.",
    "Released last year, the software was a success at MIT.",
    "They reserved all the rooms on the right.",
    "Permission was granted to any person in charge.",
    "The creative work of the commons was an attribution of their success.",
    "This is a list of the terms that you may use.",
    "The foundation published a report on general conditions.",
    "The article was published by researchers at MIT in the spring.",
    "The Apache helicopter was released under pressure from the public.",
    "The eclipse was made available to the public on film.",
    "The bar is licensed under the general rules of the city.",
)
# Names of licences that are no family here; a notice of one of them is unknown.
OTHERS = (
    "Sleepycat License",
    "Microsoft Public License",
    "European Union Public Licence 1.2",
    "Artistic License 2.0",
    "Boost Software License 1.0",
    "zlib License",
    "Open Software License 3.0",
    "Common Development and Distribution License",
    "Academic Free License",
    "Open Data Commons Open Database License",
    "SIL Open Font License 1.1",
    "Python Software Foundation License",
    "Business Source License 1.1",
    "Server Side Public License",
    "PostgreSQL License",
)
# How families are named, as patterns on a line of any case.
NAMES = {
    "Apache-2.0": r"\bapache(?:[- ]2|(?: software)? licen[cs]e|,? v(?:ersion|\.)? ?2)",
    "MIT": r"(?-i:\bMIT\b)|\bmit licen[cs]e",
    "BSD": r"(?<!(?:two|2)[- ]clause )(?<!simplified )\bbsd\b(?!-2|[- ]2[- ]clause)",
    "BSD-2-Clause": r"\bbsd[- ]2[- ]clause|\b(?:two|2)[- ]clause bsd|\bsimplified bsd",
    "ISC": r"(?-i:\bISC\b)|\bisc licen[cs]e",
    "GPL": r"(?<!lesser )(?<!library )(?<!affero )\bgeneral public licen[cs]e|\bgpl",
    "LGPL": r"\blgpl|\b(?:lesser|library) general public licen[cs]e",
    "AGPL": r"\bagpl|\baffero general public",
    "MPL-2.0": r"\bmpl\b|\bmozilla public licen[cs]e",
    "EPL": r"\bepl\b|\beclipse public licen[cs]e",
    "Unlicense": r"\bunlicense\b",
    "CC-BY": r"\bcc[- ]by(?![- ](?:sa|nc|nd)\b)\b|\bcommons attribution(?![- ]?(?:share|non|no))",
    "CC-BY-SA": r"\bcc[- ]by[- ]sa\b|\battribution[- ]share",
    "CC-BY-ND": r"\bcc[- ]by[- ]nd\b|\battribution[- ]no-?deriv",
    "CC-BY-NC": r"\bcc[- ]by[- ]nc(?![- ](?:sa|nd)\b)\b|\battribution[- ]non-?commercial(?![- ](?:share|no))",
    "CC-BY-NC-SA": r"\bcc[- ]by[- ]nc[- ]sa\b|\bnon-?commercial[- ]share",
    "CC-BY-NC-ND": r"\bcc[- ]by[- ]nc[- ]nd\b|\bnon-?commercial[- ]no-?deriv",
    "CC0": r"\bcc0\b|\bcommons zero\b",
    "all-rights-reserved": r"\ball rights reserved",
}
# How the names above begin; every line with a name has one of these.
HEADS = (
    r"(?-i:MIT|ISC)\b|mit licen|isc licen|apache|bsd|general public licen|l?gpl|agpl|affero|mpl\b|mozilla public|epl\b|"
    r"eclipse public|unlicense|cc[- ]by|cc0|commons (?:attribution|zero)|attribution[- ](?:share|no)|non-?commercial[- ]|all rights reserved"
)
# Words that grant, before a name; such a clause is a template whose name is a blank.
GRANT = r"(?:\b(?:licen[cs]ed|released|distributed|available|published|provided|covered|dedicated|subject|redistribute|used|shared)\b[^;]{0,60}?\b(?:under|to|by)\b|\bspdx-license-identifier:|\blicen[cs]e:)"
# Denials of a grant.
DENIAL = r"\b(?:not|never|no longer|isn't|aren't|wasn't|neither|nor)\b(?: \w+){0,2} (?:licen[cs]ed|released|distributed|available|published|covered|under)\b"
FAMILIES = (UNKNOWN, *TEMPLATES)


def words(text: Column) -> Column:
    """Words in lower case: letters, digits, and dots, dashes and pluses inside them."""
    clean = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.+-]+|[.+-]+(?=[^\p{L}\p{N}]|$)", " ")
    return F.filter(F.split(clean, " "), lambda w: w != "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def n_grams(tokens: Column) -> Column:
    """The different runs of up to ``N_GRAMS`` words."""

    def runs(own: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(own) - n + 1)
        found = F.transform(starts, lambda i: F.array_join(F.slice(own, i, n), " "))
        return F.when(F.size(own) >= n, found).otherwise(F.expr("CAST(array() AS array<string>)"))

    return _let(tokens, lambda own: F.array_distinct(F.concat(own, *[runs(own, n) for n in range(2, N_GRAMS + 1)])))


def _template_rows(spark: SparkSession) -> DataFrame:
    """(text, family): templates, and each without one of its words."""
    rows = []
    for family, texts in TEMPLATES.items():
        for text in texts:
            parts = text.split()
            rows.append((text, family))
            rows += [(" ".join(parts[:i] + parts[i + 1 :]), family) for i in range(len(parts)) if len(parts) > 3]
    rows += [(text, UNKNOWN) for text in NO_NOTICE]
    for other in OTHERS:
        rows += [(f"{start} the {other}.", UNKNOWN) for start in ("Licensed under", "This work is licensed under", "Released under")]
    return spark.createDataFrame(rows, "text string, family string")


def template_words(spark: SparkSession) -> dict[str, list[list[str]]]:
    """The different words of each template, cut as paragraphs are."""
    flat = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    rows = spark.createDataFrame(flat, "family string, text string")
    out: dict[str, list[list[str]]] = {family: [] for family in TEMPLATES}
    for row in rows.select("family", F.array_distinct(words(F.col("text"))).alias("words")).collect():
        out[row.family].append(row.words)
    return out


def _array(items: list[str]) -> Column:
    return F.array(*[F.lit(i) for i in items])


def _covered(tokens: Column, templates: dict[str, list[list[str]]]) -> Column:
    """The largest part of any template's words that the words have."""
    flat = [own for texts in templates.values() for own in texts]
    return F.greatest(*[F.size(F.array_intersect(tokens, _array(own))) / len(own) for own in flat])


def marked(templates: dict[str, list[list[str]]], paragraphs: DataFrame) -> dict[str, list[tuple[list[str], list[str]]]]:
    """Templates with their marks: the words rarest in paragraphs of the corpus, and just so
    many that no confirming part of a template can do without all of them."""
    known = sorted({w for texts in templates.values() for own in texts for w in own})
    own_words = paragraphs.select(F.explode(F.array_intersect("words", _array(known))).alias("word"))
    seen = {r.word: r["count"] for r in own_words.groupBy("word").count().collect()}
    out: dict[str, list[tuple[list[str], list[str]]]] = {}
    for family, texts in templates.items():
        out[family] = []
        for own in texts:
            rare = sorted(own, key=lambda w: (seen.get(w, 0), -len(w), w))
            out[family].append((own, rare[: len(own) - math.ceil(len(own) * LEAST_TEMPLATE) + 1]))
    return out


def training_rows(docs: DataFrame) -> tuple[DataFrame, dict[str, list[tuple[list[str], list[str]]]]]:
    """Rows (text, family, grams, apart, alone), and the templates with their marks.

    Notices stand alone and inside paragraphs; paragraphs without a notice are ``unknown``.
    """
    spark = docs.sparkSession
    some = docs.select("doc_id", F.col("text").cast("string")).filter("text IS NOT NULL")
    # About SAMPLE_DOCS different rows, chosen by a hash: no sorting, and reruns choose the same.
    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) <= (SAMPLE_DOCS << 30) // max(1, docs.count())
    some = some.filter(chosen).dropDuplicates(["doc_id", "text"])
    lines = some.select(F.explode(F.split("text", "\n")).alias("text")).filter("length(text) > 0")
    lines = lines.distinct().orderBy(F.xxhash64("text"), "text").limit(SAMPLE_PARAGRAPHS)
    lines = stored(lines.withColumn("words", words(F.col("text"))), "paragraphs")
    templates = template_words(spark)
    plain = lines.filter(_covered(F.col("words"), templates) < LEAST_TEMPLATE).select("text", "words")
    notices = _template_rows(spark)
    # A notice is one also where other words stand around it.
    inside = notices.filter(F.col("family") != UNKNOWN).withColumn("nth", F.pmod(F.xxhash64("text"), F.lit(16)))
    around = plain.withColumn("nth", F.pmod(F.xxhash64("text"), F.lit(997))).filter("nth < 16")
    around = around.groupBy("nth").agg(F.min(F.substring("text", 1, 300)).alias("other"))
    inside = inside.join(F.broadcast(around), "nth").select(F.concat_ws(" ", "other", "text").alias("text"), "family")
    rows = notices.withColumn("alone", F.lit(True)).union(inside.withColumn("alone", F.lit(False)))
    rows = rows.union(plain.select("text", F.lit(UNKNOWN).alias("family"), F.lit(True).alias("alone")))
    grams = n_grams(words(F.col("text")))
    part = F.pmod(F.xxhash64(F.lit("part"), "text"), F.lit(5)) == 0
    rows = rows.select("text", "family", grams.alias("grams"), part.alias("apart"), "alone")
    return stored(rows, "training"), marked(templates, plain)


@dataclass
class Model:
    """Per n-gram a weight for each of ``FAMILIES``; ``temperature`` divides the sums.

    ``templates`` has, per family, the words of its templates and the marks among them.
    """

    weights: dict[str, list[float]]
    bias: list[float]
    templates: dict[str, list[tuple[list[str], list[str]]]]
    temperature: float = 1.0

    def sums(self, grams: Column) -> Column:
        """Sums of weights of the n-grams present, one per family."""
        table = F.from_json(F.lit(json.dumps(self.weights)), "map<string,array<double>>")
        known = F.filter(F.transform(grams, lambda g: F.element_at(table, g)), lambda w: w.isNotNull())
        start = F.array(*[F.lit(b) for b in self.bias])
        return F.aggregate(known, start, lambda s, w: F.zip_with(s, w, lambda a, b: a + b))

    def pattern(self) -> str:
        """Matches every paragraph that a template can confirm: each needs one of its marks, or a name."""
        marks = sorted({w for texts in self.templates.values() for _, own in texts for w in own})
        words = "|".join(re.escape(w).replace("\\-", "-") for w in marks)
        return rf"(?i)(?<![\p{{L}}\p{{N}}])(?:{HEADS}|(?:{words})(?![\p{{L}}\p{{N}}]))"


def probabilities(sums: Column, temperature: float) -> Column:
    """Calibrated probabilities from sums of weights."""
    scaled = _let(F.array_max(sums), lambda top: F.transform(sums, lambda s: F.exp((s - top) / F.lit(temperature))))
    return _let(
        scaled,
        lambda e: _let(F.aggregate(e, F.lit(0.0), lambda t, x: t + x), lambda total: F.transform(e, lambda x: x / total)),
    )


def train(docs: DataFrame) -> Model:
    """Weights by elastic-net logistic regression, and the temperature that suits rows kept apart."""
    rows, templates = training_rows(docs)
    # Names of other licences have weights too: they speak against all families.
    other = F.arrays_overlap("grams", n_grams(words(F.lit(" ".join(OTHERS)))))
    template_grams = rows.filter(F.col("alone") & ((F.col("family") != UNKNOWN) | other)).select("grams")
    vocabulary = CountVectorizer(inputCol="grams", outputCol="x", binary=True, minDF=3, vocabSize=VOCABULARY).fit(template_grams)
    label = F.array_position(F.array(*[F.lit(f) for f in FAMILIES]), F.col("family")).cast("double") - 1
    # Families weigh alike, as the number of their templates says nothing.
    sizes = {r.family: r["count"] for r in rows.groupBy("family").count().collect()}
    even = F.lit(sum(sizes.values()) / len(FAMILIES)) / F.element_at(
        F.from_json(F.lit(json.dumps(sizes)), "map<string,double>"), F.col("family")
    )
    data = vocabulary.transform(rows).select("x", label.alias("label"), even.alias("weight"), "apart").cache()
    fitted = LogisticRegression(
        featuresCol="x", weightCol="weight", family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=40,
    ).fit(data.filter("NOT apart").coalesce(2))
    data.unpersist()
    matrix, bias = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    weights = {
        gram: [round(float(matrix[f, i]), 6) for f in range(len(FAMILIES))]
        for i, gram in enumerate(vocabulary.vocabulary)
        if abs(matrix[:, i]).max() > 1e-4
    }
    model = Model(weights, [float(b) for b in bias], templates)
    model.temperature = _temperature(model, rows.filter("apart"))
    return model


def _temperature(model: Model, rows: DataFrame) -> float:
    """The temperature with the least log loss."""
    right = F.array_position(_array(list(FAMILIES)), F.col("family")).cast("int")
    known = stored(rows.select(model.sums(F.col("grams")).alias("sums"), right.alias("right")), "sums")
    losses = [
        F.avg(-F.log(F.greatest(F.lit(1e-9), F.element_at(probabilities(F.col("sums"), t), F.col("right")))))
        for t in TEMPERATURES
    ]
    found = known.agg(*losses).first()
    pairs = [(loss, t) for loss, t in zip(found, TEMPERATURES, strict=True) if loss is not None and not math.isnan(loss)]
    return min(pairs)[1] if pairs else 1.0


def _confirmed(tokens: Column, line: Column, family: Column, templates: dict[str, list[tuple[list[str], list[str]]]]) -> Column:
    """Whether a template of the family is there, or the words are a quoted part of it with a mark.

    A template that names its family confirms only a line that names it too.
    """
    out = F.lit(False)
    own = F.array_distinct(tokens)
    for name, texts in templates.items():
        fits = F.lit(False)
        for (template, marks), text in zip(texts, TEMPLATES[name], strict=True):
            common = F.size(F.array_intersect(own, _array(template)))
            whole = common >= math.ceil(len(template) * LEAST_TEMPLATE)
            quoted = (common >= 2 * LEAST_WORDS) & (common >= F.ceil(F.size(own) * LEAST_TEMPLATE))
            there = whole | (quoted & F.arrays_overlap(own, _array(marks)))
            fits = fits | (there & F.rlike(line, F.lit(f"(?i){NAMES[name]}")) if _names(name, text) else there)
        out = F.when(family == name, fits).otherwise(out)
    return out


def _names(family: str, text: str) -> bool:
    """Whether a template's text names its family."""
    pattern = NAMES.get(family, "(?!)").replace("(?-i:", "(?:")
    # Alternatives of equal length, which Python asks of a look behind.
    pattern = pattern.replace("(?<!(?:two|2)[- ]clause )", "")
    return re.search(pattern, text, re.I) is not None


def _named(line: Column) -> Column:
    """Families that a clause of the line grants by name, in the order of ``NAMES``."""
    said = [
        F.when(F.rlike(line, F.lit(f"(?i){name if family == 'all-rights-reserved' else f'{GRANT}[^;]{{0,120}}?(?:{name})'}")), F.lit(family))
        for family, name in NAMES.items()
    ]
    return F.array_compact(F.array(*said))


def findings(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, licences, n_notices): per document its confirmed notices, in their order.

    ``licences`` is an array of (family, probability, paragraph); paragraphs count from 1.
    """
    pattern = F.lit(model.pattern())
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    lines = F.transform(F.split("text", "\n"), lambda line, i: F.struct((i + 1).alias("paragraph"), line.alias("line")))
    cued = F.filter(lines, lambda p: F.rlike(p["line"], pattern))
    rows = rows.select("doc_id", F.when(F.rlike("text", pattern), cued).alias("cued"))
    tokens = F.transform("cued", lambda p: F.struct(p["paragraph"].alias("paragraph"), p["line"].alias("line"), words(p["line"]).alias("words")))
    rows = rows.select("doc_id", tokens.alias("cued"))
    scored = F.transform(
        "cued",
        lambda p: F.struct(
            p["paragraph"].alias("paragraph"),
            p["line"].alias("line"),
            p["words"].alias("words"),
            _let(model.sums(n_grams(p["words"])), lambda sums: probabilities(sums, model.temperature)).alias("p"),
        ),
    )
    rows = rows.select("doc_id", F.filter(scored, lambda s: (s["p"][0] < 1 - LEAST_PROBABILITY) & ~F.rlike(s["line"], F.lit(f"(?i){DENIAL}"))).alias("cued"))
    families = F.array(*[F.lit(f) for f in FAMILIES])
    named = F.transform(
        "cued",
        lambda s: F.struct(
            F.element_at(families, F.array_position(s["p"], F.array_max(s["p"])).cast("int")).alias("family"),
            F.array_max(s["p"]).alias("probability"),
            (1 - s["p"][0]).alias("notice"),
            s["paragraph"].alias("paragraph"),
            s["line"].alias("line"),
            s["words"].alias("words"),
            _named(s["line"]).alias("named"),
        ),
    )
    rows = rows.select("doc_id", named.alias("cued"))
    found = F.transform(
        "cued",
        lambda s: F.struct(
            s["paragraph"].alias("paragraph"),
            s["notice"].alias("notice"),
            F.when(
                (s["family"] != UNKNOWN) & (s["probability"] >= LEAST_PROBABILITY) & _confirmed(s["words"], s["line"], s["family"], model.templates),
                F.array_union(F.array(s["family"]), s["named"]),
            )
            .otherwise(s["named"])
            .alias("families"),
        ),
    )
    rows = rows.select("doc_id", found.alias("cued"))
    empty = F.expr("CAST(array() AS array<struct<family: string, probability: double, paragraph: int>>)")
    plain = F.flatten(
        F.transform(
            "cued",
            lambda s: F.transform(
                s["families"], lambda f: F.struct(f.alias("family"), s["notice"].alias("probability"), s["paragraph"].alias("paragraph"))
            ),
        )
    )
    rows = rows.select("doc_id", F.coalesce(plain, empty).alias("licences"))
    return rows.select("doc_id", "licences", F.size("licences").cast("long").alias("n_notices"))


def scan(docs: DataFrame) -> DataFrame:
    """Train on the corpus and report every document: (doc_id, families, n_notices, licences)."""
    found = findings(docs, train(docs))
    families = F.array_join(F.array_sort(F.array_distinct(F.col("licences.family"))), ",")
    return found.select("doc_id", families.alias("families"), "n_notices", "licences")
