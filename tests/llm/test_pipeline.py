"""The pipeline, stage by stage, and its registration."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

import __spark_entry__
from brute import brute_ids
from sluicegate.llm import decontaminate, mixing, queries, simhash, toxicity
from sluicegate.llm.common import stored, table


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert names.keys() >= {"pipeline"} and names.keys() >= queries.QUERIES.keys()
    assert [s for s, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_dedup", "decontamination", "mixing", "token_files"]


def test_stages_keep_what_the_operators_say(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    labels, benchmark = table(spark, sf_small, "labels"), table(spark, sf_small, "benchmark")
    rows = docs
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        rows = stored(stage(spark, rows, sf_small), f"test-{name}")
        kept.append(rows)
    clean = {r.doc_id for r in toxicity.toxicity(docs, labels).filter("predicted = 0").collect()}
    assert sorted(r.doc_id for r in kept[0].collect()) == sorted(clean)
    groups = simhash.near_duplicates(kept[0]).select("component_id").distinct().collect()
    assert sorted(r.doc_id for r in kept[1].collect()) == sorted(r.component_id for r in groups)
    bad = {r.doc_id for r in decontaminate.overlaps(kept[1], benchmark).filter("contaminated").collect()}
    assert sorted(r.doc_id for r in kept[2].collect()) == sorted({r.doc_id for r in kept[1].collect()} - bad)
    copies = {r.doc_id: r.copies for r in mixing.mix(kept[2]).collect()}
    times = {r.doc_id: r["count"] for r in kept[3].groupBy("doc_id").count().collect()}
    assert times == {d: n for d, n in copies.items() if n}
    assert all(frame.columns == docs.columns for frame in kept[:4])
    ordered = [(r.doc_id, r.text) for r in kept[3].orderBy("doc_id").collect()]
    found = sorted(tuple(r) for r in kept[4].collect())
    assert found == sorted(brute_ids(ordered))
    assert kept[4].agg(F.sum("n_tokens")).first()[0] == sum(n for _, _, n, _ in found)


def test_stages_of_an_empty_table(spark, sf_small):
    rows = table(spark, sf_small, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        rows = stored(stage(spark, rows, sf_small), f"empty-{name}")
        assert rows.count() == 0


def test_the_tokenizer_is_there():
    assert public_tokenizers.path(queries.TOKENIZER)
