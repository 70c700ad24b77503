"""The registered queries of the thirteen operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm import alignment, decontaminate, exact_dedup, fill_in_middle, html_text, licenses, minhash, mixing, packing, pseudonyms, simhash, toxicity, warc
from sluicegate.llm.common import table

TOKENIZER = "word_bpe_49k.json"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")
# For the registered query alone; whoever runs the operator brings a key of their own.
PSEUDONYM_KEY = b"key of the registered query"


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "families", "n_notices")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.with_next(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digests(found)


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudonyms.pseudonyms(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)
    return found.select("doc_id", "text", "n_private", F.to_json("spans").alias("spans"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.newest_first(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"), *map(public_tokenizers.path, ALIGNED))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_main_text": op1_main_text,
    "op2_mixing": op2_mixing,
    "op3_simhash": op3_simhash,
    "op4_licenses": op4_licenses,
    "op5_minhash": op5_minhash,
    "op6_token_files": op6_token_files,
    "op7_warc": op7_warc,
    "op8_decontamination": op8_decontamination,
    "op9_pseudonyms": op9_pseudonyms,
    "op10_toxicity": op10_toxicity,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE: dict[str, str] = {
    "op2_mixing": mixing.ORACLE,
    "op7_warc": warc.ORACLE,
    "op11_exact_dedup": exact_dedup.ORACLE,
    "op12_fill_in_middle": fill_in_middle.ORACLE,
}
