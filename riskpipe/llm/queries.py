"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskpipe.llm import (
    byte_bpe,
    collocations,
    fingerprints,
    hard_negatives,
    html_text,
    line_dedup,
    near_dedup,
    packing,
    pii,
    pu_quality,
    quality_rules,
    toxicity,
    word_table,
)
from riskpipe.llm.shared import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rule_report(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(packing.TOKENIZER)
    return packing.pack(table(spark, sf_dir, "documents"), path)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.visible_text(table(spark, sf_dir, "pages"))


def op5_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(byte_bpe.RANKS)
    return byte_bpe.token_digests(table(spark, sf_dir, "documents"), path)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_report(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op11_word_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(word_table.TOKENIZER)
    return word_table.token_digests(table(spark, sf_dir, "documents"), path)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.from_embeddings(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_packing": op2_packing,
    "op3_toxicity": op3_toxicity,
    "op4_html_text": op4_html_text,
    "op5_pu_quality": op5_pu_quality,
    "op6_line_dedup": op6_line_dedup,
    "op7_near_dedup": op7_near_dedup,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_fingerprints": op9_fingerprints,
    "op10_pii": op10_pii,
    "op11_word_table": op11_word_table,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}
