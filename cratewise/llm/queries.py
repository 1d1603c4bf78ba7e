"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cratewise.llm import (
    alignment,
    bpe,
    classifier,
    fingerprints,
    jaccard,
    language,
    licenses,
    mixing,
    ppm,
    quality,
    spelling,
    token_output,
    toxicity,
)
from cratewise.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER, PIECE_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    description = bpe.read_description(public_tokenizers.path(TOKENIZER))
    return token_output.token_output(table(spark, sf_dir, "documents"), description, end_id=2)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_report(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    description = bpe.read_description(public_tokenizers.path(TOKENIZER))
    return bpe.bpe_digests(table(spark, sf_dir, "documents"), description)


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op9_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.lm_scores(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    description = bpe.read_description(public_tokenizers.path(BYTE_TOKENIZER))
    model = Path(public_tokenizers.path(PIECE_TOKENIZER)).read_bytes()
    return alignment.alignment_report(table(spark, sf_dir, "documents"), description, model)


def op12_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_token_blocks": op1_token_blocks,
    "op2_fingerprints": op2_fingerprints,
    "op3_mixing": op3_mixing,
    "op4_toxicity": op4_toxicity,
    "op5_language": op5_language,
    "op6_bpe": op6_bpe,
    "op7_jaccard": op7_jaccard,
    "op8_licenses": op8_licenses,
    "op9_ppm": op9_ppm,
    "op10_quality": op10_quality,
    "op11_alignment": op11_alignment,
    "op12_classifier": op12_classifier,
    "op13_spelling": op13_spelling,
}

ORACLE_SQL: dict[str, str] = {
    "op8_licenses": licenses.license_sql(),
}
