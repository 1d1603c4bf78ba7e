"""A training-data pipeline over ``documents``: five stages, each stored before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cratewise.llm import bpe, jaccard, mixing, quality, toxicity
from cratewise.llm.common import table
from cratewise.llm.queries import TOKENIZER
from cratewise.sources.stage import Stage

StageFunction = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that the rules reject go."""
    return quality.quality_filter(docs, table(spark, sf_dir, "labels"))


def toxic_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that are predicted toxic go."""
    return toxicity.toxicity_filter(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: one document of each group of near copies stays."""
    return jaccard.jaccard_filter(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: every document as often as the mix takes it."""
    return mixing.mix_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: ids of every remaining text, and digests of ids and decoded text."""
    return bpe.bpe_digests(docs, bpe.read_description(public_tokenizers.path(TOKENIZER)))


STAGES: list[tuple[str, StageFunction]] = [
    ("quality_rules", quality_rules),
    ("toxic_passages", toxic_passages),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

# SQL can express neither the learned stages nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    stage = Stage(spark)
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage.save(name, function(spark, docs, sf_dir))
    return docs
