"""A corpus from raw documents: language, near copies, personal data, mix, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallymill.llm import bpe, language, minhash, mixing, pii
from tallymill.llm.common import table
from tallymill.llm.queries import MIX
from tallymill.session import materialise


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found, by what two thirds of the documents teach."""
    return language.keep_identified(docs, language.learn(language.training_part(docs)))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return minhash.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redact(docs, pii.learn(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents taken to meet the target weights, once for each epoch that takes them."""
    return mixing.select_mix(docs, **MIX).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document's text, with the digest of what they decode to."""
    return bpe.encode_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", known_language),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("tokens", tokens),
]
#: Trained language profiles and selectors and sampled signatures have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
