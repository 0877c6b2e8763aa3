"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm import ann, bpe, chat, fim, html, language, lattice, minhash, mixing, pii, ranking, tokens, trie
from tallymill.llm.common import table

MIX = {"share_percent": 60, "epochs": 2, "weights": {"mix_lang": {"en": 2.0}}, "seed": 17}


def near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.echo_pairs(table(spark, sf_dir, "conversations"))


def near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.learn(language.training_part(docs)))
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digests(docs, pii.learn(docs))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    return tokens.count_tokens(table(spark, sf_dir, "documents"), *paths)


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.select_mix(table(spark, sf_dir, "documents"), **MIX)
    return taken.select(
        "row.doc_id",
        F.col("mix_domain").alias("domain"),
        F.col("mix_lang").alias("lang"),
        F.col("mix_source").alias("source"),
        F.col("mix_epoch").cast("long").alias("epoch"),
        F.col("mix_tokens").alias("n_tokens"),
    )


def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.extract(pages, html.learn(pages))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.grafted(table(spark, sf_dir, "conversations")))


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_near_embeddings": near_embeddings,
    "op2_personal_data": personal_data,
    "op3_nearest_neighbours": nearest_neighbours,
    "op4_language_id": language_id,
    "op5_token_counts": token_counts,
    "op6_bpe_round_trip": bpe_round_trip,
    "op7_preference_pairs": preference_pairs,
    "op8_source_mix": source_mix,
    "op9_main_texts": main_texts,
    "op10_near_documents": near_documents,
    "op11_quality": quality_scores,
    "op12_conversation_trie": conversation_trie,
    "op13_fill_in_middle": fill_in_middle,
}
SQL = {
    "op1_near_embeddings": lattice.SQL,
    "op7_preference_pairs": chat.ECHO_SQL,
    "op8_source_mix": mixing.mix_sql(**MIX),
    "op12_conversation_trie": trie.SQL,
    "op13_fill_in_middle": fim.digest_sql(),
}
