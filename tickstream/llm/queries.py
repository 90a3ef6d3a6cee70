"""Registered queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tickstream.llm import (
    bpe, chat, embed_dedup, language, line_dedup, merkle, mixing, ngram_join, quality, suffix_dedup,
    toxicity, url_filter, vector_codes,
)
from tickstream.llm.frames import session_of, table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_report(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_report(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_report(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    session_of(docs)
    return mixing.mix(docs)


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_report(spark, table(spark, sf_dir, "conversations"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_report(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.link_vectors(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_report(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_url_filter, op3_bpe, op4_mixing, op5_chat, op6_ngram_join, op7_quality,
    op8_embedding_dedup, op9_toxicity, op10_language, op11_line_dedup,
    op12_merkle, op13_vector_codes)} | {"pipeline": corpus_pipeline.run}

ORACLE = {
    "op2_url_filter": url_filter.URL_SQL,
    "op4_mixing": mixing.MIX_SQL,
    "op5_chat": chat.CHAT_SQL,
    "op6_ngram_join": ngram_join.JACCARD_SQL,
    "op11_line_dedup": line_dedup.LINE_SQL,
    "op12_merkle": merkle.MERKLE_SQL,
    "op13_vector_codes": vector_codes.CODE_SQL,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
