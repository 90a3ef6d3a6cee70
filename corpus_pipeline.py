"""The corpus pipeline: documents to a mixed, deduplicated, tokenised training set.

Each stage works on all that its predecessor kept. Stages read and write Parquet in the
cluster's shared folder, so a lost executor costs no finished stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickstream.llm import bpe, language, mixing, ngram_join, suffix_dedup
from tickstream.llm.frames import keep, session_of, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the classifier knows; those it rejects go."""
    return language.keep_identified(docs)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return ngram_join.keep_one_of_group(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes that begin twice are removed, and passages of 51 words that two
    documents have; emptied documents go."""
    return suffix_dedup.cut_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, shuffled; one corpus long."""
    return mixing.mix(docs, copy=None)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, and whether decoding gives the text back."""
    return bpe.encode_stage(docs)


STAGES = [
    ("language", identify_language),
    ("near_copies", join_near_copies),
    ("repeats", cut_repeats),
    ("mixing", mix_sources),
    ("tokens", encode),
]

# Classifier, suffix arrays and byte-pair merges have no SQL form; tests compare the
# stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    session_of(docs)
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
