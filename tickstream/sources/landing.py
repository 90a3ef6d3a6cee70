"""Landed feed files: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tickstream.schemas import RAW_ARTICLE, RAW_BAR

# Files a micro-batch takes at most, so that a backlog is worked off in steps.
MAX_FILES = 10_000


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_ARTICLE).json(path)


def stream_articles(spark: SparkSession, path: str, max_files: int = MAX_FILES) -> DataFrame:
    return _stream(spark, path, RAW_ARTICLE, max_files)


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_BAR).json(path)


def stream_bars(spark: SparkSession, path: str, max_files: int = MAX_FILES) -> DataFrame:
    return _stream(spark, path, RAW_BAR, max_files)


def _stream(spark: SparkSession, path: str, schema: StructType, max_files: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(path)
