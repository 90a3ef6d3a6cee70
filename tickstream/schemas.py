"""Table contracts as Spark schemas. Every column is nullable."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT = StringType()
REAL = DoubleType()
WHOLE = LongType()


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


NEWS_PAYLOAD = _schema(
    ingested_at=TEXT, source_name=TEXT, author=TEXT, title=TEXT,
    description=TEXT, url=TEXT, published_at=TEXT, content=TEXT,
)

PRICE_PAYLOAD = _schema(
    ingested_at=TEXT, ticker=TEXT, bar_time=TEXT,
    open=REAL, high=REAL, low=REAL, close=REAL, volume=WHOLE,
)

ENVELOPE = _schema(
    key=BinaryType(), value=BinaryType(), topic=TEXT, partition=IntegerType(),
    offset=WHOLE, timestamp=TimestampType(), timestampType=IntegerType(),
)

# One article as the feed delivers it. ``position`` is its place in the feed.
RAW_ARTICLE = _schema(
    source=_schema(name=TEXT), author=TEXT, title=TEXT, description=TEXT,
    url=TEXT, publishedAt=TEXT, content=TEXT,
    category=TEXT, language=TEXT, position=WHOLE,
)

RAW_BAR = _schema(
    ticker=TEXT, bar_time_ts=TimestampType(),
    # Feeds spell volumes with or without a fraction.
    open=REAL, high=REAL, low=REAL, close=REAL, volume=REAL,
)

VECTORS = _schema(
    vec_id=WHOLE, embedding=ArrayType(FloatType()), title=TEXT, url=TEXT,
    source_name=TEXT, published_at=TEXT, text=TEXT,
)

GOLD_ANOMALY_COLUMNS = (
    "ticker", "bar_time_ts", "bar_date", "open", "high", "low", "close", "volume",
    "price_range", "volume_zscore", "range_zscore", "is_anomaly", "gold_processed_at",
)

GOLD_SENTIMENT_COLUMNS = (
    "published_date", "article_count", "source_diversity",
    "attention_score_proxy", "last_updated",
)
