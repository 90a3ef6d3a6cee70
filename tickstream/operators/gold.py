"""Silver to gold: anomaly flags and daily attention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickstream.constants import (
    ANOMALY_THRESHOLD,
    ARTICLES_PER_ATTENTION_POINT,
    ROLLING_BARS,
)
from tickstream.functions.stats import exceeds, stddev_over, zscore
from tickstream.functions.times import stamp
from tickstream.operators.rolling import BY_SIZE, with_rolling
from tickstream.schemas import GOLD_ANOMALY_COLUMNS, GOLD_SENTIMENT_COLUMNS


def rolling_stats(prices: DataFrame, n: int = ROLLING_BARS,
                  split_rows: int | None = BY_SIZE, extra: Sequence[str] = ()) -> DataFrame:
    """Mean and sample deviation of volume and price range over the last ``n`` bars.

    ``extra`` names more columns that stay.
    """
    base = prices.filter(F.col("bar_time_ts").isNotNull()).select(
        "ticker",
        "bar_time_ts",
        F.to_date("bar_time_ts").alias("bar_date"),
        "open", "high", "low", "close", "volume", "price_range", *extra,
    )
    return with_rolling(
        base,
        key="ticker",
        ts="bar_time_ts",
        rows=n,
        stats={
            "avg_volume": lambda w: F.avg("volume").over(w),
            "stddev_volume": lambda w: stddev_over(F.col("volume"), w, n),
            "avg_range": lambda w: F.avg("price_range").over(w),
            "stddev_range": lambda w: F.stddev_samp("price_range").over(w),
        },
        inputs=["volume", "price_range"],
        # Two bars of one instant are put in a fixed order.
        ties=["open", "high", "low", "close", "volume"],
        split_rows=split_rows,
    )


def price_anomaly_flags(prices: DataFrame, n: int = ROLLING_BARS,
                        threshold: float = ANOMALY_THRESHOLD,
                        as_of: Column | None = None,
                        split_rows: int | None = BY_SIZE, extra: Sequence[str] = ()) -> DataFrame:
    """Rolling z-scores per ticker; flagged when either is beyond the threshold.

    The flag looks at the unrounded scores.
    """
    scored = rolling_stats(prices, n, split_rows, extra).withColumns({
        "_zv": zscore(F.col("volume"), F.col("avg_volume"), F.col("stddev_volume")),
        "_zr": zscore(F.col("price_range"), F.col("avg_range"), F.col("stddev_range")),
    })
    return scored.withColumns({
        "volume_zscore": F.round("_zv", 3),
        "range_zscore": F.round("_zr", 3),
        "is_anomaly": exceeds(threshold, F.col("_zv"), F.col("_zr")),
        "gold_processed_at": stamp(as_of),
    }).select(*GOLD_ANOMALY_COLUMNS, *extra)


def day_sources(news: DataFrame) -> DataFrame:
    """Articles per publication day and source, as sums that can be added up later.

    The sources of a day are kept as a set of rows, so days merge exactly.
    """
    return (
        news.filter(F.col("published_at_ts").isNotNull())
        .groupBy(F.to_date("published_at_ts").alias("published_date"), "source_name")
        .agg(F.count("*").alias("articles"), F.max("silver_processed_at").alias("last_updated"))
    )


def merged_sentiment(sources: DataFrame) -> DataFrame:
    """Daily attention from any number of ``day_sources``."""
    return _attention(sources.groupBy("published_date").agg(
        F.sum("articles").alias("article_count"),
        F.count_distinct("source_name").alias("source_diversity"),
        F.max("last_updated").alias("last_updated"),
    ))


def daily_sentiment(news: DataFrame) -> DataFrame:
    """Articles and distinct sources per publication day, with the attention proxy."""
    return _attention(
        news.filter(F.col("published_at_ts").isNotNull())
        .groupBy(F.to_date("published_at_ts").alias("published_date"))
        .agg(
            F.count("*").alias("article_count"),
            F.count_distinct("source_name").alias("source_diversity"),
            F.max("silver_processed_at").alias("last_updated"),
        )
    )


def _attention(days: DataFrame) -> DataFrame:
    return days.withColumn(
        "attention_score_proxy",
        F.round(
            F.col("article_count").cast("decimal(20,0)")
            / F.lit(ARTICLES_PER_ATTENTION_POINT).cast("decimal(3,1)"),
            2,
        ).cast("decimal(24,2)"),
    ).select(*GOLD_SENTIMENT_COLUMNS)
