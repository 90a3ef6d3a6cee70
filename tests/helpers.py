from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UTC = dt.timezone.utc


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


def utc(value: dt.datetime | None) -> str | None:
    """A collected timestamp as UTC text, whatever the machine's zone is."""
    return None if value is None else value.astimezone(UTC).strftime("%Y-%m-%d %H:%M:%S.%f")


def now() -> Column:
    """The processing time of the tests."""
    return F.lit(ts("2026-04-24T12:00:00"))


def column(df: DataFrame, name: str) -> list:
    return [row[name] for row in df.select(name).collect()]


def scalar(spark: SparkSession, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def price_rows(spark: SparkSession, volumes, ticker="A", ranges=None, start=0) -> DataFrame:
    """Silver-like hourly bars with the given volumes."""
    ranges = ranges or [1.0] * len(volumes)
    rows = [(ticker, start + i, 10.0, 10.0 + r, 10.0, 10.0, v, r)
            for i, (v, r) in enumerate(zip(volumes, ranges, strict=True))]
    return spark.createDataFrame(
        rows,
        "ticker string, h bigint, open double, high double, low double, close double, "
        "volume bigint, price_range double",
    ).withColumn("bar_time_ts", F.timestamp_seconds(F.col("h") * 3600)).drop("h")


BRONZE_NEWS = (
    "ingested_at string, source_name string, author string, title string, "
    "description string, url string, published_at string, content string, "
    "kafka_timestamp timestamp, kafka_partition int, kafka_offset bigint, "
    "spark_written_at timestamp"
)
BRONZE_PRICES = (
    "ingested_at string, ticker string, bar_time string, open double, high double, "
    "low double, close double, volume bigint, kafka_timestamp timestamp, "
    "kafka_partition int, kafka_offset bigint, spark_written_at timestamp"
)


def bronze_news(spark: SparkSession, *rows: dict) -> DataFrame:
    base = {
        "ingested_at": "2026-04-24T04:00:00.123456+00:00", "source_name": "s", "author": "a",
        "title": "t", "description": "d", "url": "u", "published_at": "2026-04-24T03:45:55Z",
        "content": "c", "kafka_timestamp": ts("2026-04-24T04:00:00"), "kafka_partition": 0,
        "kafka_offset": 0, "spark_written_at": ts("2026-04-24T05:00:00"),
    }
    return spark.createDataFrame([tuple((base | r).values()) for r in rows], BRONZE_NEWS)


def bronze_prices(spark: SparkSession, *rows: dict) -> DataFrame:
    base = {
        "ingested_at": "2026-04-24T04:00:00.123456+00:00", "ticker": "A",
        "bar_time": "2026-04-24T03:00:00Z", "open": 1.0, "high": 3.0, "low": 0.5, "close": 2.0,
        "volume": 10, "kafka_timestamp": ts("2026-04-24T04:00:00"), "kafka_partition": 0,
        "kafka_offset": 0, "spark_written_at": ts("2026-04-24T05:00:00"),
    }
    return spark.createDataFrame([tuple((base | r).values()) for r in rows], BRONZE_PRICES)
