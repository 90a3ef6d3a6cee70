"""Contract tables derived from the test tables.

Every adapter uses all rows and whole texts. Gaps, repeats and odd spellings come
from what the rows contain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickstream.constants import NEWS_TOPIC, PRICES_TOPIC, REMOVED_TITLE
from tickstream.functions.times import iso_string
from tickstream.operators.envelope import news_key, price_key, to_messages
from tickstream.schemas import NEWS_PAYLOAD, PRICE_PAYLOAD

EVENT_TICKERS = ("click", "error", "purchase", "signup", "view")
NEWS_START = "2024-01-01 00:00:00"
ARRIVAL_START = "2024-04-01 00:00:00"
CYCLE_TIME = "2024-01-03 12:00:00"
PHRASES = ("the and", "that of")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def instant(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def hourly_bars(events: DataFrame) -> DataFrame:
    """Event types as tickers, hourly bars of the event values."""
    ts = F.col("ts").cast("timestamp")
    hour = F.date_trunc("hour", ts)
    # Microsecond of the hour, then event id, in one number: events of the same
    # microsecond keep a fixed order, and the aggregate a fixed-width buffer.
    micros = (F.unix_micros(ts) - F.unix_micros(hour)).cast("decimal(38,0)")
    turn = (micros * F.lit("100000000000000000000").cast("decimal(21,0)") + F.col("event_id")).cast("decimal(38,0)")
    return (
        events.groupBy(F.col("event_type").alias("ticker"), hour.alias("bar_time_ts"))
        .agg(
            F.min_by("value", turn).alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", turn).alias("close"),
            F.count("*").alias("volume"),
        )
        .withColumn("price_range", F.col("high") - F.col("low"))
    )


def part_bars(lineitem: DataFrame) -> DataFrame:
    """Parts as tickers, daily bars of the unit price, quantity as volume."""
    price = F.try_divide("l_extendedprice", "l_quantity")
    line = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return (
        lineitem.groupBy("l_partkey", "l_shipdate")
        .agg(
            F.min_by(price, line).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, line).alias("close"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
        )
        .select(
            F.concat(F.lit("P"), F.col("l_partkey")).alias("ticker"),
            F.col("l_shipdate").cast("timestamp").alias("bar_time_ts"),
            "open", "high", "low", "close", "volume",
            (F.col("high") - F.col("low")).alias("price_range"),
        )
    )


def bronze_prices(bars: DataFrame) -> DataFrame:
    """Every bar as two or three polls saw it.

    Poll 1 comes too early: one trade is missing, and a bar of a single trade has
    no close yet. Poll 2 sees the full bar. Poll 3 sends busy bars again, their
    time spelled with another offset.
    """
    hour = F.col("bar_time_ts")
    polls = F.array(F.lit(1), F.lit(2), F.when(F.col("volume") >= 4, F.lit(3)))
    polled = bars.withColumn("poll", F.explode(F.array_compact(polls)))
    utc = F.date_format(hour, "yyyy-MM-dd'T'HH:mm:ss")
    cet = F.date_format(hour + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss")
    arrival = hour + F.make_interval(hours=F.col("poll"))
    early = F.col("poll") == 1
    return polled.select(
        iso_string(arrival, micros=True).alias("ingested_at"),
        "ticker",
        F.when(F.col("poll") == 3, F.concat(cet, F.lit("+01:00")))
        .otherwise(F.concat(utc, F.lit("Z"))).alias("bar_time"),
        "open", "high", "low",
        F.when(~early | (F.col("volume") > 1), F.col("close")).alias("close"),
        (F.col("volume") - F.when(early, 1).otherwise(0)).alias("volume"),
        arrival.alias("kafka_timestamp"),
        F.col("poll").cast("int").alias("kafka_partition"),
        F.floor(F.unix_seconds(hour) / 3600).cast("bigint").alias("kafka_offset"),
    )


def _articles(documents: DataFrame, *extra: str) -> DataFrame:
    one_line = ~F.contains("text", F.lit("\n"))
    over_three_lines = F.substring_index("text", "\n", 3) != F.col("text")
    desk = F.substring_index("source", "src", -1).cast("int")
    minutes = F.col("n_chars").cast("int")
    published = instant(NEWS_START) + F.make_interval(mins=minutes)
    arrival = instant(ARRIVAL_START) + F.make_interval(mins=minutes + desk)
    clock = "yyyy-MM-dd'T'HH:mm:ss"
    return documents.select(
        iso_string(arrival, micros=True).alias("ingested_at"),
        F.when(F.col("source") != "src0", F.col("source")).alias("source_name"),
        F.concat("lang", F.lit(" desk")).alias("author"),
        F.when(F.col("n_chars") < 40, F.lit(REMOVED_TITLE))
        .when(~one_line | (F.col("n_chars") < 400), F.substring_index("text", "\n", 1))
        .alias("title"),
        F.nullif(F.split_part("text", F.lit("\n"), F.lit(2)), F.lit("")).alias("description"),
        F.when((F.col("source") != "src2") | ~one_line,
               F.concat(F.lit("https://news.example/"), F.md5("text"))).alias("url"),
        F.when(one_line, F.lit("n/a"))
        .when(F.col("lang") == "de",
              F.concat(F.date_format(published + F.expr("INTERVAL 1 HOUR"), clock),
                       F.lit("+01:00")))
        .when(F.col("lang") == "fr",
              F.concat(F.date_format(published, clock), F.lit(".000000+00:00")))
        .otherwise(F.concat(F.date_format(published, clock), F.lit("Z")))
        .alias("published_at"),
        F.when(F.col("source") != "src1",
               F.concat("text", F.lit(" [+"), "n_chars", F.lit(" chars]"))).alias("content"),
        arrival.alias("arrival"),
        F.when(over_three_lines, F.lit("business")).otherwise(F.lit("general")).alias("category"),
        F.col("lang").alias("language"),
        F.col("doc_id").alias("position"),
        *extra,
    )


def bronze_news(documents: DataFrame) -> DataFrame:
    """Documents as articles: first line as title, second as description.

    Equal texts share a url. Stubs are withdrawn, long unbroken texts have no
    title, and texts of one line have no readable date.
    """
    return _bronze_news(documents)


def _bronze_news(documents: DataFrame, *extra: str) -> DataFrame:
    return _articles(documents, *extra).select(
        *NEWS_PAYLOAD.fieldNames(),
        F.col("arrival").alias("kafka_timestamp"),
        F.lit(0).alias("kafka_partition"),
        F.col("position").alias("kafka_offset"),
        *extra,
    )


def raw_articles(documents: DataFrame) -> DataFrame:
    """Documents as a feed would deliver them; texts of many lines are business."""
    return _articles(documents).select(
        F.struct(F.col("source_name").alias("name")).alias("source"),
        "author", "title", "description", "url",
        F.col("published_at").alias("publishedAt"),
        "content", "category", "language", "position",
    )


def _envelope(bronze: DataFrame, payload: StructType, key: Column, topic: str, *extra: str) -> DataFrame:
    return to_messages(
        bronze, payload, key, topic,
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        *extra,
    )


def price_envelope(bars: DataFrame) -> DataFrame:
    return _envelope(bronze_prices(bars), PRICE_PAYLOAD, price_key(), PRICES_TOPIC)


def news_envelope(documents: DataFrame) -> DataFrame:
    return _envelope(bronze_news(documents), NEWS_PAYLOAD, news_key(), NEWS_TOPIC)


def broken_news_envelope(documents: DataFrame) -> DataFrame:
    """News messages as a faulty sender leaves them: by language, values are missing, not JSON or foreign."""
    bronze = _bronze_news(documents, "lang", "text").filter(F.col("kafka_offset").isNotNull())
    good = _envelope(bronze, NEWS_PAYLOAD, news_key(), NEWS_TOPIC, "lang", "text")
    value = (
        F.when(F.col("lang") == "fr", F.col("text").cast("binary"))
        .when((F.col("lang") == "de") & (F.length("text") % 2 == 0), F.lit(None).cast("binary"))
        .when(F.col("lang") == "de", F.to_json(F.struct(F.col("text").alias("other"))).cast("binary"))
        .otherwise(F.col("value"))
    )
    return good.withColumn("value", value).drop("lang", "text")
