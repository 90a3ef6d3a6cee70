from __future__ import annotations

import json

from helpers import column, now, ts, utc
from pyspark.sql import Row
from pyspark.sql import functions as F

from tickstream.constants import NEWS_TOPIC, PRICES_TOPIC
from tickstream.operators import articles, bars
from tickstream.operators.envelope import news_key, parse_messages, price_key, to_messages
from tickstream.plans.ingest import news_messages, price_messages
from tickstream.schemas import ENVELOPE, NEWS_PAYLOAD, PRICE_PAYLOAD, RAW_ARTICLE, RAW_BAR
from tickstream.sources import kafka, landing


def article(position, **given):
    base = dict(source=Row(name="Wire"), author="a", title=f"t{position}", description="d",
                url=f"u{position}", publishedAt="2026-04-24T03:45:55Z", content="c",
                category="business", language="en", position=position)
    return tuple((base | given).values())


def feed_rows(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_ARTICLE)


def test_cycle_feeds(spark):
    df = feed_rows(
        spark,
        article(1, title="NVIDIA up as stock rallies"),
        article(2, title="Apple", description="earnings beat", category="tech"),
        article(3, title="Apple earnings", category="tech",
                publishedAt="2026-04-22T23:59:59Z"),
        article(4, title="Apple earnings", category="tech", language="de"),
        article(5, title="Apple earnings; NVIDIA stock", publishedAt="2026-04-23T00:00:00Z"),
        article(6, title="Weather", publishedAt=None),
    )
    got = articles.cycle_feeds(df, now()).select("feed", "position").collect()
    assert sorted((r.feed, r.position) for r in got) == [
        (0, 1), (0, 5), (0, 6), (1, 1), (1, 5), (2, 2), (2, 5)
    ]


def test_normalise_articles_keeps_first_of_a_url(spark):
    df = feed_rows(
        spark,
        article(1, url="x", title="second feed"),
        article(2, url="x", title="later"),
        article(3, url="x", title="earlier"),
        article(4, title=""),
        article(5, title=None),
        article(6, title="[Removed]"),
        article(7, url=None),
        article(8, source=None),
    ).withColumn("feed", F.when(F.col("position") == 1, 1).otherwise(0)).withColumn(
        "position", F.when(F.col("position") == 3, 0).otherwise(F.col("position"))
    )
    out = articles.normalise_articles(df, now())
    assert out.columns == NEWS_PAYLOAD.fieldNames()
    rows = {r.url: r for r in out.collect()}
    assert set(rows) == {"x", "u8"}
    assert rows["x"].title == "earlier"
    assert rows["x"].source_name == "Wire"
    assert rows["u8"].source_name is None
    assert rows["x"].ingested_at == "2026-04-24T12:00:00.000000+00:00"


def test_page_sizes(spark):
    rows = [article(i, publishedAt=f"2026-04-24T03:{i:02d}:00Z") for i in range(30)]
    df = feed_rows(spark, *rows)
    feeds = df.withColumn("feed", F.explode(F.array(F.lit(0), F.lit(1))))
    got = articles.page(feeds).collect()
    assert sorted(r.position for r in got if r.feed == 0) == list(range(20))
    assert sorted(r.position for r in got if r.feed == 1) == list(range(20, 30))


def test_normalise_bars(spark):
    at = ts("2026-04-24T09:30:00")
    df = spark.createDataFrame(
        [("NVDA", at, 1.00005, 2.0, 0.5, 1.23456, 7.0), ("XXX", at, 1.0, 2.0, 0.5, 1.0, 7.0)],
        RAW_BAR,
    )
    out = bars.normalise_bars(df, as_of=now())
    assert out.columns == PRICE_PAYLOAD.fieldNames()
    (row,) = out.collect()
    assert row.bar_time == "2026-04-24T09:30:00+00:00"
    assert (row.open, row.close, row.volume) == (1.0001, 1.2346, 7)
    assert bars.normalise_bars(df, tickers=None).count() == 2


def test_messages_round_trip(spark):
    row = ("2026", "NVDA", "2026-04-24T09:30:00+00:00", 1.0, 2.0, 0.5, None, 7)
    df = spark.createDataFrame([row], PRICE_PAYLOAD)
    (message,) = to_messages(df, PRICE_PAYLOAD, price_key(), PRICES_TOPIC).collect()
    assert bytes(message.key) == b"NVDA|2026-04-24T09:30:00+00:00"
    assert message.topic == PRICES_TOPIC
    assert json.loads(bytes(message.value)) == dict(
        zip(PRICE_PAYLOAD.fieldNames(), row, strict=True)
    )


def test_cycle_messages(spark):
    df = feed_rows(spark, *[article(i, title="Apple earnings") for i in range(25)])
    out = news_messages(df, now())
    assert out.columns == ["key", "value", "topic"]
    assert out.count() == 25
    # Headlines 0-19, and the first ten of the equally new search hits.
    keys = {bytes(r.key).decode() for r in news_messages(df, now(), paged=True).collect()}
    assert keys == {f"u{i}" for i in range(20)}
    bar = spark.createDataFrame(
        [("NVDA", ts("2026-04-24T09:30:00"), 1.0, 2.0, 0.5, 1.2, 7.0)], RAW_BAR
    )
    (message,) = price_messages(bar).collect()
    assert message.topic == PRICES_TOPIC


def test_news_key_is_url(spark):
    df = spark.createDataFrame([("i", "s", "a", "t", "d", "http://x/é", "p", "c")], NEWS_PAYLOAD)
    (message,) = to_messages(df, NEWS_PAYLOAD, news_key(), NEWS_TOPIC).collect()
    assert bytes(message.key).decode() == "http://x/é"


def envelope(spark, *values):
    at = ts("2026-04-24T09:30:00")
    rows = [(b"k", None if v is None else v.encode(), "t", 3, i, at, 0)
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE)


def test_parse_messages(spark):
    df = envelope(
        spark, '{"ticker":"X"}', "oops", '{"ticker":"X","volume":"zz"}', '{"volume":1.5}', None,
        '{"ticker":"X","volume":5,"extra":1}',
    )
    out = parse_messages(df, PRICE_PAYLOAD, now(), keep_raw=True).orderBy("kafka_offset")
    rows = out.collect()
    assert [r.ticker for r in rows] == ["X", None, "X", None, None, "X"]
    assert [r.volume for r in rows] == [None, None, None, None, None, 5]
    assert all(v is None for v in rows[1][:8])
    assert rows[1].raw_value == "oops"
    assert rows[1].kafka_partition == 3
    assert utc(rows[1].kafka_timestamp) == "2026-04-24 09:30:00.000000"
    assert parse_messages(df, PRICE_PAYLOAD).columns == [
        *PRICE_PAYLOAD.fieldNames(), "kafka_timestamp", "kafka_partition", "kafka_offset",
        "spark_written_at",
    ]


def test_landing_files_declare_their_schema(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"source":{"name":"Wire"},"title":"t","url":"u","position":1}\n{"title":"no source"}\n'
    )
    df = landing.read_articles(spark, str(tmp_path))
    assert df.columns == RAW_ARTICLE.fieldNames()
    assert sorted(column(df.select("source.name"), "name"), key=str) == [None, "Wire"]
    (tmp_path / "bars").mkdir()
    (tmp_path / "bars" / "b.json").write_text(
        '{"ticker":"A","bar_time_ts":"2026-04-24T03:00:00.000Z","open":1.0,"volume":2}\n'
    )
    (bar,) = landing.read_bars(spark, str(tmp_path / "bars")).collect()
    assert (bar.ticker, bar.volume, bar.close) == ("A", 2, None)


def test_kafka_options():
    plain = kafka.connection_options("broker:1")
    assert plain == {"kafka.bootstrap.servers": "broker:1"}
    secure = kafka.connection_options("broker:1", "key", "secret")
    assert secure["kafka.security.protocol"] == "SASL_SSL"
    assert secure["kafka.sasl.mechanism"] == "PLAIN"
    assert secure["kafka.ssl.endpoint.identification.algorithm"] == "https"
    assert 'username="key" password="secret";' in secure["kafka.sasl.jaas.config"]
    options = kafka.source_options(secure)
    assert options["startingOffsets"] == "latest"
    assert options["failOnDataLoss"] == "false"
    assert "maxOffsetsPerTrigger" not in options
    assert "minPartitions" not in options
    backfill = kafka.source_options(plain, "earliest", True, 1000, 64)
    assert backfill["minPartitions"] == "64"
    assert backfill["startingOffsets"] == "earliest"
    assert backfill["failOnDataLoss"] == "true"
    assert backfill["maxOffsetsPerTrigger"] == "1000"
