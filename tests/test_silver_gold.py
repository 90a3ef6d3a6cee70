from __future__ import annotations

import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from helpers import bronze_news, bronze_prices, column, now, price_rows, ts, utc
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickstream.operators import gold, rolling, silver
from tickstream.operators.dedup import one_per_key, top_of_few_groups, top_per_group
from tickstream.schemas import GOLD_ANOMALY_COLUMNS, GOLD_SENTIMENT_COLUMNS


# News ---------------------------------------------------------------------


def test_news_validity(spark):
    df = bronze_news(
        spark, {"url": "1"}, {"url": "2", "title": None}, {"url": None},
        {"url": "4", "title": "[Removed]"}, {"url": "5", "title": ""},
    )
    assert sorted(column(silver.silver_news(df), "url")) == ["1", "5"]


def test_first_seen_article_stays(spark):
    early, late = ts("2026-04-24T04:00:00"), ts("2026-04-24T05:00:00")
    df = bronze_news(
        spark,
        {"title": "late", "kafka_timestamp": late, "kafka_offset": 1},
        {"title": "tie", "kafka_timestamp": early, "kafka_offset": 9},
        {"title": "first", "kafka_timestamp": early, "kafka_offset": 3},
        {"title": "other partition", "kafka_timestamp": early, "kafka_offset": 1,
         "kafka_partition": 1},
    )
    assert column(silver.silver_news(df), "title") == ["first"]


def test_news_times(spark):
    df = bronze_news(
        spark, {"url": "1"}, {"url": "2", "published_at": "2026-04-24T03:45:55+02:00"},
        {"url": "3", "published_at": "yesterday", "ingested_at": None},
    )
    out = {r.url: r for r in silver.silver_news(df, now()).collect()}
    assert utc(out["1"].published_at_ts) == "2026-04-24 03:45:55.000000"
    assert utc(out["2"].published_at_ts) == "2026-04-24 01:45:55.000000"
    assert out["3"].published_at_ts is None
    assert out["3"].ingested_at_ts is None
    assert utc(out["1"].ingested_at_ts) == "2026-04-24 04:00:00.123456"
    assert utc(out["1"].silver_processed_at) == "2026-04-24 12:00:00.000000"


def test_dedup_is_idempotent_and_order_free(spark):
    rng = random.Random(3)
    rows = [{"url": f"u{rng.randrange(20)}", "title": f"t{i}", "kafka_offset": i,
             "kafka_timestamp": ts(f"2026-04-24T04:{rng.randrange(60):02d}:00")}
            for i in range(200)]
    once = silver.silver_news(bronze_news(spark, *rows))
    rng.shuffle(rows)
    again = silver.silver_news(bronze_news(spark, *rows))
    titles = sorted(column(once, "title"))
    assert titles == sorted(column(again, "title"))
    twice = silver.silver_news(once.select(bronze_news(spark, {}).columns))
    assert titles == sorted(column(twice, "title"))


def test_keep_rejects_other_words(spark):
    with pytest.raises(ValueError, match="keep"):
        one_per_key(spark.range(1), ["id"], ["id"], "any")


def test_top_of_few_groups(spark):
    df = spark.range(5000).select("id", (F.col("id") * 7919 % 1000).alias("v"),
                                  F.when(F.col("id") % 3 == 0, "hot").otherwise("b").alias("g"))
    order = [F.desc("v"), F.asc("id")]
    whole = top_per_group(df, ["g"], order, 12).orderBy("g", "rank").collect()
    salted = top_of_few_groups(df, ["g"], order, 12, ["id"], salts=8)
    assert salted.orderBy("g", "rank").collect() == whole


def test_rank_filter_runs_before_the_shuffle(spark):
    plan = silver.silver_news(bronze_news(spark, {}))._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


# Prices -------------------------------------------------------------------


def test_price_validity_and_range(spark):
    df = bronze_prices(
        spark, {}, {"ticker": "B", "close": None}, {"ticker": None}, {"bar_time": None},
        {"ticker": "C", "bar_time": "soon"},
    )
    out = {r.ticker: r for r in silver.silver_prices(df).collect()}
    assert set(out) == {"A", "C"}
    assert out["A"].price_range == 2.5
    assert utc(out["A"].bar_time_ts) == "2026-04-24 03:00:00.000000"
    assert out["C"].bar_time_ts is None


def test_keep_first_or_last_snapshot(spark):
    df = bronze_prices(
        spark, {"volume": 1}, {"volume": 2, "kafka_timestamp": ts("2026-04-24T05:00:00")}
    )
    assert column(silver.silver_prices(df), "volume") == [1]
    assert column(silver.silver_prices(df, keep="last"), "volume") == [2]


def test_one_instant_spelled_twice(spark):
    df = bronze_prices(
        spark, {}, {"bar_time": "2026-04-24T05:00:00+02:00", "kafka_offset": 1},
        {"bar_time": "soon"}, {"bar_time": "later"},
    )
    assert silver.silver_prices(df).count() == 4
    by_instant = silver.silver_prices(df, by_instant=True)
    assert sorted(column(by_instant, "bar_time")) == ["2026-04-24T03:00:00Z", "later", "soon"]


# Gold: anomalies ----------------------------------------------------------


def flags(spark, volumes, **kw):
    out = gold.price_anomaly_flags(price_rows(spark, volumes, **kw), as_of=now())
    assert tuple(out.columns) == GOLD_ANOMALY_COLUMNS
    return out.orderBy("bar_time_ts").collect()


@pytest.mark.parametrize("volumes, z, flagged", [
    ([7], 0.0, False),
    ([5, 5, 5, 5], 0.0, False),
    ([1, 1, 1, 1, 9], 1.789, False),
    ([1, 1, 1, 1, 1, 9], 2.041, True),
    ([9, 9, 9, 9, 9, 1], -2.041, True),
])
def test_last_bar(spark, volumes, z, flagged):
    last = flags(spark, volumes)[-1]
    assert last.volume_zscore == z
    assert last.range_zscore == 0.0
    assert last.is_anomaly is flagged


def test_range_alone_can_flag(spark):
    last = flags(spark, [5] * 6, ranges=[1.0] * 5 + [9.0])[-1]
    assert (last.volume_zscore, last.range_zscore, last.is_anomaly) == (0.0, 2.041, True)


def test_flag_uses_the_unrounded_score(spark):
    rows = price_rows(spark, [1, 1, 1, 1, 1, 9])
    exact = 5 / math.sqrt(6)
    rounded = round(exact, 3)
    at_rounded = gold.price_anomaly_flags(rows, threshold=rounded).filter("is_anomaly").count()
    assert at_rounded == (1 if exact > rounded else 0)


def test_rows_without_time_are_left_out(spark):
    df = price_rows(spark, [1, 2]).withColumn(
        "bar_time_ts", F.when(F.col("volume") == 1, F.col("bar_time_ts"))
    )
    assert gold.price_anomaly_flags(df).count() == 1


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=60))
def test_score_bound(spark, volumes):
    for i, row in enumerate(flags(spark, volumes)):
        n = min(i + 1, 20)
        assert abs(row.volume_zscore) <= (n - 1) / math.sqrt(n) + 1e-3
        assert n >= 6 or not row.is_anomaly


def series(spark, rng, lengths):
    frames = []
    for t, length in lengths.items():
        frames.append(price_rows(
            spark, [rng.randrange(1000) for _ in range(length)], ticker=t,
            ranges=[rng.random() for _ in range(length)],
        ))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@pytest.mark.parametrize("split_rows", [1, 7, 19, 20, 50])
def test_cut_series_equal_the_uncut(spark, tmp_path, split_rows):
    """Long and short series, with a gap that leaves most spans empty."""
    rng = random.Random(split_rows)
    df = series(spark, rng, {"hot": 300, "warm": 60, "cold": 5}).unionByName(
        price_rows(spark, [rng.randrange(1000) for _ in range(40)], ticker="hot", start=5000)
    )
    df.write.parquet(str(tmp_path / "bars"))
    df = spark.read.parquet(str(tmp_path / "bars"))
    whole = gold.rolling_stats(df, split_rows=None).orderBy("ticker", "bar_time_ts").collect()
    cut = gold.rolling_stats(df, split_rows=split_rows).orderBy("ticker", "bar_time_ts")
    assert cut.collect() == whole


def test_cut_series_with_equal_instants(spark):
    """Rows of one instant end up in one span and keep their order."""
    rng = random.Random(1)
    df = series(spark, rng, {"hot": 120})
    df = df.unionByName(df.withColumn("open", F.col("open") + 1).withColumn(
        "volume", F.col("volume") * 2))
    whole = gold.rolling_stats(df, split_rows=None)
    cut = gold.rolling_stats(df, split_rows=10)
    keys = ("bar_time_ts", "open", "volume")
    assert cut.orderBy(*keys).collect() == whole.orderBy(*keys).collect()


def test_window_of_one_row(spark):
    df = series(spark, random.Random(4), {"a": 40})
    out = gold.rolling_stats(df, n=1, split_rows=10)
    assert out.filter("avg_volume = volume AND stddev_volume IS NULL").count() == 40


def test_bursts_are_cut_evenly(spark):
    """A burst in a long thin series, and rows without a key, fill spans of the wanted size."""
    thin, crowded = spark.range(100), spark.range(5000)
    df = thin.select(F.timestamp_seconds(F.col("id") * 86400).alias("t")).unionByName(
        crowded.select(F.timestamp_seconds(8640000 + F.col("id")).alias("t"))
    ).withColumn("ticker", F.lit("A"))
    df = df.unionByName(df.withColumn("ticker", F.lit(None).cast("string")))
    spans = rolling._ranged(df, ["ticker", "t"], 500)
    sizes = column(spans.groupBy("_span").count(), "count")
    assert sum(sizes) == 10_200
    assert max(sizes) <= 2 * 500


def test_series_without_a_key_and_of_many_lengths(spark):
    rng = random.Random(2)
    df = series(spark, rng, {"a": 40, "b": 1, "c": 60, "d": 2, "e": 3})
    lost = series(spark, rng, {"x": 70}).withColumn("ticker", F.lit(None).cast("string"))
    df = df.unionByName(lost)
    whole = gold.rolling_stats(df, split_rows=None).orderBy("ticker", "bar_time_ts").collect()
    for rows in (3, 10, 1000):
        cut = gold.rolling_stats(df, split_rows=rows).orderBy("ticker", "bar_time_ts").collect()
        assert cut == whole


# Gold: attention ----------------------------------------------------------


def test_daily_sentiment(spark):
    at = ts("2026-04-24T05:00:00")
    df = spark.createDataFrame(
        [("a", ts("2026-04-24T03:00:00"), at), (None, ts("2026-04-24T23:59:59"), at),
         ("a", ts("2026-04-24T00:00:00"), ts("2026-04-24T06:00:00")),
         ("b", ts("2026-04-25T00:00:00"), at), ("b", None, at)],
        "source_name string, published_at_ts timestamp, silver_processed_at timestamp",
    )
    out = gold.daily_sentiment(df)
    assert tuple(out.columns) == GOLD_SENTIMENT_COLUMNS
    assert out.schema["attention_score_proxy"].dataType.simpleString() == "decimal(24,2)"
    first, second = out.orderBy("published_date").collect()
    assert first.published_date == dt.date(2026, 4, 24)
    assert (first.article_count, first.source_diversity) == (3, 1)
    assert first.attention_score_proxy == Decimal("0.30")
    assert utc(first.last_updated) == "2026-04-24 06:00:00.000000"
    assert second.article_count == 1


def test_score_of_exactly_two_is_no_anomaly(spark):
    """Whole volumes give exact scores, whose last digit does not depend on the order of adding."""
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [("A", start + dt.timedelta(hours=k), 1.0, v)
            for k, v in enumerate([46, 44, 48, 33, 41, 27, 44, 13])]
    bars = spark.createDataFrame(rows, "ticker string, bar_time_ts timestamp, open double, volume bigint").selectExpr(
        "*", "open AS high", "open AS low", "open AS close", "0.0D AS price_range")
    last = gold.price_anomaly_flags(bars).orderBy(F.desc("bar_time_ts")).first()
    assert (last["volume_zscore"], last["is_anomaly"]) == (-2.0, False)
    # Values that are not whole, or too large to be squared, still have a deviation.
    for volume in ("volume + 0.5D", "volume * 1000000000000"):
        shifted = bars.withColumn("volume", F.expr(volume))
        assert abs(gold.price_anomaly_flags(shifted).orderBy(F.desc("bar_time_ts")).first()["volume_zscore"] + 2) < 1e-9
