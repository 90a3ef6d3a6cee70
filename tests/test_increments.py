"""Increments: the rows of a full run from new rows only."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import SF_DIR
from helpers import bronze_news, bronze_prices, now, ts
from pyspark.sql import functions as F

from tickstream import fixtures as fx
from tickstream.operators import keyindex
from tickstream.operators.gold import daily_sentiment, day_sources, merged_sentiment, price_anomaly_flags
from tickstream.operators.reopen import reopened_days
from tickstream.operators.silver import silver_news, silver_prices
from tickstream.plans.batch import run_batch
from tickstream.plans.increments import apply_news, apply_prices, start_increments
from tickstream.session import work_path
from tickstream.sources.tables import Lake, read_gold, read_table
from tickstream.streaming.ingest import run_to_end
from tickstream.streaming.triggers import Trigger


def _bars(spark, hours, ticker="A", start="2026-01-01T00:00:00", offset=0):
    base = ts(start).timestamp()
    return bronze_prices(spark, *[{
        "ticker": ticker, "bar_time": np.datetime_as_string(np.datetime64(int(base + 3600 * h), "s")) + "Z",
        "volume": int(10 + h * 37 % 11), "high": 3.0 + h % 5, "kafka_offset": offset + k,
    } for k, h in enumerate(hours)])


def _rows(df):
    df = df.drop("gold_processed_at", "silver_processed_at")
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def _flags(spark, lake):
    return read_gold(spark, lake, "price_anomaly_flags", "parquet")


def test_late_bars_reopen_only_what_they_reach(spark):
    lake = Lake(work_path(spark, "lake"))
    first = _bars(spark, [h for h in range(0, 24 * 20) if h != 24 * 5 + 3]).unionByName(
        _bars(spark, range(0, 24 * 20, 7), "B"))
    apply_prices(spark, lake, first, 0, "parquet", as_of=F.lit(ts("2026-02-01T00:00:00")))
    late = _bars(spark, [24 * 5 + 3])
    apply_prices(spark, lake, late, 1, "parquet", as_of=F.lit(ts("2026-02-02T00:00:00")))
    got = _flags(spark, lake)
    want = price_anomaly_flags(silver_prices(first.unionByName(late)))
    assert _rows(got) == _rows(want)
    # 19 bars behind the late one end within its day, so no other day of its ticker was written.
    again = {(r["ticker"], str(r["bar_date"])) for r in
             got.filter(F.col("gold_processed_at") == F.lit(ts("2026-02-02T00:00:00"))).collect()}
    assert again == {("A", "2026-01-06"), ("A", "2026-01-07")} or again == {("A", "2026-01-06")}


def test_days_around_gaps_are_found(spark):
    def days(*rows):
        return spark.createDataFrame([("A", *r) for r in rows], "ticker string, d string, rows long, touched boolean"
                                     ).select("ticker", F.to_date("d").alias("bar_date"), "rows", "touched")
    table = days(("2026-01-01", 10, False), ("2026-01-02", 10, False), ("2026-01-05", 1, False),
                 ("2026-02-01", 3, True), ("2026-03-01", 10, False), ("2026-03-02", 9, False),
                 ("2026-03-03", 5, False), ("2026-03-04", 5, False))
    got = {str(r["bar_date"])[5:]: r["reopen"] for r in reopened_days(table, 19).collect()}
    # 19 bars lie between the new ones and 03-03; before them are 1 + 10 bars, so 01-01 is needed too.
    assert got == {"01-01": False, "01-02": False, "01-05": False, "02-01": True, "03-01": True, "03-02": True}


def test_an_increment_can_be_repeated_and_none_be_overtaken(spark):
    lake = Lake(work_path(spark, "lake"))
    parts = [_bars(spark, range(0, 30)), _bars(spark, range(30, 50), offset=30), _bars(spark, [12, 60, 61], offset=50)]
    for number, part in enumerate(parts):
        apply_prices(spark, lake, part, number, "parquet")
        once = _rows(_flags(spark, lake)), _rows(read_table(spark, lake.silver("prices"), "parquet"))
        apply_prices(spark, lake, part, number, "parquet")
        assert once == (_rows(_flags(spark, lake)), _rows(read_table(spark, lake.silver("prices"), "parquet")))
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert _rows(_flags(spark, lake)) == _rows(price_anomaly_flags(silver_prices(whole)))
    with pytest.raises(ValueError):
        apply_prices(spark, lake, parts[1], 1, "parquet")


def test_increments_without_rows_or_times(spark):
    lake = Lake(work_path(spark, "lake"))
    none = _bars(spark, range(3)).filter("false")
    assert apply_prices(spark, lake, none, 0, "parquet")["silver_prices"] == 0
    odd = bronze_prices(spark, {"bar_time": "n/a"}, {"bar_time": "n/a"}, {"close": None})
    assert apply_prices(spark, lake, odd, 1, "parquet") == {"silver_prices": 1, "price_anomaly_flags": 0}
    assert apply_prices(spark, lake, odd, 2, "parquet")["silver_prices"] == 0
    assert apply_prices(spark, lake, _bars(spark, range(25)), 3, "parquet")["price_anomaly_flags"] == 25
    assert apply_news(spark, lake, bronze_news(spark, {"url": None}), 0, "parquet")["silver_news"] == 0


def test_a_lake_of_full_runs_is_not_taken_over(spark):
    lake = Lake(work_path(spark, "lake"))
    _bars(spark, range(5)).write.parquet(lake.bronze("prices"))
    bronze_news(spark, {}).write.parquet(lake.bronze("news"))
    run_batch(spark, lake, "parquet")
    with pytest.raises(ValueError):
        apply_prices(spark, lake, _bars(spark, [7]), 0, "parquet")


def test_urls_are_checked_exactly_when_filters_say_yes(spark, monkeypatch):
    # With one bit a key most unknown keys are held for known.
    monkeypatch.setattr("tickstream.plans.increments.build_filters", lambda keys: keyindex.build_filters(keys, 1))
    lake = Lake(work_path(spark, "lake"))
    news = [{"url": f"u{k}", "title": f"t{k}", "source_name": f"s{k % 3}", "kafka_offset": k,
             "kafka_timestamp": ts(f"2026-04-{10 + k % 5}T00:00:00")} for k in range(400)]
    first, second = bronze_news(spark, *news[:250]), bronze_news(spark, *news[200:], {"url": "none", "kafka_timestamp": None})
    assert apply_news(spark, lake, first, 0, "parquet")["silver_news"] == 250
    counts = apply_news(spark, lake, second, 1, "parquet")
    assert counts["silver_news"] == 151 and counts["possible_urls"] > 60
    table = read_table(spark, lake.silver("news"), "parquet")
    urls = [r["url"] for r in table.select("url").collect()]
    assert sorted(urls) == sorted({*urls}) and len(urls) == 401
    want = daily_sentiment(silver_news(first.unionByName(second)))
    got = read_gold(spark, lake, "daily_sentiment", "parquet")
    assert _rows(got.drop("last_updated")) == _rows(want.drop("last_updated"))
    assert apply_news(spark, lake, bronze_news(spark, {"url": "none"}), 2, "parquet")["silver_news"] == 0


def test_new_urls_read_no_day_of_silver(spark):
    keys = spark.range(3000).select(F.to_date(F.lit("2026-01-01")).alias("day"), *keyindex.key_hashes("id"))
    filters = keyindex.build_filters(keys)
    asked = spark.range(2900, 6000).select(*keyindex.key_hashes("id"))
    found = keyindex.possible_days(asked, filters, 3100).select("k1", "k2").distinct().count()
    assert 100 <= found <= 103
    # Several parts of the keys meet the same filters.
    many = keyindex.possible_days(asked, filters, 200 * keyindex.SHARDS * keyindex.FILTER_KEYS)
    assert many.select("k1", "k2").distinct().count() == found


def test_filters_are_of_bounded_size(spark, monkeypatch):
    keys = spark.range(10_000).coalesce(1).select(F.to_date(F.lit("2026-01-01")).alias("day"), *keyindex.key_hashes("id"))
    assert keyindex.build_filters(keys).agg(F.max(F.octet_length("bits"))).first()[0] < 24 * 400
    assert keyindex.build_filters(keys).count() == keyindex.SHARDS


def test_days_merge_exactly(spark):
    news = silver_news(fx.bronze_news(fx.load(spark, SF_DIR, "documents")), as_of=now())
    parts = [day_sources(news.filter(F.pmod("kafka_offset", F.lit(3)) == k)) for k in range(3)]
    merged = merged_sentiment(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert _rows(merged) == _rows(daily_sentiment(news))


def test_bronze_tables_as_streams_of_increments(spark):
    lake = Lake(work_path(spark, "lake"))
    parts = [_bars(spark, range(0, 30)), _bars(spark, [29, *range(31, 55)], offset=30), _bars(spark, [30], offset=90)]
    seen = []
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(lake.bronze("prices"))
        run_to_end([start_increments(spark, lake, "prices", "parquet", Trigger(available=True),
                                     report=lambda n, c: seen.append((n, c["silver_prices"])))])
    assert seen == [(0, 30), (1, 24), (2, 1)]
    whole = silver_prices(read_table(spark, lake.bronze("prices"), "parquet"))
    assert _rows(_flags(spark, lake)) == _rows(price_anomaly_flags(whole))
