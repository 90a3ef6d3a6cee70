"""Phrases by index, ranges over time, and readers that stop at the newest days."""

from __future__ import annotations

import datetime as dt
import random

from helpers import bronze_prices, price_rows, ts, utc
from pyspark.sql import functions as F

from tickstream.operators import phrases, serving
from tickstream.operators.gold import price_anomaly_flags
from tickstream.plans.batch import run_batch
from tickstream.plans.reports import _first_day, latest_rows, live_prices
from tickstream.session import work_path
from tickstream.sources.tables import Lake, partition_days, read_gold, read_table


def test_ten_thousand_phrases_in_one_pass(spark):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(60)]
    texts = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 25)))) for k in range(150)]
    texts += [(900, None), (901, ""), (902, "W1, w2! W1")]
    asked = {" ".join(rng.sample(vocabulary, rng.randint(1, 4))) for _ in range(10_000)}
    asked |= {"", "  ", "W1 w1", "absent w1", "w2 W1"}
    articles = spark.createDataFrame(texts, "id long, title string").withColumn("anchor", F.lit("x")).withColumn("wanted", F.lit(1))
    names = spark.createDataFrame([(p,) for p in [*asked, "w2 W1"]], "phrase string")
    out = phrases.match_phrases(articles, names, F.col("title"))
    assert out.columns == ["id", "title", "anchor", "wanted", "phrase"]
    want = set()
    for k, text in texts:
        have = set((text or "").lower().replace(",", "").replace("!", "").split())
        want |= {(k, p) for p in asked if p.split() and set(p.lower().split()) <= have}
    got = [(r["id"], r["phrase"]) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 1000
    assert phrases.match_phrases(articles, names.filter("false"), F.col("title")).count() == 0


def test_phrases_come_to_the_articles_in_blocks(spark):
    """Words of articles are never moved, and blocks of phrases give the same rows as all at once."""
    rng = random.Random(5)
    texts = [(k, " ".join(f"w{rng.randint(0, 30)}" for _ in range(12))) for k in range(80)]
    asked = {" ".join(f"w{rng.randint(0, 30)}" for _ in range(rng.randint(1, 4))) for _ in range(300)}
    articles = spark.createDataFrame(texts, "id long, title string")
    names = spark.createDataFrame([(p,) for p in asked], "phrase string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = phrases.match_phrases(articles, names, F.col("title"))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        whole = sorted(map(tuple, out.collect()))
        parts = phrases.match_phrases(articles, names, F.col("title"), block_bytes=10_000).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted(map(tuple, parts)) == whole and whole


def test_ranges_join_nothing(spark):
    """A bar moves to its own day and to the first of its range, with what it found; nothing is joined."""
    bars = spark.createDataFrame([], "ticker string, bar_time_ts timestamp, high double, low double, close double")
    out = serving.year_ranges(bars)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.columns == [*bars.columns, "year_high", "year_low"]


def test_ranges_over_bursts_gaps_and_ties(spark):
    rng = random.Random(9)
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = []
    for ticker in ("A", "B", None):
        at = start
        for _ in range(120):
            at += rng.choice([dt.timedelta(), dt.timedelta(seconds=1), dt.timedelta(hours=5), dt.timedelta(days=1),
                              dt.timedelta(days=3), dt.timedelta(days=3, seconds=-1), dt.timedelta(days=9)])
            rows.append((ticker, at, rng.randint(1, 99) * 1.0, rng.choice([None, rng.randint(1, 99) * 1.0])))
    rows.append(("A", None, 5.0, 1.0))
    bars = spark.createDataFrame(rows, "ticker string, bar_time_ts timestamp, high double, low double")
    got = {(r["ticker"], utc(r["bar_time_ts"]), r["high"], r["low"], r["year_high"], r["year_low"])
           for r in serving.year_ranges(bars, days=3).collect()}
    want = set()
    for t, at, high, low in rows:
        near = [r for r in rows if at and r[1] and r[0] == t and dt.timedelta() <= at - r[1] <= dt.timedelta(days=3)]
        near = near or [(t, at, high, low)]
        lows = [r[3] for r in near if r[3] is not None]
        want.add((t, utc(at), high, low, max(r[2] for r in near), min(lows) if lows else None))
    assert got == want


def _flags(spark, days, flagged):
    """One bar a day; ``flagged`` days stand out."""
    rows = [("A", dt.date(2026, 1, 1) + dt.timedelta(days=k), float(k), k in flagged) for k in range(days)]
    return spark.createDataFrame(rows, "ticker string, bar_date date, open double, is_anomaly boolean").withColumn(
        "bar_time_ts", F.col("bar_date").cast("timestamp"))


def test_newest_flags_read_no_more_days_than_needed(spark):
    for flagged, n in (({3, 50, 80}, 2), ({3, 50}, 20), (set(), 5), (set(range(90)), 7), ({0}, 1), ({1}, 200)):
        table = _flags(spark, 90, flagged)
        days = [r["bar_date"] for r in table.select("bar_date").collect()]
        got = [tuple(r) for r in serving.newest_anomalies(table, days, n).collect()]
        assert got == [tuple(r) for r in serving.latest_anomalies(table, n).collect()]
    path = work_path(spark, "flags")
    _flags(spark, 90, {87, 88, 89}).write.partitionBy("bar_date").parquet(path)
    days = partition_days(spark, path, "bar_date")
    assert len(days) == 90 and days == sorted(days)
    newest = serving.newest_anomalies(spark.read.parquet(path), days, 2)
    plan = newest._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "2026-03-31" in filters and "2026-01-01" not in filters
    assert [r["bar_date"].day for r in newest.collect()] == [31, 30]


def test_lake_gives_the_latest_rows_of_its_whole_table(spark):
    lake = Lake(work_path(spark, "lake"))
    volumes = [10 + (k * 37) % 7 + (500 if k % 41 == 40 else 0) for k in range(400)]
    bars = price_rows(spark, volumes)
    flags = price_anomaly_flags(bars)
    flags.write.partitionBy("bar_date").parquet(lake.gold("gold_price_anomaly_flags"))
    got = latest_rows(spark, lake, "price_anomaly_flags", "parquet")
    want = serving.latest_anomalies(read_gold(spark, lake, "price_anomaly_flags", "parquet"))
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_prices_read_two_days_and_a_year_back(spark):
    def bar(day, ticker="A", close=2.0):
        return {"ticker": ticker, "bar_time": f"{day}T15:00:00Z", "close": close, "high": close + 1,
                "kafka_timestamp": ts("2026-04-24T04:00:00")}
    lake = Lake(work_path(spark, "lake"))
    days = ["2020-01-02", "2023-05-05", "2025-12-31", "2026-01-02"]
    bronze = bronze_prices(spark, *[bar(d, close=k + 1.0) for k, d in enumerate(days)],
                           bar("2019-03-04", "B", 7.0), bar("2026-01-02", "B", 9.0), bar("2018-01-01", "C"))
    bronze.write.parquet(lake.bronze("prices"))
    from helpers import bronze_news
    bronze_news(spark, {}).write.parquet(lake.bronze("news"))
    run_batch(spark, lake, "parquet")
    silver = read_table(spark, lake.silver("prices"), "parquet")
    assert str(_first_day(silver.filter("symbol = 'A'"))) == "2025-01-03"
    # The previous bar of B is years back and still counts for its change.
    assert str(_first_day(silver.filter("symbol IN ('A', 'B')"))) == "2019-03-04"
    answers = {r["ticker"].upper(): r["answer"] for r in live_prices(spark, lake, ["a", "B", "x"], fmt="parquet").collect()}
    assert "4.00" in answers["A"] and "+2.00" in answers["B"] and len(answers) == 3
    plan = live_prices(spark, lake, ["A"], as_of=F.lit(ts("2026-01-01T00:00:00")), fmt="parquet")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    filters = text[text.index("PartitionFilters"):].split("PushedFilters")[0]
    assert "2025-12-31" in filters or "20089" in filters or ">=" in filters
    assert "<=" in filters
