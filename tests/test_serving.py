from __future__ import annotations

import datetime as dt

import pytest
from helpers import price_rows, ts
from pyspark.sql import functions as F

from tickstream.operators import bars, serving
from tickstream.sources.tables import (
    Lake,
    TableNotFound,
    default_format,
    read_gold,
    read_table,
    row_counts,
    sql_path,
    table_exists,
    write_table,
)

DAILY = ("ticker string, bar_date date, open double, high double, low double, close double, "
         "volume bigint")


def daily(spark, *rows):
    return spark.createDataFrame(
        [(t, dt.date.fromisoformat(d), c, c + 1, c - 1, c, 1000) for t, d, c in rows], DAILY
    )


def test_daily_bars(spark):
    df = price_rows(spark, list(range(1, 31))).withColumns({
        "open": F.col("volume").cast("double"), "close": F.col("volume") + 0.5,
    })
    first, second = bars.daily_bars(df).orderBy("bar_date").collect()
    assert (first.open, first.close, first.volume) == (1.0, 24.5, sum(range(1, 25)))
    assert (second.open, second.close, second.volume) == (25.0, 30.5, sum(range(25, 31)))
    assert first.bar_date == dt.date(1970, 1, 1)


def test_recent_daily_bars(spark):
    df = daily(spark, *[("A", f"2026-04-{d:02d}", float(d)) for d in range(1, 9)],
               ("B", "2026-04-01", 1.0))
    got = bars.recent_daily_bars(df).orderBy("ticker", "rank").collect()
    assert [(r.ticker, r.rank, r.bar_date.day) for r in got] == [
        ("A", 1, 8), ("A", 2, 7), ("A", 3, 6), ("A", 4, 5), ("A", 5, 4), ("B", 1, 1)
    ]


def test_price_snapshot(spark):
    df = daily(
        spark,
        ("A", "2025-04-23", 500.0), ("A", "2025-04-25", 90.0), ("A", "2026-04-23", 10.0),
        ("A", "2026-04-24", 11.0),
        ("one", "2026-04-24", 5.0),
        ("zero", "2026-04-23", 0.0), ("zero", "2026-04-24", 5.0),
    )
    snap = serving.price_snapshot(df)
    rows = {r.ticker: r for r in snap.collect()}
    a = rows["A"]
    assert (a.close, a.prev_close, a.change) == (11.0, 10.0, 1.0)
    assert a.change_pct == pytest.approx(10.0)
    assert (a.year_high, a.year_low) == (91.0, 9.0)
    assert rows["one"].change is None
    assert rows["zero"].change == 5.0
    assert rows["zero"].change_pct is None

    text = {r.ticker: r for r in serving.snapshot_text(snap).collect()}
    assert text["A"].daily_change == "+1.00 (+10.00%)"
    assert text["A"].volume == "1,000"
    assert text["A"].latest_close == "USD 11.00"
    assert text["ONE"].daily_change == ""
    assert text["ZERO"].daily_change == "+5.00"


def test_price_answers(spark):
    snap = serving.price_snapshot(
        daily(spark, ("Nv", "2026-04-23", 1000.0), ("Nv", "2026-04-24", 1500.0))
    )
    asked = spark.createDataFrame([(" nv",), ("NV",), ("x",)], "ticker string")
    got = {r.ticker: r.answer for r in serving.price_answers(asked, snap).collect()}
    assert got == {
        "NV": "Ticker: NV\nLatest Close: USD 1500.00\nDaily Change: +500.00 (+50.00%)\n"
              "Volume: 1,000\nHigh: USD 1501.00 | Low: USD 1499.00\n"
              "52-Week High: USD 1501.00 | Low: USD 999.00\n",
        "X": "No price data available for X. Market may be closed.",
    }


def test_snapshot_of_named_tickers_and_day(spark):
    df = daily(spark, ("Nv", "2026-04-23", 1.0), ("Nv", "2026-04-24", 2.0),
               ("X", "2026-04-24", 1.0))
    (row,) = serving.price_snapshot(df, [" nv "]).collect()
    assert (row.ticker, row.close) == ("Nv", 2.0)
    as_of = F.lit(ts("2026-04-23T10:00:00"))
    (row,) = serving.price_snapshot(df, as_of=as_of).collect()
    assert (row.ticker, row.close) == ("Nv", 1.0)
    assert serving.price_snapshot(df, ["none"]).count() == 0


def test_latest_rows(spark):
    flags = spark.createDataFrame(
        [(f"T{i}", i % 4 == 0, ts(f"2026-04-{i % 27 + 1:02d}T00:00:00")) for i in range(60)],
        "ticker string, is_anomaly boolean, bar_time_ts timestamp",
    )
    got = serving.latest_anomalies(flags).collect()
    assert len(got) == 20
    assert [r.is_anomaly for r in got] == [True] * 15 + [False] * 5
    flagged = [(r.bar_time_ts, r.ticker) for r in got if r.is_anomaly]
    assert flagged == sorted(flagged, key=lambda x: (-x[0].timestamp(), x[1]))
    days = spark.range(1, 25).select(F.date_add(F.lit(dt.date(2026, 1, 1)), F.col("id").cast("int"))
                                     .alias("published_date"))
    got = serving.latest_attention(days).collect()
    assert [r.published_date.day for r in got] == list(range(25, 15, -1))


def test_top_rows_are_taken_without_a_full_sort(spark):
    flags = price_rows(spark, [1, 2]).withColumn("is_anomaly", F.lit(True))
    plan = serving.latest_anomalies(flags)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_render(spark):
    assert serving.render(spark.range(0), 5, "no data yet") == "no data yet"
    assert serving.render(spark.range(3), 2, "").split() == ["id", "0", "1"]


def test_tables(spark, tmp_path):
    lake = Lake(str(tmp_path))
    path = lake.gold("gold_daily_sentiment")
    assert not table_exists(spark, path, "parquet")
    with pytest.raises(TableNotFound, match="no table"):
        read_gold(spark, lake, "daily_sentiment", "parquet")
    with pytest.raises(ValueError, match="daily_sentiment"):
        read_gold(spark, lake, "secrets")
    assert write_table(spark.range(5), path, "parquet") == 5
    # A second run replaces rows and schema.
    assert write_table(spark.range(3).withColumnRenamed("id", "n"), path, "parquet") == 3
    out = read_gold(spark, lake, "daily_sentiment", "parquet")
    assert out.columns == ["n"]
    assert out.count() == 3
    assert table_exists(spark, path, "parquet")
    assert spark.sql(f"SELECT sum(n) AS s FROM {sql_path(path, 'parquet')}").first().s == 3
    assert default_format() in ("delta", "parquet")
    assert read_table(spark, path, "parquet").count() == 3


def test_row_counts(spark):
    got = row_counts({"a": spark.range(3), "b": spark.range(0)}).collect()
    assert {r.stage: r.n_rows for r in got} == {"a": 3, "b": 0}
