"""Price bars: shaping for ingest and the daily roll-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickstream.constants import RECENT_DAILY_BARS, TICKERS
from tickstream.functions.text import normal_ticker
from tickstream.functions.times import iso_string, stamp
from tickstream.operators.dedup import ARRIVAL, one_per_key, top_per_group
from tickstream.schemas import PRICE_PAYLOAD


def normalise_bars(bars: DataFrame, tickers: Sequence[str] | None = TICKERS,
                   as_of: Column | None = None) -> DataFrame:
    """Bars of the tracked tickers in payload form; ``tickers=None`` tracks all."""
    tracked = bars if tickers is None else bars.filter(F.col("ticker").isin(list(tickers)))
    return tracked.select(
        iso_string(stamp(as_of), micros=True).alias("ingested_at"),
        "ticker",
        iso_string(F.col("bar_time_ts")).alias("bar_time"),
        *[F.round(c, 4).alias(c) for c in ("open", "high", "low", "close")],
        F.col("volume").cast("bigint").alias("volume"),
    ).select(*PRICE_PAYLOAD.fieldNames())


def settled_bars(prices: DataFrame) -> DataFrame:
    """One row per ticker and instant: what the latest poll saw.

    Silver keys bars by the text of their time, so a bar whose time was spelled in two
    ways is there twice. Tickers are compared, and returned, in upper case without
    surrounding blanks. Bars without a readable time are left out.
    """
    named = prices.filter(F.col("bar_time_ts").isNotNull()).withColumn(
        "ticker", normal_ticker(F.col("ticker")))
    return one_per_key(named, ["ticker", "bar_time_ts"], ARRIVAL, keep="last")


def daily_bars(prices: DataFrame) -> DataFrame:
    """One bar per ticker and day from finer bars (columns as in silver prices).

    Bars that carry their arrival, as silver prices do, are settled first, so polls of
    one bar count once. Without arrival columns bar times should be distinct per ticker.
    All aggregates have fixed-width buffers, so they hash-aggregate before the
    shuffle and a crowded ticker costs one row per task and day.
    """
    if set(ARRIVAL) <= set(prices.columns):
        prices = settled_bars(prices)
    ts = F.col("bar_time_ts")
    return (
        prices.filter(ts.isNotNull())
        .groupBy("ticker", F.to_date(ts).alias("bar_date"))
        .agg(
            F.min_by("open", ts).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", ts).alias("close"),
            F.sum("volume").alias("volume"),
        )
    )


def recent_daily_bars(daily: DataFrame, n: int = RECENT_DAILY_BARS) -> DataFrame:
    """The last ``n`` daily bars of every ticker, newest first as rank 1."""
    return top_per_group(daily, ["ticker"], [F.col("bar_date").desc()], n)
