"""Read-side reports over gold tables and daily bars."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickstream.constants import LATEST_ANOMALIES, LATEST_DAYS, YEAR_RANGE_DAYS
from tickstream.functions.stats import percent_change
from tickstream.functions.text import (
    money,
    no_price_text,
    normal_ticker,
    price_text,
    signed_change,
)


def latest_anomalies(flags: DataFrame, n: int = LATEST_ANOMALIES) -> DataFrame:
    """Flagged bars first, then the newest; tickers, then the bar's values break ties."""
    ties = [c for c in ("ticker", "open", "high", "low", "close", "volume") if c in flags.columns]
    return flags.orderBy(F.desc("is_anomaly"), F.desc("bar_time_ts"), *map(F.asc, ties)).limit(n)


def newest_anomalies(flags: DataFrame, days: Sequence[date], n: int = LATEST_ANOMALIES) -> DataFrame:
    """``latest_anomalies`` of a table laid out by ``bar_date``, from its newest days.

    ``days`` are the table's partitions. They are read newest first, each step twice as many,
    until there are ``n`` flagged rows; where the whole table has fewer, the newest other rows
    make up the rest in the same way. A step counts one column of the days it adds.
    """
    newest = sorted(days, reverse=True)
    flagged, missing = _newest_days(flags.filter("is_anomaly"), newest, n)
    wanted = flags.filter(F.col("is_anomaly") & F.col("bar_date").isin(flagged))
    if missing:
        others, _ = _newest_days(flags.filter("NOT is_anomaly"), newest, missing)
        wanted = wanted.unionAll(flags.filter(~F.col("is_anomaly") & F.col("bar_date").isin(others)))
    return latest_anomalies(wanted, n)


def _newest_days(rows: DataFrame, newest: Sequence[date], n: int) -> tuple[list[date], int]:
    """The newest days that hold ``n`` of the rows, and how many are missing in all days."""
    taken, step = 0, 1
    while n > 0 and taken < len(newest):
        n -= rows.filter(F.col("bar_date").isin(list(newest[taken:taken + step]))).limit(n).count()
        taken, step = taken + step, step * 2
    return list(newest[:taken]), max(n, 0)


def latest_attention(sentiment: DataFrame, n: int = LATEST_DAYS) -> DataFrame:
    return sentiment.orderBy(F.desc("published_date")).limit(n)


def price_snapshot(daily: DataFrame, tickers: Sequence[str] | None = None,
                   as_of: Column | None = None) -> DataFrame:
    """Latest daily bar of every (or every named) ticker, its change and 52-week range.

    ``as_of`` ignores later days. A ticker has one row per calendar day here, so
    its window partition is bounded by the length of its history in days. Its
    newest day is found in one pass, and the aggregation after it runs on the
    same partitioning.
    """
    if tickers is not None:
        names = [t.strip().upper() for t in tickers]
        daily = daily.filter(normal_ticker(F.col("ticker")).isin(names))
    if as_of is not None:
        daily = daily.filter(F.col("bar_date") <= F.to_date(as_of))
    newest = F.max("bar_date").over(Window.partitionBy("ticker"))
    day = F.col("bar_date")
    before = day < F.col("_newest")
    within_year = day >= F.date_sub("_newest", YEAR_RANGE_DAYS)
    return (
        daily.withColumn("_newest", newest)
        .groupBy("ticker")
        .agg(
            F.max("bar_date").alias("bar_date"),
            F.max_by("close", day).alias("close"),
            F.max_by("close", F.when(before, day)).alias("prev_close"),
            F.max_by("volume", day).alias("volume"),
            F.max_by("high", day).alias("high"),
            F.max_by("low", day).alias("low"),
            F.max(F.when(within_year, F.col("high"))).alias("year_high"),
            F.min(F.when(within_year, F.col("low"))).alias("year_low"),
        )
        .withColumns({
            "change": F.col("close") - F.col("prev_close"),
            "change_pct": percent_change(F.col("close"), F.col("prev_close")),
        })
        .select(
            "ticker", "bar_date", "close", "prev_close", "change", "change_pct",
            "volume", "high", "low", "year_high", "year_low",
        )
    )


def year_ranges(bars: DataFrame, ts: str = "bar_time_ts", days: int = YEAR_RANGE_DAYS) -> DataFrame:
    """Every bar with the highest ``high`` and lowest ``low`` of the ``days`` before it and itself.

    The range ends at the bar and begins the same time of day ``days`` earlier. It falls apart
    into the bar's own day up to the bar, the days between as one row each, and the end of the
    first day; each is found among the rows of one ticker and day, or one row per calendar day,
    so a ticker's whole history is never sorted by one task. A bar moves twice: to its own day, then,
    with what it found there, to the day in which its range begins; the days between come there
    as one row, so nothing is joined. Bars without a time have only themselves in range.
    """
    pairs = (("high", F.max), ("low", F.min))
    names = [c for c, _ in pairs]
    dated = bars.withColumn("_day", F.to_date(ts))
    timed = dated.filter(F.col(ts).isNotNull())
    own = Window.partitionBy("ticker", "_day").orderBy(ts).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    whole = timed.groupBy("ticker", "_day").agg(*[best(c).alias(f"_{c}") for c, best in pairs])
    # Day numbers instead of dates: frames by value need numbers.
    number = F.datediff("_day", F.lit("1970-01-01"))
    between = Window.partitionBy("ticker").orderBy(number).rangeBetween(-(days - 1), -1)
    first_day = F.date_sub("_day", days).alias("_day")
    asks = dated.withColumns(
        {f"_{c}_own": F.when(F.col(ts).isNotNull(), best(c).over(own)).otherwise(F.col(c)) for c, best in pairs}
    ).select(*bars.columns, F.lit(True).alias("_ask"), first_day,
             (F.unix_micros(ts) - F.lit(days * 86_400_000_000)).alias("_at"), *[f"_{c}_own" for c in names])
    full = whole.select("ticker", first_day, *[best(f"_{c}").over(between).alias(f"_{c}_between") for c, best in pairs])
    had = timed.select("ticker", "_day", F.unix_micros(ts).alias("_at"), *[F.col(c).alias(f"_{c}") for c in names])
    met = asks.unionByName(had, allowMissingColumns=True).unionByName(full, allowMissingColumns=True)
    here = Window.partitionBy("ticker", "_day")
    rest = here.orderBy("_at").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    found = met.withColumns({f"_{c}_first": best(f"_{c}").over(rest) for c, best in pairs} | {
        f"_{c}_between": best(f"_{c}_between").over(here) for c, best in pairs})
    return found.filter("_ask").select(
        *bars.columns,
        F.greatest("_high_own", "_high_between", "_high_first").alias("year_high"),
        F.least("_low_own", "_low_between", "_low_first").alias("year_low"))


def snapshot_text(snapshot: DataFrame) -> DataFrame:
    """The snapshot as display strings."""
    return snapshot.select(
        normal_ticker(F.col("ticker")).alias("ticker"),
        money(F.col("close")).alias("latest_close"),
        signed_change(F.col("change"), F.col("change_pct")).alias("daily_change"),
        F.format_number("volume", 0).alias("volume"),
        money(F.col("high")).alias("high"),
        money(F.col("low")).alias("low"),
        money(F.col("year_high")).alias("year_high"),
        money(F.col("year_low")).alias("year_low"),
    )


def price_answers(requested: DataFrame, snapshot: DataFrame) -> DataFrame:
    """One text per requested ticker: its snapshot, or a note that there is no data.

    Tickers are compared in upper case without surrounding blanks. Of several snapshots
    of one ticker the newest answers.
    """
    wanted = requested.select(normal_ticker(F.col("ticker")).alias("ticker")).distinct()
    change = signed_change(F.col("change"), F.col("change_pct"))
    texts = snapshot.select(
        normal_ticker(F.col("ticker")).alias("ticker"),
        price_text(
            normal_ticker(F.col("ticker")), F.col("close"), change, F.col("volume"),
            F.col("high"), F.col("low"), F.col("year_high"), F.col("year_low"),
        ).alias("_text"),
        F.struct(F.col("bar_date"), F.col("ticker")).alias("_order"),
    ).groupBy("ticker").agg(F.max_by("_text", "_order").alias("_text"))
    return wanted.join(texts, "ticker", "left").select(
        "ticker", F.coalesce("_text", no_price_text(F.col("ticker"))).alias("answer")
    )


def render(df: DataFrame, n: int, empty: str) -> str:
    """At most ``n`` rows as a text table, or the ``empty`` message."""
    rows = df.limit(n).toPandas()
    return empty if rows.empty else rows.to_string(index=False)
