"""Which days of a series new rows change, when statistics look back over a number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickstream.operators.dedup import top_per_group

ORDER = ("bar_time_ts", "open", "high", "low", "close", "volume")
BAR = ("ticker", *ORDER, "price_range")


def series_tails(rows: DataFrame, carry: int) -> DataFrame:
    """The last ``carry`` rows of every ticker, narrowed down before anything is moved."""
    last = [F.col(c).desc() for c in ORDER]
    return top_per_group(rows.select(*BAR), ["ticker"], last, carry, "_rank").drop("_rank")


def reopened_days(days: DataFrame, carry: int) -> DataFrame:
    """(ticker, bar_date, reopen) for all days of which rows are needed.

    ``days`` has one row per ticker and day with its ``rows``, and ``touched`` where some of
    them are new. A row changes when a new one is among the ``carry`` rows before it: such
    days are re-opened. Days with some of the ``carry`` rows before a re-opened day are context. A
    ticker has one row per calendar day here, which bounds the window.
    """
    series = Window.partitionBy("ticker").orderBy("bar_date")
    before = series.rowsBetween(Window.unboundedPreceding, -1)
    after = series.rowsBetween(1, Window.unboundedFollowing)
    placed = days.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0))).withColumn(
        "end", F.col("start") + F.col("rows"))
    touched_end = F.last(F.when(F.col("touched"), F.col("end")), ignorenulls=True).over(before)
    opened = placed.withColumn(
        "reopen", F.col("touched") | F.coalesce(F.col("start") - touched_end < carry, F.lit(False)))
    open_start = F.first(F.when(F.col("reopen"), F.col("start")), ignorenulls=True).over(after)
    context = F.coalesce(open_start - F.col("end") < carry, F.lit(False))
    return opened.withColumn("context", context).where("reopen OR context").select("ticker", "bar_date", "reopen")
